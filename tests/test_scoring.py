import re
from collections import Counter

import numpy as np
import pytest
from conftest import plan_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.operators import rouge as R
from corpusflow.operators.bert_score import bert_score

words = st.lists(st.sampled_from("abcd"), max_size=14)


def table_lcs(a, b):
    cells = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            cells[i + 1][j + 1] = (
                cells[i][j] + 1 if x == y else max(cells[i][j + 1], cells[i + 1][j])
            )
    return cells


def walk_back(a, b):
    """The usual way back through the full table."""
    cells, i, j, places = table_lcs(a, b), len(a), len(b), []
    while i and j:
        if a[i - 1] == b[j - 1]:
            places, i, j = [i - 1, *places], i - 1, j - 1
        elif cells[i][j - 1] > cells[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return places


@settings(max_examples=300, deadline=None)
@given(words, words)
def test_bit_rows_equal_the_table(a, b):
    assert R.lcs_length(a, b) == table_lcs(a, b)[-1][-1]
    assert R.lcs_places(a, b) == walk_back(a, b)


@settings(max_examples=200, deadline=None)
@given(st.lists(words, max_size=5), st.lists(words, max_size=5))
def test_union_hits_equal_brute_force(refs, cands):
    left_ref, left_cand = Counter(sum(refs, [])), Counter(sum(cands, []))
    hits = 0
    for ref in refs:
        covered = sorted({p for cand in cands for p in walk_back(ref, cand)})
        for token in (ref[p] for p in covered):
            if left_ref[token] and left_cand[token]:
                left_ref[token] -= 1
                left_cand[token] -= 1
                hits += 1
    assert R.union_lcs_hits(refs, cands) == hits


def test_long_texts_are_scored_whole():
    a = [str(i % 997) for i in range(20_000)]
    assert R.lcs_length(a, a[5_000:]) == 15_000


TEXTS = [
    ("the cat sat on the mat the the", "The cat, the dog\nmat on SAT"),
    ("", "a"),
    ("a", ""),
    ("one", "one"),
    ("a b a b a", "b a b a b"),
    ("café naïve 42", "caf na ve 42"),
    (None, "a"),
    ("a", None),
]


def score(hits, n_pred, n_ref):
    p = hits / n_pred if n_pred else 0.0
    r = hits / n_ref if n_ref else 0.0
    return (p, r, 2 * p * r / (p + r) if hits else 0.0)


def tokens(text):
    kept = "".join(ch if ch.isascii() and ch.isalnum() else " " for ch in text.lower())
    return kept.split()


def grams(text, n):
    t = tokens(text)
    return Counter(tuple(t[i : i + n]) for i in range(len(t) - n + 1))


def test_rouge(spark):
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(TEXTS)], "i int, prediction string, reference string")
    for row in R.rouge(df).collect():
        pred, ref = row.prediction, row.reference
        if pred is None or ref is None:
            assert [row[m] for m in R.METRICS] == [None] * 4
            continue
        for n in (1, 2):
            p, r = grams(pred, n), grams(ref, n)
            expected = score((p & r).total(), p.total(), r.total())
            assert tuple(row[f"rouge{n}"]) == pytest.approx(expected)
        p, r = tokens(pred), tokens(ref)
        expected = score(table_lcs(p, r)[-1][-1], len(p), len(r))
        assert tuple(row.rougeL) == pytest.approx(expected)
    with pytest.raises(ValueError):
        R.rouge(df, metrics=["rouge9"])


def test_lsum_counts_lines(spark):
    df = spark.createDataFrame(
        [("a b c\nd e", "d e\na b c")], "prediction string, reference string"
    )
    row = R.rouge(df, metrics=["rougeL", "rougeLsum"]).first()
    assert row.rougeLsum.f1 == pytest.approx(1.0)
    assert row.rougeL.f1 == pytest.approx(0.6)


def test_corpus_and_runs(spark):
    df = spark.createDataFrame(
        [("a b", "a b"), ("a", "b")], "prediction string, reference string"
    )
    runs = R.compare_runs({"x": df, "y": df.limit(1)}, metrics=("rouge1",))
    assert sorted(runs.collect())[0] == ("x", 2, 0.5)
    assert runs.count() == 2
    with pytest.raises(ValueError):
        R.compare_runs({})


def test_bootstrap_is_seeded_and_brackets_the_mean(spark):
    rows = [(i, "a " * (i % 7), "a a a b") for i in range(300)]
    df = spark.createDataFrame(rows, "i int, prediction string, reference string")
    scored = R.rouge(df, metrics=("rouge1",))
    mean = R.rouge_corpus(scored, ("rouge1",)).first().rouge1
    first, again = (
        R.rouge_bootstrap(t, ["i"], ("rouge1",), resamples=100, seed=3).first()
        for t in (scored, scored.repartition(5))
    )
    assert tuple(first)[1:] == pytest.approx(tuple(again)[1:])
    assert first.low < mean < first.high
    assert first.mid == pytest.approx(mean, abs=0.02)


def test_bert_score(spark):
    rng = np.random.default_rng(5)
    rows, expected = [], {}
    for pair, (n, m) in enumerate([(3, 4), (1, 1), (9, 2), (0, 3), (2, 0)]):
        pred, ref = rng.normal(size=(n, 8)), rng.normal(size=(m, 8))
        rows += [(pair, "pred", i, v.tolist()) for i, v in enumerate(pred)]
        rows += [(pair, "ref", i, v.tolist()) for i, v in enumerate(ref)]
        if n and m:
            unit = [x / np.linalg.norm(x, axis=1, keepdims=True) for x in (pred, ref)]
            cos = unit[0] @ unit[1].T
            p, r = cos.max(axis=1).mean(), cos.max(axis=0).mean()
            expected[pair] = (p, r, 2 * p * r / (p + r))
        else:
            expected[pair] = (0.0, 0.0, 0.0)
    df = spark.createDataFrame(rows, "pair_id long, side string, pos long, vec array<double>")
    for block in (256, 2):
        found = {r.pair_id: tuple(r)[1:] for r in bert_score(df, block).collect()}
        assert found.keys() == expected.keys()
        for pair, scores in expected.items():
            assert found[pair] == pytest.approx(scores)


def test_bootstrap_rows_do_not_grow_with_pairs(spark):
    """A task hands on one row a resample."""
    scored = spark.range(0, 2000, 1, 3).select("id", F.struct((F.col("id") / 2000).alias("f1")).alias("rouge1"))
    made = R.rouge_bootstrap(scored, ["id"], ("rouge1",), resamples=40)
    plan = made._jdf.queryExecution().executedPlan()
    assert abs(made.first().mid - 0.5) < 0.05
    found = re.search(r"MapInPandas", plan.toString())
    assert found and "Generate" not in plan.toString()
    rows = spark.createDataFrame([(None,), (1,)], "k int").select(
        F.struct(F.lit(None).cast("double").alias("f1")).alias("rouge1"), "k"
    )
    assert tuple(R.rouge_bootstrap(rows, ["k"], ("rouge1",), resamples=5).first()) == ("rouge1", None, None, None)
    draws = R._draws([str(i) for i in range(3000)], 10, 0)
    times = np.searchsorted(R.poisson_edges(), draws, side="right")
    assert abs(times.mean() - 1) < 0.02 and abs(times.var() - 1) < 0.05 and times.max() < 12


@pytest.mark.parametrize(
    ("rows", "message"),
    [
        ([(1, "pred", 0, None), (1, "ref", 0, [1.0])], "no vector"),
        ([(1, "pred", None, [1.0]), (1, "ref", 0, [1.0])], "no vector or no position"),
        ([(1, "pred", 0, [1.0]), (1, "pred", 0, [2.0]), (1, "ref", 0, [1.0])], "position repeats"),
        ([(1, "pred", 0, [1.0]), (1, "pred", 1, [2.0, 1.0]), (1, "ref", 0, [1.0])], "differ in length"),
        ([(1, "pred", 0, [1.0]), (1, "ref", 0, [1.0, 2.0])], "components"),
    ],
)
def test_bert_score_refuses_broken_tokens(spark, rows, message):
    df = spark.createDataFrame(rows, "pair_id long, side string, pos long, vec array<double>")
    with pytest.raises(Exception, match=message):
        bert_score(df).collect()


def test_bert_score_shuffles_three_times(spark):
    df = spark.createDataFrame([], "pair_id string, side string, pos int, vec array<float>")
    made = bert_score(df)
    made.collect()
    plan = plan_of(made).split("Initial Plan")[0]
    assert len(re.findall(r"(?<!Reused)Exchange hashpartitioning", plan)) <= 3
    assert made.collect() == []


def test_bert_score_of_a_huge_pair_is_split(spark):
    """A pair with most of the tokens: its block pairs go to several tasks, with the same result."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
    }
    rng = np.random.default_rng(1)
    pred, ref = rng.normal(size=(700, 8)), rng.normal(size=(500, 8))
    rows = [("hot", s, i, v.tolist()) for s, x in (("pred", pred), ("ref", ref)) for i, v in enumerate(x)]
    for p in range(40):
        rows += [(f"p{p}", s, 0, rng.normal(size=8).tolist()) for s in ("pred", "ref")]
    df = spark.createDataFrame(rows, "pair_id string, side string, pos long, vec array<double>").repartition(6)
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        made = bert_score(df, 16)
        found = {r.pair_id: r for r in made.collect()}
        assert "skew=true" in plan_of(made)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    unit = [x / np.linalg.norm(x, axis=1, keepdims=True) for x in (pred, ref)]
    cos = unit[0] @ unit[1].T
    assert found["hot"].precision == pytest.approx(cos.max(axis=1).mean())
    assert found["hot"].recall == pytest.approx(cos.max(axis=0).mean())
    assert len(found) == 41
