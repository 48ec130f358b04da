"""Search, classifiers, fingerprints and the pipeline on small tables."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import fingerprints, graph_search, lang_id, lookups, storage, toxicity

SF_DIR = "/root/testdata/sf0.01"


def nearest(vectors, query, k):
    own = vectors[query]
    far = ((math.dist(own, v), i) for i, v in vectors.items() if i != query)
    return sorted(far)[:k]


def graph_answers(df, k, shards, where="vec_id % 100 = 0"):
    graphs = graph_search.index(df, k=k, shards=shards)
    found = graph_search.search(graphs, df.where(where), k=k, shards=shards)
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
    return out


def test_graph_search_recall(spark):
    r = np.random.default_rng(3)
    vectors = {i: r.normal(size=24).tolist() for i in range(1500)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got = graph_answers(df, 10, 3)
    hits = [
        len({v for _, v in got[q]} & {v for _, v in nearest(vectors, q, 10)}) for q in got
    ]
    assert len(got) == 15 and sum(hits) >= 0.9 * 10 * len(got)
    for q, found in got.items():
        assert found == sorted(found)
        assert all(s == pytest.approx(math.dist(vectors[q], vectors[v])) for s, v in found)


def test_graph_search_odd_vectors_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    same = [(i, [1.0, 2.0], "x") for i in range(0, 40)]  # one vector, many rows
    rows = same + [(100, [1.0, 2.5], "x"), (101, None, "x"), (102, [0.0, 0.0], "x")]
    rows += [(103, [1.0, None], "x"), (104, [nan, 1.0], "x"), (105, [inf, 1.0], "x"), (200, [], "x")]
    rows += [(None, [1.0, 1.0], "x"), (100, [1.0, 2.5], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, ids string")
    got = graph_answers(df, 10, 2)
    assert sorted(got) == [0, 100]
    assert got[0] == [(0.0, i) for i in range(1, 11)]
    assert got[100] == [(0.5, i) for i in range(10)]
    few = df.where("vec_id in (0, 100)")
    assert graph_answers(few, 10, 1) == {0: [(0.5, 100)], 100: [(0.5, 0)]}
    assert graph_answers(df.where("false"), 10, 1) == {}


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = lang_id.train(docs, ~lang_id.held_out("doc_id"))
    got = lang_id.identify(docs.withColumn("score", F.lit("x")), model).where(lang_id.held_out("doc_id"))
    right, total = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.98 * total and got.where("score < 0 or score > 1").count() == 0


def test_language_of_odd_texts(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([
        ("the quick brown fox of the house", "en"), ("der schnelle Fuchs und das Haus", "de"),
    ] * 30)]
    odd = [(1000, None, "en"), (1001, "", "en"), (1002, "12 %% 3", "en"), (1003, "the " * 60_000, None), (None, "das", "de")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    model = lang_id.train(docs, ~lang_id.held_out("doc_id"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in lang_id.identify(docs, model).collect()}
    assert got[1000] == got[1001] == got[1002] == ("und", 0.0)
    assert got[1003][0] == "en" and got[None][0] == "de" and got[0][0] == "en"
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    none = lang_id.train(unlabelled, ~lang_id.held_out("doc_id"))
    assert none is None
    assert {r.lang_pred for r in lang_id.identify(docs, none).collect()} == {"und"}
    empty = docs.where("false")
    assert lang_id.identify(empty, lang_id.train(empty, F.lit(True))).count() == 0


def test_presence_kernel_matches_sets():
    sets = [b"abcab", b"abd", b"xyz", b"xyzzy"]
    grams = [lang_id.grams(np.frombuffer(s, np.uint8)) for s in sets]
    plain = [{s[i : i + p] for p in (1, 2, 3) for i in range(len(s) - p + 1)} for s in sets]
    presence = lang_id.Presence()
    for g, s in zip(grams, plain):
        assert presence.mark(g) == len(s)
        for h, t in zip(grams, plain):
            assert presence.has(np.unique(h)).sum() == len(s & t)


def made_up(r, toxic, n=60):
    words = [f"w{min(int(r.expovariate(0.02)), 400)}" for _ in range(n)]
    if toxic:
        for k in r.sample(range(n), 4):
            words[k] = r.choice(["vile", "Rotten,", "(nasty)"])
    return " ".join(words)


def test_toxicity_on_held_out_rows(spark):
    r = random.Random(9)
    rows = [(i, made_up(r, i % 5 == 0, 60)) for i in range(1500)]
    rows += [(9001, None), (9002, ""), (9003, made_up(r, True, 20_000)), (None, "w1 vile")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", F.lit("x"))
    marks = [(i, int(i % 5 == 0)) for i in range(1500)] + [(3, None), (None, 1), (7, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.train(docs.where(~lang_id.held_out("doc_id")), labels)
    got = {x.doc_id: x for x in toxicity.score(docs, model).collect()}
    held = {x.doc_id for x in docs.where(lang_id.held_out("doc_id")).collect()}
    seen = [i for i in held if i is not None and i < 1500]
    toxic = [got[i].predicted for i in seen if i % 5 == 0]
    clean = [got[i].predicted for i in seen if i % 5]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.05 * len(clean)
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.3) for x in got.values())
    assert got[9001].score == got[9002].score


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    scores = [x.score for x in toxicity.score(docs, toxicity.train(docs, none)).collect()]
    assert scores == pytest.approx([0.0, 0.0], abs=1e-9)
    assert toxicity.score(docs.where("false"), toxicity.train(docs, none)).count() == 0


def test_shared_backoff_is_a_distribution():
    counts = np.array([[5.0, 2, 0, 1, 0], [0, 1, 3, 0, 0]])
    model = toxicity.KneserNey(counts, np.array([3.0, 2, 2, 1, 0])).prepare()
    every = np.arange(5)
    assert model.shared.sum() == pytest.approx(1)
    for kind in (0, 1):
        assert np.exp(model.log_probability(kind, every)).sum() == pytest.approx(1)
    # Unseen in the class: judged by the shared distribution alone.
    assert model.log_probability(1, np.array([0])) > model.log_probability(1, np.array([4]))


def test_toxicity_counts_are_those_of_words(spark):
    # 100,000 words, more than any fixed small number of buckets could keep apart.
    words = [f"v{i}" for i in range(100_000)]
    rows = [(i, " ".join(words[i * 500 : i * 500 + 500])) for i in range(200)]
    labelled = spark.createDataFrame(rows, "id long, text string").withColumn("label", (F.col("id") % 2).cast("int"))
    counts = toxicity.count_words(labelled).where("before > 0")  # pairs have no word before
    assert counts.count() == len(words)
    assert counts.where("ordinary + toxic <> 1 or before <> 1").count() == 0


def test_toxicity_of_ordinary_words_in_a_toxic_order(spark):
    r = random.Random(4)
    rows = []
    for i in range(1200):
        words = [f"w{r.randrange(60)}" for _ in range(60)]
        for k in r.sample(range(0, 58, 2), 3):  # both words in every row, in order only if toxic
            words[k : k + 2] = ["burn", "down"] if i % 3 == 0 else ["down", "burn"]
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    model = toxicity.train(docs.where(~lang_id.held_out("doc_id")), labels)
    got = toxicity.score(docs.where(lang_id.held_out("doc_id")), model).collect()
    wrong = [x for x in got if x.predicted != (x.doc_id % 3 == 0)]
    assert len(got) > 200 and len(wrong) <= 0.05 * len(got)


def test_slices_sum_what_tasks_and_parts_counted(spark):
    r = random.Random(3)
    rows = [(r.randrange(-(2**63), 2**63), r.randrange(5), r.randrange(3)) for _ in range(300)]
    rows += [(k, 1, 0) for k, _, _ in rows[:100]]
    want = {}
    for key, a, b in rows:
        x, y = want.get(key % 2**64, (0, 0))
        want[key % 2**64] = x + a, y + b
    df = spark.createDataFrame(rows, "key long, a long, b long").repartition(4)
    parts = lookups.sliced(df, 2)
    table = lookups.merged(parts, lambda v: [len(v), int(v[:, 0].sum())], ["keys_", "a_"]).collect()
    got = {}
    for row in table:
        key, values = lookups._unpacked_slice(row["keys"], row["values"])
        assert row["keys_"] == len(key) and row["a_"] == values[0].sum()
        assert all(int(k) >> 62 == row["slice"] for k in key)
        got.update(zip(map(int, key), map(tuple, values.T.tolist())))
    assert got == want and len(table) == 4


def test_toxicity_scores_in_waves_are_those_of_one(spark, monkeypatch):
    r = random.Random(6)
    rows = [(i, made_up(r, i % 4 == 0, 40)) for i in range(400)] + [(900, None), (901, None), (902, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    steps = []

    def noted(df, purpose):
        steps.append(purpose)
        return storage.written(df, purpose)

    monkeypatch.setattr(toxicity, "written", noted)
    found = []
    for waves in (1, toxicity.WAVES):
        monkeypatch.setattr(toxicity, "WAVES", waves)
        model = toxicity.train(docs, labels)
        steps.clear()
        got = toxicity.score(docs, model, keep_text=False)
        assert got.columns == ["doc_id", "score", "predicted"] and len(steps) == waves
        found.append({x.doc_id: x.score for x in got.collect()})
        assert len(found[-1]) == len(rows)
    assert found[0] == pytest.approx(found[1], abs=1e-9)
    left = spark.sql("SHOW TABLES").where("tableName LIKE 'toxicity_parts%'")
    assert left.count() == 0
    texts = pa.array([t for _, t in rows])
    assert (toxicity.distinct_keys(texts) == toxicity.Words(texts).keys).all()


def test_words_after_a_word_are_a_distribution():
    alone = np.array([0.5, 0.25, 0.125, 0.125])
    n = np.array([3, 1, 0, 0])
    some = toxicity.after(n, np.full(4, 4), np.full(4, 2), 0.7, alone)
    assert some.sum() == pytest.approx(1) and some[1] > some[2] * 2
    assert toxicity.after(n * 0, np.zeros(4), np.zeros(4), 0.7, alone) == pytest.approx(alone)


@pytest.fixture(scope="module")
def printed(spark):
    r = random.Random(7)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(r.choices(words, k=r.randrange(1, 150))) for _ in range(60)]
    texts += [None, "", " \n", "one", "é漢字\U0001f600 x y", texts[0], "z " * 40_000]
    rows = [(i * 7 % 1000, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(5)
    return [(i, t or "") for i, t, _ in rows], fingerprints.with_edits(df).collect()


def shingle_set(text):
    w = [x for x in text.lower().split() if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_fingerprints_of_edits(printed):
    rows, got = printed
    order = sorted(rows, key=lambda r: -r[0])
    found = {r.id: r for r in got}
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(order):
        follow = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + follow[:half]
        row = found[i]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for near, other in ((row.near_edited, edited), (row.near_next, follow)):
            a, b = shingle_set(text), shingle_set(other)
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(near - true) < 0.16


def test_equal_texts_have_equal_fingerprints(printed):
    rows, got = printed
    text = dict(rows)
    by_text = {}
    for r in got:
        by_text.setdefault(text[r.id], set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    assert by_text[""] == {""} == by_text[" \n"]


def test_one_shingle_fills_all_bins_unlike_another():
    a, b = (fingerprints.packed(*fingerprints.sketches(pa.array([t]))) for t in ("one", "two"))
    assert fingerprints.likeness(a, a) == [1.0] and fingerprints.likeness(a, b)[0] < 0.2


def test_next_row_of_ties_nulls_and_nothing(spark):
    rows = [(5, "b"), (5, "a"), (None, "c"), (9, "d"), (5, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, fingerprints.with_next(df).collect()), key=str)
    expected = [(9, "d", "b"), (5, "b", "b"), (5, "b", "a"), (5, "a", "c"), (None, "c", "d")]
    assert got == sorted(expected, key=str)
    assert fingerprints.with_next(df.where("false")).count() == 0
    single = df.where("text = 'd'")
    assert list(map(tuple, fingerprints.with_next(single).collect())) == [(9, "d", "d")]


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame(
        [(9001, None, "en", None, None), (9002, "", None, "src1", 0), (9003, "12 34", "en", "src1", 5), (None, "of the and", "en", "src1", 10)],
        docs.schema,
    )
    docs, columns = docs.unionByName(odd), docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns and docs.count() > 0
        if name == "language_id":
            assert {9001, 9002, 9003} & {r.doc_id for r in docs.collect()} == set()
        if name == "jaccard_join":
            assert docs.where("doc_id is not null").count() == docs.select("doc_id").distinct().count() - 1
            assert docs.count() <= before.count()
    assert docs.where("not round_trip").count() == 0 and docs.count() == before.count()


@pytest.mark.parametrize("name", ["language_id", "line_dedup", "jaccard_join", "source_mix", "byte_bpe"])
def test_pipeline_stages_on_nothing(spark, name):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("false")
    assert dict(corpus_pipeline.STAGES)[name](spark, docs, "/root/testdata/sf0.001").count() == 0


def test_pipeline_keeps_different_texts_of_one_id(spark):
    import corpus_pipeline

    texts = [" ".join(f"{name}{i}" for i in range(40)) for name in "abc"]
    rows = [(5, texts[0]), (5, texts[1]), (5, texts[1]), (6, texts[1]), (4, texts[2]), (7, texts[2]), (8, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars"
    )
    got = corpus_pipeline.one_of_each_group(spark, docs, "").collect()
    assert sorted((r.doc_id, r.text or "") for r in got) == [(4, texts[2]), (5, texts[0]), (5, texts[1]), (8, "")]


@pytest.mark.parametrize("learned", [["en"], ["en", "fr"], ["de", "en", "es", "fr"]])
def test_pipeline_rejects_languages_not_learned(spark, learned):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where(F.length("text") > 200)
    odd = [(-1, "Быстрая коричневая лиса прыгает через ленивую собаку"), (-2, "Ο γρήγορος σκύλος τρέχει")]
    other = spark.createDataFrame(odd, "doc_id long, text string").selectExpr(
        "doc_id", "text", "CAST(NULL AS STRING) AS lang", "CAST(NULL AS STRING) AS source", "length(text) AS n_chars"
    )
    kept, strange = docs.where(F.col("lang").isin(learned)), docs.where(~F.col("lang").isin(learned))
    # The others are there to be judged, not to be learned from.
    strange = strange.withColumn("true", F.col("lang")).withColumn("lang", F.lit(None).cast("string"))
    table = kept.withColumn("true", F.col("lang")).unionByName(strange).unionByName(
        other.withColumn("true", F.lit("xx"))
    )
    got = corpus_pipeline.identify_language(spark, table, "")
    n = {r.true: r["count"] for r in table.groupBy("true").count().collect()}
    left = {r.true: r["count"] for r in got.groupBy("true").count().collect()}
    assert all(left[x] >= 0.98 * n[x] for x in learned)
    assert all(left.get(x, 0) <= 0.25 * n[x] for x in n if x not in learned) and "xx" not in left


def test_samples_are_bounded_where_ids_repeat(spark):
    rows = [(1, f"text {i % 400}", "a") for i in range(800)] + [(i, "x", "a") for i in range(2, 7)]
    rows += [(1, f"other {i}", "b") for i in range(40)] + [(9, None, "b")]
    known = spark.createDataFrame(rows, "id long, text string, label string")
    got = lang_id.sampled(known, 8).collect()
    of = {x: [r.id for r in got if r.label == x] for x in "ab"}
    assert sorted(of["a"]) == [1, 1, 1, 2, 3, 4, 5, 6] and sorted(of["b"]) == [1] * 7 + [9]
    assert len({(r.label, r.id, r.text) for r in got}) == len(got) == 16
