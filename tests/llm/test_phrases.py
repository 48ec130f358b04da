"""Collocations against counting everything."""

import random
import re
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import phrases


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def brute(rows, top, least):
    counts = {}
    for text, lang in rows:
        of = counts.setdefault(lang or "und", Counter())
        for ws in tokens(text):
            for k in (1, 2, 3):
                of.update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            inside = [b for q, b in candidates.items() if len(q) > len(p) and p in (q[:2], q[1:])]
            if any(100 * b >= 50 * a for b in inside):
                continue
            score, _, left, right = min(
                (1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))
            )
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def corpus(seed, n):
    r = random.Random(seed)
    stock = ["new york city", "New York", "ad hoc", "de facto rule", "é ü ñ", "a\tb", "x  y", "of the", "in the end of"]
    rows = []
    for _ in range(n):
        words = []
        for _ in range(r.randrange(0, 60)):
            words.append(r.choice(stock) if r.random() < 0.4 else f"w{int(r.expovariate(0.2))}")
            words.append(r.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "!? ", " ", "\x1f"]))
        rows.append(("".join(words), r.choice(["en", "en", "fr", None, "und"])))
    return rows + [(None, "en"), ("", None), ("word", "solo"), (" \t\n", "fr"), ("the the the the " * 500, "fr")]


def mined(spark, rows, **kw):
    df = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    clash = {c: F.lit(1) for c in ("phrase", "n", "size", "rank", "mark", "__xy", "x", "place")}
    out = phrases.mine(df.withColumns(clash), **kw)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in out.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("top,ahead", [(2000, 1.5), (8, 1.5), (3, 0.4)])
def test_equals_counting_all(spark, top, ahead):
    """With a small ``top`` most prefixes are never grown, and languages settle in later waves."""
    rows = corpus(1, 400)
    assert mined(spark, rows, top=top, least=4, ahead=ahead) == brute(rows, top, 4)


def test_large_frontier_counts_all_triples(spark, monkeypatch):
    rows = corpus(2, 200)
    plain = phrases.count_triples
    monkeypatch.setattr(phrases, "count_triples", lambda *a, **k: plain(*a, **k, limit=0))
    assert mined(spark, rows, top=10, least=3) == brute(rows, 10, 3)


def test_frontier_stays_small(spark, monkeypatch):
    """Only triples that a mark leaves open are counted."""
    sizes = []
    plain = phrases.count_triples

    def watched(docs, frontier, *a, **k):
        sizes.append(frontier.count())
        return plain(docs, frontier, *a, **k)

    monkeypatch.setattr(phrases, "count_triples", watched)
    r = random.Random(7)
    rows = [(" ".join(f"w{r.randrange(60)}" for _ in range(400)) + " rare find" * (i % 3), "en") for i in range(60)]
    assert mined(spark, rows, top=1, least=4) == brute(rows, 1, 4)
    pairs = phrases.count_pairs(spark.createDataFrame(rows, "text string, lang string"), 4).where("size = 2").count()
    assert sum(sizes) < pairs / 4


def test_batches_are_cut_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PART_BYTES", 500)
    rows = corpus(3, 100)
    assert mined(spark, rows, top=50, least=3) == brute(rows, 50, 3)


def test_a_large_batch_takes_little_memory():
    line = " ".join(f"w{i * i % 9973}" for i in range(9000)) + "\n"
    batch = pa.record_batch({"text": [line] * 400, "lang": ["en"] * 400})
    tracemalloc.start()
    for part in phrases._parts(batch):
        for size in (0, 1, 2):
            phrases.Words(part.column("text"), part.column("lang")).counted(size)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert batch.nbytes > 16_000_000
    assert peak < 140_000_000


def test_exact_beyond_64_bits(spark):
    big = 3_000_000_007
    df = spark.createDataFrame([(big, big, 9_000_000_000_001), (2, 3, 2), (10, 10, 10)], "a long, l long, r long")
    got = [r[0] for r in df.select(phrases._scored("a", "l", "r")).collect()]
    assert got == [1_000_000 * big * big // (big * 9_000_000_000_001), 666_666, 1_000_000]


def test_empty(spark):
    assert mined(spark, [], top=5) == []
    assert mined(spark, [(None, None)], top=5) == []
