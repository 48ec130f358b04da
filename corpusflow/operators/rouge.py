"""ROUGE-1, -2, -L and -Lsum per pair of texts, and per corpus.

Tokens are runs of a-z and 0-9 of the lower-cased text; no stemming. ROUGE-N is native.
The common-subsequence scores need a loop over one pair of texts, which a small vectorised
UDF does. Either way a pair is scored where its row is: nothing is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from hashlib import md5
from itertools import chain
from math import exp

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.binding import let

METRICS = ("rouge1", "rouge2", "rougeL", "rougeLsum")  # fixed values


def rouge_tokens(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.array_remove(F.split(_plain(c), " "), "")


def _plain(c: Column) -> Column:
    """Tokens separated by blanks."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")


def ngrams(c: Column | str, n: int, mark: str = "") -> Column:
    """Runs of ``n`` tokens joined by a blank, each with a mark at its end."""
    c = F.col(c) if isinstance(c, str) else c
    if n == 1 and mark:
        marked = F.regexp_replace(F.concat(F.lower(c), F.lit(" ")), "[^a-z0-9]+", f"{mark} ")
        return F.array_remove(F.array_remove(F.split(marked, " "), mark), "")

    def runs(row: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(row) - F.lit(n - 1), F.lit(1)))
        joined = F.transform(
            starts, lambda i: F.concat(F.array_join(F.slice(row, i, n), " "), F.lit(mark))
        )
        none = F.array().cast("array<string>")
        return F.when(F.size(row) >= n, joined).when(row.isNotNull(), none)

    return let(rouge_tokens(c), runs)


def _overlap(pred: Column, ref: Column) -> Column:
    """How many grams two lists share, copies counted; one list is marked A, the other B.

    Sorted together, the copies of a gram form one run marked A and right after it one
    marked B (tokens hold no capitals). The shorter of two such neighbours is the overlap.
    """

    def from_sorted(row: Column) -> Column:
        ends = F.filter(
            F.sequence(F.lit(1), F.greatest(F.size(row), F.lit(1))),
            lambda i: (i >= F.size(row)) | (F.get(row, i - 1) != F.get(row, i)),
        )
        return let(ends, lambda found: from_runs(row, found))

    def from_runs(row: Column, ends: Column) -> Column:
        def shared(k: Column) -> Column:
            end, middle = F.get(ends, k), F.get(ends, k - 1)
            start = F.coalesce(F.get(ends, k - 2), F.lit(0))
            ours, theirs = F.get(row, middle - 1), F.get(row, end - 1)
            same = F.concat(F.substring(ours, 1, F.length(ours) - 1), F.lit("B")) == theirs
            return F.when(same, F.least(middle - start, end - middle)).otherwise(0)

        neighbours = F.sequence(F.lit(1), F.greatest(F.size(ends) - 1, F.lit(1)))
        total = F.aggregate(neighbours, F.lit(0), lambda acc, k: acc + shared(k))
        return F.when(F.size(ends) > 1, total).otherwise(0)

    return let(F.sort_array(F.concat(pred, ref)), from_sorted)


def _scores(hits: Column, n_pred: Column, n_ref: Column) -> Column:
    """Struct of precision, recall and F1, all 0 when there is nothing to compare."""

    def share(n: Column, of: Column) -> Column:
        return F.when(of > 0, n / of).otherwise(0.0)

    def with_f1(s: Column) -> Column:
        p, r = s["precision"], s["recall"]
        f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
        return F.struct(p.alias("precision"), r.alias("recall"), f1.alias("f1"))

    def from_counts(c: Column) -> Column:
        p, r = share(c["hits"], c["n_pred"]), share(c["hits"], c["n_ref"])
        both = let(F.struct(p.alias("precision"), r.alias("recall")), with_f1)
        return F.when(c["hits"].isNotNull(), both)

    counts = F.struct(hits.alias("hits"), n_pred.alias("n_pred"), n_ref.alias("n_ref"))
    return let(counts, from_counts)


def rouge_n(
    df: DataFrame, pred: str = "prediction", ref: str = "reference", n: int = 1
) -> DataFrame:
    """Add struct ``rouge{n}``: clipped n-gram overlap of two texts."""

    def from_grams(g: Column) -> Column:
        p, r = g["pred"], g["ref"]
        hits = F.when(p.isNotNull() & r.isNotNull(), _overlap(p, r))
        return _scores(hits, F.size(p), F.size(r))

    grams = F.struct(ngrams(pred, n, "A").alias("pred"), ngrams(ref, n, "B").alias("ref"))
    return df.withColumn(f"rouge{n}", let(grams, from_grams))


def _token_bits(tokens: Sequence[str]) -> dict[str, int]:
    """Per token a whole number with a bit for each place it stands at."""
    bits: dict[str, int] = {}
    for place, token in enumerate(tokens):
        bits[token] = bits.get(token, 0) | (1 << place)
    return bits


def _bit_rows(a: Sequence[str], bits: dict[str, int], width: int) -> list[int]:
    """The rows of the subsequence table, one whole number each: a zero bit marks a place
    where the length grows. Memory is one bit per token instead of a number."""
    row = full = (1 << width) - 1
    rows = [row]
    for token in a:
        hit = bits.get(token)
        if hit:
            meet = row & hit
            row = ((row + meet) | (row - meet)) & full
        rows.append(row)
    return rows


def lcs_length(a: Sequence[str], b: Sequence[str]) -> int:
    """Length of the longest common subsequence."""
    bits = _token_bits(b)
    row = full = (1 << len(b)) - 1
    for hit in filter(None, map(bits.get, a)):
        meet = row & hit
        row = ((row + meet) | (row - meet)) & full
    return len(b) - row.bit_count()


def lcs_places(
    ref: Sequence[str], cand: Sequence[str], bits: dict[str, int] | None = None
) -> list[int]:
    """Indices into ``ref`` of one longest common subsequence.

    Walks back from the end; on a mismatch it drops the last candidate token only when
    that keeps a strictly longer subsequence than dropping the last reference token. A
    reference token the candidate lacks is always dropped, so it is left out at once.
    """
    bits = _token_bits(cand) if bits is None else bits
    kept = [place for place, token in enumerate(ref) if token in bits]
    rows = _bit_rows([ref[place] for place in kept], bits, len(cand))
    places = []
    i, j = len(kept), len(cand)
    best = j - rows[i].bit_count()
    while best:
        place = kept[i - 1]
        if ref[place] == cand[j - 1]:
            places.append(place)
            i, j, best = i - 1, j - 1, best - 1
            continue
        last = 1 << (j - 1)
        grows_here = not rows[i] & last
        # Without growth at j the candidate token can go; it does if the row above is shorter.
        if not grows_here and j - (rows[i - 1] & (2 * last - 1)).bit_count() < best:
            j -= 1
        else:
            i -= 1
    return places[::-1]


def union_lcs_hits(ref_lines: list[list[str]], cand_lines: list[list[str]]) -> int:
    """Summary-level hits: per reference line, the union over candidate lines of the
    common subsequences, each token counted at most as often as both texts hold it.
    """
    left_ref, left_cand = (Counter(chain.from_iterable(x)) for x in (ref_lines, cand_lines))
    line_bits = [_token_bits(line) for line in cand_lines]
    holders: dict[str, set[int]] = {}
    for number, bits in enumerate(line_bits):
        for token in bits:
            holders.setdefault(token, set()).add(number)
    hits = 0
    for line in ref_lines:
        sharing = set().union(*[holders.get(token, ()) for token in line])
        covered: set[int] = set()
        for number in sharing:
            covered.update(lcs_places(line, cand_lines[number], line_bits[number]))
        for token in (line[p] for p in sorted(covered)):
            if left_ref[token] > 0 and left_cand[token] > 0:
                left_ref[token] -= 1
                left_cand[token] -= 1
                hits += 1
    return hits


@F.pandas_udf(T.LongType())
def _lcs_hits(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for preds, refs in pairs:
        yield pd.Series(
            [
                None if p is None or r is None else lcs_length(p.split(), r.split())
                for p, r in zip(preds, refs)
            ],
            dtype="Int64",
        )


@F.pandas_udf(T.LongType())
def _union_hits(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    def lines(text: str) -> list[list[str]]:
        return [line.split() for line in text.split("\n") if line]

    for preds, refs in pairs:
        yield pd.Series(
            [
                None if p is None or r is None else union_lcs_hits(lines(r), lines(p))
                for p, r in zip(preds, refs)
            ],
            dtype="Int64",
        )


def _plain_lines(c: Column) -> Column:
    """The same line by line."""
    return F.array_join(F.transform(F.split(c, "\n"), _plain), "\n")


def rouge_l(df: DataFrame, pred: str = "prediction", ref: str = "reference") -> DataFrame:
    """Add struct ``rougeL``: longest common subsequence of the whole texts."""
    scored = df.withColumn("__hits", _lcs_hits(_plain(F.col(pred)), _plain(F.col(ref))))
    score = _scores(F.col("__hits"), F.size(rouge_tokens(pred)), F.size(rouge_tokens(ref)))
    return scored.withColumn("rougeL", score).drop("__hits")


def rouge_lsum(df: DataFrame, pred: str = "prediction", ref: str = "reference") -> DataFrame:
    """Add struct ``rougeLsum``: line by line, union of common subsequences."""
    scored = df.withColumn("__hits", _union_hits(_plain_lines(F.col(pred)), _plain_lines(F.col(ref))))
    score = _scores(F.col("__hits"), F.size(rouge_tokens(pred)), F.size(rouge_tokens(ref)))
    return scored.withColumn("rougeLsum", score).drop("__hits")


def rouge(
    df: DataFrame,
    pred: str = "prediction",
    ref: str = "reference",
    metrics: Sequence[str] = METRICS,
) -> DataFrame:
    """Add one struct of precision, recall and F1 per metric."""
    unknown = [m for m in metrics if m not in METRICS]
    if unknown:
        raise ValueError(f"unknown metrics: {unknown}")
    for metric in metrics:
        if metric == "rougeL":
            df = rouge_l(df, pred, ref)
        elif metric == "rougeLsum":
            df = rouge_lsum(df, pred, ref)
        else:
            df = rouge_n(df, pred, ref, int(metric[-1]))
    return df


def rouge_corpus(
    scored: DataFrame, metrics: Sequence[str] = METRICS, by: Sequence[str] = ()
) -> DataFrame:
    """Mean F1 per metric over all pairs, or per ``by`` group."""
    return scored.groupBy(*by).agg(
        F.count("*").alias("n_pairs"), *[F.avg(f"{m}.f1").alias(m) for m in metrics]
    )


def rouge_bootstrap(
    scored: DataFrame,
    key_cols: Sequence[str],
    metrics: Sequence[str] = METRICS,
    resamples: int = 1000,
    confidence: float = 0.95,
    seed: int = 0,
) -> DataFrame:
    """Low, middle and high F1 per metric over seeded resamples of the pairs.

    Each resample takes a pair as often as a unit Poisson draw says. Draws are 32-bit numbers,
    four to an MD5 digest of seed, number and the pair's key, so that results depend neither on
    the layout nor on the engine. A task adds up its pairs for all resamples at once and hands on
    one row a resample, however many pairs it has. A null score counts in no resample.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in key_cols]
    key = F.concat_ws("\x1f", *parts).alias("key")
    edges = np.array(poisson_edges(), np.int64)
    sums, weights = ([f"{w}{i}" for i in range(len(metrics))] for w in ("sum", "weight"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, resamples, len(metrics)))
        for batch in batches:
            for at in range(0, len(batch), _DRAWN):
                some = batch.iloc[at : at + _DRAWN]
                times = np.searchsorted(edges, _draws(some["key"], resamples, seed), side="right").T
                values = some.iloc[:, 1:].to_numpy(np.float64)
                known = ~np.isnan(values)
                total += times @ np.where(known, values, 0.0), times @ known
        made = pd.DataFrame(np.hstack(total), columns=sums + weights)
        yield made.assign(resample=np.arange(resamples))[["resample", *sums, *weights]]

    schema = ", ".join(["resample long", *[f"{c} double" for c in sums + weights]])
    drawn = scored.select(key, *[F.col(f"{m}.f1").alias(f"v{i}") for i, m in enumerate(metrics)])
    means = drawn.mapInPandas(run, schema).groupBy("resample").agg(
        *[
            (F.sum(s) / F.nullif(F.sum(w), F.lit(0.0))).alias(m)
            for s, w, m in zip(sums, weights, metrics)
        ]
    )
    tail = (1 - confidence) / 2
    long = means.unpivot(["resample"], list(metrics), "metric", "f1")
    return long.groupBy("metric").agg(
        F.percentile("f1", F.lit(tail)).alias("low"),
        F.percentile("f1", F.lit(0.5)).alias("mid"),
        F.percentile("f1", F.lit(1 - tail)).alias("high"),
    )


_DRAWN = 512  # pairs whose draws are held at a time


def _draws(keys: Sequence[str], resamples: int, seed: int) -> np.ndarray:
    """32-bit numbers, pairs by resamples."""
    digests = -(-resamples // 4)
    data = b"".join(
        md5(f"{seed}\x1f{i}\x1f{key}".encode()).digest() for key in keys for i in range(digests)
    )
    return np.frombuffer(data, ">u4").reshape(-1, 4 * digests)[:, :resamples].astype(np.int64)


def poisson_edges() -> list[int]:
    """A 32-bit number draws as many as it reaches of these: unit Poisson probabilities, summed."""
    edges, term, total, k = [], exp(-1), 0.0, 0
    while total + term < 1 - 2**-32:
        total += term
        edges.append(int(total * 2**32))
        k += 1
        term /= k
    return edges


def compare_runs(
    runs: dict[str, DataFrame],
    pred: str = "prediction",
    ref: str = "reference",
    metrics: Sequence[str] = METRICS,
) -> DataFrame:
    """Corpus scores of several prediction tables side by side."""
    if not runs:
        raise ValueError("no runs to compare")
    tables = [
        table.select(F.lit(label).alias("run"), pred, ref) for label, table in runs.items()
    ]
    together = tables[0]
    for table in tables[1:]:
        together = together.unionByName(table)
    return rouge_corpus(rouge(together, pred, ref, metrics), metrics, by=["run"])
