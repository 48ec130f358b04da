"""BERTScore over token vectors that are already computed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREDICTION, REFERENCE = "pred", "ref"
BLOCK = 256  # tokens of one side compared at a time


def _unit(flat: np.ndarray, n: int) -> np.ndarray:
    """A matrix with a row for each token, of length 1; a zero vector stays zero."""
    rows = np.asarray(flat, np.float64).reshape(n, -1)
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def _maxima(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Best cosine of each token of a block over the blocks it has met, as long as these follow
    one another; a block whose company is spread over tasks gives a row in each."""
    now, own, best = None, None, None
    for batch in batches:
        done = []
        for pair, side, block, n, flat, m, other in batch.itertuples(index=False, name=None):
            if (pair, side, block) != now:
                if now is not None:
                    done.append((*now, best))
                now, own, best = (pair, side, block), _unit(flat, n), np.full(n, -np.inf)
            met = _unit(other, m)
            if own.shape[1] != met.shape[1]:
                raise ValueError(f"pair {pair}: vectors of {own.shape[1]} and of {met.shape[1]} components")
            np.maximum(best, (own @ met.T).max(axis=1), out=best)
        yield pd.DataFrame(done, columns=["pair_id", "side", "block", "best"])
    if now is not None:
        yield pd.DataFrame([(*now, best)], columns=["pair_id", "side", "block", "best"])


def bert_score(tokens: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(pair_id, side, pos, vec)`` to ``(pair_id, precision, recall, f1)``.

    Every token takes its best cosine on the other side; precision averages over the
    prediction, recall over the reference. A pair that lacks a side scores 0.

    Vectors are gathered in blocks of at most ``block`` positions per side. A block meets the
    other side's blocks one matrix product at a time and keeps running maxima, so no token or
    pair of tokens is ever a row. Three shuffles: blocks, blocks by pair (both sides of the join
    read the same one, and the engine splits a huge pair), and the maxima.

    A null vector or position, a position that repeats within a side and vectors of different
    lengths are errors.
    """
    sides = tokens.where(F.col("side").isin(PREDICTION, REFERENCE))
    rows = F.array_sort(F.collect_list(F.struct("pos", "vec")))
    blocks = (
        sides.select("pair_id", "side", F.floor(F.col("pos") / block).alias("block"), "pos", "vec")
        .groupBy("pair_id", "side", "block")
        .agg(rows.alias("rows"))
        .select("pair_id", "side", "block", F.size("rows").alias("n"), _packed("rows").alias("flat"))
    )

    def named(prefix: str) -> DataFrame:
        return blocks.toDF(*[f"{prefix}_{c}" for c in blocks.columns])

    met = named("own").join(
        named("met"),
        (F.col("own_pair_id") == F.col("met_pair_id")) & (F.col("own_side") != F.col("met_side")),
    )
    kind = tokens.schema["pair_id"].dataType.simpleString()
    best = met.select(
        "own_pair_id", "own_side", "own_block", "own_n", "own_flat", "met_n", "met_flat"
    ).mapInPandas(_maxima, f"pair_id {kind}, side string, block long, best array<double>")
    # Every pair has a row here, so one that lacks a side is still in the result.
    present = blocks.select(
        "pair_id", "side", "block", F.lit(None).cast("array<double>").alias("best")
    )
    larger = lambda x, y: F.when(x.isNull() | (y > x), y).otherwise(x)
    highest = F.aggregate(
        "all", F.array().cast("array<double>"), lambda done, one: F.zip_with(done, one, larger)
    )
    # The rows are dealt by pair, which serves both groupings.
    per_block = (
        best.unionByName(present)
        .repartition("pair_id")
        .groupBy("pair_id", "side", "block")
        .agg(F.collect_list("best").alias("all"))
        .select("pair_id", "side", highest.alias("best"))
        .select("pair_id", "side", F.size("best").alias("n"), _sum("best").alias("total"))
    )

    def mean(side: str) -> Column:
        mine = F.col("side") == side
        return F.coalesce(F.sum(F.when(mine, F.col("total"))) / F.nullif(F.sum(F.when(mine, F.col("n"))), F.lit(0)), F.lit(0.0))

    means = per_block.groupBy("pair_id").agg(
        mean(PREDICTION).alias("precision"), mean(REFERENCE).alias("recall")
    )
    total = F.col("precision") + F.col("recall")
    f1 = F.when(total != 0, 2 * F.col("precision") * F.col("recall") / total).otherwise(0.0)
    return means.withColumn("f1", f1)


def _sum(values: str) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda done, x: done + x)


def _packed(rows: str) -> Column:
    """The vectors of a block one after another, once they are found in order."""
    missing = F.exists(rows, lambda r: r["vec"].isNull() | r["pos"].isNull())
    places = F.size(F.array_distinct(F.transform(rows, lambda r: r["pos"])))
    lengths = F.size(F.array_distinct(F.transform(rows, lambda r: F.size(r["vec"]))))
    wrong = (
        F.when(missing, F.lit("a token has no vector or no position"))
        .when(places != F.size(rows), F.lit("a position repeats within a side"))
        .when(lengths > 1, F.lit("vectors differ in length"))
    )
    vectors = F.flatten(F.transform(rows, lambda r: r["vec"].cast("array<double>")))
    return F.when(wrong.isNull(), vectors).otherwise(F.raise_error(wrong).cast("array<double>"))
