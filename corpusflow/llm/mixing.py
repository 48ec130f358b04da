"""Mix sources to target weights: Sainte-Laguë quotas of equal-token blocks, then seeded choice.

1. Each source gets a target in words: its weight's share of ``share`` times all words, at most
   ``ceiling`` times its own size; what goes beyond is shared again by weight.
2. A source is taken in whole copies as far as its target holds them. The rest of the target is
   handed out in blocks of ``block_words`` words: to the sources by highest quotients (weight
   over 1, 3, 5, ...), then the same way from a source to its shards.
3. Within a shard and source, documents in seeded order form one stream of words, cut into
   blocks. As many blocks as the quota says are taken, evenly spaced from a seeded start, so
   each row works out its own blocks and none is exploded.

Only source totals (a row per source) reach the driver, and quotas are worked out on a row per
source and shard. Each source has shards of its own, one for every ``shard_docs`` of its texts
with words, so no task sees more than that and every shard of several holds many full blocks,
however large the other sources are. Texts without words lie in shards apart.

Defined results: a null or empty text has size 0 and is taken 0 times; a null source is a source
of its own, last in order; repeated rows count each; an empty table gives an empty result.
Other columns pass through, but one named like a result column is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import cycle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusflow.llm.names import clashing, restored

# Fixed value: what a word is.
WORD = r"[^\x20\x09-\x0D]+"


def targets(
    sizes: Sequence[int], weights: Sequence[float], share: float = 1.5, ceiling: float = 2.0
) -> list[float]:
    """Share ``share * sum(sizes)`` by weight, none above ``ceiling`` times its size."""
    total = share * sum(sizes)
    out = [0.0] * len(sizes)
    free = set(range(len(sizes)))
    while free:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in free)
        weight = sum(weights[i] for i in free)
        given = {i: left * weights[i] / weight for i in free}
        above = {i for i in free if given[i] > ceiling * sizes[i]}
        if not above:
            for i in free:
                out[i] = given[i]
            break
        for i in above:
            out[i] = float(ceiling * sizes[i])
        free -= above
    return out


def sainte_lague(weights: Sequence[float], seats: int, most: Sequence[int]) -> np.ndarray:
    """Seats by highest quotients ``w / (2 k + 1)``; ties to the earlier; at most ``most`` each.

    A divisor is found by bisection; the few seats around it are settled quotient by quotient.
    """
    w, cap = np.asarray(weights, float), np.asarray(most, np.int64)
    seats = int(min(seats, cap[w > 0].sum()))
    out = np.zeros(len(w), np.int64)
    if seats <= 0:
        return out
    taken = lambda d: np.minimum(np.floor(w / d + 0.5).astype(np.int64), cap)
    low, high = w.max() / (2.0 * seats + 2) / max(len(w), 1), 4 * w.max()
    while taken(low).sum() < seats:
        low /= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if taken(middle).sum() >= seats else (low, middle)
    out = taken(high)
    while (left := seats - out.sum()) > 0:
        quotient = np.where(out < cap, w / (2 * out + 1), -1.0)
        best = np.flatnonzero(quotient >= quotient.max() * (1 - 1e-12))[:left]
        out[best] += 1
    return out


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    block_words: int = 64,
    shard_docs: int = 20_000,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target``, ``copies``, ``ranges`` and ``taken``.

    ``copies`` is how often the whole text is taken; ``ranges`` are the word ranges
    (begin, end), in order, taken once more. ``weights`` repeat over the sources in code point
    order, null last. Whole texts are read once and not shuffled unless kept in the result.
    """
    if others := clashing(docs, "_mix_", [id_col, text_col, source_col]):
        renamed = docs.withColumnsRenamed(others)
        columns = id_col, text_col, source_col
        return restored(mix(renamed, weights, share, block_words, shard_docs, seed, *columns), others)
    spark = docs.sparkSession
    source = F.struct(
        F.col(source_col).isNull().alias("absent"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("name"),
    )
    sized = docs.withColumn("_mix_source", source).withColumn("_mix_size", word_count(text_col))
    found = (
        sized.groupBy("_mix_source")
        .agg(
            F.sum("_mix_size").alias("size"),
            F.count_if(F.col("_mix_size") > 0).alias("docs"),
            F.count_if(F.col("_mix_size") == 0).alias("blanks"),
        )
        .collect()
    )
    found.sort(key=lambda r: (r[0].absent, r[0].name))
    wants = targets([r.size for r in found], [w for _, w in zip(found, cycle(weights))], share)
    copies = [int(t // r.size) if r.size else 0 for t, r in zip(wants, found)]
    rest = [t - c * r.size for t, c, r in zip(wants, copies, found)]
    blocks = sainte_lague(
        rest or [0.0],
        round(sum(rest) / block_words),
        [math.ceil(r.size / block_words) for r in found] or [0],
    )
    plan = spark.createDataFrame(
        [
            (r[0].absent, r[0].name, r.size, t, c, int(b), -(-r.docs // shard_docs), -(-r.blanks // shard_docs))
            for r, t, c, b in zip(found, wants, copies, blocks)
        ],
        "absent boolean, name string, source_size long, target double, copies long, blocks long,"
        " shards long, blank_shards long",
    ).select(
        F.struct("absent", "name").alias("_mix_source"),
        F.col("source_size").alias("_mix_total"),
        F.col("target").alias("_mix_target"),
        F.col("copies").alias("_mix_copies"),
        "blocks",
        F.col("shards").alias("_mix_shards"),
        F.col("blank_shards").alias("_mix_blank_shards"),
    )

    place = F.xxhash64(F.lit(seed), F.col(id_col))
    sized = sized.join(F.broadcast(plan.drop("blocks")), "_mix_source").withColumn(
        "_mix_shard",
        F.when(F.col("_mix_size") > 0, F.pmod(place, "_mix_shards")).otherwise(
            -1 - F.pmod(place, "_mix_blank_shards")
        ),
    )

    def share_out(shard_sizes: pd.DataFrame) -> pd.DataFrame:
        shard_sizes = shard_sizes.sort_values("shard")
        sizes = shard_sizes["shard_size"].to_numpy()
        blocks = -(-sizes // block_words)
        quota = sainte_lague(sizes, int(shard_sizes["blocks"].iloc[0]), blocks)
        return shard_sizes.assign(quota=quota, blocks=np.maximum(blocks, 1))[
            ["absent", "name", "shard", "quota", "blocks"]
        ]

    quotas = (
        sized.groupBy("_mix_source", "_mix_shard")
        .agg(F.sum("_mix_size").alias("shard_size"))
        .join(plan.select("_mix_source", "blocks"), "_mix_source")
        .select("_mix_source.*", F.col("_mix_shard").alias("shard"), "shard_size", "blocks")
        .groupBy("absent", "name")
        .applyInPandas(
            share_out, "absent boolean, name string, shard long, quota long, blocks long"
        )
        .select(
            F.struct("absent", "name").alias("_mix_source"),
            F.col("shard").alias("_mix_shard"),
            F.col("quota").alias("_mix_quota"),
            F.col("blocks").alias("_mix_blocks"),
        )
    )

    # The stream of a shard and source: where each text's words lie in it, and its blocks.
    stream = Window.partitionBy("_mix_source", "_mix_shard").orderBy(
        F.xxhash64(F.lit(seed + 1), F.col(id_col)), F.col(id_col), F.col("_mix_size")
    )
    placed = (
        sized.join(quotas, ["_mix_source", "_mix_shard"])
        .withColumn("_mix_end", F.sum("_mix_size").over(stream.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_mix_begin", F.col("_mix_end") - F.col("_mix_size"))
        .withColumn("_mix_start", F.pmod(F.xxhash64(F.lit(seed + 2), "_mix_source", "_mix_shard"), "_mix_blocks"))
    )

    def chosen_before(block: Column) -> Column:
        """How many blocks before this one are taken: the quota, evenly from a seeded start."""
        return F.floor((block * F.col("_mix_quota") + F.col("_mix_start")) / F.col("_mix_blocks"))

    span = F.lit(block_words).cast("long")
    block = F.sequence(
        F.floor(F.col("_mix_begin") / span), F.floor((F.col("_mix_end") - 1) / span)
    )
    ranges = F.transform(
        F.filter(block, lambda b: chosen_before(b + 1) > chosen_before(b)),
        lambda b: F.struct(
            (F.greatest(b * span, F.col("_mix_begin")) - F.col("_mix_begin")).alias("begin"),
            (F.least((b + 1) * span, F.col("_mix_end")) - F.col("_mix_begin")).alias("end"),
        ),
    )
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    partly = F.when((F.col("_mix_size") > 0) & (F.col("_mix_quota") > 0), ranges).otherwise(none)
    taken = F.aggregate("_mix_ranges", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["begin"])
    made = {"size", "source_size", "target", "copies", "ranges", "taken"}
    placed = placed.withColumn("_mix_ranges", partly)
    return placed.select(
        *[c for c in docs.columns if c not in made],
        F.col("_mix_size").alias("size"),
        F.col("_mix_total").alias("source_size"),
        F.col("_mix_target").alias("target"),
        F.col("_mix_copies").alias("copies"),
        F.col("_mix_ranges").alias("ranges"),
        (F.col("_mix_copies") * F.col("_mix_size") + taken).alias("taken"),
    )
