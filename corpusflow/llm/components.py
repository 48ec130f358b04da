"""Connected components by alternating stars, on tables of any size.

Each round points every node's larger neighbours at its smallest one, then its smaller ones;
both are a minimum per node, summed up before the shuffle, and a join. Rounds are written to the
shared folder, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.storage import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` of every node of an edge, itself included; component is its least."""
    pairs = edges.select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).where("u <> v").distinct()
    pairs = written(pairs, "components")
    state = _state(pairs)
    while state[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = low.select("u", F.col("m").alias("v"))
        pairs = written(small.where("u <> v").unionByName(own).distinct(), "components")
        before, state = state, _state(pairs)
        if before == state:
            break
    node = pairs.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    roots = pairs.select(F.col("v").alias("node")).distinct()
    roots = roots.join(node, "node", "left_anti").withColumn("component", F.col("node"))
    return node.unionByName(roots)


def _state(pairs: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(pairs.agg(F.count(F.lit(1)), digest).first())
