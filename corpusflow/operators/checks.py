"""Sequence checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def continuity_check(
    df: DataFrame,
    partition: str,
    order: str,
    value: str,
    wrap_values: Sequence[int] = (),
) -> DataFrame:
    """Per partition: does each value follow the one before by +1, or wrap to 1?

    A wrap is allowed after a value in ``wrap_values``. Gives ``(partition, ok)``.

    Equal rows are counted first, then the rest is range partitioned, so that a partition
    value held by a third of all rows is checked in stretches by many tasks. What meets
    in one place per partition value is one row for each stretch.
    """
    wraps = [F.lit(v) for v in wrap_values]

    def follows(current: Column, following: Column) -> Column:
        step = following - current == 1
        if wraps:
            step = step | ((following == 1) & current.isin(*wraps))
        return F.coalesce(step, F.lit(False))

    rows = df.groupBy(
        F.col(partition).alias("__p"), F.col(order).alias("__o"), F.col(value).alias("__v")
    ).agg(F.count("*").alias("__copies"))
    stretches = rows.repartitionByRange("__p", "__o", "__v").withColumn(
        "__stretch", F.spark_partition_id()
    )
    inside = Window.partitionBy("__p", "__stretch").orderBy("__o", "__v")
    steps = stretches.withColumns(
        {
            "__next": F.lead("__v").over(inside),
            "__last": F.lead(F.lit(True)).over(inside).isNull(),
        }
    )
    v = F.col("__v")
    repeats_ok = (F.col("__copies") == 1) | follows(v, v)
    step_ok = F.col("__last") | follows(v, F.col("__next"))
    place = F.struct("__o", "__v")
    summary = steps.groupBy("__p", "__stretch").agg(
        F.bool_and(repeats_ok & step_ok).alias("__ok"),
        F.min(place).alias("__from"),
        F.max(place).alias("__to"),
    )
    across = Window.partitionBy("__p").orderBy("__stretch")
    seam = F.lead("__from").over(across)
    joined = summary.withColumn(
        "__seam_ok", seam.isNull() | follows(F.col("__to.__v"), seam.getField("__v"))
    )
    return joined.groupBy(F.col("__p").alias(partition)).agg(
        F.bool_and(F.col("__ok") & F.col("__seam_ok")).alias("ok")
    )
