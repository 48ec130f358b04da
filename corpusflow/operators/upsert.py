"""Merge of a source into a target as a plain DataFrame rewrite."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.errors import ColumnException
from corpusflow.functions.conditions import changed_condition, merge_condition, update_map
from corpusflow.operators.joins import distinct_keys, half


def upsert(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    exclude: Iterable[str] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """The target after the merge.

    Matched and changed: the non-excluded columns come from the source. Matched and
    unchanged, or in the target only: the row stays. In the source only: the row is
    inserted with all its columns. Null keys match nothing. Several source rows for a
    matched key raise an error when the plan runs.

    Updates and inserts are separate joins with one row per key on the right; the side that may
    hold a hot key, or many rows without one, is on the left, where the engine can split it. The
    target is read twice, the second time for its keys only, and the source twice.
    """
    excluded = set(exclude or ())
    on = list(on)
    for side, table in (("target", target), ("source", source)):
        lacking = [c for c in on if c not in table.columns]
        if lacking:
            raise ColumnException(f"match columns not in the {side}: {lacking}")
    extra = [c for c in source.columns if c not in target.columns]
    if extra:
        raise ColumnException(f"source columns not in the target: {extra}")
    condition = merge_condition(on)
    changed = changed_condition(source.columns, excluded, null_safe)

    keys_known = reduce(and_, [F.col(f"`{c}`").isNotNull() for c in on])
    source_keyed = source.where(keys_known)
    one_per_key = source_keyed.groupBy(*on, half(*on)).agg(
        F.first(F.struct(*source.columns)).alias("row"), F.count("*").alias("rows")
    )
    src = one_per_key.select("row.*", F.col("rows").alias("__rows")).alias("src")
    joined = target.alias("tgt").join(src, condition, "left")

    matched = F.col("src.__rows").isNotNull()
    ambiguous = F.when(
        F.col("src.__rows") > 1,
        F.raise_error(F.lit("several source rows match the same target row")).cast("boolean"),
    )
    take = F.coalesce(ambiguous, matched & changed, F.lit(False))
    updates = {t.split(".", 1)[1]: s for t, s in update_map(source.columns, excluded).items()}
    merged = joined.withColumn("__take", take).select(
        *[
            (
                F.when(F.col("__take"), F.col(f"src.`{c}`").cast(field.dataType))
                .otherwise(F.col(f"tgt.`{c}`"))
                .alias(c)
                if c in updates
                else F.col(f"tgt.`{c}`")
            )
            for c, field in ((f.name, f) for f in target.schema.fields)
        ]
    )

    known = distinct_keys(target.where(keys_known), *on).alias("tgt")
    inserts = source.alias("src").join(known, condition, "left_anti")
    return merged.unionByName(_as_target(inserts, target), allowMissingColumns=False)


def _as_target(rows: DataFrame, target: DataFrame) -> DataFrame:
    """Target columns in target types; a column the source lacks is null."""
    return rows.select(
        *[
            (F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in target.schema.fields
        ]
    )
