"""Reading split tables."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import DataFrame, SparkSession

SPLITS = ("train", "validation", "test")  # fixed values


def read_splits(
    spark: SparkSession,
    base: str,
    splits: Sequence[str] = SPLITS,
    fmt: str = "parquet",
    folder: str = "{split}",
) -> dict[str, DataFrame]:
    """Landed files, one folder per split; ``folder`` says how a split's folder is named, such
    as ``split={split}`` where one write landed them all."""
    places = {split: f"{base.rstrip('/')}/{folder.format(split=split)}" for split in splits}
    return {split: spark.read.format(fmt).load(place) for split, place in places.items()}


def read_tables(
    spark: SparkSession,
    schema: str,
    names: Sequence[str] = SPLITS,
    suffix: str = "",
    missing: Literal["raise", "skip"] = "raise",
) -> dict[str, DataFrame]:
    """``schema.name + suffix`` for every name.

    With ``missing="skip"`` a table that does not exist is left out; any other failure
    still raises.
    """
    if missing not in ("raise", "skip"):
        raise ValueError(f"missing must be 'raise' or 'skip', not {missing!r}")
    tables = {}
    for name in names:
        full_name = f"{schema}.{name}{suffix}"
        if missing == "skip" and not spark.catalog.tableExists(full_name):
            continue
        tables[name] = spark.table(full_name)
    return tables
