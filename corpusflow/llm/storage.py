"""Shared folders for results that are cut from their lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from corpusflow.storage import staging_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """An unused path below the folder that the cluster names in ``spark.checkpoint.dir``."""
    return staging_path(spark, purpose)


@contextmanager
def leaving_no_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that end in the block take their shuffle files along.

    Otherwise these lie beside the written rows until the driver happens to collect its garbage.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read back."""
    path = fresh_folder(df.sparkSession, purpose)
    with leaving_no_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """The rows as a table of the warehouse, and its name, for the caller to drop with its files."""
    spark = df.sparkSession
    name = f"{purpose.replace('-', '_')}_{uuid.uuid4().hex}"
    with leaving_no_shuffles(spark):
        df.write.saveAsTable(name, format="parquet")
    return spark.table(name), name


def bucketed(
    df: DataFrame, purpose: str, by: str, buckets: int, to: str | None = None
) -> tuple[DataFrame, str]:
    """The rows as a table of the warehouse in buckets, and its name, for the caller to drop.

    Windows and joins on the column ``by`` read such a table without a shuffle. The rows should come
    in as many partitions by that column, so that a bucket is one file. With ``to``, the rows are
    added to that table, which was made alike.
    """
    spark = df.sparkSession
    name = to or f"{purpose.replace('-', '_')}_{uuid.uuid4().hex}"
    with leaving_no_shuffles(spark):
        df.write.mode("append").bucketBy(buckets, by).saveAsTable(name, format="parquet")
    return spark.table(name), name
