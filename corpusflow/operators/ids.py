"""Row numbers and document ids that stay put.

An id must be the same whenever a row is worked out again. Ids therefore come from where a row
lies in its file, or from its contents; only rows that have neither are checkpointed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.errors import ColumnException
from corpusflow.storage import checkpointed

ROW_BITS = 33  # of an id that is made of a file's number and a row's place in it
#: Files up to which their numbers are broadcast.
FILES = 50_000
#: Copies of one row that a task writes out at a time.
COPIES = 10_000


def with_position(
    df: DataFrame, order_by: Sequence[Column | str], name: str = "position"
) -> DataFrame:
    """Dense 0-based row numbers in the given order, without a one-task window.

    The table is range partitioned and sorted, and rows are counted inside each partition.
    Only the partition sizes (one row per partition) are summed up in one place and
    broadcast back. Rows that tie are spread by the partition they came from, so a value
    held by a third of all rows does not end up in one task.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order_by]
    tie = "__origin"
    names = [f"__key{i}" for i in range(len(keys))]
    keyed = df.withColumns({**dict(zip(names, keys)), tie: F.spark_partition_id()})
    ranged = (
        keyed.repartitionByRange(*names, tie)
        .sortWithinPartitions(*names, tie)
        .drop(*names, tie)
        .withColumn("__slot", F.monotonically_increasing_id())
    )
    ranged = checkpointed(ranged)
    part = F.shiftright("__slot", 33).alias("__part")
    sizes = ranged.groupBy(part).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    )
    within = F.col("__slot").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        ranged.withColumn("__part", F.shiftright("__slot", 33))
        .join(F.broadcast(starts), "__part")  # one row per partition
        .withColumn(name, F.col("__start") + within)
        .drop("__part", "__start", "__slot")
    )


def with_doc_id(
    df: DataFrame, key_cols: Sequence[str] | None = None, id_col: str = "doc_id"
) -> DataFrame:
    """Give every row a unique long id.

    An id column that is there already is kept. Without ``key_cols`` the ids are unique
    and increasing but not dense: rows read from Parquet files get the file's number and their
    place in it, other rows a running number, checkpointed. With ``key_cols`` they are the
    positions in the order of the keys' digest, ties in the order of the whole row's digest:
    the same rows get the same ids whatever the layout of the table. Then only digests are
    checkpointed; the rows are read again and must be the same, else the job fails.
    """
    if id_col in df.columns:
        return df
    if key_cols is None:
        placed = _by_place(df, id_col)
        return checkpointed(df.withColumn(id_col, F.monotonically_increasing_id())) if placed is None else placed
    if not key_cols:
        raise ColumnException("key_cols must name at least one column")
    return _by_rank(df, key_cols, id_col)


def _by_place(df: DataFrame, id_col: str) -> DataFrame | None:
    """Ids from file and row number, or None where rows do not come straight from Parquet files."""
    place = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")]
    try:
        rows = df.select("*", *place)
        files = df.select(place[0]).distinct()
    except AnalysisException:
        return None
    numbers = with_position(files, ["__file"], "__number")
    if numbers.limit(FILES + 1).count() <= FILES:
        numbers = F.broadcast(numbers)
    number = F.shiftleft("__number", ROW_BITS)
    return rows.join(numbers, "__file").select(*[rows[c] for c in df.columns], (number + F.col("__row")).alias(id_col))


def _by_rank(df: DataFrame, key_cols: Sequence[str], id_col: str) -> DataFrame:
    """Ids from the rank of each row's digests in a table of digests alone.

    Rows that are alike in every column are as many neighbouring ranks; which of them gets which
    makes no difference. One of them is kept and written out as often as there are ranks, in
    packets, so that no task meets a large group of copies.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in key_cols]
    digests = {
        "__key": F.unhex(F.md5(F.concat_ws("\x1f", *parts))),
        "__whole": F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]),
    }
    keyed = df.withColumns(digests)
    ranks = (
        with_position(keyed.select(*digests), [*digests], "__rank")
        .groupBy(*digests)
        .agg(F.min("__rank").alias("__first"), F.count(F.lit(1)).alias("__n"))
    )
    ranks = checkpointed(ranks)
    found = keyed.join(ranks, [*digests], "left")
    changed = F.raise_error(F.lit("the rows changed between two readings; no stable id exists"))
    single = found.where("__n IS NULL OR __n = 1").select(
        *[found[c] for c in df.columns], F.coalesce("__first", changed.cast("long")).alias(id_col)
    )
    if not ranks.where("__n > 1").limit(1).count():
        return single
    copies = keyed.join(ranks.where("__n > 1"), [*digests])
    packet = F.explode(F.sequence(F.lit(0), F.col("__n") - 1, F.lit(COPIES).cast("long"))).alias("__packet")
    last = F.least(F.col("__packet") + COPIES, F.col("__n")) - 1
    repeated = (
        copies.groupBy(*digests, "__first", "__n")
        .agg(F.first(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("__row"))
        .select("__row", "__first", "__n", packet)
        .repartition("__first", "__packet")
        .select("__row", "__first", F.explode(F.sequence(F.col("__packet"), last)).alias("__copy"))
        .select("__row.*", (F.col("__first") + F.col("__copy")).alias(id_col))
    )
    return single.unionByName(repeated)


def assign_batches(
    df: DataFrame, batch_size: int, order_by: Sequence[Column | str], name: str = "batch_id"
) -> DataFrame:
    """Number consecutive runs of ``batch_size`` rows; only the last run may be short."""
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    positions = with_position(df, order_by, "__position")
    return positions.withColumn(
        name, F.floor(F.col("__position") / batch_size).cast("long")
    ).drop("__position")
