"""Saving, merging, keying and compacting catalog tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from corpusflow.errors import KeyViolation
from corpusflow.operators.joins import distinct_keys
from corpusflow.operators.upsert import upsert
from corpusflow.storage import staging_path

TIMESTAMP_COLUMN = "processing_ts"  # fixed value
MOST_PARTITIONS = 10_000
#: Files below half of this are small; two or more of them in a partition are worth a rewrite.
FILE_BYTES = 32 << 20
_VERSION = "__version_"  # marks the folders of replaced tables
# Properties that the engine sets itself and lets nobody set.
_RESERVED = ("comment", "external", "location", "owner", "provider", "collation", "is_managed_location")
_KEYS = "corpusflow.primary_keys"  # the table property that names keys known to be unique


@dataclass(frozen=True)
class UpsertConfig:
    on_match_cols: Sequence[str]
    exclusion_list: Sequence[str] = field(default_factory=tuple)
    null_safe: bool = False


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def with_processing_ts(df: DataFrame, ts: datetime | None = None) -> DataFrame:
    """One audit timestamp, the same on every row of the call.

    A ``ts`` without a time zone is wall-clock time in the session's zone.
    """
    moment = ts or datetime.now(timezone.utc)
    return df.withColumn(TIMESTAMP_COLUMN, F.lit(moment.isoformat(" ")).cast("timestamp"))


def _partition_list(partition_by: str | Sequence[str] | None) -> list[str]:
    if partition_by is None:
        return []
    return [partition_by] if isinstance(partition_by, str) else list(partition_by)


def save_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    mode: str = "append",
    merge_schema: bool = False,
    partition_by: str | Sequence[str] | None = None,
) -> None:
    """Write a table.

    ``merge_schema`` lets an append bring new columns or lack some: new ones are added to the
    table's schema, and the rows are appended as files of their own. Earlier rows have null in a
    new column without being rewritten; partitioning, comment and properties stay.
    """
    spark = df.sparkSession
    parts = _partition_list(partition_by)
    if mode == "append" and table_exists(spark, name):
        _forget_keys(spark, name)
        if merge_schema:
            _widened(df, name).write.mode("append").insertInto(name)
            return
    df.write.format(fmt).mode(mode).saveAsTable(name, partitionBy=parts or None)


def _widened(df: DataFrame, name: str) -> DataFrame:
    """Add to the table the columns that only the rows have; the rows in the table's columns."""
    spark = df.sparkSession
    known = {c.lower() for c in spark.table(name).columns}
    fresh = [f for f in df.schema.fields if f.name.lower() not in known]
    if fresh:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    brought = {c.lower() for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name.lower() in brought else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in spark.table(name).schema.fields
        ]
    )


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    """What users and this module noted about a table, without the engine's own entries."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {
        r["key"]: r["value"]
        for r in rows
        if r["key"] not in _RESERVED and not r["key"].startswith(("spark.sql.", "transient_"))
    }


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _set_properties(spark: SparkSession, name: str, properties: dict[str, str]) -> None:
    if properties:
        listed = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")


def _forget_keys(spark: SparkSession, name: str) -> None:
    """Rows are about to come that nobody has checked."""
    if _KEYS in _properties(spark, name):
        spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ({_quoted(_KEYS)})")


def _details(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalog says of the table as a whole."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    at = next(i for i, r in enumerate(rows) if r["col_name"].startswith("# Detailed"))
    return {r["col_name"]: r["data_type"] for r in rows[at + 1 :]}


def _dress(spark: SparkSession, name: str, like: str) -> None:
    """Give a table the comment, properties and column comments of another."""
    _set_properties(spark, name, {k: v for k, v in _properties(spark, like).items() if k != _KEYS})
    comment = _details(spark, like).get("Comment")
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(comment)}")
    own = set(spark.table(name).columns)
    for column in spark.catalog.listColumns(like):
        if column.description and column.name in own and not column.isPartition:
            spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{column.name}` COMMENT {_quoted(column.description)}")


def _folder(spark: SparkSession, name: str) -> str:
    """The folder of a table's schema."""
    schema = name.rsplit(".", 1)[0] if "." in name else spark.catalog.currentDatabase()
    return spark.catalog.getDatabase(schema).locationUri.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def replace_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    partition_by: str | Sequence[str] | None = None,
    check: Callable[[DataFrame], None] | None = None,
) -> None:
    """Put new contents under a name; ``df`` may read the table it replaces.

    The rows go to a folder of their own under a staging name, and the names are swapped
    at the end: a failed write changes nothing and readers never meet a half-written table,
    but between the two renames the name is missing for a moment (and a catalog that keeps a
    managed table's folder by its name moves it). Comments and properties go over to the new
    version. The replaced one is deleted last. ``check`` may look at the staged rows and raise
    to call the swap off.
    """
    spark = df.sparkSession
    tag = uuid.uuid4().hex[:12]
    staging, old = f"{name}__new_{tag}", f"{name}__old_{tag}"
    version = f"{_folder(spark, name)}/{name.rsplit('.', 1)[-1]}{_VERSION}{tag}"
    parts = _partition_list(partition_by)
    writer = df.write.format(fmt).mode("errorifexists").option("path", version)
    try:
        writer.saveAsTable(staging, partitionBy=parts or None)
        if check is not None:
            check(spark.table(staging))
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        _delete(spark, version)
        raise
    if not table_exists(spark, name):
        spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")
        return
    _dress(spark, staging, name)
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")
    except Exception:
        spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    replaced = _details(spark, old)["Location"]
    spark.sql(f"DROP TABLE {old}")
    if _VERSION in replaced.rsplit("/", 1)[-1]:  # only folders made here
        _delete(spark, replaced)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _in_partitions(target: DataFrame, parts: Sequence[str], values: Sequence[Row]) -> DataFrame:
    """The rows of some partitions. The test on each column prunes the scan; with several
    partition columns a join with the values, ``MOST_PARTITIONS`` at most, makes it exact."""
    tests = []
    for part in parts:
        kind = target.schema[part].dataType
        known = {row[part] for row in values if row[part] is not None}
        test = F.col(part).isin([F.lit(v).cast(kind) for v in known]) if known else F.lit(False)
        if any(row[part] is None for row in values):
            test = test | F.col(part).isNull()
        tests.append(test)
    pruned = target.where(reduce(and_, tests))
    return pruned if len(parts) == 1 else _semi(pruned, parts, _few_rows(target, parts, values))


def _few_rows(target: DataFrame, parts: Sequence[str], values: Sequence[Row]) -> DataFrame:
    kinds = target.select(*parts).schema
    return F.broadcast(target.sparkSession.createDataFrame([tuple(v) for v in values], kinds))


def _semi(df: DataFrame, columns: Sequence[str], found: DataFrame) -> DataFrame:
    """The rows whose columns, nulls included, are among those found."""
    other = found.toDF(*[f"__{c}" for c in columns])
    return df.join(other, reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in columns]), "left_semi")


@contextmanager
def _staged(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """The rows as a table in the shared folder, worked out once and deleted afterwards."""
    spark = df.sparkSession
    path = staging_path(spark, purpose)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _delete(spark, path)


def upsert_table(
    source: DataFrame,
    name: str,
    config: UpsertConfig,
    fmt: str = "parquet",
    partition_by: str | Sequence[str] | None = None,
) -> None:
    """Merge into an existing table; the first call creates it.

    Of a partitioned table only touched partitions are read as a whole and rewritten: those that
    the source's rows belong to, and those where rows with its keys lie now, which a scan of the
    key columns finds unless the match columns include the partition columns. Files of other
    partitions stay. The source is worked out once. New files are complete before any old one
    goes, so a failure up to then changes nothing; partitions are then exchanged one by one.
    """
    spark = source.sparkSession
    if not table_exists(spark, name):
        replace_table(source, name, fmt, partition_by)
        return
    if _properties(spark, name).get(_KEYS) != _listed(config.on_match_cols):
        _forget_keys(spark, name)
    with _staged(source, "merge") as rows:
        _merge(rows, name, config, fmt, partition_by)


def _listed(keys: Sequence[str]) -> str:
    return ",".join(sorted(keys))


def _merge(
    rows: DataFrame, name: str, config: UpsertConfig, fmt: str, partition_by: str | Sequence[str] | None
) -> None:
    spark, on = rows.sparkSession, list(config.on_match_cols)
    target = spark.table(name)
    parts = _partition_columns(spark, name)

    def merged(into: DataFrame) -> DataFrame:
        return upsert(into, rows, on, config.exclusion_list, config.null_safe)

    touched = _touched(target, rows, parts, on).limit(MOST_PARTITIONS + 1).collect() if parts else []
    if not parts or len(touched) > MOST_PARTITIONS:
        replace_table(merged(target), name, fmt, parts or partition_by)
        return
    if not touched:
        return
    within = _in_partitions(target, parts, touched)
    before = _files(spark, name, parts, touched)
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        merged(within).hint("rebalance", *parts).write.mode("overwrite").insertInto(name)
    spark.catalog.refreshTable(name)
    if not set(parts) <= set(on):  # rows may have left a partition altogether
        _drop_emptied(spark, name, parts, before & _files(spark, name, parts, touched))


def _touched(target: DataFrame, rows: DataFrame, parts: Sequence[str], on: Sequence[str]) -> DataFrame:
    """Values of the partition columns where the merge may change something."""
    brought = rows.select(
        *[(F.col(f"`{p}`") if p in rows.columns else F.lit(None)).cast(target.schema[p].dataType).alias(p) for p in parts]
    ).distinct()
    if set(parts) <= set(on):
        return brought
    keys = distinct_keys(rows.dropna(subset=list(on)), *on)
    now = target.select(*dict.fromkeys([*on, *parts])).join(keys, list(on), "left_semi")
    return now.select(*parts).distinct().unionByName(brought).distinct()


def _files(spark: SparkSession, name: str, parts: Sequence[str], values: Sequence[Row]) -> set[tuple]:
    """Path and partition values of each file of some partitions."""
    path = F.col("_metadata.file_path").alias("__path")
    listed = spark.table(name).select("*", path).select("__path", *parts)
    return {tuple(r) for r in _in_partitions(listed, parts, values).distinct().collect()}


def _drop_emptied(spark: SparkSession, name: str, parts: Sequence[str], stale: set[tuple]) -> None:
    """Drop partitions that a merge left without rows; their old files were not replaced."""
    folders = {path.rsplit("/", 1)[0]: values for path, *values in stale}
    by_catalog = _details(spark, name).get("Partition Provider") == "Catalog"
    for folder, values in folders.items():
        if by_catalog:
            spec = ", ".join(f"`{p}` = " + ("NULL" if v is None else _quoted(str(v))) for p, v in zip(parts, values))
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    if folders:
        spark.catalog.refreshTable(name)


def key_violations(df: DataFrame, primary_keys: str | Sequence[str]) -> DataFrame:
    """Keys that are null or not unique, with their row count; empty means valid."""
    keys = _partition_list(primary_keys)
    any_null = F.greatest(*[F.col(f"`{k}`").isNull() for k in keys], F.lit(False))
    counts = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return counts.where((F.col("n_rows") > 1) | any_null)


def write_keyed_table(
    df: DataFrame,
    name: str,
    primary_keys: str | Sequence[str],
    mode: str = "overwrite",
    partition_by: str | Sequence[str] | None = None,
    fmt: str = "parquet",
) -> None:
    """Write a table whose keys are unique and not null; ``merge`` upserts on them.

    An overwrite checks the keys on the staged table, which reads only the key columns back
    instead of computing the rows a second time. A merge checks its own rows, staged likewise:
    a table with unique keys has unique keys after it too. That a table is such a one is noted
    in a property of it, which an unchecked append takes away; without the note, its keys are
    looked at once. Of a partitioned table only touched partitions are rewritten
    (see ``upsert_table``); partition columns need not be keys.
    """
    if mode not in ("overwrite", "merge"):
        raise ValueError(f"a keyed table is written with overwrite or merge, not {mode!r}")
    keys = _partition_list(primary_keys)
    if not keys:
        raise ValueError("a keyed table needs primary keys")
    spark = df.sparkSession

    def check(staged: DataFrame) -> None:
        examples = key_violations(staged, keys).take(5)
        if examples:
            raise KeyViolation(f"{name}: null or repeated keys {keys}, such as {examples}")

    if mode == "merge" and table_exists(spark, name):
        if _properties(spark, name).get(_KEYS) != _listed(keys):
            check(spark.table(name))
        with _staged(df, "keyed-merge") as rows:
            check(rows)
            _merge(rows, name, UpsertConfig(keys, null_safe=True), fmt, partition_by)
    else:
        replace_table(df, name, fmt, partition_by, check)
    _set_properties(spark, name, {_KEYS: _listed(keys)})


def file_sizes(spark: SparkSession, name: str) -> DataFrame:
    """Files, bytes and small files of each partition; reads no data columns."""
    parts = _partition_columns(spark, name)
    about = [F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_size").alias("__size")]
    files = spark.table(name).select(*parts, *about).groupBy(*parts, "__path").agg(F.max("__size").alias("__size"))
    small = F.count_if(F.col("__size") < F.lit(FILE_BYTES // 2))
    return files.groupBy(*parts).agg(
        F.count("*").alias("n_files"), F.sum("__size").alias("n_bytes"), small.alias("n_small")
    )


def compact_table(spark: SparkSession, name: str, target_files: int | None = None) -> None:
    """Rewrite what lies in many small files into fewer, larger ones.

    A partition (or a table without partitions) is rewritten if it has two small files or more;
    the others keep their files. The engine sizes the new files (``rebalance`` splits large
    partitions and merges small ones up to the advisory size), which also holds for skewed ones.
    ``target_files`` asks a table without partitions for that many files.
    """
    parts = _partition_columns(spark, name)
    fmt = _details(spark, name)["Provider"].lower()
    sizes = file_sizes(spark, name)
    if not parts:
        table, keys = spark.table(name), _properties(spark, name).get(_KEYS)
        now = sizes.first()
        if target_files is not None and now["n_files"] != target_files:
            replace_table(table.repartition(target_files), name, fmt)
        elif target_files is None and now["n_small"] > 1:
            replace_table(table.hint("rebalance"), name, fmt)
        else:
            return
        if keys:  # the same rows
            _set_properties(spark, name, {_KEYS: keys})
        return
    scattered = sizes.where("n_small > 1").select(*parts).collect()
    for at in range(0, len(scattered), MOST_PARTITIONS):
        some = _in_partitions(spark.table(name), parts, scattered[at : at + MOST_PARTITIONS])
        with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            some.hint("rebalance", *parts).write.mode("overwrite").insertInto(name)
        spark.catalog.refreshTable(name)


def save(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    mode: str = "append",
    primary_keys: str | Sequence[str] | None = None,
    partition_by: str | Sequence[str] | None = None,
    upsert_config: UpsertConfig | None = None,
    keyed: bool = False,
    optimize: bool = False,
    ts: datetime | None = None,
) -> None:
    """Stamp the rows, make the schema and write by the kind of table and mode.

    ``optimize`` writes files of the engine's advisory size at once; after an append or a merge
    it also compacts partitions that small files have gathered in.
    """
    if fmt.upper() == "VOLUME":
        raise ValueError("a volume holds files, not a table; nothing would be written")
    spark = df.sparkSession
    stamped = with_processing_ts(df, ts)
    if "." in name:
        ensure_schema(spark, name.rsplit(".", 1)[0])
    grown = optimize and mode != "overwrite" and table_exists(spark, name)
    if optimize:
        stamped = stamped.hint("rebalance", *_partition_list(partition_by))
    if keyed:
        write_keyed_table(stamped, name, primary_keys or (), mode, partition_by, fmt)
    elif mode == "upsert":
        if upsert_config is None:
            raise ValueError("mode 'upsert' needs an upsert_config")
        upsert_table(stamped, name, upsert_config, fmt, partition_by)
    elif mode == "overwrite":
        replace_table(stamped, name, fmt, partition_by)
    else:
        save_table(stamped, name, fmt, mode, partition_by=partition_by)
    if grown:
        compact_table(spark, name)
