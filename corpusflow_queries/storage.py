"""Sources, sinks, merges and the ingestion stages.

Every query writes below the shared folder, under names of its own, and reads back.
"""

from __future__ import annotations

import io
import json
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.prompts import GOLD_PROMPT
from corpusflow.operators.upsert import upsert
from corpusflow.plans import stages
from corpusflow.sinks import tables as sinks
from corpusflow.sources.files import expand_archives, read_archives, read_json_docs
from corpusflow.sources.tables import SPLITS, read_splits, read_tables
from corpusflow.storage import staging_path
from corpusflow_queries import inputs as I
from corpusflow_queries.registry import query

_TS = datetime(2024, 5, 1, 12, 0, 0)


def _new_schema(spark: SparkSession) -> str:
    name = f"cf_{uuid.uuid4().hex[:12]}"
    sinks.ensure_schema(spark, name, staging_path(spark, name))
    return name


# --- upsert ----------------------------------------------------------------------------

_CHANGES = """
SELECT CASE WHEN doc_id % 10 = 1 THEN doc_id + 100000000
            WHEN doc_id % 10 <> 3 THEN doc_id END AS doc_id,
       CASE WHEN doc_id % 8 = 2 THEN NULL WHEN doc_id % 4 = 0 THEN 1 - quality
            ELSE quality END AS quality,
       toxic + 1 AS toxic
FROM labels
"""


def _upsert_sql(differs: str) -> str:
    return f"""
    SELECT CASE WHEN t.hit THEN t.doc_id ELSE s.doc_id END AS doc_id,
           CASE WHEN t.hit IS NULL THEN s.quality
                WHEN s.hit AND {differs} THEN s.quality ELSE t.quality END AS quality,
           CASE WHEN t.hit THEN t.toxic ELSE s.toxic END AS toxic
    FROM (SELECT *, TRUE AS hit FROM labels) t
    FULL JOIN (SELECT *, TRUE AS hit FROM ({_CHANGES})) s ON s.doc_id = t.doc_id"""


def _labels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The labels and a change for each: altered, nulled, as before, unknown or keyless."""
    target = I.table(spark, sf_dir, "labels")
    doc_id, quality = F.col("doc_id"), F.col("quality")
    changes = target.select(
        F.when(doc_id % 10 == 1, doc_id + 100000000)
        .when(doc_id % 10 != 3, doc_id)
        .alias("doc_id"),
        F.when(doc_id % 8 == 2, F.lit(None))
        .when(doc_id % 4 == 0, 1 - quality)
        .otherwise(quality)
        .alias("quality"),
        (F.col("toxic") + 1).alias("toxic"),
    )
    return target, changes


@query("upsert", _upsert_sql("coalesce(s.quality <> t.quality, FALSE)"))
def upsert_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, changes = _labels(spark, sf_dir)
    return upsert(target, changes, ["doc_id"], exclude=["toxic"])


@query("upsert_null_safe", _upsert_sql("s.quality IS DISTINCT FROM t.quality"))
def upsert_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, changes = _labels(spark, sf_dir)
    return upsert(target, changes, ["doc_id"], exclude=["toxic"], null_safe=True)


@query("upsert_table", _upsert_sql("coalesce(s.quality <> t.quality, FALSE)"))
def upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first save creates the table, the second merges into it."""
    target, changes = _labels(spark, sf_dir)
    name = f"{_new_schema(spark)}.labels"
    config = sinks.UpsertConfig(["doc_id"], ["toxic", sinks.TIMESTAMP_COLUMN])
    for rows in (target, changes):
        sinks.save(rows, name, mode="upsert", upsert_config=config, ts=_TS)
    return spark.table(name).drop(sinks.TIMESTAMP_COLUMN)


@query(
    "upsert_partitioned",
    """SELECT d.doc_id, d.lang,
              CASE WHEN d.doc_id % 7 = 0 AND d.source IS NOT NULL THEN upper(d.source) ELSE d.source END AS source,
              d.n_chars FROM documents d WHERE lang = 'fr' OR lang = 'es'
       UNION ALL SELECT doc_id, lang, source, n_chars FROM documents
                 WHERE lang IS NULL OR lang NOT IN ('fr', 'es')
       UNION ALL SELECT -1 - doc_id, lang, source, n_chars FROM documents WHERE lang = 'fr' AND doc_id % 5 = 0""",
)
def upsert_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes and new rows for two languages of a table partitioned by language and half."""
    docs = I.table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", "lang")
    docs = docs.withColumn("half", F.pmod("doc_id", F.lit(2)))
    name = f"{_new_schema(spark)}.documents"
    sinks.save(docs, name, mode="overwrite", partition_by=["lang", "half"], ts=_TS)
    some = docs.where("lang IN ('fr', 'es')")
    changes = some.where("doc_id % 7 = 0").withColumn("source", F.upper("source"))
    fresh = some.where("lang = 'fr' AND doc_id % 5 = 0").withColumn("doc_id", -1 - F.col("doc_id"))
    config = sinks.UpsertConfig(["doc_id", "lang", "half"], [sinks.TIMESTAMP_COLUMN])
    sinks.save(changes.unionByName(fresh), name, mode="upsert", upsert_config=config, ts=_TS)
    return spark.table(name).select("doc_id", "lang", "source", "n_chars")


# --- keyed tables ----------------------------------------------------------------------


@query(
    "keyed_table_violations",
    "SELECT conv_id, count(*) AS n_rows FROM conversations GROUP BY conv_id HAVING count(*) > 1",
)
def keyed_table_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.key_violations(I.table(spark, sf_dir, "conversations"), "conv_id")


@query("keyed_table", "SELECT conv_id, turn, upper(role) AS role FROM conversations")
def keyed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once, then merged with changed rows."""
    turns = I.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    name = f"{_new_schema(spark)}.turns"
    keys = ["conv_id", "turn"]
    sinks.write_keyed_table(turns, name, keys)
    sinks.write_keyed_table(turns.withColumn("role", F.upper("role")), name, keys, mode="merge")
    return spark.table(name)


@query(
    "keyed_merge_partitioned",
    """SELECT conv_id, turn, CASE WHEN conv_id % 10 = 0 AND role = 'user' THEN 'asker' ELSE role END AS role,
              CASE WHEN conv_id % 10 = 0 THEN md5(text) ELSE text END AS text FROM conversations
       UNION ALL SELECT conv_id, turn + 1000, 'later', text FROM conversations WHERE conv_id % 10 = 1""",
)
def keyed_merge_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitioned by a column that is no key: rows move to other partitions and new ones come."""
    turns = I.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", "role")
    name = f"{_new_schema(spark)}.turns"
    keys = ["conv_id", "turn"]
    sinks.write_keyed_table(turns, name, keys, partition_by="role")
    moved = turns.where("conv_id % 10 = 0").withColumns(
        {"text": F.md5("text"), "role": F.when(F.col("role") == "user", "asker").otherwise(F.col("role"))}
    )
    later = turns.where("conv_id % 10 = 1").withColumns({"turn": F.col("turn") + 1000, "role": F.lit("later")})
    sinks.write_keyed_table(moved.unionByName(later), name, keys, mode="merge")
    return spark.table(name)


# --- plain tables ----------------------------------------------------------------------


@query(
    "save_roundtrip",
    """SELECT doc_id, text, lang, source, n_chars,
       TIMESTAMP '2024-05-01 12:00:00' AS processing_ts FROM documents""",
)
def save_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned table, written in two parts and compacted."""
    docs = I.table(spark, sf_dir, "documents")
    name = f"{_new_schema(spark)}.documents"
    english = F.col("lang") == "en"
    sinks.save(docs.where(english), name, mode="append", partition_by="lang", ts=_TS)
    sinks.save(
        docs.where(~english), name, mode="append", partition_by="lang", optimize=True, ts=_TS
    )
    # Read as wall-clock time, whatever the session's time zone.
    return spark.table(name).withColumn("processing_ts", F.col("processing_ts").cast("timestamp_ntz"))


@query(
    "merged_schema",
    """SELECT doc_id, quality, CASE WHEN doc_id % 2 = 0 THEN toxic END AS toxic FROM labels
       UNION ALL SELECT doc_id + 1000000000, quality, NULL FROM labels WHERE doc_id % 3 = 0""",
)
def merged_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the rows come first, in a partitioned table, and lack a column the others bring;
    rows that lack it again come last."""
    labels = I.table(spark, sf_dir, "labels").select("doc_id", "toxic", "quality")
    name = f"{_new_schema(spark)}.labels"
    sinks.save_table(labels.where("doc_id % 2 = 1").drop("toxic"), name, partition_by="quality")
    sinks.save_table(labels.where("doc_id % 2 = 0"), name, merge_schema=True)
    last = labels.where("doc_id % 3 = 0").withColumn("doc_id", F.col("doc_id") + 1000000000)
    sinks.save_table(last.drop("toxic"), name, merge_schema=True)
    return spark.table(name)


@query("compacted_table", "SELECT event_id, user_id, event_type, value FROM events")
def compacted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = I.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    name = f"{_new_schema(spark)}.events"
    sinks.save_table(events.repartition(16), name)
    sinks.compact_table(spark, name)
    return spark.table(name)


@query("compacted_partitions", "SELECT event_id, user_id, value, event_type FROM events")
def compacted_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended in three parts, of which the last one only brings files to some partitions."""
    events = I.table(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type")
    name = f"{_new_schema(spark)}.events"
    third = F.pmod("event_id", F.lit(3))
    for i in range(3):
        sinks.save(events.where(third == i), name, partition_by="event_type", optimize=True, ts=_TS)
    return spark.table(name).drop(sinks.TIMESTAMP_COLUMN)


# One write lands all splits, each in a folder named like this.
_FOLDER = "split={split}"


def _landed_splits(spark: SparkSession, sf_dir: str, keep: Sequence[str] = ()) -> str:
    """Documents with a summary, as one folder of files per split; ids only where asked for."""
    docs = I.articles(spark, sf_dir).select(
        *keep,
        "article",
        I.first_long_sentence("article").alias("summary"),
        I.split_name("doc_id").alias("split"),
    )
    base = staging_path(spark, "landing")
    docs.write.partitionBy("split").parquet(base)
    return base


def _together(tables: dict[str, DataFrame]) -> DataFrame:
    labelled = [df.withColumn("split", F.lit(name)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, labelled)


@query(
    "split_read",
    f"SELECT doc_id, text AS article, {I.sql_split('doc_id')} AS split FROM documents",
)
def split_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files to tables; a fourth table that does not exist is skipped."""
    schema = _new_schema(spark)
    base = _landed_splits(spark, sf_dir, ["doc_id"])
    for name, df in read_splits(spark, base, folder=_FOLDER).items():
        sinks.save_table(df.drop("summary"), f"{schema}.{name}")
    return _together(read_tables(spark, schema, (*SPLITS, "extra"), missing="skip"))


def _feature_store(spark: SparkSession, sf_dir: str) -> str:
    """All three stages, from landed files to keyed tables."""
    base = _landed_splits(spark, sf_dir)
    bronze, gold = (stages.Layer(_new_schema(spark)) for _ in range(2))
    features = stages.Layer(_new_schema(spark), keyed=True)
    stages.run_pipeline(lambda _: stages.source_to_bronze(spark, base, folder=_FOLDER), bronze, ts=_TS)
    raw = read_tables(spark, bronze.schema_name)
    stages.run_pipeline(lambda _: stages.bronze_to_gold(raw), gold, ts=_TS)
    prompted = read_tables(spark, gold.schema_name)
    stages.run_pipeline(lambda _: stages.gold_to_feature_store(prompted), features, ts=_TS)
    return features.schema_name


_FIXED_LENGTH = len(f"<s>[INS] {GOLD_PROMPT}\nARTICLE:\n\nPlain Language Summary:[INST]\n</s>")


@query(
    "feature_store",
    f"""SELECT md5(d.text) AS digest, c.article_clean, {I.sql_split('c.doc_id')} AS split,
        length(c.article_clean) + length(c.summary) + {_FIXED_LENGTH} AS n_prompt,
        md5('<s>[INS] {GOLD_PROMPT.replace("'", "''")}' || chr(10) || 'ARTICLE:' || chr(10) || c.article_clean || chr(10)
            || 'Plain Language Summary:[INST]' || chr(10) || c.summary || '</s>') AS prompt_digest,
        TRUE AS has_id FROM ({I.CLEAN}) c JOIN documents d ON d.doc_id = c.doc_id""",
)
def feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables land without ids; the last stage gives each document one of its own."""
    tables = read_tables(spark, _feature_store(spark, sf_dir))
    rows = _together(tables)
    return rows.select(
        F.md5("article").alias("digest"),
        "article_clean",
        "split",
        F.length("model_input").cast("long").alias("n_prompt"),
        F.md5("model_input").alias("prompt_digest"),
        F.col("doc_id").isNotNull().alias("has_id"),
    )


@query(
    "feature_store_snippets",
    f"""SELECT CASE WHEN c.doc_id IS NOT NULL THEN md5(d.text) END AS digest,
        n.article_snippet, n.snippet_len, n.split_id, {I.sql_split('n.doc_id')} AS split, TRUE AS keyed
        FROM ({I.SNIPPETS}) n JOIN documents d ON d.doc_id = n.doc_id
        LEFT JOIN ({I.CLEAN}) c ON c.doc_id = n.doc_id""",
)
def feature_store_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snippets beside the digest of the document that their generated id leads to, if any of its
    snippets is long enough for the document table."""
    schema = _feature_store(spark, sf_dir)
    snippets = _together(read_tables(spark, schema, suffix="_snippets"))
    docs = _together(read_tables(spark, schema)).select("split", "doc_id", F.md5("article").alias("digest"))
    made = F.concat_ws("_", "doc_id", "split_id")
    return snippets.join(docs, ["split", "doc_id"], "left").select(
        "digest", "article_snippet", "snippet_len", "split_id", "split", (F.col("doc_split_id") == made).alias("keyed")
    )


@query(
    "cached_stage",
    f"""SELECT {I.sql_split('doc_id')} AS split, count(*) AS n_snippets, sum(snippet_len)::BIGINT AS n_words,
        TRUE AS held_while_saving, TRUE AS released FROM ({I.SNIPPETS}) GROUP BY ALL""",
)
def cached_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage with its snippets in a cache scope: held while tables are saved, free after."""
    base = _landed_splits(spark, sf_dir)
    gold = {
        name: df.withColumn("prompt", F.lit(GOLD_PROMPT))
        for name, df in read_splits(spark, base, folder=_FOLDER).items()
    }
    features = stages.Layer(_new_schema(spark), keyed=True)
    cached: list[DataFrame] = []
    held: list[bool] = []

    def transform(scope: stages.CacheScope) -> Iterator[stages.TableOutput]:
        outputs = stages.gold_to_feature_store(gold, scope=scope)
        cached.extend(o.df for o in outputs if o.table_name.endswith("_snippets"))
        for output in outputs:
            held.append(all(df.is_cached for df in cached))
            yield output

    stages.run_pipeline(transform, features, ts=_TS)
    snippets = _together(read_tables(spark, features.schema_name, suffix="_snippets"))
    return snippets.groupBy("split").agg(F.count("*").alias("n_snippets"), F.sum("snippet_len").alias("n_words")).select(
        "*",
        F.lit(len(cached) == 3 and all(held)).alias("held_while_saving"),
        F.lit(not any(df.is_cached for df in cached)).alias("released"),
    )


# --- files -----------------------------------------------------------------------------


@query("json_docs", "SELECT doc_id, text, lang FROM documents")
def json_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as many JSON files, each one array of rows, read back in parallel."""
    docs = I.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")

    def arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 200):
                rows = batch.iloc[start : start + 200].to_dict("records")
                yield pd.DataFrame({"value": [json.dumps(rows, indent=1)]})

    path = staging_path(spark, "json")
    files = docs.mapInPandas(arrays, "value string")
    files.write.option("maxRecordsPerFile", 1).text(path)
    schema = T.StructType([f for f in docs.schema.fields])
    return read_json_docs(spark, path, schema)


@query(
    "archives",
    """SELECT doc_id::VARCHAR || '.zip' AS archive, unnest(['text/body.txt', 'lang.txt']) AS member,
       unnest([md5(text), md5(lang)]) AS digest FROM documents""",
)
def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One archive per document: a folder entry and two members."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, packed, size = [], [], 0
        for batch in batches:
            for doc_id, text, lang in zip(*(batch.column(c) for c in ("doc_id", "text", "lang"))):
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("text/", "")
                    archive.writestr("text/body.txt", text.as_py())
                    archive.writestr("lang.txt", lang.as_py())
                paths.append(f"{doc_id.as_py()}.zip")
                packed.append(buffer.getvalue())
                size += len(packed[-1])
                if size >= 1 << 20:  # a few hundred archives at a time
                    yield pa.RecordBatch.from_pydict({"path": paths, "content": packed})
                    paths, packed, size = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(packed, pa.binary())], ["path", "content"])

    docs = I.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    zipped = docs.mapInArrow(pack, "path string, content binary")
    return expand_archives(zipped).select("archive", "member", F.md5("content").alias("digest"))


@query(
    "archive_folder",
    """SELECT coalesce(source, 'none') AS archive, 'docs/' || doc_id || '.txt' AS member,
       strlen(text) AS n_bytes, md5(text) AS digest FROM documents""",
)
def archive_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of archives, one per packet of a source's documents, written by the tasks that have
    them. Beside them lies a file that is none."""
    docs = I.table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce("source", F.lit("none")).alias("source"))
    folder = staging_path(spark, "archives")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source, rows in batch.groupby("source"):
                name = f"{source}~{uuid.uuid4().hex}.zip"
                with _new_file(f"{folder}/{name}") as file, zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("docs/", "")
                    for doc_id, text in zip(rows["doc_id"], rows["text"]):
                        archive.writestr(f"docs/{doc_id}.txt", text)
                yield pd.DataFrame({"name": [name]})

    names = docs.mapInPandas(pack, "name string")
    written = f"{folder}-names"
    names.write.parquet(written)  # a task that is tried again leaves archives that are not listed
    found = read_archives(spark, folder).withColumn("name", F.substring_index("archive", "/", -1))
    kept = found.join(spark.read.parquet(written), "name", "left_semi")
    return kept.select(
        F.substring_index("name", "~", 1).alias("archive"),
        "member",
        F.octet_length("content").cast("long").alias("n_bytes"),
        F.md5("content").alias("digest"),
    )


def _new_file(path: str):
    """A file to write to, in any store that Arrow knows."""
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(path)
    store.create_dir(place.rsplit("/", 1)[0])
    return store.open_output_stream(place)
