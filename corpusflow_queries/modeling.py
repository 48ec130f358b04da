"""Training sets and batched prediction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators.inference import echo_with, extractive_generator
from corpusflow.plans import modeling
from corpusflow.sinks import tables as sinks
from corpusflow.sinks.files import write_predictions
from corpusflow.storage import staging_path
from corpusflow_queries import inputs as I
from corpusflow_queries.prompts import _ANSWER, _BATCH
from corpusflow_queries.registry import query
from corpusflow_queries.storage import _new_schema, _together


@query(
    "training_export",
    f"SELECT {_BATCH} || {_ANSWER} AS text, {I.sql_split('conv_id')} AS split FROM ({I.PAIRS})",
)
def training_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary-pair tables to prompts to sharded files, read back."""
    schema = _new_schema(spark)
    rows = I.pairs(spark, sf_dir).select(
        F.col("reference").alias("gpt_summary"),
        F.col("prediction").alias("summary"),
        I.split_name("conv_id").alias("split"),
    )
    for name in ("train", "validation", "test"):
        part = rows.where(F.col("split") == name).drop("split")
        sinks.save_table(part, f"{schema}.{name}_gpt_summary")
    texts = modeling.training_texts(spark, schema)
    paths = modeling.export_training_sets(texts, staging_path(spark, "training"))
    return _together({name: spark.read.parquet(path) for name, path in paths.items()})


@query(
    "sampled_export",
    f"""SELECT {I.sql_split('doc_id')} AS split, TRUE AS from_the_table, TRUE AS plausible_size
        FROM documents GROUP BY ALL""",
)
def sampled_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seeded share of each split's prompts as files: all come from the table, about as many as asked."""
    schema = _new_schema(spark)
    docs = I.documents(spark, sf_dir).select(I.split_name("doc_id").alias("split"), F.col("text").alias("model_input"))
    for name in ("train", "validation", "test"):
        sinks.save_table(docs.where(F.col("split") == name).drop("split"), f"{schema}.{name}")
    drawn = modeling.sampled_inputs(spark, schema, fraction=0.4, seed=5)
    paths = modeling.export_training_sets(drawn, staging_path(spark, "sampled"))
    read = _together({name: spark.read.parquet(path) for name, path in paths.items()})
    row = ["split", F.md5("model_input").alias("digest")]
    drawn_counts = read.select(*row).groupBy("split", "digest").agg(F.count("*").alias("drawn"))
    counts = docs.select(*row).groupBy("split", "digest").agg(F.count("*").alias("there"))
    both = counts.join(drawn_counts, ["split", "digest"], "full").groupBy("split").agg(
        F.sum("drawn").alias("n"),
        F.sum("there").alias("n_all"),
        F.bool_and(F.coalesce("drawn", F.lit(0)) <= F.coalesce("there", F.lit(0))).alias("from_the_table"),
    )
    spread = 6 * F.sqrt(F.col("n_all") * 0.4 * 0.6)
    plausible = F.abs(F.coalesce("n", F.lit(0)) - 0.4 * F.col("n_all")) <= spread
    return both.select("split", "from_the_table", plausible.alias("plausible_size"))


def _load():
    return echo_with(extractive_generator(1))


_PREDICTED = f"""
SELECT doc_id, n - 1 AS seq_no, CASE n WHEN 1 THEN {I.sql_leading("text", 1)}
       ELSE {I.sql_leading("text", 2)} END AS predicted_summary
FROM documents, (SELECT unnest([1, 2]) AS n)
"""


@query("batch_predict", _PREDICTED)
def batch_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = I.documents(spark, sf_dir)
    return modeling.predict(
        asked, _load, "text", keep=["doc_id"], params={"num_return_sequences": 2}
    ).drop("articles")


@query(
    "written_predictions",
    f"""SELECT text AS articles, {I.sql_leading("text", 1)} AS predicted_summary
        FROM documents""",
)
def written_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = I.documents(spark, sf_dir)
    path = staging_path(spark, "predictions")
    write_predictions(modeling.predict(asked, _load, "text"), path)
    return spark.read.schema("articles string, predicted_summary string").json(path)
