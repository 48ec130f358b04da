"""Training sets, batched prediction and evaluation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.prompts import extract_response, inference_prompt, training_prompt
from corpusflow.operators.columns import (
    DEFAULT_PARAMS,
    REQUEST_SCHEMA,
    enforce_signature,
    with_default_params,
)
from corpusflow.operators.inference import Generator, expand_sequences, generate_batches
from corpusflow.operators.sampling import sample
from corpusflow.sinks.files import export_training_text
from corpusflow.sources.tables import SPLITS, read_tables


def training_texts(
    spark: SparkSession, schema: str, names: Sequence[str] = SPLITS
) -> dict[str, DataFrame]:
    """``text`` prompts of the splits that have a summary-pair table."""
    tables = read_tables(spark, schema, names, suffix="_gpt_summary", missing="skip")
    text = training_prompt("gpt_summary", "summary").alias("text")
    return {
        name: df.select("gpt_summary", "summary").select(text).where("text is not null")
        for name, df in tables.items()
    }


def sampled_inputs(
    spark: SparkSession,
    schema: str,
    names: Sequence[str] = SPLITS,
    fraction: float = 0.1,
    seed: int = 0,
) -> dict[str, DataFrame]:
    """A seeded share of every split's ``model_input``."""
    tables = read_tables(spark, schema, names)
    return {name: sample(df.select("model_input"), fraction, seed) for name, df in tables.items()}


def export_training_sets(
    tables: Mapping[str, DataFrame], base: str, fmt: str = "parquet"
) -> dict[str, str]:
    """Write each split below ``base`` and give the paths."""
    paths = {name: f"{base.rstrip('/')}/{name}" for name in tables}
    for name, df in tables.items():
        export_training_text(df, df.columns, paths[name], fmt)
    return paths


def request(
    df: DataFrame,
    article: Column | str,
    keep: Sequence[str] = (),
    params: Mapping[str, Any] | None = None,
) -> DataFrame:
    """An inference request: the article, the parameters and the columns to keep."""
    text = F.col(article) if isinstance(article, str) else article
    rows = df.select(*keep, text.alias("articles"))
    return with_default_params(rows, params)


def predict(
    df: DataFrame,
    load: Callable[[], Generator],
    article: Column | str,
    keep: Sequence[str] = (),
    params: Mapping[str, Any] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Kept columns, ``articles``, ``seq_no`` and the ``predicted_summary`` after the marker."""
    asked = request(df, article, keep, params)
    enforce_signature(asked.drop(*keep), REQUEST_SCHEMA)
    prompted = asked.withColumn(
        "prompt",
        inference_prompt("articles", F.col("system_prompts"), F.col("instructions")),
    )
    settings = {**DEFAULT_PARAMS, **(params or {})}
    generated = generate_batches(prompted, load, settings, keep=[*keep, "articles"])
    return expand_sequences(generated, text="raw").select(
        *keep,
        "articles",
        "seq_no",
        extract_response("raw", strict=strict).alias("predicted_summary"),
    )
