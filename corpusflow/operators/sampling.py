"""Sampling, token lengths, truncation and length grouping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.tokens import regex_tokens

TRAINING_FRACTION = 0.1  # fixed value
_DIGITS = 15  # hex digits of a digest that are compared: 60 bits


def sample(df: DataFrame, fraction: float = TRAINING_FRACTION, seed: int = 0) -> DataFrame:
    """Seeded Bernoulli sample; the rows depend on the layout of the table."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(
    df: DataFrame, key: str, fraction: float = TRAINING_FRACTION, salt: str = ""
) -> DataFrame:
    """Keep a fixed share of keys, the same rows on any layout.

    The digest's first 60 bits are compared with the fraction, so tiny fractions work too. A
    null key has a digest of its own: such rows are kept or left out together.
    """
    named = F.coalesce(F.col(key).cast("string"), F.lit("\x00null"))
    digest = F.md5(F.concat(named, F.lit(salt)))
    slot = F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("long")
    return df.where(slot < int(fraction * 16**_DIGITS))


def with_token_count(
    df: DataFrame, text: str, name: str = "n_tokens", tokens: Column | None = None
) -> DataFrame:
    found = regex_tokens(text) if tokens is None else tokens
    return df.withColumn(name, F.size(found).cast("long"))


def token_length_stats(
    df: DataFrame, text: str, tokens: Column | None = None, accuracy: int = 10_000
) -> DataFrame:
    """One row: rows, total, mean, median, 95th percentile and longest token count."""
    counted = with_token_count(df.where(F.col(text).isNotNull()), text, tokens=tokens)
    quantile = F.percentile_approx("n_tokens", [0.5, 0.95], accuracy)
    return counted.agg(
        F.count("*").alias("n_rows"),
        F.sum("n_tokens").alias("total_tokens"),
        F.avg("n_tokens").alias("mean_tokens"),
        quantile.alias("q"),
        F.max("n_tokens").alias("max_tokens"),
    ).select(
        "n_rows",
        "total_tokens",
        "mean_tokens",
        F.col("q")[0].alias("p50_tokens"),
        F.col("q")[1].alias("p95_tokens"),
        "max_tokens",
    )


def truncate_tokens(
    df: DataFrame, text: str, n: int, name: str = "tokens", tokens: Column | None = None
) -> DataFrame:
    """The first ``n`` tokens of each text."""
    found = regex_tokens(text) if tokens is None else tokens
    return df.withColumn(name, F.slice(found, 1, n))


def length_buckets(
    df: DataFrame, length: str, width: int, name: str = "bucket", arrange: bool = True
) -> DataFrame:
    """Number rows by length and place rows of like length side by side.

    Rebalancing lets the engine split a bucket that holds most of the rows and merge small
    ones by their measured size; unlike range partitioning it needs no sampling pass, which
    would compute the lengths twice.
    """
    bucketed = df.withColumn(name, F.floor(F.col(length) / width).cast("long"))
    if not arrange:
        return bucketed
    return bucketed.hint("rebalance", name).sortWithinPartitions(name, length)
