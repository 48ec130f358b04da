"""File exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def export_training_text(
    df: DataFrame,
    columns: Sequence[str],
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
) -> None:
    """Hand a trainer sharded files instead of pulling the rows to one machine."""
    df.select(*columns).write.format(fmt).mode(mode).save(path)


def write_predictions(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines with ``articles`` and ``predicted_summary``."""
    df.select("articles", "predicted_summary").write.mode(mode).json(path)
