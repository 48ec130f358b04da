"""The ingestion stages: landed files, raw tables, prompts, training features."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from corpusflow.functions.prompts import GOLD_PROMPT, model_input
from corpusflow.operators.columns import add_constant
from corpusflow.operators.ids import with_doc_id
from corpusflow.operators.snippets import MIN_WORDS, split_sentences, with_clean_article
from corpusflow.sinks.tables import UpsertConfig, save
from corpusflow.sources.tables import SPLITS, read_splits


@dataclass(frozen=True)
class Layer:
    """Where the tables of a stage live and how they are written."""

    schema_name: str
    catalog_name: str | None = None
    destination_file_format: str = "parquet"
    mode: str = "overwrite"
    keyed: bool = False

    def table(self, name: str) -> str:
        return ".".join(p for p in (self.catalog_name, self.schema_name, name) if p)


@dataclass(frozen=True)
class TableOutput:
    table_name: str
    df: DataFrame
    partition_by: str | Sequence[str] | None = None
    primary_keys: str | Sequence[str] | None = None
    upsert_config: UpsertConfig | None = None


class CacheScope:
    """Remembers what it cached."""

    def __init__(self, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
        self._level = level
        self._cached: list[DataFrame] = []

    def cache(self, df: DataFrame) -> DataFrame:
        self._cached.append(df.persist(self._level))
        return self._cached[-1]

    def release(self) -> None:
        while self._cached:
            self._cached.pop().unpersist()


@contextmanager
def cache_scope() -> Iterator[CacheScope]:
    """Everything cached inside is released at the end, after a failure too."""
    scope = CacheScope()
    try:
        yield scope
    finally:
        scope.release()


def run_pipeline(
    transform: Callable[[CacheScope], Iterable[TableOutput]],
    layer: Layer,
    optimize: bool = False,
    ts: datetime | None = None,
) -> list[str]:
    """Build the outputs of a stage and save them in order; the first failure stops it."""
    saved = []
    with cache_scope() as scope:
        for output in transform(scope):
            name = layer.table(output.table_name)
            save(
                output.df,
                name,
                fmt=layer.destination_file_format,
                mode=layer.mode,
                primary_keys=output.primary_keys,
                partition_by=output.partition_by,
                upsert_config=output.upsert_config,
                keyed=layer.keyed,
                optimize=optimize,
                ts=ts,
            )
            saved.append(name)
    return saved


def source_to_bronze(
    spark: SparkSession,
    base: str,
    splits: Sequence[str] = SPLITS,
    fmt: str = "parquet",
    folder: str = "{split}",
) -> list[TableOutput]:
    """Landed split files as they are."""
    found = read_splits(spark, base, splits, fmt, folder)
    return [TableOutput(name, df) for name, df in found.items()]


def bronze_to_gold(
    tables: Mapping[str, DataFrame], prompt: str = GOLD_PROMPT
) -> list[TableOutput]:
    """Every row gets the task prompt."""
    return [TableOutput(name, add_constant(df, "prompt", prompt)) for name, df in tables.items()]


def gold_to_feature_store(
    tables: Mapping[str, DataFrame],
    eos_token: str = "</s>",
    min_words: int = MIN_WORDS,
    abbreviations: Sequence[str] = (),
    id_keys: Sequence[str] | None = None,
    scope: CacheScope | None = None,
) -> list[TableOutput]:
    """Per split: a snippet table keyed by ``doc_split_id`` and a document table keyed by
    ``doc_id`` with ``article_clean`` and ``model_input``.

    Both come straight from the documents row by row. Cutting the text twice is cheaper
    than caching every snippet, so only a caller that reads the snippets again gains from
    passing a cache scope.
    """
    outputs = []
    for name, table in tables.items():
        docs = with_doc_id(table, id_keys)
        snippets = split_sentences(docs, "doc_id", "article", abbreviations)
        if scope is not None:
            snippets = scope.cache(snippets)
        features = with_clean_article(docs, "article", min_words, abbreviations).withColumn(
            "model_input", model_input("prompt", "article_clean", "summary", eos_token)
        )
        outputs.append(TableOutput(f"{name}_snippets", snippets, primary_keys="doc_split_id"))
        outputs.append(TableOutput(name, features, primary_keys="doc_id"))
    return outputs
