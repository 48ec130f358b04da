"""Documents to sentence snippets and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.text import clean_article, clean_text, sentence_array, word_count

MIN_WORDS = 8  # fixed value: a snippet must have more words than this
_CHUNK = 4096  # snippets joined in the first step of a reassembly


def snippet_key(doc_id: Column, split_id: Column) -> Column:
    return F.concat_ws("_", doc_id, split_id)


def split_sentences(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "article",
    abbreviations: Sequence[str] = (),
    clean: bool = True,
) -> DataFrame:
    """One row per sentence: ``doc_split_id, article_snippet, doc_id, snippet_len, split_id``.

    Only the id and the text are carried along; a text without words gives no row.
    """
    text = clean_text(text_col) if clean else F.col(text_col)
    pieces = df.select(
        F.col(id_col).alias("doc_id"),
        F.posexplode(sentence_array(text, abbreviations)).alias("split_id", "article_snippet"),
    ).where(F.col("article_snippet") != "")
    return pieces.select(
        snippet_key(F.col("doc_id"), F.col("split_id")).alias("doc_split_id"),
        "article_snippet",
        "doc_id",
        word_count("article_snippet").alias("snippet_len"),
        F.col("split_id").cast("long").alias("split_id"),
    )


def dedupe_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Any one row per key. Copies are already reduced before the shuffle."""
    return df.dropDuplicates(list(keys))


def filter_short_snippets(snippets: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    return snippets.where(F.col("snippet_len") > min_words)


def _in_order(place: str, text: str) -> Column:
    rows = F.array_sort(F.collect_list(F.struct(place, text)))
    return F.concat_ws(" ", F.transform(rows, lambda r: r[text]))


def reassemble_document(snippets: DataFrame) -> DataFrame:
    """Snippets of each document joined by blanks in ``split_id`` order.

    Stretches of a few thousand snippets are joined first, so a very long document is
    sorted and joined by many tasks; only its stretches meet in one row.
    """
    stretches = snippets.groupBy(
        "doc_id", F.floor(F.col("split_id") / _CHUNK).alias("stretch")
    ).agg(_in_order("split_id", "article_snippet").alias("part"))
    return stretches.groupBy("doc_id").agg(_in_order("stretch", "part").alias("article_clean"))


def clean_articles(
    docs: DataFrame, snippets: DataFrame, min_words: int = MIN_WORDS
) -> DataFrame:
    """Add ``article_clean`` from a table of snippets; documents without one disappear."""
    rebuilt = reassemble_document(filter_short_snippets(snippets, min_words))
    return docs.join(rebuilt, "doc_id", "inner")


def with_clean_article(
    df: DataFrame,
    text_col: str = "article",
    min_words: int = MIN_WORDS,
    abbreviations: Sequence[str] = (),
) -> DataFrame:
    """What ``clean_articles`` gives for ``split_sentences`` of the same documents.

    A document is one row from start to end, so nothing is shuffled. Exploding the one
    value or none drops the documents that end up empty and computes the text once; a
    filter on the finished column would be pushed below and compute it twice.
    """
    rebuilt = clean_article(text_col, min_words, abbreviations)
    return df.select("*", F.explode(F.array_compact(F.array(rebuilt))).alias("article_clean"))
