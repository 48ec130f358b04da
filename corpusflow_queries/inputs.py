"""Inputs derived from the shared tables, on the Spark side and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.text import WHITESPACE, clean_text, long_sentences
from corpusflow.operators.joins import half


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, text`` of every document."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, article`` of every document."""
    return documents(spark, sf_dir).withColumnRenamed("text", "article")


def first_long_sentence(c: str) -> Column:
    return F.get(long_sentences(clean_text(c)), F.lit(0))


def split_name(key: str) -> Column:
    """8 of 10 keys train, 1 validation, 1 test, by digest."""
    slot = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long") % 10
    return F.when(slot < 8, "train").when(slot == 8, "validation").otherwise("test")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn (reference) with the assistant turn right after it (prediction).

    The join key holds the turn number, so the turns of one long conversation spread.
    """
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where("role = 'user'").select(
        "conv_id", "turn", F.col("text").alias("reference")
    )
    answered = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("prediction")
    )
    return asked.join(answered, ["conv_id", "turn"])


def contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first system turn of each conversation that has one."""
    turns = table(spark, sf_dir, "conversations").where("role = 'system'")
    first = F.min_by("text", "turn").alias("context")
    return turns.groupBy("conv_id", half("conv_id")).agg(first).drop("__half")


# --- the same in SQL -------------------------------------------------------------------

_WS_SET = (
    r"\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS = f"[{_WS_SET}]"


def sql_strip(x: str) -> str:
    return f"trim({x}, '{WHITESPACE}')"


def sql_drop_parentheticals(x: str) -> str:
    return rf"regexp_replace({x}, '\([^)]*\)', '', 'g')"


def sql_tighten(x: str) -> str:
    return rf"""regexp_replace({x}, '{WS}([?.!"](?:{WS}|\z))', '\1', 'g')"""


def sql_clean_whitespace(x: str) -> str:
    lines = (
        f"array_to_string(list_transform(string_split({x}, chr(10)), "
        "lambda l: trim(l, ' ' || chr(9))), chr(10))"
    )
    return rf"regexp_replace({lines}, '\n{{3,}}', chr(10) || chr(10), 'g')"


def sql_clean(x: str) -> str:
    return sql_clean_whitespace(sql_tighten(sql_drop_parentheticals(sql_strip(x))))


def sql_sentences(x: str) -> str:
    marked = rf"regexp_replace({x}, '([.!?]){WS}+', '\1' || chr(30), 'g')"
    return f"list_transform(string_split({marked}, chr(30)), lambda s: {sql_strip('s')})"


def sql_words(x: str) -> str:
    return f"len(list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> ''))"


def sql_leading(x: str, n: int) -> str:
    return (
        f"array_to_string(list_slice(list_filter({sql_sentences(x)}, lambda s: s <> ''), 1, {n}),"
        " ' ')"
    )


SNIPPETS = f"""
SELECT doc_id::VARCHAR || '_' || split_id::VARCHAR AS doc_split_id, article_snippet, doc_id,
       {sql_words("article_snippet")} AS snippet_len, split_id
FROM (SELECT doc_id, unnest(s) AS article_snippet, unnest(range(len(s))) AS split_id
      FROM (SELECT doc_id, {sql_sentences(sql_clean("text"))} AS s FROM documents))
WHERE article_snippet <> ''
"""

CLEAN = f"""
SELECT doc_id, string_agg(article_snippet, ' ' ORDER BY split_id) AS article_clean,
       arg_min(article_snippet, split_id) AS summary
FROM ({SNIPPETS}) WHERE snippet_len > 8 GROUP BY doc_id
"""

PAIRS = """
SELECT u.conv_id, u.turn, u.text AS reference, a.text AS prediction
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'
"""

CONTEXTS = """
SELECT conv_id, arg_min(text, turn) AS context FROM conversations
WHERE role = 'system' GROUP BY conv_id
"""


def sql_slot(key: str, modulus: int) -> str:
    return f"(('0x' || substr(md5({key}::VARCHAR), 1, 8))::BIGINT % {modulus})"


def sql_split(key: str) -> str:
    slot = sql_slot(key, 10)
    return f"CASE WHEN {slot} < 8 THEN 'train' WHEN {slot} = 8 THEN 'validation' ELSE 'test' END"
