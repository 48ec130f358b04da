"""The training-data pipeline: five stages over ``documents``, each rereading the one before.

language ID -> line dedup -> n-gram Jaccard join -> mixing to target weights -> byte-level BPE.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows it is given. All but the last
return the columns of ``documents``; a text that a stage changes gets its ``n_chars`` anew.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import lang_id
from corpusflow.llm.bpe import encode
from corpusflow.llm.line_join import remove_lines
from corpusflow.llm.mixing import WORD, mix
from corpusflow.llm.set_join import link_classes
from corpusflow.llm.storage import fresh_folder

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters and texts that are like no language learned."""
    model = lang_id.train(docs, ~lang_id.held_out("doc_id"))
    scored = lang_id.identify(docs, model, recognised=True)
    known = (F.col("lang_pred") != "und") & F.col("recognised")
    return scored.where(known).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines that resemble an earlier one; documents with nothing but blanks left go."""
    cut = remove_lines(docs)
    left = (F.col("n_removed") == 0) | F.col("text").rlike(WORD)
    return _sized(cut.where(left), docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their shingles, the one with the smallest id stays.

    Rows with one id and different texts are documents of their own; of rows with one id and
    one text, the least stays. Rows without an id all stay, as nothing names them.
    """
    named = docs.where("doc_id IS NOT NULL")
    row = ["doc_id", "text_key"]
    classes = link_classes(named, row_keys=True)
    alone = classes.where("group_key IS NULL").select(*row)
    first = classes.where("group_key IS NOT NULL").groupBy("group_key").agg(F.min(F.struct(*row)).alias("row"))
    kept = (
        named.withColumn("text_key", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
        .join(alone.unionByName(first.select("row.*")).distinct(), row, "left_semi")
        .groupBy(*row)
        .agg(F.min(F.struct(*docs.columns)).alias("least"))
    )
    return kept.select("least.*").unionByName(docs.where("doc_id IS NULL"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole copies as rows of their own, then the words of the blocks taken once more."""
    mixed = mix(docs)
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    some = F.flatten(
        F.transform(
            "ranges",
            lambda r: F.slice("words", (r["begin"] + 1).cast("int"), (r["end"] - r["begin"]).cast("int")),
        )
    )
    part = F.when(F.size("ranges") > 0, F.array(F.array_join(some, " ")))
    none = F.array().cast("array<string>")
    whole = F.when(F.col("copies") > 0, F.array_repeat("text", F.col("copies").cast("int")))
    texts = F.concat(F.coalesce(whole, none), F.coalesce(part, none))
    rows = mixed.withColumn("words", F.when(F.size("ranges") > 0, words))
    return _sized(rows.withColumn("text", F.explode(texts)), docs)


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text in place of the text, and a check that they decode to it."""
    texts = docs.select("doc_id", "lang", "source", "text")
    digest = texts.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    coded = encode(
        digest, VOCABULARY, public_tokenizers.PATTERN, outputs=("ids", "n_tokens", "decoded")
    )
    exact = F.sha2("decoded", 256) == F.col("text_sha256")
    return coded.withColumn("round_trip", exact).drop("decoded")


def _sized(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, with ``n_chars`` as the text now has."""
    if "n_chars" in like.columns:
        df = df.withColumn("n_chars", F.char_length("text").cast("long"))
    return df.select(*like.columns)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("jaccard_join", one_of_each_group),
    ("source_mix", mix_sources),
    ("byte_bpe", encode_bytes),
]

# No SQL twin: kernels, seeded blocks and token ids have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    root = fresh_folder(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = f"{root}/{i}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
