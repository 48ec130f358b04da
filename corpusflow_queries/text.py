"""Cleaning, segmentation and reassembly."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import text as T
from corpusflow.operators import sampling, snippets
from corpusflow_queries import inputs as I
from corpusflow_queries.registry import query


@query(
    "text_cleaning",
    f"""SELECT page_id, md5({I.sql_strip("html")}) AS stripped,
        md5({I.sql_drop_parentheticals("html")}) AS no_brackets,
        md5({I.sql_tighten("html")}) AS tightened,
        md5({I.sql_clean_whitespace("html")}) AS lines,
        {I.sql_words("html")} AS n_words FROM pages""",
)
def text_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "pages").select(
        "page_id",
        F.md5(T.strip_text("html")).alias("stripped"),
        F.md5(T.drop_parentheticals("html")).alias("no_brackets"),
        F.md5(T.tighten_punctuation("html")).alias("tightened"),
        F.md5(T.clean_whitespace("html")).alias("lines"),
        T.word_count("html").alias("n_words"),
    )


@query("snippets", I.SNIPPETS)
def split_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snippets.split_sentences(I.articles(spark, sf_dir))


@query("snippets_deduped", I.SNIPPETS)
def dedupe_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every snippet twice, then one row per key."""
    once = snippets.split_sentences(I.articles(spark, sf_dir))
    return snippets.dedupe_by_key(once.union(once), ["doc_split_id"])


@query("long_snippets", f"SELECT * FROM ({I.SNIPPETS}) WHERE snippet_len > 8")
def long_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snippets.filter_short_snippets(snippets.split_sentences(I.articles(spark, sf_dir)))


@query(
    "reassembled_documents",
    f"""SELECT doc_id, string_agg(article_snippet, ' ' ORDER BY split_id) AS article_clean
        FROM ({I.SNIPPETS}) GROUP BY doc_id""",
)
def reassembled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snippets.reassemble_document(snippets.split_sentences(I.articles(spark, sf_dir)))


_CLEAN_ARTICLES = f"""SELECT d.doc_id, d.text AS article, c.article_clean
FROM documents d JOIN ({I.CLEAN}) c ON c.doc_id = d.doc_id"""


@query("clean_articles", _CLEAN_ARTICLES)
def clean_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snippets.with_clean_article(I.articles(spark, sf_dir))


@query("clean_articles_from_snippets", _CLEAN_ARTICLES)
def clean_articles_from_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = I.articles(spark, sf_dir)
    return snippets.clean_articles(docs, snippets.split_sentences(docs))


_TOKENS = r"regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')"


@query(
    "token_stats",
    f"""SELECT count(*) AS n_rows, sum(n)::BIGINT AS total_tokens,
        round(avg(n), 6) AS mean_tokens, quantile_disc(n, 0.5) AS p50_tokens,
        quantile_disc(n, 0.95) AS p95_tokens, max(n) AS max_tokens
        FROM (SELECT len({_TOKENS}) AS n FROM documents)""",
)
def token_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = sampling.token_length_stats(I.documents(spark, sf_dir), "text")
    return stats.withColumn("mean_tokens", F.round("mean_tokens", 6))


@query(
    "truncated_tokens",
    f"""SELECT doc_id, len(t) AS n_tokens, array_to_string(t, ' ') AS truncated
        FROM (SELECT doc_id, list_slice({_TOKENS}, 1, 64) AS t FROM documents)""",
)
def truncated_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = sampling.truncate_tokens(I.documents(spark, sf_dir), "text", 64)
    return cut.select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.array_join("tokens", " ").alias("truncated"),
    )


@query(
    "length_buckets",
    f"""SELECT doc_id, n_tokens, n_tokens // 128 AS bucket
        FROM (SELECT doc_id, len({_TOKENS}) AS n_tokens FROM documents)""",
)
def length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = sampling.with_token_count(I.documents(spark, sf_dir), "text")
    return sampling.length_buckets(counted.select("doc_id", "n_tokens"), "n_tokens", 128)


@query(
    "hash_sample",
    """SELECT doc_id, lang, n_chars FROM documents
       WHERE ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT < 0.1 * 1152921504606846976""",
)
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = I.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return sampling.hash_sample(docs, "doc_id", 0.1)


@query("bernoulli_sample")
def bernoulli_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = I.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return sampling.sample(docs, 0.1, seed=7)


@query(
    "bernoulli_facts",
    """SELECT count(*) AS n_rows, TRUE AS from_the_table, TRUE AS same_again, TRUE AS other_with_other_seed,
       TRUE AS plausible_size FROM documents""",
)
def bernoulli_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of any seeded sample: its rows are rows of the table, each at most once, the same
    seed draws them again, and their number lies within six standard deviations."""
    docs = I.table(spark, sf_dir, "documents").select("doc_id", "lang")
    fraction, ids = 0.3, F.sum(F.xxhash64("doc_id").cast("decimal(38,0)"))
    drawn = sampling.sample(docs, fraction, seed=7)
    about = drawn.agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_ids"), ids.alias("sum"))
    again = sampling.sample(docs, fraction, seed=7).agg(ids.alias("sum_again"))
    other = sampling.sample(docs, fraction, seed=8).agg(ids.alias("sum_other"))
    known = drawn.join(docs.distinct(), ["doc_id", "lang"], "left_semi").agg(F.count("*").alias("n_known"))
    whole = docs.agg(F.count("*").alias("n_rows"))
    parts = [whole, about, again, other, known]  # one row each
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    facts = together.agg(*[F.max(c).alias(c) for c in together.columns])
    spread = 6 * F.sqrt(F.col("n_rows") * fraction * (1 - fraction))
    return facts.select(
        "n_rows",
        ((F.col("n") == F.col("n_known")) & (F.col("n") == F.col("n_ids"))).alias("from_the_table"),
        F.col("sum").eqNullSafe(F.col("sum_again")).alias("same_again"),
        (~F.col("sum").eqNullSafe(F.col("sum_other"))).alias("other_with_other_seed"),
        (F.abs(F.col("n") - F.col("n_rows") * fraction) <= spread).alias("plausible_size"),
    )
