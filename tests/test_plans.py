"""What the physical plans must and must not hold."""

import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

import __spark_entry__ as entry
from corpusflow.operators import rouge
from corpusflow.operators.joins import join_table
from corpusflow.operators.snippets import with_clean_article
from corpusflow.operators.upsert import upsert

SF_DIR = "/root/testdata/sf0.001"
PYTHON = re.compile(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups")
NATIVE = (
    "text_cleaning snippets snippets_deduped long_snippets reassembled_documents clean_articles "
    "clean_articles_from_snippets model_input instruction_prompt summary_prompt chat_prompts "
    "inference_prompts extract_response renamed_columns cleaned_column_names column_pairs "
    "regex_replaced case_when cast_table request_signature continuity_turns join_inner join_full "
    "upsert upsert_null_safe keyed_table_violations token_stats truncated_tokens length_buckets "
    "hash_sample rouge_1 rouge_2 rouge_corpus compare_runs"
).split()


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    assert not PYTHON.search(plan)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_cleaning_does_not_shuffle_and_runs_once(spark):
    docs = documents(spark).select("doc_id", F.col("text").alias("article"))
    plan = plan_of(with_clean_article(docs))
    assert "Exchange" not in plan
    # the cleaning chain would show up a second time in a pushed-down filter
    assert plan.count(r"\([^)]*\)") == 1


def test_rouge_does_not_shuffle(spark):
    pairs = documents(spark).select(
        F.col("text").alias("prediction"), F.col("text").alias("reference")
    )
    assert "Exchange" not in plan_of(rouge.rouge(pairs))


def test_only_needed_columns_are_read(spark):
    sampled = entry.queries()["hash_sample"](spark, SF_DIR)
    assert "ReadSchema: struct<doc_id:bigint,lang:string,n_chars:bigint>" in plan_of(sampled)


def test_filters_reach_the_scan(spark):
    plan = plan_of(entry.queries()["chat_prompts"](spark, SF_DIR))
    assert "EqualTo(role,user)" in plan


def test_big_sides_are_not_broadcast(spark):
    """With size estimates beyond the threshold, no operator forces a broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = documents(spark).select("doc_id", "lang")
        other = docs.withColumnRenamed("lang", "l2")
        for df in (
            join_table(docs, other, ("doc_id", "doc_id"), "full"),
            upsert(docs, docs, ["doc_id"]),
            entry.queries()["bert_score"](spark, SF_DIR),
            entry.queries()["instruction_prompt"](spark, SF_DIR),
        ):
            assert "Broadcast" not in plan_of(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
