"""A third of all rows under one key: the engine must be able to split them."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from corpusflow.operators.joins import join_table
from corpusflow.operators.upsert import upsert
from corpusflow_queries import inputs, prompts

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10000",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
}


@pytest.fixture
def tiny_limits(spark):
    """Skew settings scaled down to test data."""
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def skewed(spark, key, value):
    return spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias(key),
        F.sha2(F.col("id").cast("string"), 256).alias(value),
    )


def final_plan(df):
    """Run the query and give the plan as it was adapted."""
    df.collect()
    return plan_of(df)


def keys(spark, key, value):
    return spark.range(0, 60_000, 2).select(F.col("id").alias(key), (F.col("id") + 1).alias(value))


def largest_share(df):
    """Of the joined rows, the share in the fullest partition."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


@pytest.fixture
def many_partitions(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
def test_hot_key_on_the_left(spark, tiny_limits, how):
    left, right = skewed(spark, "a", "v"), keys(spark, "b", "w").where("b <> 0")
    joined = join_table(left, right, ("a", "b"), how)
    plain = left.join(right, F.col("a") == F.col("b"), how)
    assert "skew=true" in final_plan(joined)
    assert joined.count() == plain.count()


def test_hot_key_on_the_right(spark, tiny_limits):
    left, right = keys(spark, "b", "w"), skewed(spark, "a", "v")
    joined = join_table(left, right, ("b", "a"), "inner")
    assert "skew=true" in final_plan(joined)
    assert joined.count() == left.join(right, F.col("a") == F.col("b"), "inner").count()


@pytest.mark.parametrize("how", ["left", "right", "full"])
@pytest.mark.parametrize("hot", ["left", "right"])
def test_hot_key_of_an_outer_join_is_dealt_out(spark, tiny_limits, many_partitions, how, hot):
    """Whichever side supplies nulls, no partition holds the third of all rows that one key has."""
    sides = [skewed(spark, "a", "v"), keys(spark, "b", "w")]
    if hot == "right":
        sides = sides[::-1]
    left, right = sides
    pair = (left.columns[0], right.columns[0])
    joined = join_table(left, right, pair, how, heavy_rows=1000)
    plain = left.join(right, F.col("a") == F.col("b"), how)
    assert joined.count() == plain.count()
    assert largest_share(joined) < 0.15


def test_hot_key_in_the_target(spark, tiny_limits):
    target = skewed(spark, "k", "v")
    source = spark.range(0, 60_000, 5).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    merged = upsert(target, source, ["k"])
    assert "skew=true" in final_plan(merged)
    known = target.select("k").distinct()
    assert merged.count() == 60_000 + source.join(known, "k", "left_anti").count()


def test_one_long_conversation(spark, tiny_limits, tmp_path):
    turns = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.floor(F.col("id") / 10)).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 1000 == 0, "system")
        .when(F.col("id") % 2 == 0, "user")
        .otherwise("assistant")
        .alias("role"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    turns.withColumn("conv_id", F.lit(7).cast("long")).unionByName(
        turns.withColumn("turn", F.col("turn") + 100_000)
    ).write.parquet(str(tmp_path / "conversations.parquet"))
    made = prompts.instruction_prompt(spark, str(tmp_path))
    assert "skew=true" in final_plan(made)
    assert made.count() == inputs.pairs(spark, str(tmp_path)).count()
