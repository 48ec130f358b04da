import pytest
from pyspark.sql import functions as F

from corpusflow.errors import ColumnException
from corpusflow.operators import ids, sampling
from corpusflow.operators.checks import continuity_check


def test_positions_are_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v")).repartition(13)
    placed = ids.with_position(df, ["v"])
    assert placed.where("v <> position").count() == 0 and placed.count() == 1000


@pytest.fixture
def small_partitions(spark):
    """Keep tiny shuffle partitions apart, as large ones would be."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def test_positions_with_a_hot_value(spark, small_partitions):
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    placed = ids.with_position(spark.range(20_000).select(hot.alias("v")).repartition(8), ["v"])
    assert placed.agg(F.count_distinct("position"), F.max("position")).first() == (20_000, 19_999)
    sizes = placed.where("v = 0").groupBy(F.spark_partition_id()).count()
    assert sizes.count() > 1  # the hot value is not in one task


def test_doc_ids(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "t string")
    kept = df.withColumn("doc_id", F.lit(3))
    assert ids.with_doc_id(kept) is kept
    made = ids.with_doc_id(df)
    assert made.collect() == made.collect()
    assert made.select("doc_id").distinct().count() == 4
    one, two = (
        sorted(ids.with_doc_id(d, ["t"]).select("doc_id", "t").collect(), key=repr)
        for d in (df, df.repartition(3))
    )
    assert one == two and [r.doc_id for r in sorted(one)] == [0, 1, 2, 3]
    with pytest.raises(ColumnException):
        ids.with_doc_id(df, [])


def checkpoints(df):
    """Columns of each checkpoint that a plan reads."""
    import re

    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [set(re.findall(r"(\w+)#\d+", m)) for m in re.findall(r"LogicalRDD \[(.*?)\]", plan)]


def test_ids_of_files_need_no_checkpoint_of_rows(spark, tmp_path):
    source = spark.range(500).selectExpr("id AS v", "sha2(string(id), 256) AS text", "id % 3 AS p")
    source.repartition(7).write.partitionBy("p").parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t")).where("v >= 20").select("text", "v")
    made = ids.with_doc_id(rows)
    assert made.columns == ["text", "v", "doc_id"] and dict(made.dtypes)["doc_id"] == "bigint"
    first = {r.v: r.doc_id for r in made.collect()}
    assert len(set(first.values())) == 480
    assert {r.v: r.doc_id for r in made.select("v", "doc_id").repartition(3).collect()} == first
    assert {r.v: r.doc_id for r in ids.with_doc_id(rows.where("v > 100")).collect()}.items() <= first.items()
    assert all("text" not in columns for columns in checkpoints(made))


def test_ids_by_keys_checkpoint_digests_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ids, "COPIES", 7)
    copies = spark.range(50).selectExpr("'same' AS t", "1 AS n")
    others = spark.range(100).selectExpr("concat('t', id % 40) AS t", "cast(id AS int) AS n")
    nulls = spark.range(3).selectExpr("cast(null AS string) AS t", "2 AS n")
    df = copies.unionByName(others).unionByName(nulls)
    df.repartition(5).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    made = ids.with_doc_id(rows, ["t"])
    got = made.select("doc_id", "t", "n").collect()
    assert sorted(r.doc_id for r in got) == list(range(153))
    assert sorted((r.t, r.n) for r in got if r.t) == sorted((r.t, r.n) for r in df.collect() if r.t)
    spans = {}
    for r in got:
        spans.setdefault(r.t, []).append(r.doc_id)
    assert all(max(s) - min(s) == len(s) - 1 for s in spans.values())  # a key's ids are neighbours
    other = ids.with_doc_id(rows.repartition(3), ["t"]).select("doc_id", "t", "n").collect()
    assert sorted(other) == sorted(got)
    assert checkpoints(made) and all("t" not in columns and "n" not in columns for columns in checkpoints(made))


def test_rows_that_change_between_readings_are_an_error(spark):
    def fresh(batches):
        import uuid

        for batch in batches:
            yield batch.assign(r=[str(uuid.uuid4()) for _ in range(len(batch))])[["r"]]

    df = spark.range(50).mapInPandas(fresh, "r string")
    with pytest.raises(Exception, match="changed between two readings"):
        ids.with_doc_id(df, ["r"]).collect()


def test_batches(spark):
    df = spark.range(23).repartition(4)
    sizes = ids.assign_batches(df, 5, ["id"]).groupBy("batch_id").count()
    assert sorted(sizes.collect()) == [(0, 5), (1, 5), (2, 5), (3, 5), (4, 3)]
    with pytest.raises(ValueError):
        ids.assign_batches(df, 0, ["id"])


@pytest.mark.parametrize(
    ("values", "wraps", "ok"),
    [
        ([1, 2, 3], [], True),
        ([4], [], True),
        ([1, 3], [], False),
        ([1, 2, 3, 1, 2], [3], True),
        ([1, 2, 3, 1, 2], [], False),
        ([1, 2, 3, 1, 2], [2], False),
        ([0, 1], [], True),
        ([1, 1], [1], True),
        ([1, None, 2], [], False),
    ],
)
def test_continuity(spark, values, wraps, ok):
    rows = [("p", i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "p string, o int, v int")
    assert continuity_check(df, "p", "o", "v", wraps).collect() == [("p", ok)]


def test_continuity_of_a_long_partition(spark, small_partitions):
    df = spark.range(50_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("p"),
        F.col("id").alias("o"),
    )
    hot = df.where("p = 'hot'").selectExpr("p", "o", "o - floor(o / 3) - 1 AS v")
    cold = df.where("p <> 'hot'").selectExpr("p", "o", "o AS v")
    checked = continuity_check(hot.union(cold), "p", "o", "v")
    assert checked.where("NOT ok").count() == 0
    broken = hot.where("o <> 30001").union(cold)
    assert continuity_check(broken, "p", "o", "v").where("NOT ok").collect() == [("hot", False)]
    twice = hot.union(hot.where("o = 40000")).union(cold)
    assert continuity_check(twice, "p", "o", "v").where("NOT ok").collect() == [("hot", False)]


def test_samples(spark):
    df = spark.range(10_000)
    one, two = (sampling.hash_sample(d, "id", 0.1) for d in (df, df.repartition(7)))
    assert sorted(one.collect()) == sorted(two.collect())
    assert 800 < one.count() < 1200
    assert sampling.hash_sample(df, "id", 0.1, salt="x").count() != one.count()
    assert sampling.sample(df, 0.1, 3).collect() == sampling.sample(df, 0.1, 3).collect()


def test_samples_of_null_keys_and_tiny_fractions(spark):
    df = spark.range(3).select(F.when(F.col("id") > 0, F.col("id")).alias("id"))
    assert sampling.hash_sample(df, "id", 1.0).count() == 3
    assert sampling.hash_sample(df, "id", 0.0).count() == 0
    few = sampling.hash_sample(spark.range(3_000_000), "id", 4e-6).count()
    assert 1 <= few <= 40
    assert sampling.hash_sample(spark.range(1000), "id", 1e-9).count() == 0


def test_ids_of_equal_keys_do_not_depend_on_the_layout(spark):
    df = spark.range(60).select(F.lit("same").alias("text"), F.col("id").alias("other"))
    made = [
        {(r.other, r.doc_id) for r in ids.with_doc_id(d, ["text"]).collect()}
        for d in (df, df.repartition(7))
    ]
    assert made[0] == made[1] and len({i for _, i in made[0]}) == 60


def test_tokens(spark):
    from corpusflow.functions.tokens import custom_tokens

    df = spark.createDataFrame([("Hello, wörld!",), ("",), (None,)], "t string")
    counted = sampling.with_token_count(df, "t").collect()
    assert [r.n_tokens for r in counted] == [4, 0, None]
    split = custom_tokens("t", lambda: lambda texts: [t.split() for t in texts])
    assert [r.n_tokens for r in sampling.with_token_count(df, "t", tokens=split).collect()] == [
        2, 0, None,
    ]
    assert sampling.token_length_stats(df, "t").first().max_tokens == 4
    cut = sampling.truncate_tokens(df, "t", 2).collect()
    assert [r.tokens for r in cut] == [["Hello", ","], [], None]


def test_length_buckets(spark):
    df = spark.range(100).selectExpr("id AS n")
    plain = sampling.length_buckets(df, "n", 10, arrange=False)
    arranged = sampling.length_buckets(df, "n", 10)
    assert sorted(plain.collect()) == sorted(arranged.collect())
    assert plain.where("bucket <> n div 10").count() == 0
