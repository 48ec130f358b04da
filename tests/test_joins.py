import pytest
from pyspark.sql import functions as F

from conftest import plan_of

from corpusflow.errors import ColumnException
from corpusflow.operators import joins
from corpusflow.operators.joins import join_table


@pytest.fixture
def sides(spark):
    left = spark.createDataFrame(
        [(1, "a"), (2, "b"), (2, "c"), (None, "n"), (5, "e")], "lk int, lv string"
    )
    right = spark.createDataFrame(
        [(2, "x"), (2, "y"), (3, "z"), (None, "m")], "rk int, rv string"
    )
    return left, right


@pytest.mark.parametrize(
    "how", ["inner", "left", "right", "full", "left_outer", "outer", "left_semi", "left_anti"]
)
def test_same_rows_as_the_plain_join(sides, how):
    left, right = sides
    plain = left.join(right, F.col("lk") == F.col("rk"), how)
    ours = join_table(left, right, ("lk", "rk"), how, drop_joined_column=False)
    assert ours.columns == plain.columns
    assert sorted(map(repr, ours.collect())) == sorted(map(repr, plain.collect()))
    dropped = join_table(left, right, ("lk", "rk"), how)
    assert not {"lk", "rk"} & set(dropped.columns)
    assert dropped.count() == plain.count()


@pytest.mark.parametrize("how", ["left", "right", "full"])
@pytest.mark.parametrize("heavy", [1, 3, 5])
def test_dealt_keys_give_the_same_rows(spark, monkeypatch, how, heavy):
    """Keys that are heavy on one side, on both or on none, with copies, strangers and nulls."""
    monkeypatch.setattr(joins, "PARTS", 4)
    left = [(k, f"l{i % 7}", {"m": 1}) for k, n in ((1, 9), (2, 4), (3, 1), (4, 6), (None, 8)) for i in range(n)]
    right = [(k, f"r{i % 3}") for k, n in ((1, 7), (2, 1), (3, 6), (5, 5), (6, 1), (None, 5)) for i in range(n)]
    a = spark.createDataFrame(left, "lk int, lv string, lm map<string,int>").repartition(3)
    b = spark.createDataFrame(right, "rk int, rv string").repartition(2)
    plain = a.join(b, F.col("lk") == F.col("rk"), how)
    ours = join_table(a, b, ("lk", "rk"), how, drop_joined_column=False, heavy_rows=heavy)
    assert sorted(map(repr, ours.collect())) == sorted(map(repr, plain.collect()))


@pytest.mark.parametrize("how", ["left", "right", "full"])
@pytest.mark.parametrize("heavy", [10, 10**9])
def test_each_side_is_read_once(spark, tmp_path, how, heavy):
    for name in ("a", "b"):
        spark.range(200).selectExpr("id % 9 AS k", f"id AS {name}").write.parquet(str(tmp_path / name))
    left, right = (spark.read.parquet(str(tmp_path / name)) for name in ("a", "b"))
    joined = join_table(left, right, ("k", "k"), how, heavy_rows=heavy)
    assert plan_of(joined).count("FileScan") == 2


def test_heavy_keys_are_few(spark):
    df = spark.range(20_000).selectExpr("if(id % 3 = 0, 7, id) AS k")
    assert joins.heavy_keys(df, "k", 100) == [7]
    assert joins.heavy_keys(df, "k", 10_000) == []
    assert joins.heavy_keys(spark.range(0).selectExpr("id AS k"), "k", 1) == []


def test_same_key_name_is_kept_once(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    right = spark.createDataFrame([(2, "x"), (3, "y")], "k int, w string")
    full = join_table(left, right, ("k", "k"), "full", drop_joined_column=False)
    assert full.columns == ["k", "v", "w"]
    assert sorted(full.collect()) == [(1, "a", None), (2, "b", "x"), (3, None, "y")]


def test_columns_of_the_same_name_stay_apart(spark):
    left = spark.createDataFrame([(1, "a")], "k int, v string")
    right = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    joined = join_table(left, right, ("k", "k"), "right")
    assert joined.columns == ["v", "v"]
    assert sorted(map(repr, joined.collect())) == [
        "Row(v='a', v='b')",
        "Row(v=None, v='c')",
    ]


def test_drop_list_is_not_changed(sides):
    drop = ["lv"]
    joined = join_table(*sides, ("lk", "rk"), "inner", other_drop_columns=drop)
    assert joined.columns == ["rv"] and drop == ["lv"]


def test_faults(sides):
    with pytest.raises(ColumnException):
        join_table(*sides, ("nope", "rk"))
    with pytest.raises(ValueError):
        join_table(*sides, ("lk", "rk"), "cross")
