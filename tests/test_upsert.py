import pytest
from conftest import plan_of

from corpusflow.errors import ColumnException
from corpusflow.operators.upsert import upsert

COLUMNS = "k int, v string, w int"


def table(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def merged(*args, **kwargs):
    return sorted(upsert(*args, **kwargs).collect(), key=repr)


def test_update_insert_keep(spark):
    target = table(spark, [(1, "a", 1), (2, "b", 2), (3, "c", 3)])
    source = table(spark, [(1, "A", 9), (2, "b", 9), (4, "d", 9)])
    assert merged(target, source, ["k"], ["w"]) == [
        (1, "A", 1),  # changed: excluded column stays
        (2, "b", 2),  # unchanged but for the excluded column
        (3, "c", 3),
        (4, "d", 9),  # inserted with all columns
    ]


def test_null_values(spark):
    target = table(spark, [(1, "a", 1), (2, None, 2), (3, None, 3)])
    source = table(spark, [(1, None, 1), (2, "b", 2), (3, "c", 9)])
    assert merged(target, source, ["k"]) == [(1, "a", 1), (2, None, 2), (3, "c", 9)]
    assert merged(target, source, ["k"], null_safe=True) == [
        (1, None, 1),
        (2, "b", 2),
        (3, "c", 9),
    ]


def test_null_keys_never_match(spark):
    target = table(spark, [(None, "a", 1)])
    source = table(spark, [(None, "b", 2), (None, "b", 2)])
    assert merged(target, source, ["k"]) == [(None, "a", 1), (None, "b", 2), (None, "b", 2)]


def test_repeated_source_keys(spark):
    target = table(spark, [(1, "a", 1)])
    fresh = table(spark, [(2, "x", 1), (2, "y", 1)])
    assert merged(target, fresh, ["k"]) == [(1, "a", 1), (2, "x", 1), (2, "y", 1)]
    clash = table(spark, [(1, "x", 1), (1, "y", 1)])
    with pytest.raises(Exception, match="several source rows"):
        merged(target, clash, ["k"])


def test_repeated_target_keys_are_all_updated(spark):
    target = table(spark, [(1, "a", 1), (1, "b", 1)])
    source = table(spark, [(1, "z", 2)])
    assert merged(target, source, ["k"]) == [(1, "z", 2), (1, "z", 2)]


def test_composite_key_and_narrow_source(spark):
    target = table(spark, [(1, "a", 1), (1, "b", 2)])
    source = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    assert merged(target, source, ["k", "v"]) == [(1, "a", 1), (1, "b", 2), (2, "c", None)]


def test_faults(spark):
    target, source = table(spark, [(1, "a", 1)]), table(spark, [(1, "a", 1)])
    with pytest.raises(ColumnException):
        upsert(target, source, [])
    with pytest.raises(ColumnException):
        upsert(target, source.withColumnRenamed("w", "x"), ["k"])
    with pytest.raises(ColumnException):
        upsert(target, source, ["nope"])
    with pytest.raises(ColumnException):
        upsert(target, source, ["k"], exclude=["nope"])


def test_each_side_is_read_twice(spark, tmp_path):
    for name in ("target", "source"):
        spark.range(50).selectExpr("if(id % 7 = 0, null, id) AS k", f"'{name}' AS v").write.parquet(str(tmp_path / name))
    target, source = (spark.read.parquet(str(tmp_path / name)) for name in ("target", "source"))
    merged_rows = upsert(target, source, ["k"])
    assert plan_of(merged_rows).count("FileScan") == 4
    assert merged_rows.count() == 50 + 8  # the source's rows without a key are new
