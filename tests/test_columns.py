import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.errors import ColumnException
from corpusflow.functions.conditions import (
    case_when,
    changed_condition,
    merge_condition,
    update_map,
)
from corpusflow.operators import columns as C


@pytest.fixture
def months(spark):
    return spark.createDataFrame([(1, "mer", 3), (4, "mei", 6), (7, "jun", 9)], "A int, B string, C int")


def test_rename_swaps(months):
    assert C.replace_column_names(months, [("A", "B"), ("B", "A")]).columns == ["B", "A", "C"]
    with pytest.raises(ColumnException):
        C.replace_column_names(months, [("X", "Y")])
    with pytest.raises(ColumnException):
        C.replace_column_names(months, [("A", "B")])


def test_clean_names(spark):
    df = spark.createDataFrame([(1, 2)], "`A  b-C` int, `d.E` int")
    assert C.clean_column_names(df).columns == ["a_b_c", "d_e"]
    for names in ("`a b` int, `a-b` int", "`###` int, b int"):
        with pytest.raises(ColumnException):
            C.clean_column_names(spark.createDataFrame([(1, 2)], names))


def test_prefix_is_not_applied_twice(spark):
    df = spark.createDataFrame([(1, 2)], "a int, p_a int")
    assert C.apply_prefix(df, "p").columns == ["p_a", "p_p_a"]


def test_column_pairs(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("c", None), ("d", 4)], "l string, r int")
    assert sorted(C.column_pairs(df, "l", "r").collect()) == [("a", 1), ("d", 4)]
    with pytest.raises(ColumnException, match="Duplicate value in pair"):
        C.column_pairs(spark.createDataFrame([("a", 1), ("a", 2)], "l string, r int"), "l", "r")


def test_regex_replace(spark):
    df = spark.createDataFrame([("ab12",), (None,)], "c string")
    rows = C.regex_replace_column(df, "c", (r"([a-z]+)(\d+)", "$2-$1")).collect()
    assert [r.c for r in rows] == ["12-ab", None]


def test_case_when(months):
    whens = [
        (F.col("B").contains("mer"), F.lit("mar")),
        (F.col("B").contains("mei"), F.lit("may")),
    ]
    full = months.select(case_when(whens, F.col("B")).alias("b")).collect()
    assert [r.b for r in full] == ["mar", "may", "jun"]
    open_end = months.select(case_when(whens).alias("b")).collect()
    assert [r.b for r in open_end] == ["mar", "may", None]
    assert months.select(case_when([], F.lit(1)).alias("b")).first().b == 1
    assert months.select(case_when([]).alias("b")).first().b is None
    with pytest.raises(ColumnException):
        case_when([(F.lit(True),)])


def test_cast_table(months):
    model = T.StructType(
        [T.StructField("C", T.StringType()), T.StructField("B", T.IntegerType())]
    )
    cast = C.cast_table(months, model)
    assert cast.dtypes == [("C", "string"), ("B", "int")]
    assert [r.B for r in cast.collect()] == [None, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        C.cast_table(months, model, strict=True).collect()
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        C.cast_table(months, T.StructType([T.StructField("Z", T.LongType())]))


def test_signature(spark):
    rows = spark.createDataFrame([("text",)], "articles string")
    full = C.with_default_params(rows, {"max_tokens": 5})
    checked = C.enforce_signature(full)
    assert checked.schema.names == C.REQUEST_SCHEMA.names
    assert dict(checked.dtypes)["batch_size"] == "int"
    row = checked.first()
    assert (row.max_tokens, row.temperature, row.batch_size) == (5, 1.0, 5)
    wrong = full.withColumnRenamed("articles", "article").withColumn("top_p", F.lit("x"))
    with pytest.raises(ColumnException) as fault:
        C.enforce_signature(wrong)
    for part in ("missing column articles", "unexpected column article", "top_p is string"):
        assert part in str(fault.value)
    prompt = spark.createDataFrame([("p", 0.5, 10)], "prompt string, temperature double, max_tokens long")
    assert C.enforce_signature(prompt, C.PROMPT_REQUEST_SCHEMA).count() == 1


def test_merge_expressions(spark):
    src = spark.createDataFrame([(1, 1, None)], "k int, a int, b int").alias("src")
    tgt = spark.createDataFrame([(1, 2, 5)], "k int, a int, b int").alias("tgt")
    both = src.join(tgt, merge_condition(["k"]))

    def holds(condition):
        return both.select(condition.alias("v")).first().v

    columns = ["k", "a", "b"]
    assert holds(changed_condition(columns)) is True  # unknown or true
    assert holds(changed_condition(columns, ["a"])) is None
    assert holds(changed_condition(columns, ["a"], null_safe=True)) is True
    assert holds(changed_condition(columns, columns)) is False
    with pytest.raises(ColumnException):
        changed_condition(columns, ["zz"])
    with pytest.raises(ColumnException):
        merge_condition([])
    assert update_map(columns, ["k"]) == {"tgt.a": "src.a", "tgt.b": "src.b"}
