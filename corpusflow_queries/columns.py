"""Names, casts, ids, checks and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.conditions import case_when
from corpusflow.operators import columns, ids
from corpusflow.operators.checks import continuity_check
from corpusflow.operators.joins import join_table
from corpusflow_queries import inputs as I
from corpusflow_queries.registry import query


@query(
    "renamed_columns",
    """SELECT c_custkey AS customer_id, c_mktsegment AS c_name, c_name AS c_mktsegment,
       c_nationkey, c_acctbal FROM customer""",
)
def renamed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One plain rename and one swap."""
    return columns.replace_column_names(
        I.table(spark, sf_dir, "customer"),
        [("c_custkey", "customer_id"), ("c_name", "c_mktsegment"), ("c_mktsegment", "c_name")],
    )


@query(
    "cleaned_column_names",
    """SELECT c_custkey AS cust_key, c_name AS c_name, c_acctbal AS acct_bal_eur
       FROM customer""",
)
def cleaned_column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = I.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return columns.clean_column_names(customer.toDF("Cust-Key", "__C  name", "acct.Bal (EUR)"))


@query(
    "prefixed_columns",
    "SELECT n_nationkey AS x_n_nationkey, n_name AS x_n_name, n_regionkey AS x_n_regionkey "
    "FROM nation",
)
def prefixed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.apply_prefix(I.table(spark, sf_dir, "nation"), "x")


@query("column_pairs", "SELECT c_custkey, c_name FROM customer WHERE c_name IS NOT NULL")
def column_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.column_pairs(I.table(spark, sf_dir, "customer"), "c_custkey", "c_name")


@query("constant_column", "SELECT doc_id, 'Summarise:' AS prompt FROM documents")
def constant_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = columns.project(I.table(spark, sf_dir, "documents"), ["doc_id"])
    return columns.add_constant(docs, "prompt", "Summarise:")


@query(
    "regex_replaced",
    r"SELECT p_partkey, regexp_replace(p_name, '^(\w+) (\w+)$', '\2, \1', 'g') AS p_name FROM part",
)
def regex_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = columns.project(I.table(spark, sf_dir, "part"), ["p_partkey", "p_name"])
    return columns.regex_replace_column(part, "p_name", (r"^(\w+) (\w+)$", "$2, $1"))


@query(
    "case_when",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'large'
       WHEN o_totalprice > 100000 THEN 'medium' ELSE 'small' END AS size,
       CASE WHEN o_orderstatus = 'F' THEN 1 END AS finished FROM orders""",
)
def case_when_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    size = case_when(
        [(price > 300000, F.lit("large")), (price > 100000, F.lit("medium"))], F.lit("small")
    )
    return I.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        size.alias("size"),
        case_when([(F.col("o_orderstatus") == "F", F.lit(1))]).alias("finished"),
    )


@query(
    "cast_table",
    """SELECT TRY_CAST(props AS DOUBLE) AS props,
       TRY_CAST(event_type AS INTEGER) AS event_type,
       event_id::VARCHAR AS event_id, (value > 0)::BOOLEAN AS user_id
       FROM (SELECT event_id, props ->> 'k' AS props, event_type, value FROM events)""",
)
def cast_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that is a number in one column and never in another."""
    events = I.table(spark, sf_dir, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").alias("props"),
        "event_type",
        (F.col("value") > 0).alias("user_id"),
        "ts",
    )
    model = T.StructType(
        [
            T.StructField("props", T.DoubleType()),
            T.StructField("event_type", T.IntegerType()),
            T.StructField("event_id", T.StringType()),
            T.StructField("user_id", T.BooleanType()),
        ]
    )
    return columns.cast_table(events, model)


def _defaults_sql() -> str:
    kinds = {f.name: f.dataType.simpleString() for f in columns.REQUEST_SCHEMA.fields}
    names = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER"}
    values = {**columns.DEFAULT_PARAMS, "temperature": 0.5}
    return ", ".join(
        f"CAST('{value}' AS {names.get(kinds[name], 'BOOLEAN')}) AS {name}"
        for name, value in values.items()
    )


@query(
    "request_signature",
    f"SELECT text AS articles, {_defaults_sql()} FROM documents",
)
def request_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defaults filled in, one overridden, then checked against the signature."""
    asked = I.documents(spark, sf_dir).select(F.col("text").alias("articles"))
    return columns.enforce_signature(columns.with_default_params(asked, {"temperature": 0.5}))


@query(
    "doc_ids",
    """SELECT row_number() OVER (ORDER BY md5(text)) - 1 AS doc_id, md5(text) AS digest
       FROM documents""",
)
def doc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids from content; copies of a text get neighbouring ids."""
    texts = I.table(spark, sf_dir, "documents").select("text")
    return ids.with_doc_id(texts, ["text"]).select("doc_id", F.md5("text").alias("digest"))


@query("generated_doc_ids", "SELECT count(*) AS n_rows, count(*) AS n_ids FROM documents")
def generated_doc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = ids.with_doc_id(I.table(spark, sf_dir, "documents").select("lang"))
    return made.agg(
        F.count("*").alias("n_rows"), F.count_distinct("doc_id").alias("n_ids")
    )


@query(
    "assigned_batches",
    """SELECT conv_id, turn, (row_number() OVER (ORDER BY conv_id, turn) - 1) // 5 AS batch_id
       FROM conversations""",
)
def assigned_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = I.table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return ids.assign_batches(turns, 5, ["conv_id", "turn"])


def _continuity_sql(source: str, partition: str, order: str, value: str, wraps: str) -> str:
    return f"""
    SELECT {partition}, bool_and(nxt IS NULL OR nxt = val + 1
           OR (nxt = 1 AND val IN ({wraps}))) AS ok
    FROM (SELECT {partition}, val, lead(val) OVER (
              PARTITION BY {partition} ORDER BY ord, val) AS nxt
          FROM (SELECT {partition}, {order} AS ord, {value} AS val FROM {source}))
    GROUP BY {partition}"""


@query(
    "continuity_turns", _continuity_sql("conversations", "conv_id", "turn", "turn % 4 + 1", "4")
)
def continuity_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turn numbers that wrap after 4."""
    turns = I.table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn", "turn % 4 + 1 AS number"
    )
    return continuity_check(turns, "conv_id", "turn", "number", wrap_values=[4])


@query(
    "continuity_lines",
    _continuity_sql("lineitem", "l_orderkey", "l_linenumber", "l_linenumber", "-1"),
)
def continuity_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = I.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return continuity_check(lines, "l_orderkey", "l_linenumber", "l_linenumber")


_LEFT = """(SELECT CASE WHEN doc_id % 40 <> 0 THEN doc_id END AS doc_key, lang, n_chars
 FROM documents)"""
_RIGHT = """(SELECT CASE WHEN doc_id % 30 <> 0 THEN doc_id * 3 END AS label_key, quality, toxic
 FROM labels)"""


def _join_query(name: str, how: str, sql_join: str, sides: str) -> None:
    if sides == "left only":
        negate = "NOT " if how == "left_anti" else ""
        sql = f"""SELECT lang, n_chars, doc_key FROM {_LEFT} l WHERE {negate}EXISTS (
            SELECT 1 FROM {_RIGHT} r WHERE r.label_key = l.doc_key)"""
    else:
        sql = f"""SELECT lang, n_chars, quality, toxic, doc_key, label_key
            FROM {_LEFT} l {sql_join} JOIN {_RIGHT} r ON r.label_key = l.doc_key"""

    @query(name, sql)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Keys with nulls and strangers on both sides."""
        left = I.table(spark, sf_dir, "documents").select(
            F.when(F.col("doc_id") % 40 != 0, F.col("doc_id")).alias("doc_key"),
            "lang",
            "n_chars",
        )
        right = I.table(spark, sf_dir, "labels").select(
            F.when(F.col("doc_id") % 30 != 0, F.col("doc_id") * 3).alias("label_key"),
            "quality",
            "toxic",
        )
        return join_table(left, right, ("doc_key", "label_key"), how, drop_joined_column=False)


_join_query("join_inner", "inner", "INNER", "both")
_join_query("join_left", "left", "LEFT", "both")
_join_query("join_right", "right", "RIGHT", "both")
_join_query("join_full", "full", "FULL", "both")
_join_query("join_semi", "left_semi", "", "left only")
_join_query("join_anti", "left_anti", "", "left only")


@query(
    "join_same_key",
    """SELECT lang, quality FROM documents d JOIN labels l ON l.doc_id = d.doc_id""",
)
def join_same_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same key name on both sides, keys and further columns dropped."""
    return join_table(
        I.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"),
        I.table(spark, sf_dir, "labels"),
        ("doc_id", "doc_id"),
        "inner",
        other_drop_columns=["n_chars", "toxic"],
    )
