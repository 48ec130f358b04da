"""Column naming, casting and other row-wise table operators."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.errors import ColumnException
from corpusflow.functions.prompts import BATCH_INSTRUCTION, BATCH_SYSTEM

# The columns and types of a batched prediction request.
REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("articles", T.StringType()),
        T.StructField("system_prompts", T.StringType()),
        T.StructField("instructions", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("max_tokens", T.LongType()),
        T.StructField("top_p", T.DoubleType()),
        T.StructField("num_return_sequences", T.IntegerType()),
        T.StructField("do_sample", T.BooleanType()),
        T.StructField("batch_size", T.IntegerType()),
    ]
)
# The columns and types of a single-prompt request.
PROMPT_REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("prompt", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("max_tokens", T.LongType()),
    ]
)
# Generation defaults.
DEFAULT_PARAMS: dict[str, Any] = {
    "temperature": 1.0,
    "max_tokens": 610,
    "top_p": 0.7,
    "num_return_sequences": 1,
    "do_sample": True,
    "batch_size": 5,
    "system_prompts": BATCH_SYSTEM,
    "instructions": BATCH_INSTRUCTION,
}


def _renamed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    repeated = sorted(n for n, times in Counter(names).items() if times > 1)
    if repeated:
        raise ColumnException(f"renaming gives duplicate columns: {repeated}")
    if "" in names:
        raise ColumnException("renaming gives an empty column name")
    return df.toDF(*names)


def replace_column_names(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Rename columns all at once, so swaps work."""
    new_names = dict(pairs)
    missing = [old for old in new_names if old not in df.columns]
    if missing:
        raise ColumnException(f"columns not in the table: {missing}")
    return _renamed(df, [new_names.get(c, c) for c in df.columns])


def clean_column_names(df: DataFrame) -> DataFrame:
    """Lower-case names made of letters, digits and single underscores."""
    return _renamed(df, ["_".join(re.findall("[A-Za-z0-9]+", c)).lower() for c in df.columns])


def apply_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return _renamed(df, [f"{prefix}_{c}" for c in df.columns])


def column_pairs(df: DataFrame, left: str, right: str) -> DataFrame:
    """Value pairs of two columns; rows with a null on either side are left out.

    Raises when one side has more distinct values than the other.
    """
    pairs = df.select(F.col(left), F.col(right)).where(
        F.col(left).isNotNull() & F.col(right).isNotNull()
    )
    n_left, n_right = pairs.agg(F.count_distinct(left), F.count_distinct(right)).first()
    if n_left != n_right:
        raise ColumnException(f"Duplicate value in pair: {n_left} {left}, {n_right} {right}")
    return pairs


def add_constant(df: DataFrame, name: str, value: Any) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def regex_replace_column(df: DataFrame, column: str, replacement: tuple[str, str]) -> DataFrame:
    """Replace a pattern in place; ``$1`` stands for a group and null stays null."""
    pattern, value = replacement
    return df.withColumn(column, F.regexp_replace(F.col(column), pattern, value))


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def cast_table(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Exactly the schema's columns, in its order, cast to its types.

    A value that does not fit turns null; with ``strict`` it raises instead.
    """

    def cast(field: T.StructField):
        column = F.col(f"`{field.name}`")
        typed = column.cast(field.dataType) if strict else column.try_cast(field.dataType)
        return typed.alias(field.name)

    return df.select(*[cast(field) for field in schema.fields])


def enforce_signature(df: DataFrame, schema: T.StructType = REQUEST_SCHEMA) -> DataFrame:
    """Check an inference request against its signature; one error lists every fault."""
    present = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in schema.fields}
    faults = [f"missing column {name}" for name in wanted if name not in present]
    faults += [f"unexpected column {name}" for name in present if name not in wanted]
    faults += [
        f"column {name} is {present[name].simpleString()}, not {kind.simpleString()}"
        for name, kind in wanted.items()
        if name in present and present[name] != kind
    ]
    if faults:
        raise ColumnException("request does not match its signature: " + "; ".join(faults))
    return df.select(*wanted)


def with_default_params(
    df: DataFrame,
    params: Mapping[str, Any] | None = None,
    schema: T.StructType = REQUEST_SCHEMA,
) -> DataFrame:
    """Add the generation parameters as constant columns of the signature's types."""
    values = {**DEFAULT_PARAMS, **(params or {})}
    types = {f.name: f.dataType for f in schema.fields}
    return df.withColumns(
        {k: F.lit(v).cast(types[k]) if k in types else F.lit(v) for k, v in values.items()}
    )
