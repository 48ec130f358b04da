"""Single-key equi join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.errors import ColumnException

_LEFT, _RIGHT = "__left_key", "__right_key"
#: A key is heavy with more than one in ``HEAVY`` rows of its side, and ``HEAVY_ROWS`` at least;
#: so a side has fewer than ``HEAVY`` heavy keys, whatever its size.
HEAVY = 256
HEAVY_ROWS = 100_000
#: Into how many parts a heavy key's rows are dealt.
PARTS = 32
# The spellings Spark accepts for each join type.
_JOIN_TYPES = {
    "inner": "inner",
    "left": "left",
    "leftouter": "left",
    "right": "right",
    "rightouter": "right",
    "outer": "full",
    "full": "full",
    "fullouter": "full",
    "semi": "semi",
    "leftsemi": "semi",
    "anti": "anti",
    "leftanti": "anti",
}


def join_table(
    left: DataFrame,
    right: DataFrame,
    join_pair: tuple[str, str],
    how: str = "inner",
    drop_joined_column: bool = True,
    other_drop_columns: Sequence[str] | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Join on ``left.a = right.b`` and drop both key columns, or keep them.

    Keys of the same name are kept as one column. Null keys never match.

    An inner join is left to the engine, which can split a hot key on either side. It cannot on
    the null-supplying side of an outer join, so there heavy keys (see ``HEAVY``) are dealt out:
    their rows get a part number, and the other side's rows with that key go to every part. Each
    side is read once. To find heavy keys, a small job counts the key columns while the plan is
    built; sides that the engine knows to be smaller than ``heavy_rows`` rows are not counted.
    """
    kind = _JOIN_TYPES.get(how.lower().replace("_", ""))
    if kind is None:
        raise ValueError(f"unsupported join type: {how}")
    left_key, right_key = join_pair
    for table, key in ((left, left_key), (right, right_key)):
        if key not in table.columns:
            raise ColumnException(f"join column {key} not in the table")
    left = left.withColumnRenamed(left_key, _LEFT)
    right = right.withColumnRenamed(right_key, _RIGHT)
    if kind in ("semi", "anti"):
        joined = _against_keys(left, _LEFT, right, _RIGHT, kind)
    else:
        names = left.columns + right.columns
        # Columns of the same name on both sides stay apart until the rows are together.
        apart = right.withColumnsRenamed(
            {c: f"__right_{c}" for c in right.columns if c in left.columns}
        )
        if kind == "inner":
            joined = left.join(apart, F.col(_LEFT) == F.col(_RIGHT), "inner")
        else:
            joined = _dealt_join(left, apart, kind, heavy_rows)
        joined = joined.select(*left.columns, *apart.columns).toDF(*names)
    if drop_joined_column:
        joined = joined.drop(_LEFT, _RIGHT)
    else:
        joined = _restore_keys(joined, left_key, right_key)
    return joined.drop(*(other_drop_columns or ()))


def heavy_keys(df: DataFrame, key: str, heavy_rows: int = HEAVY_ROWS) -> list:
    """Keys with more than their share of the rows; fewer than ``HEAVY``."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    most = counts.where(F.col("__n") >= heavy_rows).orderBy(F.desc("__n")).limit(HEAVY).collect()
    if not most:
        return []
    total = df.count()
    return [r[key] for r in most if r["__n"] * HEAVY > total]


def _dealt_join(left: DataFrame, right: DataFrame, kind: str, heavy_rows: int) -> DataFrame:
    """An outer join by key and part.

    A row with a key that is heavy on its own side lies in one part, chosen by its contents and
    where it was read; one with a key that is heavy on the other side lies in all the parts that
    the other rows are dealt to. So any two rows with one key meet exactly once. A copy that meets
    none has met others elsewhere, as the key has rows on the other side: it is left out.
    """
    sides = ((left, _LEFT), (right, _RIGHT))
    heavy = [heavy_keys(table, key, heavy_rows) for table, key in sides]

    def dealt(i: int) -> DataFrame:
        table, key = sides[i]
        own, other = ("__own", "__other")[:: 1 if i == 0 else -1]
        contents = [F.col(f"`{f.name}`") for f in table.schema.fields if _hashable(f.dataType)]
        place = F.pmod(F.xxhash64(F.spark_partition_id(), *contents), F.lit(PARTS)).cast("int")
        alone = F.col(key).isNull()  # null keys meet nobody and are merely spread
        part = F.when(alone | _among(key, heavy[i]), place).otherwise(0)
        out = table.withColumn(f"{own}_{i}", part)
        if not heavy[1 - i]:
            return out.withColumn(f"{other}_{i}", F.lit(0))
        every = F.array([F.lit(n) for n in range(PARTS)])
        return out.withColumn(
            f"{other}_{i}", F.explode(F.when(_among(key, heavy[1 - i]), every).otherwise(F.array(F.lit(0))))
        )

    same = F.col(_LEFT) == F.col(_RIGHT)
    for name in ("__own", "__other"):
        same = same & (F.col(f"{name}_0") == F.col(f"{name}_1"))
    met = dealt(0).join(dealt(1), same, kind)
    for key, absent, keys in ((_LEFT, _RIGHT, heavy[1]), (_RIGHT, _LEFT, heavy[0])):
        if keys:
            met = met.where(~(F.col(absent).isNull() & _among(key, keys)))
    return met


def _among(key: str, keys: list) -> Column:
    return F.coalesce(F.col(key).isin(keys), F.lit(False)) if keys else F.lit(False)


def _hashable(kind: T.DataType) -> bool:
    """Whether the engine hashes values of the type, in which maps must not lie."""
    return not any(word in kind.simpleString() for word in ("map<", "variant"))


def half(*keys: str) -> Column:
    """A bit that depends on the key alone, to be grouped by along with it.

    The groups stay the same, but the result is not partitioned by the key itself, so a
    join on the key takes its input straight from a shuffle. Only then can the engine split
    the other side's hot keys; a side that keeps the partitioning of its aggregate would
    rule that out.
    """
    return F.pmod(F.xxhash64(*keys), F.lit(2)).alias("__half")


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Distinct key values, ready to be joined with a skewed table."""
    return df.select(*keys, half(*keys)).distinct().drop("__half")


def _against_keys(
    table: DataFrame, key: str, other: DataFrame, other_key: str, kind: str
) -> DataFrame:
    """Semi or anti join with the other side's distinct keys (null keys match nothing)."""
    keys = distinct_keys(other.where(F.col(other_key).isNotNull()), other_key)
    if kind == "semi":
        return table.join(keys, F.col(key) == F.col(other_key), "left_semi")
    without_key = table.where(F.col(key).isNull())
    with_key = table.where(F.col(key).isNotNull())
    return with_key.join(keys, F.col(key) == F.col(other_key), "left_anti").union(without_key)


def _restore_keys(joined: DataFrame, left_key: str, right_key: str) -> DataFrame:
    if _RIGHT not in joined.columns:  # semi and anti joins
        return joined.withColumnRenamed(_LEFT, left_key)
    if left_key != right_key:
        return joined.withColumnsRenamed({_LEFT: left_key, _RIGHT: right_key})
    one: Column = F.coalesce(_LEFT, _RIGHT)
    return joined.withColumn(_LEFT, one).withColumnRenamed(_LEFT, left_key).drop(_RIGHT)
