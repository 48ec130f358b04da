"""Conditional and merge-related column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.errors import ColumnException


def case_when(
    whens: Sequence[tuple[Column, Column]], otherwise: Column | None = None
) -> Column:
    """First matching clause wins; nothing matching gives ``otherwise`` or null."""
    if any(len(clause) != 2 for clause in whens):
        raise ColumnException("each clause must be a (condition, value) pair")
    fallback = F.lit(None) if otherwise is None else otherwise
    if not whens:
        return fallback
    (condition, value), *rest = whens
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain.otherwise(fallback)


def merge_condition(match_cols: Sequence[str], source: str = "src", target: str = "tgt") -> Column:
    """``src.a = tgt.a AND ...``; null keys match nothing."""
    if not match_cols:
        raise ColumnException("a merge needs at least one match column")
    return reduce(and_, [F.col(f"{source}.`{c}`") == F.col(f"{target}.`{c}`") for c in match_cols])


def _kept(columns: Iterable[str], excluded: Iterable[str] | None) -> list[str]:
    excluded = set(excluded or ())
    return [c for c in columns if c not in excluded]


def changed_condition(
    columns: Sequence[str],
    excluded: Iterable[str] | None = None,
    null_safe: bool = False,
    source: str = "src",
    target: str = "tgt",
) -> Column:
    """True when any compared column differs.

    By default a comparison with null is unknown, so null to value alone is no change;
    ``null_safe`` counts it as one. Nothing to compare means nothing changed.
    """
    unknown = set(excluded or ()) - set(columns)
    if unknown:
        raise ColumnException(f"excluded columns not in the table: {sorted(unknown)}")
    differs = []
    for c in _kept(columns, excluded):
        s, t = F.col(f"{source}.`{c}`"), F.col(f"{target}.`{c}`")
        differs.append(~s.eqNullSafe(t) if null_safe else s != t)
    return reduce(or_, differs, F.lit(False)) if differs else F.lit(False)


def update_map(
    columns: Sequence[str],
    excluded: Iterable[str] | None = None,
    source: str = "src",
    target: str = "tgt",
) -> dict[str, str]:
    """``{"tgt.c": "src.c"}`` for every column not excluded."""
    return {f"{target}.{c}": f"{source}.{c}" for c in _kept(columns, excluded)}
