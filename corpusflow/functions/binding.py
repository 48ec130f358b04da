"""Naming an intermediate value inside a column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row.

    An expression used twice is copied into the plan twice; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
