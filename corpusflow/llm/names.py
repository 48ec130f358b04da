"""Names that an operator uses for columns of its own, when the input has them too."""

from __future__ import annotations

import uuid
from collections.abc import Collection

from pyspark.sql import DataFrame


def clashing(df: DataFrame, prefix: str, used: Collection[str]) -> dict[str, str]:
    """Other names for the columns that begin with ``prefix``, but for those that are ``used``."""
    names = [c for c in df.columns if c.lower().startswith(prefix) and c not in used]
    return {c: f"kept_{uuid.uuid4().hex}" for c in names}


def restored(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({other: c for c, other in names.items()})
