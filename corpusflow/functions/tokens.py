"""Tokens and token counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: a run of letters, digits and underscores, or one other printing character.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"

Tokenizer = Callable[[Sequence[str]], list[list[str]]]


def regex_tokens(c: Column | str, pattern: str = TOKEN_PATTERN) -> Column:
    """The default tokenizer: native, no Python worker."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def custom_tokens(c: Column | str, load: Callable[[], Tokenizer]) -> Column:
    """Tokens from any vectorised tokenizer; ``load`` runs once per task."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = load()
        for texts in batches:
            present = texts.notna()
            out = pd.Series([None] * len(texts), index=texts.index, dtype=object)
            found = tokenizer(texts[present].tolist())
            out[present] = pd.Series(found, index=texts.index[present], dtype=object)
            yield out

    return tokens(c)
