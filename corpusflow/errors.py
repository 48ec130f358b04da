"""Errors raised by the library."""


class ColumnException(Exception):
    """A column is missing, duplicated, mistyped or otherwise unusable."""


class KeyViolation(Exception):
    """Rows break the primary key of a keyed table."""
