"""The library's operators as queries over the shared tables, each with its SQL twin."""

from corpusflow_queries import columns, modeling, prompts, scoring, storage, text
from corpusflow_queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "columns", "modeling", "prompts", "scoring", "storage", "text"]
