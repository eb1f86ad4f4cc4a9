"""Registered queries: one per operator, with the SQL that states the same answer."""

from tidemark.catalog import (  # noqa: F401
    access,
    changes,
    chunk_store,
    feeds,
    merges,
    reporting,
    scheduling,
    versions,
)
from tidemark.catalog.registry import queries, sql_answers

__all__ = ["queries", "sql_answers"]
