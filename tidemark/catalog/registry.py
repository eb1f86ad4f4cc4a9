"""Where queries and their SQL are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

# Shared derivations, in SQL. A query's SQL names those it builds on; a later one may use an earlier.
VIEWS: dict[str, str] = {}


def view(name: str, body: str) -> None:
    VIEWS[name] = body


def register(sql: str | None = None, uses: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Registers a query under its function name; `sql` may build on the shared views in `uses`."""

    def keep(query: Query) -> Query:
        name = query.__name__
        if name in _QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        _QUERIES[name] = query
        if sql is not None:
            heads = [f"{v} AS ({VIEWS[v]})" for v in VIEWS if v in _needed(uses)]
            _SQL[name] = (f"WITH {', '.join(heads)} " if heads else "") + sql
        return query

    return keep


def _needed(uses: tuple[str, ...]) -> set[str]:
    needed, todo = set(), list(uses)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            words = set(VIEWS[name].replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split())
            todo += [v for v in VIEWS if v in words and v != name]
    return needed


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def sql_answers() -> dict[str, str]:
    return dict(_SQL)
