"""Line search over documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions import paths as P
from tidemark.operators.scopes import Rules, scope_filter


def matching_lines(content: Column, query: str | Column, max_lines: int | None = K.SEARCH_MAX_LINES) -> Column:
    """The first `max_lines` lines holding `query`, any case, as an array of `struct(line, text)`.

    A query that is a column must be in lower case.
    """
    needle = query.lower() if isinstance(query, str) else query
    numbered = F.transform(
        F.split(content, "\n", -1), lambda text, i: F.struct((i + 1).alias("line"), text.alias("text"))
    )
    hits = F.filter(numbered, lambda hit: F.lower(hit["text"]).contains(needle))
    return hits if max_lines is None else F.slice(hits, 1, max_lines)


def searchable(
    df: DataFrame, scope: str | None = None, rules: Rules = K.DEFAULT_SCOPES, agent: str = K.DEFAULT_AGENT, enforce: bool = True
) -> DataFrame:
    """The rows whose path may be searched: by extension, folder and the agent's scopes."""
    found = scope_filter(
        df.filter(P.has_extension("path", K.SEARCH_EXTENSIONS) & ~P.in_folder("path", K.SEARCH_SKIPPED_DIRS)),
        rules,
        agent,
        enforce=enforce,
    )
    return found.filter(F.col("path").startswith(scope)) if scope else found


def search_all(
    df: DataFrame,
    query: str,
    scope: str | None = None,
    rules: Rules = K.DEFAULT_SCOPES,
    agent: str = K.DEFAULT_AGENT,
    enforce: bool = True,
    max_lines: int | None = K.SEARCH_MAX_LINES,
) -> DataFrame:
    """`(path, matches)` for every file with a hit.

    Map-only: path tests run before the text is touched, whole files without the query are dropped
    before they are split, and the limit per file is a slice of the row's own array.
    """
    if not query or not query.strip():
        raise ValueError("query must not be empty")
    found = searchable(df, scope, rules, agent, enforce)
    # A text holds a query without a line break exactly if one of its lines does.
    has_hit = F.lit(False) if "\n" in query else F.lower("content").contains(query.lower())
    return found.filter(has_hit).select("path", matching_lines(F.col("content"), query, max_lines).alias("matches"))


def search(
    df: DataFrame,
    query: str,
    scope: str | None = None,
    max_results: int = K.SEARCH_MAX_FILES,
    rules: Rules = K.DEFAULT_SCOPES,
    agent: str = K.DEFAULT_AGENT,
    enforce: bool = True,
    max_lines: int | None = K.SEARCH_MAX_LINES,
) -> DataFrame:
    """The first `max_results` files with a hit, by path. The order makes this a distributed top-k."""
    return search_all(df, query, scope, rules, agent, enforce, max_lines).orderBy("path").limit(max_results)


def search_total(df: DataFrame, query: str, scope: str | None = None, **options) -> DataFrame:
    """One row: how many files and lines hold the query, beyond any limit."""
    hits = search_all(df, query, scope, max_lines=None, **options)
    return hits.agg(
        F.count("*").alias("total_files"), F.coalesce(F.sum(F.size("matches")), F.lit(0)).alias("total_lines")
    )
