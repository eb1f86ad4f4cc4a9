"""All queries of the folder and their SQL."""

from __future__ import annotations

from tidemark.llm import cascade, centroids, conversations, decontaminate, licenses, maxent, mixing, pii, shards, simhash, toxicity, warc, wavelet
from tidemark.llm.common import Query

_MODULES = (shards, mixing, cascade, wavelet, simhash, decontaminate, toxicity, warc, pii, maxent, centroids, licenses, conversations)


def queries() -> dict[str, Query]:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def sql_answers() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
