"""Every registered query and its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from attestra.plans import evidence_queries, index_queries, linkage_queries, metric_queries, review_queries, stream_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
for _m in (evidence_queries, index_queries, linkage_queries, metric_queries, review_queries, stream_queries):
    QUERIES |= _m.QUERIES
    ORACLES |= _m.ORACLES
