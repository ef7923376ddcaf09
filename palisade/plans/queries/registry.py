"""Registration of queries, and SQL building blocks shared by the twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from palisade.plans import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}

WITH_CONN = f"WITH conn AS ({views.CONN})"
WITH_BIN = f"{WITH_CONN}, bin AS (SELECT * REPLACE (CASE WHEN label = 'normal' THEN 0 ELSE 1 END AS label) FROM conn)"
WITH_SCORES = f"{WITH_CONN}, scores AS ({views.SCORES})"
WITH_FULL = f"WITH full_conn AS ({views.FULL_CONN})"
WITH_DOCS = f"WITH docs AS ({views.LABELLED_DOCUMENTS})"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, when given, the DuckDB text that must return the same rows."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries are named {name!r}")
        QUERIES[name] = fn
        if sql is not None:
            TWINS[name] = sql
        return fn

    return register
