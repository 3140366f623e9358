"""Registry of the operator queries exposed through ``__spark_entry__``.

``@register(name, sql)`` records a callable ``(spark, sf_dir) -> DataFrame``
and, when the operator is expressible in SQL, the DuckDB statement the
driver runs as an oracle on the same parquet tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def reasons_sql(rules: list[tuple[str, str]]) -> str:
    """SQL twin of ``quality.tag``: failed rule names joined by ', ' in declaration order."""
    parts = [f"CASE WHEN coalesce(({cond}), false) THEN '{name}' END" for name, cond in rules]
    return "concat_ws(', ', " + ", ".join(parts) + ")"
