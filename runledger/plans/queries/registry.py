"""The query registry: every registered query and its DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _bigint_counts(sql: str) -> str:
    """DuckDB's count_if returns HUGEINT; Spark's returns BIGINT: cast every call."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "CAST(" + key + _bigint_counts(sql[j + len(key):k - 1]) + ") AS BIGINT)")
        i = k


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = _bigint_counts(sql)
        return fn
    return deco


