"""Registry of queries, and readers of the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

_RUNS: dict[str, Run] = {}
_SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Run], Run]:
    """Register a function under its own name, with the SQL of the same result."""

    def register(run: Run) -> Run:
        _RUNS[run.__name__] = run
        _SQL[run.__name__] = sql.strip()
        return run

    return register


def queries() -> dict[str, Run]:
    return dict(_RUNS)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
