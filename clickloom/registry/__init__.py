"""The queries over the provided tables, and for each the same in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickloom.registry import ads, categories, helpers, pages, products, sessions, streams

Query = Callable[[SparkSession, str], DataFrame]
_MODULES = (products, sessions, categories, pages, ads, helpers, streams)


def _in_utc(query: Query) -> Query:
    """Times are read and shown in UTC, whatever zone the session was opened in."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    return run


def all_queries() -> dict[str, Query]:
    return {name: _in_utc(q) for module in _MODULES for name, q in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
