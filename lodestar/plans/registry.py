"""Registered queries and, beside each, the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import size_shuffles
from .oracle import with_views
from .views import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of the tables under its own name."""
    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            size_shuffles(spark, sf_dir)
            return build(Tables(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return build
    return register
