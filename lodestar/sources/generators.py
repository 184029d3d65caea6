"""Synthetic rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def uniform_ints(spark: SparkSession, n: int, columns: dict[str, int], seed: int = 0) -> DataFrame:
    """``n`` rows; each column is a random number in [0, k] rounded to the nearest integer.

    Rounding leaves the two end values half as frequent as the others.
    """
    return _draw(spark.range(n), columns, seed)


def uniform_ints_like(df: DataFrame, columns: dict[str, int], seed: int = 0) -> DataFrame:
    """As ``uniform_ints``, with one row per row of ``df``."""
    return _draw(df.select(), columns, seed)


def _draw(rows: DataFrame, columns: dict[str, int], seed: int) -> DataFrame:
    return rows.select(*[F.rint(F.rand(seed + i) * k).cast("int").alias(name)
                         for i, (name, k) in enumerate(columns.items())])
