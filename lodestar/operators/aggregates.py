"""Counting jobs over keyed events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, key_col: str, value_col: str) -> DataFrame:
    return df.groupBy(key_col, value_col).agg(F.count("*").alias("n"))


def _extremes(value_col: str) -> tuple:
    """Smallest and largest value among those with the top count."""
    first = F.min_by(value_col, F.struct(-F.col("n"), F.col(value_col)))
    last = F.max_by(value_col, F.struct(F.col("n"), F.col(value_col)))
    return first, last


def favourite(df: DataFrame, key_col: str, value_col: str) -> DataFrame:
    """Most frequent value per key; ties go to the smallest value.

    Two aggregations with map-side combine and no sort of a key's rows.
    """
    first, _ = _extremes(value_col)
    return value_counts(df, key_col, value_col).groupBy(key_col).agg(first.alias(value_col))


def strict_favourite(df: DataFrame, key_col: str, value_col: str) -> DataFrame:
    """Most frequent value per key; keys whose top two counts tie are left out."""
    first, last = _extremes(value_col)
    return (value_counts(df, key_col, value_col).groupBy(key_col)
            .agg(first.alias(value_col), last.alias("_last"))
            .where(F.col(value_col) == F.col("_last")).drop("_last"))


def strict_favourite_in_all(df: DataFrame, key_col: str, value_col: str, period_col: str,
                            periods: list) -> DataFrame:
    """``strict_favourite`` of the keys seen in every period, in the same two passes."""
    first, last = _extremes(value_col)
    seen = [F.bool_or(F.col(period_col) == F.lit(p)).alias(f"_p{i}") for i, p in enumerate(periods)]
    again = [F.bool_or(f"_p{i}").alias(f"_p{i}") for i in range(len(periods))]
    gate = F.lit(True)
    for i in range(len(periods)):
        gate = gate & F.col(f"_p{i}")
    return (df.groupBy(key_col, value_col).agg(F.count("*").alias("n"), *seen)
            .groupBy(key_col).agg(first.alias(value_col), last.alias("_last"), *again)
            .where(gate & (F.col(value_col) == F.col("_last")))
            .select(key_col, value_col))


def present_in_all(df: DataFrame, key_col: str, period_col: str, periods: list) -> DataFrame:
    """Keys that occur in every one of ``periods``."""
    gate = [F.bool_or(F.col(period_col) == F.lit(p)).alias(f"_p{i}") for i, p in enumerate(periods)]
    out = df.groupBy(key_col).agg(*gate)
    for i in range(len(periods)):
        out = out.where(F.col(f"_p{i}"))
    return out.select(key_col)


def fan_counts(favourites: DataFrame, value_col: str, out_col: str = "n_fans") -> DataFrame:
    """Number of keys per favourite value."""
    return favourites.groupBy(value_col).agg(F.count("*").alias(out_col))


def stddev_pop_value(df: DataFrame, col: str) -> DataFrame:
    """Population standard deviation, one row."""
    return df.agg(F.stddev_pop(F.col(col).cast("double")).alias("stddev_pop"))
