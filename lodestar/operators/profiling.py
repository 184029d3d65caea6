"""Column profiles, equi-depth histograms, selectivities and key skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scores
from .ordering import values_at_ranks


def ndv_profile(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """Rows, nulls and distinct values per column, from one pass over the table."""
    distinct = F.approx_count_distinct if approx else F.count_distinct
    measures = [F.count("*").alias("_rows")]
    for i, c in enumerate(cols):
        measures += [distinct(c).alias(f"_d{i}"), F.count(c).alias(f"_c{i}")]
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("n_rows"),
                              (F.col("_rows") - F.col(f"_c{i}")).alias("n_null"),
                              F.col(f"_d{i}").alias("ndv")) for i, c in enumerate(cols)])
    return df.agg(*measures).select(F.inline(rows))


def equi_depth_histogram(df: DataFrame, col: str, n: int) -> DataFrame:
    """Exact bounds of ``n`` equally full buckets: n + 1 rows ``(bound, value)``.

    Bound 0 is the minimum; bound i is the value at rank ceil(i · rows / n).
    """
    def ranks(rows: int) -> list[int]:
        return [max(-(-i * rows // n), 1) for i in range(n + 1)]

    return values_at_ranks(df, col, ranks).select(F.col("pos").alias("bound"), "value")


def range_selectivity(histogram: DataFrame, lo: float | None, hi: float | None) -> DataFrame:
    """Estimated share of values in (lo, hi), linear inside a bucket; one row.

    The histogram is n + 1 rows by construction.
    """
    lower = F.lit(lo).cast("double") if lo is not None else F.lit(float("-inf"))
    upper = F.lit(hi).cast("double") if hi is not None else F.lit(float("inf"))
    a = histogram.select(F.col("bound").alias("_i"), F.col("value").cast("double").alias("_a"))
    b = histogram.select((F.col("bound") - 1).alias("_i"), F.col("value").cast("double").alias("_b"))
    width = F.col("_b") - F.col("_a")
    overlap = F.greatest(F.least(F.col("_b"), upper) - F.greatest(F.col("_a"), lower), F.lit(0.0))
    inside = (F.col("_a") > lower) & (F.col("_b") < upper)
    share = F.when(width > 0, overlap / width).otherwise(F.when(inside, 1.0).otherwise(0.0))
    return a.join(b, "_i").agg((F.sum(share) / F.count("*")).alias("selectivity"))


def predicate_selectivity(profile: DataFrame) -> DataFrame:
    """Estimates for ``col = x`` and ``col <> x`` from a distinct-value profile."""
    ndv: Column = F.col("ndv")
    return profile.select("column_name", "ndv",
                          scores.equality_selectivity(ndv).alias("sel_equal"),
                          scores.inequality_selectivity(ndv).alias("sel_not_equal"))


def key_skew_profile(df: DataFrame, keys: list[str]) -> DataFrame:
    """How evenly a grouping on ``keys`` would load its tasks; one row."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("size"))
    return sizes.agg(
        F.count("*").alias("n_keys"), F.sum("size").alias("n_rows"),
        F.max("size").alias("max_group"), F.min("size").alias("min_group"),
        (F.sum("size") / F.count("*")).alias("avg_group"),
        (F.max("size") / F.sum("size")).alias("max_share"))


def replication_rate(rows_in: DataFrame, rows_out: DataFrame) -> DataFrame:
    """Emitted rows per input row of a keyed job; one row."""
    n_in = rows_in.agg(F.count("*")).scalar()
    return rows_out.agg(F.count("*").alias("n_out")).select(
        n_in.alias("n_in"), "n_out", F.try_divide(F.col("n_out").cast("double"), n_in).alias("rate"))
