"""Top-k, ordered limits and exact order statistics without a global sort in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise

BUCKETS = 200
KEYS_PER_BUCKET = 5_000_000
MOST_BUCKETS = 5_000


def buckets_for(n_keys: int) -> int:
    """Ordered ranges for so many distinct keys: one range is sorted by one task."""
    return min(max(BUCKETS, n_keys // KEYS_PER_BUCKET), MOST_BUCKETS)


def top_k_per_group(df: DataFrame, group_cols: list[str], order: list[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """First ``k`` rows of each group in ``order``, which must be a total order.

    The rank filter becomes a group limit ahead of the shuffle, so a hot group sends at
    most ``k`` rows per task.
    """
    window = W.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(window)).where(F.col(rank_col) <= k)


def ordered_limit(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows in a total order (each task keeps ``n`` rows at most)."""
    return df.orderBy(*order).limit(n)


def quantile_bounds(df: DataFrame, col: str, buckets: int = BUCKETS) -> list:
    """At most ``buckets - 1`` ascending cut points that split ``col`` evenly.

    A mergeable sketch returns one small row. The cut points steer the balance of
    tasks only; results are the same for any cut points.
    """
    steps = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.percentile_approx(col, steps, buckets * 20).alias("cuts")).first()
    return sorted(set(row["cuts"] or []))


def bucket_of(col: Column, bounds: list) -> Column:
    """Number of cut points below the value (0 for the first bucket), by bisection."""
    if not bounds:
        return F.lit(0)
    cuts = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
    # a step beyond the last cut reads null and is not taken
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(cuts, at + step - 1) < col, at + step).otherwise(at))
    # never null, so a join on it infers no filter that would repeat the search in the scan
    return F.coalesce(found, F.lit(0))


def values_at_ranks(df: DataFrame, col: str, ranks: Callable[[int], list[int]],
                    buckets: int | None = None) -> DataFrame:
    """Exact values at 1-based ranks: rows ``(pos, rank, value)``.

    ``ranks`` maps the number of non-null values to the wanted ranks; ``pos`` is the
    position in that list. Equal values are counted first, so duplicates never travel;
    the counts are written once, so the table is read once. Value buckets are then
    summed (one row per bucket) and only inside a bucket are values ordered.
    """
    values = materialise(df.where(F.col(col).isNotNull())
                         .groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n")), "values")
    n, n_keys = values.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    bounds = quantile_bounds(values, "value", buckets or buckets_for(n_keys))
    wanted = F.array(*[F.struct(F.lit(pos).alias("pos"), F.lit(rank).cast("long").alias("rank"))
                       for pos, rank in enumerate(ranks(n))])
    counted = values.withColumn("bucket", bucket_of(F.col("value"), bounds))
    # at most `buckets` rows from here to the broadcast
    totals = counted.groupBy("bucket").agg(F.sum("n").alias("in_bucket"))
    before = totals.select("bucket", F.coalesce(F.sum("in_bucket").over(
        W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = F.sum("n").over(W.partitionBy("bucket").orderBy("value")
                             .rowsBetween(W.unboundedPreceding, 0))
    placed = (counted.withColumn("within", within)
              .join(F.broadcast(before), "bucket")
              .withColumn("last", F.col("before") + F.col("within"))
              .withColumn("first", F.col("last") - F.col("n") + 1))
    hits = F.filter(wanted, lambda w: w["rank"].between(F.col("first"), F.col("last")))
    return placed.select("value", F.inline(hits)).select("pos", "rank", "value")


def median_value(df: DataFrame, col: str) -> DataFrame:
    """Exact median (mean of the two middle values for an even count), one row."""
    middle = values_at_ranks(df, col, lambda n: [(n + 1) // 2, n // 2 + 1])
    return middle.agg(F.avg(F.col("value").cast("double")).alias("median"))
