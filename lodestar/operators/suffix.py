"""Aggregates over all right rows with a larger key, for each left row.

Planned as written (a correlated inequality), this is a nested-loop join. Here it is one
aggregation per distinct key, a running aggregate inside key ranges and a total per range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise
from .ordering import bucket_of, buckets_for, quantile_bounds
from .skew import heavy_counted, salted_join


def _per_key(left: DataFrame, lkey: str, right: DataFrame, rkey: str, value: str) -> DataFrame:
    """(key, mx, sm, ct, asked): aggregates of a key's right rows, and the number of its left rows.

    Written once, because several branches read it.
    """
    entries = (right.select(F.col(rkey).alias("key"), F.col(value).alias("v"),
                            F.lit(0).alias("asked"))
               .unionByName(left.select(F.col(lkey).alias("key"),
                                        F.lit(None).cast(right.schema[value].dataType).alias("v"),
                                        F.lit(1).alias("asked")))
               .where(F.col("key").isNotNull()))
    return materialise(entries.groupBy("key").agg(
        F.max("v").alias("mx"), F.sum("v").alias("sm"), F.count("v").alias("ct"),
        F.sum("asked").alias("asked")), "suffix-keys")


def suffix_table(left: DataFrame, lkey: str, right: DataFrame, rkey: str, value: str,
                 buckets: int | None = None) -> DataFrame:
    """For each distinct ``lkey``: max, sum and count of ``value`` where ``rkey > lkey``.

    Returns ``key, suffix_max, suffix_sum, suffix_count``. Keys must be numeric. Equal
    keys are one row before any ordering, so a key shared by many rows costs nothing; a
    bucket is a quantile range of the keys and so about 1 / ``buckets`` of them.
    """
    return _suffixes(_per_key(left, lkey, right, rkey, value), buckets)


def _suffixes(per_key: DataFrame, buckets: int | None) -> DataFrame:
    bounds = quantile_bounds(per_key, "key", buckets or buckets_for(per_key.count()))
    keyed = per_key.withColumn("bucket", bucket_of(F.col("key"), bounds))
    later = W.partitionBy("bucket").orderBy(F.desc("key")).rowsBetween(W.unboundedPreceding, -1)
    inside = keyed.select("key", "bucket", "asked",
                          F.max("mx").over(later).alias("in_max"),
                          F.sum("sm").over(later).alias("in_sum"),
                          F.sum("ct").over(later).alias("in_count"))
    # one row per bucket, at most `buckets`
    totals = keyed.groupBy("bucket").agg(F.max("mx").alias("mx"), F.sum("sm").alias("sm"),
                                         F.sum("ct").alias("ct"))
    beyond = W.orderBy(F.desc("bucket")).rowsBetween(W.unboundedPreceding, -1)
    after = totals.select("bucket", F.max("mx").over(beyond).alias("out_max"),
                          F.sum("sm").over(beyond).alias("out_sum"),
                          F.sum("ct").over(beyond).alias("out_count"))
    zero = F.lit(0)
    count = F.coalesce("in_count", zero) + F.coalesce("out_count", zero)
    total = F.coalesce("in_sum", zero) + F.coalesce("out_sum", zero)
    return (inside.where("asked > 0").join(F.broadcast(after), "bucket")
            .select("key", F.greatest("in_max", "out_max").alias("suffix_max"),
                    F.when(count > 0, total).alias("suffix_sum"),
                    count.alias("suffix_count")))


def suffix_agg(left: DataFrame, lkey: str, right: DataFrame, rkey: str, value: str,
               buckets: int | None = None, **skew) -> DataFrame:
    """``left`` with suffix_max, suffix_sum, suffix_count and suffix_avg.

    Left rows with no later right row get nulls and a count of 0.
    """
    left = materialise(left, "suffix-left")  # whatever made these rows runs once
    per_key = _per_key(left, lkey, right, rkey, value)
    sizes = {k: skew[k] for k in ("share", "min_rows", "width") if k in skew}
    hot = skew.pop("hot", None)
    if hot is None:
        hot = heavy_counted(per_key.where("asked > 0"), ["key"], "asked", **sizes)
    average = F.try_divide(F.col("suffix_sum").cast("double"), F.col("suffix_count"))
    return (salted_join(left.withColumn("key", F.col(lkey)), _suffixes(per_key, buckets), ["key"], "left",
                        hot=hot, **skew)
            .drop("key")
            .withColumn("suffix_count", F.coalesce("suffix_count", F.lit(0)))
            .withColumn("suffix_avg", average))
