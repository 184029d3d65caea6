"""Joins, bag operations and subquery rewrites."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_width
from .skew import checked_broadcast, semi_join


def natural_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Equi-join on all columns the two sides share."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("no shared columns")
    return left.join(right, shared)


def multiplicities(df: DataFrame, count_col: str = "n") -> DataFrame:
    """Bag as distinct rows plus the number of copies."""
    return df.groupBy(*df.columns).agg(F.count("*").alias(count_col))


def natural_join_counted(tables: list[DataFrame], count_col: str = "n") -> DataFrame:
    """Natural join of several bags, as distinct result rows plus their multiplicity.

    Copies are counted before each join and counts multiplied, so repeated rows never
    meet as pairs.
    """
    def step(left: DataFrame, right: DataFrame) -> DataFrame:
        counted = multiplicities(right, "_right")
        joined = natural_join(left, counted)
        return joined.withColumn(count_col, F.col(count_col) * F.col("_right")).drop("_right")

    return reduce(step, tables[1:], multiplicities(tables[0], count_col))


def bag_difference(left: DataFrame, right: DataFrame, block: int = 100_000) -> DataFrame:
    """Each row of ``left`` as often as it occurs there beyond its number in ``right``; columns by position.

    Both sides are counted first. What is left of a row is written out in blocks of copies, and the
    blocks, not the copies, are dealt over the tasks: a row with millions of copies comes from many.
    """
    cols = left.columns
    signed = left.select("*", F.lit(1).alias("_n")).union(
        right.toDF(*cols).select(*cols, F.lit(-1).alias("_n")))
    counted = signed.groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n > 0")
    blocks = counted.select("*", F.explode(F.sequence(
        F.lit(0), F.expr(f"(_n - 1) div {block}"))).alias("_block"))
    copies = F.least(F.col("_n") - F.col("_block") * block, F.lit(block))
    return (blocks.repartition(shuffle_width(left.sparkSession), *cols, "_block")
            .select(*cols, F.explode(F.sequence(F.lit(1), copies)).alias("_copy")).drop("_copy"))


def exists_greater(left: DataFrame, lkey: str, right: DataFrame, rkey: str) -> DataFrame:
    """``EXISTS (… WHERE rkey > lkey)``: only the largest right key matters.

    An empty right side gives a null maximum and hence no rows.
    """
    return left.where(F.col(lkey) < right.agg(F.max(rkey)).scalar())


def join_by_method(left: DataFrame, right: DataFrame, on: list[str], method: str) -> DataFrame:
    """Inner join by a named method: merge, shuffle_hash or broadcast.

    Broadcast is taken only when the right side passes the size check; a merge join
    stands in beyond it.
    """
    if method == "broadcast":
        side, small = checked_broadcast(right)
        return left.join(side if small else right.hint("merge"), on)
    return left.join(right.hint(method), on)


def semijoin_reduced(left: DataFrame, right: DataFrame, on: list[str],
                     left_cols: list[str], right_cols: list[str]) -> DataFrame:
    """Inner join that first ships only the left keys and drops right rows without partner."""
    slim_right = semi_join(right.select(*dict.fromkeys([*on, *right_cols])), left, on)
    return (left.select(*dict.fromkeys([*on, *left_cols])).join(slim_right, on)
            .select(*left_cols, *right_cols))


def outer_join(left: DataFrame, right: DataFrame, on: list[str], side: str) -> DataFrame:
    """Outer join that keeps all of ``side`` ('left' or 'right')."""
    if side not in ("left", "right"):
        raise ValueError(side)
    return left.join(right, on, side)


def having_equals_scalar(df: DataFrame, key_col: str, value_col: str, pred: Column) -> DataFrame:
    """Keys whose row count equals the number of distinct values, both under ``pred``."""
    kept = df.where(pred)
    wanted = kept.agg(F.count_distinct(value_col)).scalar()
    return (kept.groupBy(key_col).agg(F.count("*").alias("n"))
            .where(F.col("n") == wanted))


def single_value_keys(df: DataFrame, key_col: str, value_col: str, pred: Column) -> DataFrame:
    """Keys for which one value makes up all non-null values, with that value.

    Put as a subquery, a (key, value) count is compared with the key's count. Those are
    equal exactly when smallest and largest value agree, which needs one aggregate.
    """
    return (df.where(pred & F.col(value_col).isNotNull()).groupBy(key_col)
            .agg(F.min(value_col).alias(value_col), F.max(value_col).alias("_last"))
            .where(F.col(value_col) == F.col("_last")).drop("_last"))


def avg_over_join(left: DataFrame, right: DataFrame, on: list[str], group_col: str,
                  value_col: str, out_col: str) -> DataFrame:
    """Average of a right column over ``left JOIN right``, per left group.

    Both sides are summed per key before they meet: a key with l left and r right rows
    costs one joined row per group and not l * r.
    """
    per_group = left.groupBy(*on, group_col).agg(F.count("*").alias("_l"))
    value = F.col(value_col).cast("double")
    per_key = right.groupBy(*on).agg(F.sum(value).alias("_s"), F.count(value).alias("_r"))
    return (per_group.join(per_key, on).groupBy(group_col)
            .agg((F.sum(F.col("_l") * F.col("_s")) / F.nullif(F.sum(F.col("_l") * F.col("_r")), F.lit(0)))
                 .alias(out_col)))
