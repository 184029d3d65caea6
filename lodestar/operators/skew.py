"""Joins that stay balanced when one key holds a large share of the rows.

Adaptive execution splits skewed partitions only where both join sides are plain
exchanges. When the right side has been aggregated to one row per key, a hot key on
the left lands in one task. ``salted_join`` covers that case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffle_width

MIN_ROWS = 1_000_000
TRACKED_PER_KEY = 16


def hot_share(width: int) -> float:
    """Share of the rows from which on a key is hot: four average partitions' worth.

    Kept between 1/2048 and 1/64, so at most 2048 keys can be hot.
    """
    return max(1 / 2048, min(1 / 64, 4 / width))


def salts_for(count: int, rows: int, width: int) -> int:
    """Tasks that a key's rows are spread over: as many average partitions as they fill."""
    return max(2, -(-count * width // rows))


def heavy_keys(df: DataFrame, keys: list[str], share: float | None = None,
               min_rows: int = MIN_ROWS, width: int | None = None) -> dict[int, int]:
    """Hashes of the hot keys, each with its number of salts, the hottest first.

    One pass over the key columns with a top-k sketch. At most ``1 / share`` keys can
    hold that share of the rows, so the answer is bounded whatever the data. A sketch
    error changes only how keys are salted, never a result.
    """
    width = width or shuffle_width(df.sparkSession)
    share = share or hot_share(width)
    most = int(2 / share)
    found = df.agg(
        F.count("*").alias("n"),
        F.call_function("approx_top_k", F.xxhash64(*keys), F.lit(most),
                        F.lit(most * TRACKED_PER_KEY)).alias("top"),
    ).first()
    floor = max(found["n"] * share, min_rows)
    return {entry["item"]: salts_for(entry["count"], found["n"], width)
            for entry in found["top"] or [] if entry["count"] > floor}


def heavy_counted(counts: DataFrame, keys: list[str], count: str, share: float | None = None,
                  min_rows: int = MIN_ROWS, width: int | None = None) -> dict[int, int]:
    """``heavy_keys`` from a table with one row per key and its number of rows: exact, no pass over the rows."""
    width = width or shuffle_width(counts.sparkSession)
    share = share or hot_share(width)
    rows = counts.agg(F.sum(count).alias("n")).first()["n"] or 0
    floor = max(rows * share, min_rows)
    found = counts.where(F.col(count) > floor).select(F.xxhash64(*keys).alias("key"), F.col(count).alias("n"))
    return {r["key"]: salts_for(r["n"], rows, width) for r in found.orderBy(F.desc("n"), "key").collect()}


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner",
                share: float | None = None, min_rows: int = MIN_ROWS,
                width: int | None = None, hot: dict[int, int] | None = None,
                spread_by: list[str] | None = None) -> DataFrame:
    """Join of a large ``left`` with a ``right`` that has one row per key.

    Rows of a hot left key are spread over as many tasks as they would fill, and only
    its right row is repeated, once per task: altogether about as many extra rows as
    there are shuffle partitions. Without hot keys this is the plain join. ``how``:
    inner, left, left_semi or left_anti. ``hot`` gives the hot keys when they are already
    known and saves the pass that looks for them.

    Hot rows are spread by a hash of ``spread_by``, for example the row id, or of all columns of
    ``left``: a task that runs again deals its rows the same way, in whatever order they arrive.
    """
    for key in on:
        if left.schema[key].dataType != right.schema[key].dataType:
            raise TypeError(f"join key {key} differs in type")
    if hot is None:
        hot = heavy_keys(left, on, share, min_rows, width)
    if not hot:
        return left.join(right, on, how)
    key_hash = F.xxhash64(*on)
    table = F.create_map(*[F.lit(x).cast(kind) for pair in hot.items()
                           for x, kind in zip(pair, ("long", "int"))])
    # cold rows skip the lookup
    salts = F.when(key_hash.isin(list(hot)), F.element_at(table, key_hash)).otherwise(F.lit(1))
    place = F.xxhash64(*[F.col(c) for c in spread_by or left.columns])
    salted_left = left.withColumn("_salt", F.pmod(place, salts).cast("int"))
    salted_right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")


def salt_table(spark: SparkSession, hot: dict[int, int]) -> DataFrame:
    """(key_hash, salts): the hot keys of ``heavy_keys`` as a table; at most 2048 rows, often none."""
    return spark.createDataFrame(list(hot.items()), "key_hash long, salts int")


def dealt(df: DataFrame, on: list[str], table: DataFrame, spread_by: list[str]) -> DataFrame:
    """``df`` with a column ``salt``: 0, or for rows of a hot key a number that a hash of the row chooses."""
    place = F.pmod(F.xxhash64(*spread_by), F.col("salts")).cast("int")
    return (df.withColumn("key_hash", F.xxhash64(*on)).join(F.broadcast(table), "key_hash", "left")
            .withColumn("salt", F.coalesce(place, F.lit(0))).drop("key_hash", "salts"))


def repeated(df: DataFrame, on: list[str], table: DataFrame) -> DataFrame:
    """``df``, one row per key, with a row for each ``salt`` that ``dealt`` gives its key."""
    last = F.coalesce(F.col("salts"), F.lit(1)) - 1
    return (df.withColumn("key_hash", F.xxhash64(*on)).join(F.broadcast(table), "key_hash", "left")
            .withColumn("salt", F.explode(F.sequence(F.lit(0), last))).drop("key_hash", "salts"))


def keys_of(df: DataFrame, on: list[str]) -> DataFrame:
    """Distinct non-null keys; partial aggregation shrinks hot keys before the shuffle."""
    return df.select(*on).dropna().distinct()


def semi_join(left: DataFrame, right: DataFrame, on: list[str], **skew) -> DataFrame:
    """Rows of ``left`` (as a bag) whose key occurs in ``right``."""
    return salted_join(left, keys_of(right, on), on, "left_semi", **skew)


def anti_join(left: DataFrame, right: DataFrame, on: list[str], **skew) -> DataFrame:
    """Rows of ``left`` (as a bag) whose key does not occur in ``right``."""
    return salted_join(left, keys_of(right, on), on, "left_anti", **skew)


def checked_broadcast(df: DataFrame, max_rows: int = 100_000) -> tuple[DataFrame, bool]:
    """``df`` marked for broadcast when it has at most ``max_rows`` rows, else as it is."""
    small = df.count() <= max_rows
    return (F.broadcast(df) if small else df), small


def lookup_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner",
                max_rows: int = 100_000, **skew) -> DataFrame:
    """Join with a per-key table that is usually tiny: broadcast if it is, salted if not."""
    side, small = checked_broadcast(right, max_rows)
    return left.join(side, on, how) if small else salted_join(left, side, on, how, **skew)

