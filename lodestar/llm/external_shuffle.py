"""A uniform shuffle of a table too large for memory, in two passes, written as equal shards.

Pass one scatters the rows into memory-sized buckets by a seeded hash. Pass two shuffles each
bucket in memory (Spark's ``shuffle`` is a seeded Fisher-Yates) and writes it. Buckets follow one
another, so a row's place in the whole is its bucket's first place plus its own in the bucket, and
shard k takes the k-th part of all places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stored

SEED = 20_240_607
BUCKET_BYTES = 32 << 20
# equal rows up to which one bucket takes them all
MOST_COPIES = 1 << 10
# beyond 32 TB of text buckets grow instead (100 MB at 100 TB), so their starts stay a table of 16 MB
MOST_BUCKETS = 1 << 20


def row_size(text: str) -> Column:
    """UTF-8 bytes of the text and 8 for the id; null has no bytes."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def _digest(docs: DataFrame) -> Column:
    return F.xxhash64(*[docs[f"`{c}`"] for c in docs.columns])


def _bucket(digest: Column, copy: Column, buckets: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(digest, copy.cast("long"), F.lit(seed)), F.lit(buckets)).cast("int")


def _scatter(docs: DataFrame, digests: DataFrame, buckets: int, seed: int) -> DataFrame:
    """(bucket, row) for every row; equal rows of large number are spread over buckets by copy.

    The bucket comes from the row's content, so a task that runs again deals the same way. Many
    equal rows would meet in one bucket: they are counted instead and their copies numbered.
    """
    rows = docs.select(_digest(docs).alias("d"), F.struct(
        *[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    crowds = digests.where(F.col("n") > MOST_COPIES).select("d")
    if crowds.isEmpty():
        return rows.select(_bucket(F.col("d"), F.lit(0), buckets, seed).alias("bucket"), "row")
    single = rows.join(crowds, "d", "left_anti").select("d", F.lit(0).cast("long").alias("copy"), "row")
    counted = rows.join(crowds, "d", "left_semi").groupBy("d", "row").agg(F.count("*").alias("n"))
    runs = counted.select("d", "row", "n", F.explode(F.sequence(
        F.lit(0), F.expr(f"(n - 1) div {MOST_COPIES}"))).alias("run")).repartition("d", "run")
    copies = runs.select("d", F.explode(F.sequence(
        F.col("run") * MOST_COPIES, F.least("n", (F.col("run") + 1) * MOST_COPIES) - 1)).alias("copy"), "row")
    return single.unionAll(copies).select(
        _bucket(F.col("d"), F.col("copy"), buckets, seed).alias("bucket"), "row")


def _bucket_starts(digests: DataFrame, buckets: int, seed: int) -> DataFrame:
    """(bucket, first): the place of each bucket's first row. One row per bucket is ordered."""
    copies = F.when(F.col("n") > MOST_COPIES, F.sequence(F.lit(0), F.expr(f"(n - 1) div {MOST_COPIES}")))
    runs = digests.select("d", "n", F.explode(F.coalesce(copies, F.array(F.lit(0).cast("long")))).alias("run"))
    crowd = F.col("n") > MOST_COPIES
    one = runs.where(~crowd).select("n", _bucket(F.col("d"), F.lit(0), buckets, seed).alias("bucket"))
    many = runs.where(crowd).select("d", F.explode(F.sequence(
        F.col("run") * MOST_COPIES, F.least("n", (F.col("run") + 1) * MOST_COPIES) - 1)).alias("copy")).select(
            F.lit(1).cast("long").alias("n"), _bucket(F.col("d"), F.col("copy"), buckets, seed).alias("bucket"))
    sizes = one.unionAll(many).groupBy("bucket").agg(F.sum("n").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))


def write_shuffled(docs: DataFrame, shards: int = 24, text_col: str = "text", seed: int = SEED,
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Writes ``docs`` in random order as ``shards`` shards and returns what was written.

    The result has all columns, ``shard`` (0 to shards - 1, row counts at most one apart) and ``slot``
    (the row's place in its shard, gapless from 0); each name gets underscores if taken. Files lie in the
    shared folder, one directory per shard. A bucket holds about ``bucket_bytes`` of text and is one task,
    shuffled in its memory; raise it with the memory of executors. Nulls, ties and equal rows are rows like
    others; an empty table gives no rows.
    """
    names = {"shard": "shard", "slot": "slot"}
    taken = {c.lower() for c in docs.columns}
    for key in names:
        while names[key] in taken:
            names[key] += "_"
    digests = stored(docs.select(_digest(docs).alias("d"), row_size(text_col).alias("size"))
                     .groupBy("d").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")), "digests")
    total = digests.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).first()
    rows, text_bytes = total["n"] or 0, total["bytes"] or 0
    buckets = min(-(-text_bytes // bucket_bytes) or 1, MOST_BUCKETS)
    first = F.broadcast(stored(_bucket_starts(digests, buckets, seed), "bucket-starts"))
    dealt = _scatter(docs, digests, buckets, seed).repartitionById(buckets, "bucket")
    mixed = (dealt.groupBy("bucket").agg(F.shuffle(F.sort_array(F.collect_list("row")), seed).alias("rows"))
             .join(first, "bucket").select("first", F.posexplode("rows").alias("at", "row"))
             .withColumn("place", F.col("first") + F.col("at")))
    shard = F.expr(f"cast(place * {shards} div {max(rows, 1)} as int)")
    slot = F.expr(f"place - (_shard * {rows}L + {shards - 1}) div {shards}")
    placed = mixed.withColumn("_shard", shard).select(
        "row.*", slot.alias(names["slot"]), F.col("_shard").alias(names["shard"]))
    path = write_scratch_by(placed.sortWithinPartitions(names["shard"], names["slot"]), names["shard"])
    return docs.sparkSession.read.schema(placed.schema).parquet(path)


def write_scratch_by(df: DataFrame, column: str) -> str:
    """Writes ``df`` to a new shared folder, a directory per value of ``column``; returns the path."""
    path = scratch_path(df.sparkSession, "shards")
    df.write.partitionBy(column).parquet(path)
    return path
