"""Shortest undirected paths between two node sets, level by level from both ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise, write_scratch


FIRST_GROUP = 64


def undirected(edges: DataFrame) -> DataFrame:
    """Distinct (node, next) pairs in both directions, without self loops."""
    there = edges.select(F.col("src").alias("node"), F.col("dst").alias("next"))
    back = edges.select(F.col("dst").alias("node"), F.col("src").alias("next"))
    return there.unionByName(back).where("node <> next").distinct()


def reach(edges: DataFrame, sources: DataFrame, targets: DataFrame, source_hops: int,
          target_hops: int, with_path: bool = False) -> DataFrame:
    """Nodes around both sets with their distance: ``from_source, origin, node, hops``.

    A breadth-first search moves all origins of both sets one hop per round. In an
    undirected graph a neighbour of level t lies on level t − 1, t or t + 1, so a round
    is checked against two levels only and not against everything visited. Each level is
    written once to the shared folder: a round's plan reads files and does not grow.

    ``with_path`` adds the smallest shortest path in list order, from source to node or
    from node to target.
    """
    spark = edges.sparkSession
    adjacency = materialise(undirected(edges), "adjacency")
    key = ["from_source", "origin", "node"]

    def seeds(ids: DataFrame, from_source: bool) -> DataFrame:
        one = ids.select("id").distinct()
        trail = [F.array("id").alias("path")] if with_path else []
        return one.select(F.lit(from_source).alias("from_source"), F.col("id").alias("origin"),
                          F.col("id").alias("node"), F.lit(0).alias("hops"), *trail)

    start = seeds(sources, True).unionByName(seeds(targets, False))
    folders = [write_scratch(start, "level")]
    for hops in range(1, max(source_hops, target_hops) + 1):
        level = spark.read.schema(start.schema).parquet(folders[-1])
        # an empty level only makes empty ones, so a look now and then is enough
        if hops % 4 == 1 and level.isEmpty():
            break
        if hops > target_hops:
            level = level.where("from_source")
        seen = spark.read.schema(start.schema).parquet(*folders[-2:])
        stepped = level.join(adjacency, "node")
        # rounds differ in file names only, so compiled code is shared between them
        moved = [F.col("from_source"), F.col("origin"), F.col("next").alias("node"),
                 (F.col("hops") + 1).alias("hops")]
        if with_path:
            onward = F.when(F.col("from_source"), F.concat("path", F.array("next"))).otherwise(
                F.concat(F.array("next"), F.col("path")))
            fresh = (stepped.select(*moved, onward.alias("path"))
                     .groupBy(*key, "hops").agg(F.min("path").alias("path")))
        else:
            fresh = stepped.select(*moved).distinct()
        fresh = fresh.join(seen.select(*key), key, "left_anti").select(*start.columns)
        folders.append(write_scratch(fresh, "level"))
    return spark.read.schema(start.schema).parquet(*folders)


def shortest_paths(edges: DataFrame, sources: DataFrame, targets: DataFrame, max_hops: int = 30,
                   min_hops: int = 0, with_path: bool = False) -> DataFrame:
    """``(source, target, hops)`` for pairs at distance ``min_hops`` … ``max_hops``.

    ``sources`` and ``targets`` hold an ``id`` column. Both ends are searched for half
    the hops and meet in the middle: a shortest path of d hops has one node that is
    ceil(d / 2) hops from the source and floor(d / 2) from the target, and no meeting
    gives less than the distance. The state is one row per origin and node within half
    the hops, and each joined row is a connected pair.

    ``with_path`` adds the path as a list of node ids, the smallest one in list order
    among the shortest.
    """
    found = reach(edges, sources, targets, (max_hops + 1) // 2, max_hops // 2, with_path)
    ends = found.where("from_source").select(
        F.col("origin").alias("source"), "node", F.col("hops").alias("there"),
        # the target is as far from the meeting node, or one hop nearer
        F.explode(F.array("hops", F.col("hops") - 1)).alias("back"),
        *([F.col("path").alias("head")] if with_path else []))
    starts = found.where("not from_source").select(
        F.col("origin").alias("target"), "node", F.col("hops").alias("back"),
        *([F.col("path").alias("tail")] if with_path else []))
    met = ends.join(starts, ["node", "back"])
    length = F.col("there") + F.col("back")
    if with_path:
        whole = F.concat("head", F.slice("tail", F.lit(2), F.size("tail")))
        best = F.min(F.struct(length.alias("hops"), whole.alias("path")))
        pairs = met.groupBy("source", "target").agg(best.alias("_b")).select(
            "source", "target", "_b.hops", "_b.path")
    else:
        pairs = met.groupBy("source", "target").agg(F.min(length).alias("hops"))
    return pairs.where(F.col("hops").between(min_hops, max_hops))


def first_path(edges: DataFrame, sources: DataFrame, targets: DataFrame, max_hops: int = 30,
               min_hops: int = 0, group: int = FIRST_GROUP) -> DataFrame:
    """``(source, target, hops, path)`` of the first pair by id in that range, or no row.

    Sources are taken in id order, in groups that grow fourfold, and the search stops at the
    first group with a pair. The state is one row per node and source of a group.
    """
    after = F.lit(True)
    while True:
        some = materialise(sources.where(after).select("id").distinct().orderBy("id").limit(group),
                           "first-sources")
        seen = some.agg(F.count("*").alias("n"), F.max("id").alias("last")).first()
        found = reach(edges, some, targets.where(F.lit(False)), max_hops, 0)
        pairs = (found.where(F.col("hops").between(min_hops, max_hops))
                 .join(targets.select(F.col("id").alias("node")).distinct(), "node"))
        first = materialise(pairs.orderBy("origin", "node").limit(1), "first-pair")
        if seen["n"] < group or not first.isEmpty():
            break
        after, group = F.col("id") > seen["last"], 4 * group
    ends = [first.select(F.col(c).alias("id")) for c in ("origin", "node")]
    return shortest_paths(edges, *ends, max_hops, min_hops, with_path=True)
