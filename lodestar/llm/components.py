"""Connected components by contraction, in a number of rounds that grows with the logarithm."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); a component shares one label.

    Each round hangs a node under that of its closed neighbourhood whose hash is smallest and
    contracts the edges along it. Hashes stand in for random priorities, so that chains in id
    order shrink as fast as others. Rounds are written to the shared folder: a lost
    executor costs a re-read. Self loops and repeated edges do no harm; null ends are dropped.
    """
    live = stored(edges.where("a <> b").distinct(), "edges")
    steps = []
    while not live.isEmpty():
        ends = live.unionAll(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
        step = stored(
            ends.groupBy(F.col("a").alias("node")).agg(F.min(rank("b")).alias("low"))
            .select("node", F.least(F.col("low"), rank("node"))["n"].alias("up")), "parents")
        steps.append(step)
        ups = lambda c: step.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up"))
        live = stored(
            live.join(ups("a"), "a").join(ups("b"), "b").where("a_up <> b_up")
            .select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b"))
            .distinct(), "edges")
    if not steps:
        return live.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = steps[-1].withColumnRenamed("up", "label")
    for step in reversed(steps[:-1]):
        later = labels.select(F.col("node").alias("up"), "label")
        labels = step.join(later, "up", "left").select(
            "node", F.coalesce("label", "up").alias("label"))
    return labels
