"""Two nodes that meet in two different shared nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise
from .graph import label_scan, typed
from .skew import salted_join

PAIR_BUDGET = 10_000_000
FIRST_GROUP = 16


def _light_cells(side1: DataFrame, side2: DataFrame, shared: DataFrame) -> DataFrame:
    """Meetings per (i, o, country): all, and those without the mismatch."""
    met = side1.join(shared, "e").join(side2, "e")
    return met.groupBy("i", "o", "c").agg(
        F.count("*").alias("n"), F.count_if(~F.col("bad")).alias("good"))


def _hubs(side1: DataFrame, side2: DataFrame, shared: DataFrame, pair_budget: int) -> DataFrame:
    """(e, c, bad, word, bit): shared nodes that would pair too many nodes, and their places in bitmaps.

    Each country numbers its hubs in blocks of 64. There are at most edges / sqrt(pair_budget) hubs, for one
    of a hub's degrees is above that root.
    """
    first = side1.groupBy("e").agg(F.count("*").alias("_d1"))
    second = side2.groupBy("e").agg(F.count("*").alias("_d2"))
    product = F.col("_d1").cast("double") * F.col("_d2")
    found = first.join(second, "e").where(product > pair_budget).select("e").join(shared, "e")
    place = F.row_number().over(W.partitionBy("c").orderBy("e")) - 1
    return materialise(found.withColumn("_place", place).select(
        "e", "c", "bad", F.floor(F.col("_place") / 64).cast("int").alias("word"),
        (F.col("_place") % 64).cast("int").alias("bit")), "hubs")


def _bit() -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))


def _in_hubs(side: DataFrame, node: str, hubs: DataFrame, group: str) -> tuple[DataFrame, DataFrame]:
    """(node, group) of the nodes in hubs, and (group, c, word, m): bitmaps of their hubs.

    Nodes in the same hubs are one group. A node's list has one entry for each block of 64 hubs.
    """
    blocks = (salted_join(side, hubs, ["e"], spread_by=[node]).groupBy(node, "c", "word")
              .agg(F.bit_or(_bit()).alias("m")))
    listed = blocks.groupBy(node).agg(F.array_sort(F.collect_list(F.struct("c", "word", "m"))).alias("_all"))
    members = materialise(listed.withColumn(group, F.md5(F.to_json("_all"))), "in-hubs")
    groups = members.groupBy(group).agg(F.first("_all").alias("_all"))
    return members.select(node, group), groups.select(group, F.inline("_all"))


def _couples(groups: DataFrame, group: str, hubs: DataFrame) -> DataFrame:
    """(group, x, y): two hubs of a group in different countries, x with the mismatch."""
    held = (groups.join(hubs, ["c", "word"]).where(F.col("m").bitwiseAND(_bit()) != 0)
            .select(group, "e", "c", "bad"))
    x = held.where("bad").select(group, F.col("e").alias("x"), F.col("c").alias("_c"))
    y = held.select(group, F.col("e").alias("y"), "c")
    return x.join(y, group).where(F.col("_c") != F.col("c")).select(group, "x", "y")


def _hub_cells(side1: DataFrame, side2: DataFrame, hubs: DataFrame, light: DataFrame) -> DataFrame:
    """Meetings in hubs, for pairs that can match, without listing a hub's pairs.

    A pair that meets in a hub matches only if it meets somewhere else too. Either that
    is a light node, and the pair is in ``light``; or it is a second hub, and the pair is
    found from two hubs that satisfy the condition, which makes it a true match. Hubs are compared once
    for two groups of nodes in the same hubs, by the set bits that their bitmaps share.
    """
    of1, groups1 = _in_hubs(side1, "i", hubs, "g1")
    of2, groups2 = _in_hubs(side2, "o", hubs, "g2")
    alike = _couples(groups1, "g1", hubs).join(_couples(groups2, "g2", hubs), ["x", "y"]).select(
        "g1", "g2").distinct()
    by_hubs = alike.join(of1, "g1").join(of2, "g2")
    met = light.select("i", "o").distinct()
    by_light = salted_join(salted_join(met, of1, ["i"]), of2, ["o"], spread_by=["i"])
    pairs = materialise(by_hubs.select("i", "o", "g1", "g2")
                        .unionByName(by_light.select("i", "o", "g1", "g2")).distinct(), "pairs")
    bad = hubs.groupBy("c", "word").agg(
        F.bit_or(F.when(F.col("bad"), _bit()).otherwise(F.lit(0).cast("long"))).alias("_bad"))
    both = F.col("m").bitwiseAND(F.col("_m2"))
    counts = (pairs.select("g1", "g2").distinct().join(groups1, "g1")
              .join(groups2.withColumnRenamed("m", "_m2"), ["g2", "c", "word"]).where(both != 0)
              .join(bad, ["c", "word"]).groupBy("g1", "g2", "c")
              .agg(F.sum(F.bit_count(both)).alias("n"),
                   F.sum(F.bit_count(both.bitwiseAND(F.bitwise_not("_bad")))).alias("good")))
    return pairs.join(counts, ["g1", "g2"]).select("i", "o", "c", "n", "good")


def _parts(nodes: DataFrame, edges: DataFrame, type1: str, type2: str, label1: str, label2: str,
           shared_label: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges (i, e) and (o, e) between the right labels, and (e, c, bad) of the shared nodes.

    The edges are written once, because several steps read them.
    """
    shared = (label_scan(nodes, shared_label).where("countries is not null")
              .select(F.col("id").alias("e"), F.col("countries").alias("c"),
                      F.coalesce(F.col("jurisdiction") != F.col("country_codes"),
                                 F.lit(False)).alias("bad")))
    firsts = label_scan(nodes, label1).select(F.col("id").alias("i"))
    seconds = label_scan(nodes, label2).select(F.col("id").alias("o"))
    side1 = (typed(edges, type1).select(F.col("src").alias("i"), F.col("dst").alias("e"))
             .distinct().join(firsts, "i", "left_semi"))
    side2 = (typed(edges, type2).select(F.col("src").alias("o"), F.col("dst").alias("e"))
             .distinct().join(seconds, "o", "left_semi"))
    return materialise(side1, "side1"), materialise(side2, "side2"), shared


def _matches(side1: DataFrame, side2: DataFrame, shared: DataFrame, pair_budget: int) -> DataFrame:
    """Number of matches per (i, o)."""
    hubs = _hubs(side1, side2, shared, pair_budget)
    if hubs.isEmpty():
        cells = _light_cells(side1, side2, shared)
    else:
        few = [side.join(hubs.select("e"), "e", "left_anti") for side in (side1, side2)]
        light = materialise(_light_cells(*few, shared), "cells")
        cells = (light.unionByName(_hub_cells(side1, side2, hubs, light))
                 .groupBy("i", "o", "c").agg(F.sum("n").alias("n"), F.sum("good").alias("good")))
    total, good = F.sum("n"), F.sum("good")
    pairs = (total * total - F.sum(F.col("n") * F.col("n"))
             - (good * good - F.sum(F.col("good") * F.col("good"))))
    return (cells.groupBy("i", "o").agg(pairs.alias("n_matches"))
            .where(F.col("n_matches") > 0))


def shared_pair_motif(nodes: DataFrame, edges: DataFrame, type1: str, type2: str,
                      label1: str, label2: str, shared_label: str,
                      pair_budget: int = PAIR_BUDGET) -> DataFrame:
    """Matches of (i)-[type1]->(e)<-[type2]-(o) and (i)-[type1]->(e2)<-[type2]-(o) per (i, o).

    e and e2 must lie in different countries and at least one of them must have a
    jurisdiction other than its country code. Returns ``i, o, n_matches``.

    Inside one (i, o) the matching pairs are counted from sums: all pairs with different
    countries, less those where neither entity has the mismatch. A shared node whose two
    degrees multiply to more than ``pair_budget`` is a hub and its pairs are not listed.
    """
    parts = _parts(nodes, edges, type1, type2, label1, label2, shared_label)
    return _matches(*parts, pair_budget)


def _first_pair(side1: DataFrame, side2: DataFrame, shared: DataFrame, pair_budget: int) -> DataFrame:
    after, size = F.lit(True), FIRST_GROUP
    while True:
        group = materialise(side1.where(after).select("i").distinct().orderBy("i").limit(size), "firsts")
        seen = group.agg(F.count("*").alias("n"), F.max("i").alias("last")).first()
        some = side1.join(group, "i", "left_semi")
        pair = materialise(_matches(some, side2, shared, pair_budget)
                           .orderBy("i", "o").limit(1).select("i", "o"), "first-pair")
        if seen["n"] < size or not pair.isEmpty():
            return pair
        after, size = F.col("i") > seen["last"], 4 * size


def first_motif_match(nodes: DataFrame, edges: DataFrame, type1: str, type2: str,
                      label1: str, label2: str, shared_label: str,
                      pair_budget: int = PAIR_BUDGET) -> DataFrame:
    """The smallest match in the order i, o, e, e2: one row, or none.

    Nodes i are taken in id order, in groups that grow fourfold, until one has a match. Then only
    the shared nodes of the first matching pair are looked at, and those are reduced
    by aggregates: a node has a partner if the other end of the country range differs.
    """
    side1, side2, shared = _parts(nodes, edges, type1, type2, label1, label2, shared_label)
    pair = _first_pair(side1, side2, shared, pair_budget)
    met = (side1.join(F.broadcast(pair), "i").join(side2, ["o", "e"]).join(shared, "e"))
    met = materialise(met.select("i", "o", "e", "c", "bad"), "first-pair-nodes")
    ends = met.agg(*[f(F.when(which, F.col("c"))).alias(name) for f, which, name in (
        (F.min, F.lit(True), "lo"), (F.max, F.lit(True), "hi"),
        (F.min, F.col("bad"), "bad_lo"), (F.max, F.col("bad"), "bad_hi"))])
    span = ends.select(F.struct("*")).scalar()
    # a node with the mismatch can take any partner, another one needs one that has it
    lo = F.when(F.col("bad"), span["lo"]).otherwise(span["bad_lo"])
    hi = F.when(F.col("bad"), span["hi"]).otherwise(span["bad_hi"])
    first = (met.where((F.col("c") != lo) | (F.col("c") != hi))
             .agg(F.min(F.struct("e", "i", "o", "c", "bad")).alias("m")).where("m is not null")
             .select("m.i", "m.o", "m.e", F.col("m.c").alias("_c"), F.col("m.bad").alias("_bad")))
    partner = met.select(F.col("e").alias("e2"), "i", "o", "c", "bad")
    return (first.join(partner, ["i", "o"])
            .where((F.col("c") != F.col("_c")) & (F.col("bad") | F.col("_bad")))
            .groupBy("i", "o", "e").agg(F.min("e2").alias("e2")))
