"""How filters act on each other: every order of them, folded over the sets of filters that rows fail.

A document is reduced to a mask, one bit for each filter that it fails, and documents are counted by
(part, mask): at most 32 cells a part. Each cell folds across the constant array of all orders, which
travels with the plan, and gives one weighted struct for each order and step; the structs of a part's
cells are then added place by place. Nothing depends on how many documents a cell stands for.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blank_words, stored

LETTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_STEP = "struct<f:int," + ",".join(f"{c}:bigint" for c in COUNTS) + ">"


def text_failures(text: Column, words: Column) -> dict[str, Column]:
    """The filters that look at one text and its words: whether it fails each.

    A: fewer than 200 words. B: under half of its words are different. C: over 3 % of its characters are
    A-Z. D: it holds one of ``#$%&*|``.
    """
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failure_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, n): rows of ``docs`` (doc_id, text, lang) by the filters that they fail.

    Filter E fails where a smaller doc_id of the whole table has the same text, known by its SHA-256.
    Only (text digest, smallest id) is joined back, on both columns, so no group of copies meets in one
    task. A null text counts as empty, a null lang as the part of the empty string. A null doc_id
    never fails E; neither does a row that repeats another one's id and text.
    """
    text = F.coalesce("text", F.lit(""))
    mask = F.lit(0)
    for k, fails in enumerate(text_failures(text, F.col("_words")).values()):
        mask = mask + F.when(fails, 1 << k).otherwise(0)
    part = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part")
    rows = stored(docs.select("doc_id", part, "text", blank_words(F.col("text")).alias("_words")).select(
        "doc_id", "part", mask.alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest")), "failures")
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("smallest")).select(
        F.col("digest").alias("_digest"), "smallest")
    slim = rows.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    at = (slim.digest == firsts._digest) & (slim.doc_id == firsts.smallest)
    copy = F.col("smallest").isNull() & F.col("doc_id").isNotNull()
    return (slim.join(firsts, at, "left")
            .withColumn("mask", F.col("mask") + F.when(copy, 1 << 4).otherwise(0))
            .groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n")))


def cells(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents, and how many of them are labelled good or toxic.

    A document is good if any row of ``labels`` (doc_id, quality, toxic) with its id has quality 1, and
    toxic in the same way; labels for no document and null ids say nothing.
    """
    marks = labels.groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("is_good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("is_toxic"))
    return counts.join(marks, "doc_id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("is_good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("toxic"))


def _orders(letters: str) -> list[tuple[int, ...]]:
    return list(permutations(range(len(letters))))


def _order_array(letters: str) -> Column:
    return F.array(*[F.array(*[F.lit(f) for f in order]) for order in _orders(letters)])


def folded(letters: str = LETTERS) -> Column:
    """One struct for each order and step, of a cell (mask, n, good, toxic)."""
    def walk(state: Column, f: Column) -> Column:
        fails = F.bit_get("mask", f) == 1
        alone = fails & (F.bit_count("mask") == 1)
        goes = state["alive"] & fails
        count = lambda when, what: F.when(when, F.col(what)).otherwise(F.lit(0)).cast("long")
        step = F.struct(
            f.alias("f"), count(state["alive"] & ~fails, "n").alias("kept"),
            count(goes, "n").alias("removed"), count(~state["alive"] & fails, "n").alias("redundant"),
            count(alone, "n").alias("unique_fails"), count(goes, "good").alias("good_lost"),
            count(goes, "toxic").alias("toxic_lost"))
        return F.struct((state["alive"] & ~fails).alias("alive"),
                        F.concat(state["steps"], F.array(step)).alias("steps"))

    start = F.struct(F.lit(True).alias("alive"), F.array().cast(f"array<{_STEP}>").alias("steps"))
    return F.flatten(F.transform(_order_array(letters), lambda order: F.aggregate(
        order, start, walk, lambda state: state["steps"])))


def _added(lists: Column, size: int) -> Column:
    """Arrays of step structs, added place by place; ``size`` structs each."""
    add = lambda a, b: F.struct(
        b["f"].alias("f"), *[(a[c] + b[c]).alias(c) for c in COUNTS])
    zero = F.struct(F.lit(0).alias("f"), *[F.lit(0).cast("long").alias(c) for c in COUNTS])
    return F.aggregate(lists, F.array_repeat(zero, size), lambda total, one: F.zip_with(total, one, add))


def interactions(found: DataFrame, letters: str = LETTERS) -> DataFrame:
    """(part, filter_order, step, counts, shapley): all orders of the filters over ``found``, see ``cells``.

    ``shapley`` is what the step's filter removes, summed over all orders. A part has at most
    2 ** len(letters) cells, so its arrays meet in one row whatever the data. No cells, no rows.
    """
    orders = _orders(letters)
    names = F.array(*[F.lit("".join(letters[f] for f in order)) for order in orders])
    size, steps = len(orders) * len(letters), len(letters)
    each = found.select("part", folded(letters).alias("rows")).groupBy("part").agg(
        F.collect_list("rows").alias("lists")).select("part", _added(F.col("lists"), size).alias("rows"))
    shares = F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda f: F.aggregate(
        "rows", F.lit(0).cast("long"),
        lambda total, one: total + F.when(one["f"] == f, one["removed"]).otherwise(F.lit(0).cast("long"))))
    return (each.select("part", shares.alias("shares"), F.posexplode("rows").alias("at", "one"))
            .select("part", F.get(names, F.expr(f"at div {steps}").cast("int")).alias("filter_order"),
                    (F.col("at") % steps + 1).alias("step"), *[F.col(f"one.{c}").alias(c) for c in COUNTS],
                    F.get("shares", F.col("one.f")).alias("shapley")))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters over ``docs`` in all 120 orders; nulls and repeated rows as in the parts above.

    An empty table gives no rows. Without labels the lost columns are 0.
    """
    found = stored(cells(failure_counts(docs), labels.select("doc_id", "quality", "toxic")), "cells")
    return interactions(found)
