"""Benchmark decontamination with a positional inverted index of the training texts.

Postings (term, document, position) are stored for the terms that the lookups start from: the
three rarest of each benchmark window, by counts over the whole corpus. A lookup takes the list of the
rarest term, shifts it to the window's start, and intersects it with the lists of the
other two, each shifted by its own offset. Survivors at the exact offsets are compared word by word;
those that are off by a few words are proximity matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, packed, stored

WINDOW = 10
RAREST = 3
SLOP = 2
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
# rows of 16 bytes that one pass over the texts broadcasts
TERMS_AT_ONCE = 1 << 20
# the same for windows, rows of some 100 bytes
WINDOWS_AT_ONCE = 1 << 17
_MET = "id <=> l_id and h = l_h and tid = l_tid and pos = l_pos"


def index_words(text: Column) -> Column:
    """Lower-cased runs of digits, letters a-z and non-ASCII characters; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """(item_id, wid, words) for each run of ``width`` words; a shorter item is one window.

    ``wid`` is a hash of the words. Null ids and items without words give nothing.
    """
    own = items.select("item_id", index_words(F.col("text")).alias("w")).where(
        "item_id is not null and size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1)))
    return own.select("item_id", F.explode(F.transform(
        starts, lambda s: F.slice("w", s, width))).alias("words")).select(
            "item_id", F.xxhash64("words").alias("wid"), "words")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"),
                       index_words(F.col("text")).alias("w"))


def _in_blocks(terms: DataFrame, at_once: int = TERMS_AT_ONCE) -> list[DataFrame]:
    """``terms`` (tid, ...) cut into parts of bounded size, each marked for broadcast."""
    blocks = -(-terms.count() // at_once) or 1
    return [F.broadcast(terms.where(F.pmod("tid", F.lit(blocks)) == b)) for b in range(blocks)]


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(tid, n): occurrences in all of ``docs`` of each term (tid) that occurs."""
    tokens = _texts(docs).select(F.explode("w").alias("term")).select(
        F.xxhash64("term").alias("tid"))
    return _union([tokens.join(block, "tid", "left_semi") for block in _in_blocks(terms)]
                  ).groupBy("tid").agg(F.count("*").alias("n"))


def lookups(found: DataFrame, counts: DataFrame) -> DataFrame:
    """(wid, words, whole, t1, o1, t2, o2, t3, o3): each window's rarest terms and their offsets.

    Terms that occur nowhere are passed over; ``whole`` is false for a window with one, which cannot
    occur as a phrase. It is kept only if three others occur. Equally rare terms go by their text. t2 and
    t3 are null for a window of fewer different terms.
    """
    terms = (found.select("wid", F.posexplode("words").alias("off", "term"))
             .groupBy("wid", "term").agg(F.min("off").alias("off"))
             .withColumn("tid", F.xxhash64("term")).join(counts, "tid", "left"))
    order = Window.partitionBy("wid").orderBy(F.col("n").asc_nulls_last(), "term")
    ranked = terms.withColumn("r", F.row_number().over(order))
    rare = F.col("n").isNotNull()
    wide = ranked.groupBy("wid").agg(
        F.min(rare).alias("whole"), F.count_if(rare).alias("occurring"),
        *[F.max(F.when(rare & (F.col("r") == k), F.col(c))).alias(f"{name}{k}")
          for k in range(1, RAREST + 1) for c, name in (("tid", "t"), ("off", "o"))])
    return found.join(wide.where(f"whole or occurring >= {RAREST}").drop("occurring"), "wid")


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(tid, id, h, pos, around): one row per occurrence of a term of ``terms`` (tid, first).

    ``around`` holds the words up to nine places before and after, for ``first`` terms only. It is cut
    after the term is looked up, so other occurrences copy nothing.
    """
    tokens = _texts(docs).select("id", "h", "w", F.posexplode("w").alias("pos", "term"))
    near = F.slice("w", F.greatest(F.col("pos") - (WINDOW - 2), F.lit(1)),
                   F.least(F.col("pos"), F.lit(WINDOW - 1)) + WINDOW)
    return _union([
        tokens.withColumn("tid", F.xxhash64("term")).join(block, "tid").select(
            "tid", "id", "h", "pos", F.when(F.col("first"), near).alias("around"))
        for block in _in_blocks(terms)])


def _words_at(start: Column, pos: Column, size: Column) -> Column:
    """``size`` words from word ``start`` on, taken from the words around word ``pos``."""
    skipped = F.greatest(pos - (WINDOW - 1), F.lit(0))
    return F.slice("around", start - skipped + 1, size)


def _lookups_of(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = stored(windows(items).groupBy("wid").agg(F.any_value("words").alias("words")), "windows")
    vocabulary = stored(found.select(F.explode("words").alias("term")).select(
        F.xxhash64("term").alias("tid")).distinct(), "vocabulary")
    return stored(lookups(found, term_counts(docs, vocabulary)), "lookups")


def phrases(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(id, h, wid): windows that occur in texts as exact phrases; see ``matches``.

    The list of a window's rarest term holds the words around, in which the other terms of the phrase
    are looked for at their offsets. So only these lists are stored, and none is shuffled.
    """
    looks = _lookups_of(docs, items).where("whole").select(F.col("t1").alias("tid"), "o1", "wid", "words")
    terms = stored(looks.select("tid").distinct().withColumn("first", F.lit(True)), "rare-terms")
    index = stored(postings(docs, terms), "postings")
    start = F.col("pos") - F.col("o1")
    return _union([
        index.join(block, "tid").where(start >= 0)
        .where(_words_at(start, F.col("pos"), F.size("words")) == F.col("words")).select("id", "h", "wid")
        for block in _in_blocks(looks, WINDOWS_AT_ONCE)]).distinct()


def matches(docs: DataFrame, items: DataFrame, slop: int = SLOP) -> DataFrame:
    """(id, h, wid, start, n, exact, slack): windows that occur in texts, from word ``start`` on.

    exact: the phrase, n words. Else its three rarest terms that occur anywhere in ``docs`` stand near
    their places, off by at most ``slop`` words each and by ``slack`` in all, but not the phrase. ``h``,
    a hash of the text, tells rows of one id apart. Rows that repeat an id and a text give one match.
    """
    looks = _lookups_of(docs, items)
    rare = looks.select(F.explode(F.array(*[
        F.struct(F.col(f"t{k}").alias("tid"), F.lit(k == 1).alias("first"))
        for k in range(1, RAREST + 1)])).alias("t")).select("t.*").where("tid is not null")
    terms = stored(rare.groupBy("tid").agg(F.max("first").alias("first")), "rare-terms")
    index = stored(postings(docs, terms), "postings")

    plain = looks.drop("words", "whole")
    live = (index.where("around is not null").select("tid", "id", "h", "pos")
            .join(plain.withColumnRenamed("t1", "tid"), "tid")
            .withColumn("start", F.col("pos") - F.col("o1")).where("start >= 0")
            .select("id", "h", "wid", "start", "o1", "t2", "o2", "t3", "o3",
                    F.lit(0).alias("slack")))
    for k in range(2, RAREST + 1):
        shifts = F.sequence(F.lit(-slop), F.lit(slop))
        asked = live.where(f"t{k} is not null").select(
            "*", F.explode(shifts).alias("off")).select(
                "*", F.col(f"t{k}").alias("tid"),
                (F.col("start") + F.col(f"o{k}") + F.col("off")).alias("pos"))
        hit = asked.join(_listed(index), F.expr(_MET), "left_semi").withColumn(
            "slack", F.col("slack") + F.abs("off")).drop("tid", "pos", "off")
        live = hit.unionAll(live.where(f"t{k} is null"))
    best = live.groupBy("id", "h", "wid", "start", "o1").agg(F.min("slack").alias("slack"))

    # the words around the rarest term decide on the exact phrase
    at = best.withColumn("pos", F.col("start") + F.col("o1")).join(
        looks.select("wid", "words", F.col("t1").alias("tid")), "wid")
    same = _words_at(F.col("start"), F.col("pos"), F.size("words")) == F.col("words")
    return (at.join(_listed(index.where("around is not null"), "around"), F.expr(_MET))
            .select("id", "h", "wid", "start", F.size("words").alias("n"), same.alias("exact"), "slack")
            .distinct())


def _listed(index: DataFrame, *more: str) -> DataFrame:
    return index.select(*[F.col(c).alias(f"l_{c}") for c in ("id", "h", "tid", "pos")], *more)


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, n_hit, n_items, items_sha256, contaminated, n_near.

    n_hit counts words inside an occurring window, n_items the items with one, n_near the proximity
    matches, each a window and a place. Null and empty texts have no words and no hits; rows with a null id are judged too.
    """
    found = stored(matches(docs, items), "matches")
    exact = found.where("exact")
    words = exact.select("id", "h", F.explode(F.sequence(
        F.col("start"), F.col("start") + F.col("n") - 1)).alias("pos")).distinct()
    members = windows(items).select("wid", F.col("item_id").cast("string").alias("item")).distinct()
    named = exact.select("id", "h", "wid").distinct().join(members, "wid")
    parts = [words.groupBy("id", "h").agg(F.count("*").alias("n_hit")),
             named.groupBy("id", "h").agg(F.array_sort(F.collect_set("item")).alias("items")),
             found.where("not exact").groupBy("id", "h").agg(F.count("*").alias("n_near"))]
    empty = F.array().cast("array<string>")
    wide = [("n_hit", F.lit(0)), ("items", empty), ("n_near", F.lit(0))]
    union = _union([part.select("id", "h", *[
        (F.col(c) if c in part.columns else F.lit(None)).cast(
            "array<string>" if c == "items" else "long").alias(c) for c, _ in wide])
        for part in parts])
    hits = stored(union.groupBy("id", "h").agg(*[F.max(c).alias(c) for c, _ in wide]), "hits")
    sized = _texts(docs).select("id", "h", F.size("w").cast("long").alias("n_words"))
    met = sized.id.eqNullSafe(hits.id) & (sized.h == hits.h)
    full = sized.join(hits, met, "left").select(
        sized.id.alias("doc_id"), "n_words", *[F.coalesce(c, none).alias(c) for c, none in wide])
    return full.select(
        "doc_id", "n_words", F.col("n_hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), F.col("n_near").cast("long").alias("n_near"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no window of ``items`` occurs, with all their columns."""
    hit = stored(phrases(docs, items).select("id", "h").distinct(), "contaminated")
    rows = packed(docs, _id=F.col("doc_id"), _h=F.xxhash64("text"))
    met = rows._id.eqNullSafe(hit.id) & (rows._h == hit.h)
    return rows.join(hit, met, "left_anti").select("_row.*")
