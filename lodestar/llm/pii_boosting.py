"""Personal data: validated formats, and boosted trees over high-recall candidate spans.

Regular expressions propose spans, overlapping ones included. Those of the four base kinds that pass
their check (Luhn, ranges, digit counts) are personal data. All other candidates are scored by
gradient-boosted trees over format and neighbouring characters. Their labels come from evidence that is no
feature: positive are candidates that overlap a span which passed its check, and those right after a hint
word that fail no check; all others are negative. So the trees learn which formats are personal data, and a
span without a hint word can be added, one after a hint word left out. Spans without a hint count as errors,
so the precision is a lower bound where hint words are missing by chance. Cutoffs are calibrated on
the half of the documents that did not train, one for each generator. Everything is counted over the whole
corpus: training rows are cells of equal features with their counts, of which there are at most about a million.
A candidate that is part of a longer word is no span; it neither trains nor is added.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, stored

# Patterns are anchored at run starts and possessive: the same matches, in time linear in the text.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "address": r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D@]{1,64}+@[^\x20\x09-\x0D@]++",
    "dotted": r"(?<![0-9])[0-9]++(?:[.:][0-9]++){2,}+",
    "number": r"(?<![0-9])[+(]?[0-9](?:[\x20().-]{0,3}[0-9]){6,}+",
    "token": r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]{0,32}[0-9])[A-Za-z0-9_-]{16,}+",
}
PATTERNS = {**BASE, **GENERATORS}
NEEDS = {"email": "[@]", "address": "[@]", "phone": "[+]"}  # characters that a match must hold
HINTS = "(?i)(?:tel|phone|call|mail|card|account|ip|host|key|token|secret|password)\\W{0,4}$"
FORM = ("made_by", "digits", "letters", "marks", "dots", "plus", "at")
FEATURES = (*FORM, "before", "after")
PRECISION, LEAST_SPANS = 0.95, 30
TREES, DEPTH = 12, 3


def _proposed(texts: DataFrame) -> DataFrame:
    """One row per match: id, h, kind, i (its number), gap (length before it), hit, left, right."""
    wide = texts
    for kind, pattern in PATTERNS.items():
        hits = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        possible = F.col("text").rlike(NEEDS.get(kind, "[0-9]"))
        none = F.array().cast("array<string>")
        wide = wide.withColumn(f"{kind}_hits", F.when(possible, hits).otherwise(none))
    for kind, pattern in PATTERNS.items():
        wide = wide.withColumn(f"{kind}_gaps", F.when(
            F.size(f"{kind}_hits") > 0, F.split("text", pattern, -1)))
    return wide.select("id", "h", F.explode(F.concat(*map(_matches, PATTERNS))).alias("m")).select(
        "id", "h", "m.*")


def _matches(kind: str) -> Column:
    gap = lambda i: F.get(f"{kind}_gaps", i)
    return F.transform(f"{kind}_hits", lambda hit, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.length(gap(i)).alias("gap"), hit.alias("hit"),
        F.right(gap(i), F.lit(24)).alias("left"), F.left(gap(i + 1), F.lit(1)).alias("right")))


def _small(number: Column) -> Column:
    """Whether a string of digits is at most 255."""
    digits = F.ltrim(number, F.lit("0"))
    return F.when(F.length(digits) <= 3, F.concat(F.lit("0"), digits).cast("int") <= 255
                  ).otherwise(F.lit(False))


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def part(at):
        d = F.substring(back, at, F.lit(1)).cast("int") * (F.lit(2) - at % 2)
        return F.when(d > 9, d - 9).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, at: s + part(at))
    return total % 10 == 0


def _valid() -> Column:
    digits = F.regexp_replace("hit", "[^0-9]+", "")
    return (F.when(F.col("kind") == "email", F.lit(True))
            .when(F.col("kind") == "ip", F.forall(F.split("hit", r"\."), _small))
            .when(F.col("kind") == "card", F.when(F.length(digits).between(16, 19), _luhn(digits))
                  .otherwise(F.lit(False)))
            .when(F.col("kind") == "phone", F.length(digits).between(8, 15))
            .otherwise(F.lit(False)))


def _failed() -> Column:
    """Whether a candidate has the digits of a card or the parts of an address, but not its check."""
    digits = F.regexp_replace("hit", "[^0-9]+", "")
    return (F.when(F.col("hit").rlike(r"^[0-9]+(\.[0-9]+){3}$"), ~F.forall(F.split("hit", r"\."), _small))
            .when(F.col("hit").rlike("^[0-9\\x20.()+-]+$") & F.length(digits).between(16, 19), ~_luhn(digits))
            .otherwise(F.lit(False)))


def _side(text: Column) -> Column:
    return (F.when(text == "", 0).when(text.rlike("[\\x20\\x09-\\x0D]"), 1)
            .when(text.rlike("[\\p{L}\\p{N}]"), 2).when(text.isin("'", '"', "`"), 4)
            .when(text.isin("=", ":"), 5).otherwise(3))


def _features() -> dict[str, Column]:
    count = lambda pattern: F.length(F.regexp_replace("hit", pattern, ""))
    step = lambda c, *cuts: reduce(
        lambda a, cut: a + F.when(c >= cut, 1).otherwise(0), cuts, F.lit(0))
    return {
        "made_by": reduce(lambda a, k: F.when(F.col("kind") == k[1], k[0]).otherwise(a),
                          enumerate(GENERATORS), F.lit(0)),
        "digits": F.least(count("[^0-9]+"), F.lit(20)),
        "letters": step(count("[^\\p{L}]+"), 1, 3, 8, 16, 24),
        "marks": step(count("[\\p{L}\\p{N}]+"), 1, 2, 4),
        "dots": F.least(count("[^.]+"), F.lit(4)),
        "plus": F.startswith(F.col("hit"), F.lit("+")).cast("int"),
        "at": F.contains(F.col("hit"), F.lit("@")).cast("int"),
        "before": _side(F.right("left", F.lit(1))),
        "after": _side(F.col("right")),
        "hint": F.col("left").rlike(HINTS).cast("int"),
    }


def candidates(docs: DataFrame) -> DataFrame:
    """(id, h, kind, start, end, base, near, failed, features): every proposed span, in code points.

    ``base``: of a base kind and valid. ``near``: overlaps such a span. ``failed``: see ``_failed``. Rows that repeat an id and a text
    count once.
    """
    texts = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"),
                        F.coalesce("text", F.lit("")).alias("text"))
    rows = _proposed(texts).repartition("id", "h").dropDuplicates(["id", "h", "kind", "i"])
    own = Window.partitionBy("id", "h", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.length("hit")).over(own)
    spans = rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("hit"))
    spans = spans.withColumn("base", _valid())
    doc = Window.partitionBy("id", "h").orderBy("start", "end", "kind")
    back = doc.rowsBetween(Window.unboundedPreceding, -1)
    ahead = doc.rowsBetween(1, Window.unboundedFollowing)
    near = (F.coalesce(F.max(F.when(F.col("base"), F.col("end"))).over(back) > F.col("start"), F.lit(False))
            | F.coalesce(F.min(F.when(F.col("base"), F.col("start"))).over(ahead) < F.col("end"), F.lit(False)))
    return spans.withColumn("near", near).select(
        "id", "h", "kind", "start", "end", "base", "near", _failed().alias("failed"),
        *[c.cast("double").alias(name) for name, c in _features().items()])


def _cutoffs(scored: DataFrame) -> dict[float, float]:
    """By generator, the lowest score from which on held-out candidates reach the precision.

    Both all of them and those that could be added, where one error is let pass.
    """
    down = Window.partitionBy("made_by").orderBy(F.col("p").desc())  # at most one row per cell
    counts = ("held", "held_k", "free", "free_k")
    sums = scored.groupBy("made_by", "p").agg(*[F.sum(c).alias(c) for c in counts])
    found = (sums.select("made_by", "p", *[F.sum(c).over(down).alias(c) for c in counts])
             .where((F.col("held") >= LEAST_SPANS) & (F.col("held_k") >= PRECISION * F.col("held"))
                    & (F.col("free") - F.col("free_k") <= F.greatest(F.lit(1.0), (1 - PRECISION) * F.col("free"))))
             .groupBy("made_by").agg(F.min("p").alias("p")).collect())
    return {r["made_by"]: r["p"] for r in found}


def _labelled_cells(others: DataFrame) -> DataFrame:
    """Features with n and k, all and positive candidates of training documents.

    held and held_k count those of the other documents, free and free_k those of them that touch no base span.
    """
    held = F.pmod(F.xxhash64("h"), F.lit(2)) == 0
    positive = F.col("near") | ((F.col("hint") == 1) & ~F.col("failed"))
    counted = lambda which: F.sum(F.when(which, 1).otherwise(0))
    parts = (("n", "k", ~held), ("held", "held_k", held), ("free", "free_k", held & ~F.col("near")))
    return others.groupBy(*FEATURES).agg(*[
        c for every, good, part in parts for c in (
            counted(part).alias(every), counted(part & positive).alias(good))])


def _scores(vectors: DataFrame, model) -> DataFrame:
    return model.transform(vectors).withColumn(
        "p", F.round(vector_to_array("probability")[1], 6)).drop(
            "x", "rawPrediction", "probability", "prediction")


def select_spans(docs: DataFrame) -> DataFrame:
    """(id, h, kind, start, end, base): the base spans and those that the trees add.

    Added spans touch no base span; of overlapping ones the best scored stays. Without both kinds of
    labels, or with fewer than ``LEAST_SPANS`` held-out candidates of a generator, nothing of it is added.
    Labels by hint words are weak, and the precision of the cutoffs is against such labels.
    """
    found = stored(candidates(docs), "pii-candidates")
    whole = (F.col("before") != 2) & (F.col("after") != 2)
    others = found.where(~F.col("kind").isin(*BASE) & whole)
    cells = stored(_labelled_cells(others), "pii-cells")
    base = found.where("base").select("id", "h", "kind", "start", "end", F.lit(True).alias("base"))
    both = cells.agg(F.sum("k").alias("k"), F.sum("n").alias("n")).first()
    if not both["k"] or both["k"] == both["n"]:
        return base
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="x")
    classes = F.explode(F.array(F.struct(F.lit(1.0).alias("y"), F.col("k").cast("double").alias("w")),
                                F.struct(F.lit(0.0).alias("y"), (F.col("n") - F.col("k")).cast("double").alias("w"))))
    training = vector.transform(cells.select("*", classes.alias("c")).select("*", "c.*").where("w > 0"))
    model = GBTClassifier(featuresCol="x", labelCol="y", weightCol="w", maxIter=TREES, maxDepth=DEPTH,
                          stepSize=0.3, seed=7).fit(training.select("x", "y", "w").repartition(2))
    scored = stored(_scores(vector.transform(cells), model), "pii-scores")
    cutoffs = _cutoffs(scored)
    if not cutoffs:
        return base
    passes = reduce(lambda a, cut: a | ((F.col("made_by") == cut[0]) & (F.col("p") >= cut[1])),
                    cutoffs.items(), F.lit(False))
    good = scored.where(passes).select(*FEATURES, "p")
    added = others.where(~F.col("near")).join(good, list(FEATURES)).select(
        "id", "h", "kind", "start", "end", "p")
    return base.unionAll(_islands(added, F.struct("p", F.col("end") - F.col("start"), -F.col("start"), "kind"))
                         .select("id", "h", "best.kind", "best.start", "best.end", F.lit(False)))


def _islands(spans: DataFrame, rank: Column) -> DataFrame:
    """(id, h, from, to, best): each run of overlapping spans, with its best one by ``rank``."""
    doc = Window.partitionBy("id", "h").orderBy("start", "end", "kind")
    before = F.max("end").over(doc.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before > F.col("start"), 0).otherwise(1)
    return (spans.withColumn("_new", new).withColumn("_run", F.sum("_new").over(doc))
            .groupBy("id", "h", "_run")
            .agg(F.min("start").alias("from"), F.max("end").alias("to"),
                 F.max_by(F.struct("kind", "start", "end"), rank).alias("best")))


def spans_by_document(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): counts of base spans, their digest, and all spans.

    A span is written kind:start:end, ordered by kind (email, ip, card, phone, then the added kinds)
    and start. Null text counts as empty.
    """
    order = {kind: at for at, kind in enumerate(PATTERNS)}
    at = reduce(lambda a, kind: F.when(F.col("kind") == kind, order[kind]).otherwise(a), order, F.lit(99))
    entry = F.struct(at.alias("o"), "start", "end", "kind", "base")
    rows = stored(select_spans(docs).groupBy("id", "h").agg(
        F.sort_array(F.collect_list(entry)).alias("spans")), "pii-spans")
    slim = docs.select(F.col("doc_id"), F.xxhash64("text").alias("own"))
    full = slim.join(rows, slim.doc_id.eqNullSafe(rows.id) & (slim.own == rows.h), "left")
    some = F.coalesce("spans", F.array().cast(rows.schema["spans"].dataType))
    write = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter(some, lambda s: s["base"])
    counted = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind))
    return full.select(
        "doc_id",
        *[counted(kind).cast("long").alias(f"n_{kind}") for kind in BASE],
        F.sha2(write(base), 256).alias("base_sha256"), write(some).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; n_chars follows the text.

    Overlapping spans become one, named by its first. Other rows and columns stay as they are.
    """
    first = F.struct(-F.col("start"), "end", "kind")
    merged = stored(_islands(select_spans(docs), first).groupBy("id", "h").agg(F.sort_array(
        F.collect_list(F.struct("from", "to", "best.kind"))).alias("spans")), "pii-redactions")
    rows = packed(docs, _id=F.col("doc_id"), _h=F.xxhash64("text"))
    # spans grow with the rows: the same join at every size, no broadcast of what happens to be small
    full = rows.join(merged.hint("merge"), rows._id.eqNullSafe(merged.id) & (rows._h == merged.h), "left")
    text = F.col("_row")["text"]

    def piece(span, i):
        done = F.coalesce(F.get("spans", i - 1)["to"], F.lit(0)).cast("int")
        return F.concat(F.substring(text, done + 1, (span["from"] - done).cast("int")),
                        F.lit("<"), span["kind"], F.lit(">"))

    rest = F.substring(text, F.element_at("spans", -1)["to"].cast("int") + 1, F.length(text))
    new = F.when(F.col("spans").isNull(), text).otherwise(
        F.concat(F.array_join(F.transform("spans", piece), ""), rest))
    out = full.withColumn("_text", new)
    changed = {"text": F.col("_text"), "n_chars": F.when(
        F.col("spans").isNull(), F.col("_row")["n_chars"] if "n_chars" in docs.columns else F.lit(0))
        .otherwise(F.length("_text"))}
    return out.select(*[
        (changed[c].cast(docs.schema[c].dataType) if c in changed else F.col("_row")[c]).alias(c)
        for c in docs.columns])
