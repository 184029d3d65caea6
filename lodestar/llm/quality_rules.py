"""Quality rules whose cutoffs come with a proven limit on the good documents they reject.

Each rule is a score in thousandths. On labelled documents, the good ones above a cutoff are
false rejections. A cutoff is certified for a stratum if the exact binomial test rejects "its
false-rejection rate is above ``alpha``". Cutoffs of one rule are tested from the mildest to the
strictest; false rejections only grow on the way, so stopping at the first that is not certified
(fixed-sequence testing) is the same as testing each, and only the rules and strata have to be
corrected for (Bonferroni). With probability ``1 - delta`` every rule in every stratum keeps to
its share of ``alpha``, and so do all rules together to ``alpha``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, blank_words, let, packed, stored

STRATA = ("de", "en", "es", "fr")
# score: thousandths of a by b
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "repeated_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "marks": ("n_marks", "n_words"),
    "capitals": ("n_upper", "word_chars"),
}
CUTOFFS = (10, 20, 30, 50, 75, 100, 150, 200, 250, 300, 400, 500, 600, 700, 800, 900)
ALPHA, DELTA = 0.02, 0.05
# a cutoff must reject this many bad labelled documents for each good one
WORTH = 10


def measured(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the counts that the rules use; null text counts as empty.

    n_repeat_words: words in runs of three that occur twice or more, the first time included.
    Repeats are found by sorting a text's runs, so long texts cost n log n.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = df.withColumns({
        "_w": blank_words(F.col(text_col)),
        "_lines": F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != "")})
    runs = words.withColumn("_runs", F.when(F.size("_w") >= 3, F.transform(
        F.sequence(F.lit(1), F.size("_w") - 2),
        lambda j: F.concat_ws(" ", F.get("_w", j - 1), F.get("_w", j), F.get("_w", j + 1))))
        .otherwise(F.array().cast("array<string>")))

    def covered(ordered: Column) -> Column:
        same = lambda one, k: F.get(ordered, k)["run"] == one["run"]
        twice = F.filter(ordered, lambda one, k: same(one, k - 1) | same(one, k + 1))
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda one: F.array(
            one["at"], one["at"] + 1, one["at"] + 2)))))

    repeated = let(F.sort_array(F.transform(
        "_runs", lambda run, at: F.struct(run.alias("run"), at.alias("at")))), covered)
    count = lambda pattern: F.length(F.regexp_replace(text, pattern, ""))
    return runs.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.concat_ws("", "_w")).cast("long"),
        "n_symbols": count("[^#*$%&|<>]+").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.when(F.size(F.array_distinct("_runs")) == F.size("_runs"), 0)
        .otherwise(repeated).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_marks": count("[^!?]+").cast("long"),
        "n_upper": count("[^\\p{Lu}]+").cast("long"),
    }).withColumn("base_failed", F.expr(
        "n_words < 50 or 100 * n_repeat_words > 50 * n_words")).drop("_w", "_lines", "_runs")


def score(rule: str) -> Column:
    part, whole = RULES[rule]
    return F.expr(f"1000 * {part} div greatest({whole}, 1)")


def stratum(lang: str) -> Column:
    """The language if it is a declared stratum, else ``other``; the number of strata is fixed."""
    return F.when(F.col(lang).isin(*STRATA), F.col(lang)).otherwise(F.lit("other"))


def _ln_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x >= 1, by Stirling's series eight places up."""
    y = x + 8.0
    series = 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7)
    down = reduce(lambda a, k: a * (x + float(k)), range(1, 8), x)
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series - F.log(down)


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) for X ~ Bin(n, rate) with k < n * rate.

    Sums from term k downwards; terms fall faster than a normal curve, so those beyond ten
    deviations are below the last digit and are not formed.
    """
    k, n = k.cast("double"), n.cast("double")
    top = F.exp(_ln_gamma(n + 1) - _ln_gamma(k + 1) - _ln_gamma(n - k + 1)
                + k * F.log(F.lit(rate)) + (n - k) * F.log(F.lit(1 - rate)))
    steps = F.least(k, F.ceil(10 * F.sqrt(n * rate)) + 100).cast("int")
    falling = F.aggregate(
        F.when(steps >= 1, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>")),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda s, i: let(s["term"] * (k - i + 1) / (n - k + i) * ((1 - rate) / rate),
                         lambda t: F.struct(t.alias("term"), (s["sum"] + t).alias("sum"))),
        lambda s: s["sum"])
    return top * falling


def certified_cutoffs(counts: DataFrame, labels: DataFrame, alpha: float = ALPHA,
                      delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff): for each the certified cutoff that is worth most, if any.

    ``counts``: measured documents with doc_id and stratum; ``labels``: (doc_id, quality), where
    0 in any row of a document makes it bad and null says nothing. A cutoff is worth the bad
    labelled documents above it less ``WORTH`` times the good ones. At most one row per stratum
    and rule.
    """
    share = alpha / len(RULES)
    level = delta / (len(RULES) * (len(STRATA) + 1))
    marks = stored(labels.where("quality is not null").groupBy("doc_id").agg(
        F.min(F.col("quality")).alias("good")), "marks")
    above = lambda rule: F.size(F.filter(
        F.array(*map(F.lit, CUTOFFS)), lambda cut: score(rule) > cut))
    cells = (counts.where("not base_failed").join(marks, "doc_id")
             .select("stratum", "good", F.explode(F.array(*[
                 F.struct(F.lit(r).alias("rule"), above(r).alias("n_above")) for r in RULES]))
                 .alias("s"))
             .groupBy("stratum", "s.rule", "s.n_above")
             .agg(F.sum(F.when(F.col("good") == 1, 1).otherwise(0)).alias("good"),
                  F.sum(F.when(F.col("good") == 1, 0).otherwise(1)).alias("bad")))
    total = cells.groupBy("stratum", "rule").agg(F.sum("good").alias("n"))
    tests = (cells.where("n_above > 0")
             .withColumn("cut", F.explode(F.slice(F.array(*map(F.lit, CUTOFFS)), 1,
                                                  F.col("n_above"))))
             .groupBy("stratum", "rule", "cut")
             .agg(F.sum("good").alias("k"), F.sum("bad").alias("bad"))
             .join(total, ["stratum", "rule"]))
    passed = F.when(F.col("k") < F.col("n") * share,
                    binomial_tail(F.col("k"), F.col("n"), share) <= level).otherwise(F.lit(False))
    worth = F.col("bad") - WORTH * F.col("k")
    return (tests.where(passed).where(worth > 0).groupBy("stratum", "rule")
            .agg(F.max(F.struct(worth.alias("worth"), F.col("cut"))).alias("best"))
            .select("stratum", "rule", F.col("best.cut").alias("cutoff")))


def verdict(cutoffs: DataFrame) -> Column:
    """The first rule whose cutoff a measured document exceeds, null if none.

    Collects ``cutoffs``, at most one row per declared stratum and rule.
    """
    found = {(r["stratum"], r["rule"]): r["cutoff"] for r in cutoffs.collect()}
    hits = [F.when((F.col("stratum") == s) & (score(rule) > cut), F.lit(rule))
            for rule in RULES for (s, r), cut in sorted(found.items()) if r == rule]
    return F.coalesce(*hits, F.lit(None).cast("string"))


def judge(docs: DataFrame, labels: DataFrame, **risk: float) -> DataFrame:
    """Counts, base_failed, rejected_by and kept for each row of ``docs`` (doc_id, text, lang).

    kept: passes the base rule, and no certified cutoff of its stratum rejects it. Null text counts
    as empty and fails. Without enough labels nothing is certified and the base rule decides.
    """
    slim = docs.select("doc_id", stratum("lang").alias("stratum"), "text")
    counts = stored(measured(slim).drop("text"), "rule-counts")
    by = verdict(certified_cutoffs(counts, labels.select("doc_id", "quality"), **risk))
    return counts.withColumn("rejected_by", by).withColumn(
        "kept", ~F.col("base_failed") & F.col("rejected_by").isNull())


def kept(docs: DataFrame, labels: DataFrame, **risk: float) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns, shuffling no text.

    Rows are measured once and written with their counts, for the cutoffs need the counts of all
    labelled documents. Rows that repeat another one are judged alike; a null text counts as empty and
    fails; an empty table stays empty.
    """
    rows = measured(packed(docs, doc_id=F.col("doc_id"), stratum=stratum("lang"), text=F.col("text")))
    counts = stored(rows.drop("text"), "rule-counts")
    by = verdict(certified_cutoffs(counts.drop("_row"), labels.select("doc_id", "quality"), **risk))
    return counts.where(~F.col("base_failed") & by.isNull()).select("_row.*")
