"""Term extraction and χ² term selection.

Tokens are the large intermediate result. They are reduced to one row per
(category, term) straight after tokenising, with map-side combine; every later step
works on that much smaller table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scores import chi2_log_p, chi2_score
from ..functions.text import distinct_terms, tokens
from ..session import materialise
from .ordering import top_k_per_group
from .skew import anti_join, lookup_join


def tokenize_terms(df: DataFrame, text_col: str, stopwords: list[str] | DataFrame,
                   stop_before_fold: bool = False, split_pipe_slash: bool = False,
                   term_col: str = "term") -> DataFrame:
    """One row per distinct term of each document; the other columns are kept.

    A word list is applied inside the row. A list too long for the plan can be given
    as a one-column DataFrame and is removed by an anti join after folding.
    """
    words = stopwords if isinstance(stopwords, list) else []
    terms = distinct_terms(F.col(text_col), words, stop_before_fold, split_pipe_slash)
    kept = [c for c in df.columns if c != text_col]
    out = df.select(*kept, F.explode(terms).alias(term_col))
    if isinstance(stopwords, DataFrame):
        if stop_before_fold:
            raise ValueError("removal before folding needs the words as a list")
        out = anti_join(out, stopwords.toDF(term_col), [term_col])
    return out


def term_counts(df: DataFrame, text_col: str, stopwords: list[str],
                term_col: str = "term", count_col: str = "tf") -> DataFrame:
    """One row per document and distinct term with the number of occurrences.

    A document is one row, so counting needs no shuffle: its tokens are sorted inside
    the row and run lengths read off. Stop words go last, when each is a single row.
    """
    kept = [c for c in df.columns if c != text_col]
    s, begin = F.col("_sorted"), F.col("_begin")
    with_tokens = df.select(*kept, F.sort_array(tokens(F.col(text_col))).alias("_sorted"))
    # positions where a run begins; a document without tokens yields one null term here
    starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                      lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
    runs = F.transform(begin, lambda at, k: F.struct(
        F.get(s, at).alias(term_col),
        (F.coalesce(F.get(begin, k + 1), F.size(s)) - at).cast("long").alias(count_col)))
    out = (with_tokens.withColumn("_begin", starts).select(*kept, F.inline(runs))
           .where(F.col(term_col).isNotNull()))
    return out.where(~F.col(term_col).isin(stopwords)) if stopwords else out


def category_freq(df: DataFrame, category_col: str = "category") -> DataFrame:
    """Documents per category, those without any term included."""
    return df.groupBy(category_col).agg(F.count("*").alias("n_docs"))


def doc_freq(terms: DataFrame) -> DataFrame:
    """Documents per term."""
    return terms.groupBy("term").agg(F.count("*").alias("n_docs"))


def category_term_freq(terms: DataFrame, category_col: str = "category") -> DataFrame:
    """Documents per (category, term)."""
    return terms.groupBy(category_col, "term").agg(F.count("*").alias("n_docs"))


def chi2_contingency(terms: DataFrame, docs: DataFrame,
                     category_col: str = "category") -> DataFrame:
    """2×2 table per (category, term): a both, b term only, c category only, d neither.

    Document frequencies are summed from the category counts by a window over the term,
    which holds at most one row per category. The category counts are joined as a
    checked broadcast and the document total is a scalar subquery.
    """
    n = docs.agg(F.count("*")).scalar()
    per_term = F.sum("a").over(W.partitionBy("term"))
    counted = (terms.groupBy(category_col, "term").agg(F.count("*").alias("a"))
               .withColumn("_e", per_term))
    sizes = docs.groupBy(category_col).agg(F.count("*").alias("_g"))
    joined = lookup_join(counted, sizes, [category_col])
    return joined.select(
        category_col, "term", "a",
        (F.col("_e") - F.col("a")).alias("b"),
        (F.col("_g") - F.col("a")).alias("c"),
        (n - F.col("_e") - F.col("_g") + F.col("a")).alias("d"))


def chi2_scores(terms: DataFrame, docs: DataFrame, category_col: str = "category",
                scaled: bool = False, with_cells: bool = False) -> DataFrame:
    """χ² per (category, term); ``scaled`` multiplies by the number of documents.

    ``with_cells`` keeps the 2×2 table beside the score.
    """
    table = chi2_contingency(terms, docs, category_col)
    cells = [F.col(x) for x in "abcd"]
    total = sum(cells[1:], cells[0])
    return table.select(category_col, "term", *(cells if with_cells else []),
                        chi2_score(*cells, n=total if scaled else None).alias("chi2"))


def chi2_top_terms(scores: DataFrame, k: int = 200, category_col: str = "category") -> DataFrame:
    """Best ``k`` terms per category; undefined scores never qualify."""
    return top_k_per_group(scores.where(F.col("chi2").isNotNull()), [category_col],
                           [F.desc("chi2"), F.asc("term")], k)


def chi2_report_lines(top: DataFrame, category_col: str = "category") -> DataFrame:
    """One text line per category, ``category<TAB>term:score term:score …``.

    Only top-k rows are collected, so a line holds k terms at most.
    """
    entry = F.struct("rank", F.concat_ws(":", "term", F.format_number("chi2", 6)).alias("text"))
    entries = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["text"])
    return (top.groupBy(category_col).agg(F.array_join(entries, " ").alias("_terms"))
            .select(F.concat_ws("\t", category_col, "_terms").alias("line")))


# χ² sums are added as integers of this many binary places: exact in any order, so ties stay ties
PLACES = 52


def _fixed(share: Column) -> Column:
    """A share of at most 1 in binary places, rounded down."""
    return F.floor(share * float(1 << PLACES)).cast("long")


def chi2_overall(counts: DataFrame, docs: DataFrame, label_col: str = "category",
                 n_docs: Column | None = None) -> DataFrame:
    """χ² of each term's count, as a categorical feature with level 0, against the label.

    From sparse counts (one row per document and term with its ``tf``) only; if a row stands for several
    documents, ``n_docs`` adds them up. With
    O documents of level v and label c: N · Σ O² / (n_v · g_c) − N. In the zero level a
    label of g documents, s of them with the term, has g − s; labels without the term are
    wholly in it and add up to one share.
    """
    n = docs.agg(F.count("*")).scalar()
    labels = docs.agg(F.count_distinct(label_col)).scalar()
    sizes = docs.groupBy(label_col).agg(F.count("*").alias("g"))
    cells = lookup_join(counts.groupBy("term", "tf", label_col).agg(
        (F.count("*") if n_docs is None else n_docs).alias("o")), sizes, [label_col])
    # (term, level) then (term, label): windows of at most one row per label and level
    o, g, n_v = (F.col(c).cast("double") for c in ("o", "g", "n_v"))
    level = W.partitionBy("term", "tf")
    by_level = (cells.withColumn("n_v", F.sum("o").over(level))
                .withColumn("share", _fixed(o * o / (n_v * g)))
                .groupBy("term").agg(F.sum("share").alias("seen"), F.count_distinct("tf").alias("levels")))
    s, zero = F.col("s").cast("double"), F.col("n_zero").cast("double")
    by_label = (cells.groupBy("term", label_col, "g").agg(F.sum("o").alias("s"))
                .withColumn("df", F.sum("s").over(W.partitionBy("term")))
                .withColumn("n_zero", n - F.col("df"))
                .withColumn("share", F.when(zero > 0, _fixed((g - s) * (g - s) / (zero * g))).otherwise(0))
                .groupBy("term", "df", "n_zero").agg(F.sum("share").alias("unseen"), F.sum("g").alias("met")))
    rest = (n - F.col("met")).cast("double")
    places = (F.col("seen") + F.col("unseen")
              + F.when(zero > 0, _fixed(rest / zero)).otherwise(0) - (1 << PLACES))
    levels = F.col("levels") + F.when(zero > 0, 1).otherwise(0)
    return by_level.join(by_label, "term").select(
        "term", "df", (n.cast("double") * places.cast("double") / float(1 << PLACES)).alias("chi2"),
        ((levels - 1) * (labels - 1)).cast("long").alias("dof"))


def contenders_by_p(scores: DataFrame, k: int) -> DataFrame:
    """The rows of ``scores`` that can be among the best ``k`` by p-value.

    At the same degrees of freedom a larger χ² has the smaller p-value, so ``k`` clearly larger ones rule a row out. χ² is
    compared in steps of a sixteenth of a power of two, one step apart, and counted above its mean only, where p-values
    differ by more than their rounding.
    """
    step = F.floor(F.log2("chi2") * 16)
    steps = scores.where(F.col("chi2") > F.col("dof")).groupBy("dof", step.alias("step")).agg(F.count("*").alias("n"))
    floors = (steps.withColumn("n", F.sum("n").over(W.partitionBy("dof").orderBy(F.desc("step"))))
              .where(F.col("n") >= k).groupBy("dof").agg((F.max("step") - 1).alias("floor")))
    return (lookup_join(scores, floors, ["dof"], "left")
            .where(F.col("floor").isNull() | (step >= F.col("floor"))).drop("floor"))


def chi2_top_terms_overall(scores: DataFrame, k: int, by: str = "chi2") -> DataFrame:
    """Best ``k`` terms over all labels by ``chi2`` or by p-value (``p``), then by term.

    Terms have different degrees of freedom, so the two orders differ. p-values are compared by
    their logarithm, column ``log_p``, because they underflow; a p-value is a long sum, so only terms that can
    be among the best get one.
    """
    ordered = scores.where(F.col("dof") > 0)
    if by == "chi2":
        return ordered.orderBy(F.desc("chi2"), F.asc("term")).limit(k)
    if by != "p":
        raise ValueError(by)
    ordered = contenders_by_p(materialise(ordered, "chi2-scores"), k).select(*ordered.columns)
    return (ordered.withColumn("log_p", chi2_log_p(F.col("chi2"), F.col("dof")))
            .orderBy(F.asc("log_p"), F.asc("term")).limit(k))
