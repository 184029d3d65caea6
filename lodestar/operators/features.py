"""Term-weight features in sparse form, one row per document and term.

Vocabulary size is not limited by what fits in a vector or in the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scores import inverse_doc_freq
from ..session import materialise, shuffle_width
from .skew import MIN_ROWS, hot_share, salted_join, salts_for

# terms whose frequencies are broadcast, some 10 MB
COMMON_TERMS = 200_000


def hash_split(df: DataFrame, id_col: str, train_percent: int = 80, seed: int = 42) -> DataFrame:
    """Adds ``is_train``, decided by a hash of the id: the same rows on every run."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100
    return df.withColumn("is_train", bucket < train_percent)


def vocabulary_topk(counts: DataFrame, k: int) -> DataFrame:
    """``k`` terms with most occurrences over the corpus, ties by term."""
    return (counts.groupBy("term").agg(F.sum("tf").alias("n_occurrences"),
                                       F.count("*").alias("n_docs"))
            .orderBy(F.desc("n_occurrences"), F.asc("term")).limit(k))


def common_floor(freq: DataFrame, most: int) -> int:
    """Smallest power of two that at most ``most`` terms reach with their ``n_docs``."""
    by_bits = freq.groupBy(F.length(F.bin("n_docs")).alias("bits")).agg(F.count("*").alias("n"))
    floor = (1 << 63) - 1
    for bits, n in sorted(by_bits.collect(), reverse=True):  # at most 63 rows
        most -= n
        if most < 0:
            break
        floor = 1 << (bits - 1)
    return floor


def tfidf_weights(counts: DataFrame, docs: DataFrame, share: float | None = None,
                  min_rows: int = MIN_ROWS, common: int = COMMON_TERMS) -> DataFrame:
    """``tf · ln((N + 1) / (df + 1))`` per document and term.

    Counts and document frequencies are written once, so texts are split once. The ``common`` terms
    with most documents hold nearly all rows; they are broadcast and their rows stay where they are.
    Only rows of the other terms are shuffled to their frequencies, salted where a term is hot. With
    a ``share`` all rows are joined that way.
    """
    n = docs.agg(F.count("*")).scalar()
    counts = materialise(counts, "term-counts")
    freq = materialise(counts.groupBy("term").agg(F.count("*").alias("n_docs")), "doc-freq")
    least = common_floor(freq, 0 if share else common)
    known, rare = freq.where(F.col("n_docs") >= least), freq.where(F.col("n_docs") < least)
    weighted = counts.join(F.broadcast(known), "term")
    rows = rare.agg(F.sum("n_docs")).first()[0] or 0
    if rows:
        width = shuffle_width(docs.sparkSession)
        floor = max(rows * (share or hot_share(width)), min_rows)
        # fewer than 1 / share terms can pass this filter
        hot = {r["h"]: salts_for(r["n_docs"], rows, width) for r in
               rare.where(F.col("n_docs") > floor).orderBy(F.desc("n_docs"))
               .select(F.xxhash64("term").alias("h"), "n_docs").collect()}
        others = counts.join(F.broadcast(known.select("term")), "term", "left_anti")
        weighted = weighted.unionByName(salted_join(others, rare, ["term"], hot=hot))
    return weighted.withColumn("weight", F.col("tf") * inverse_doc_freq(n, F.col("n_docs")))


def l2_normalised(weights: DataFrame, id_col: str) -> DataFrame:
    """Weights divided by the document's Euclidean norm; a zero norm leaves them as they are.

    A window group is one document, so no larger than the text it came from.
    """
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(W.partitionBy(id_col)))
    unit = F.when(F.col("_norm") > 0, F.col("weight") / F.col("_norm")).otherwise(F.col("weight"))
    return weights.withColumn("_norm", norm).withColumn("weight", unit).drop("_norm")


def weighted_f1(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """F1 per label weighted by label frequency, one row, from the confusion counts."""
    cells = df.groupBy(label_col, pred_col).agg(F.count("*").alias("n"))
    hit = F.when(F.col(label_col) == F.col(pred_col), F.col("n")).otherwise(0)
    actual = cells.groupBy(F.col(label_col).alias("label")).agg(
        F.sum("n").alias("n_label"), F.sum(hit).alias("tp"))
    predicted = cells.groupBy(F.col(pred_col).alias("label")).agg(F.sum("n").alias("n_pred"))
    # F1 = 2·tp / (label rows + predicted rows)
    f1 = 2 * F.col("tp") / (F.col("n_label") + F.coalesce(F.col("n_pred"), F.lit(0)))
    return (actual.join(predicted, "label", "left")
            .agg((F.sum(f1 * F.col("n_label")) / F.sum("n_label")).alias("f1")))
