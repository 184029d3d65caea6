"""Word expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_permutations(df: DataFrame, word_col: str) -> DataFrame:
    """One row per distinct permutation of each word.

    Each round moves one distinct letter from the rest to the prefix, without a shuffle.
    There are as many rounds as the longest word has letters. Output is factorial in the
    word length by definition.
    """
    longest = df.agg(F.max(F.length(word_col))).first()[0] or 0
    state = df.select(word_col, F.lit("").alias("permutation"), F.col(word_col).alias("_rest"))
    for _ in range(longest):
        letters = F.array_distinct(F.split("_rest", ""))
        step = state.select(word_col, "permutation", "_rest", F.explode_outer(
            F.when(F.length("_rest") > 0, letters)).alias("_x"))
        at = F.instr("_rest", F.col("_x"))
        rest = F.concat(F.substring("_rest", F.lit(1), at - 1),
                        F.substring("_rest", at + 1, F.length("_rest")))
        state = step.select(word_col,
                            F.concat("permutation", F.coalesce("_x", F.lit(""))).alias("permutation"),
                            F.when(F.col("_x").isNull(), F.lit("")).otherwise(rest).alias("_rest"))
    return state.select(word_col, "permutation").where(F.col(word_col).isNotNull())
