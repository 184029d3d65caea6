"""Documents with embedded lists and parents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import salted_join, semi_join

def embed_children(parent: DataFrame, child: DataFrame, key: str, child_key: str, as_col: str,
                   page: Column | None = None) -> DataFrame:
    """Parents with their children as a sorted list of structs.

    Children of one parent and one ``page``, a number made from a child's own columns, are one document,
    at every size; the number is its ``chunk``. A page that at most n children of a parent can share bounds
    the lists by n. Without a page every parent is one document, whatever its size. Parents without
    children get one document with an empty list and chunk 0.
    """
    columns = [c for c in child.columns if c != child_key]
    placed = child.withColumn("chunk", F.lit(0) if page is None else page)
    lists = (placed.groupBy(F.col(child_key).alias(key), "chunk")
             .agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(as_col)))
    empty = F.array().cast(lists.schema[as_col].dataType)
    return (parent.join(lists, key, "left")
            .withColumn("chunk", F.coalesce("chunk", F.lit(0)))
            .withColumn(as_col, F.coalesce(as_col, empty)))


def sum_children(parent: DataFrame, child: DataFrame, key: str, child_key: str, field: str,
                 out_col: str) -> DataFrame:
    """Sum of a field over the children of each parent key, 0 without any; no list is built."""
    per_key = child.groupBy(F.col(child_key).alias(key)).agg(F.sum(field).alias("_sum"))
    return parent.select(key).join(per_key, key, "left").select(
        key, F.coalesce("_sum", F.lit(0)).cast("long").alias(out_col))


def children_of(parent: DataFrame, child: DataFrame, key: str, child_key: str, **skew) -> DataFrame:
    """The rows that unnesting the documents of ``embed_children`` gives, straight from the children."""
    return semi_join(child.withColumnRenamed(child_key, key), parent.select(key), [key], **skew)


def sum_nested(documents: DataFrame, key: str, list_col: str, field: str,
               out_col: str) -> DataFrame:
    """Sum of a field over lists that are embedded already, folded in the row, then over the chunks."""
    folded = F.aggregate(list_col, F.lit(0).cast("long"),
                         lambda total, e: total + F.coalesce(e[field].cast("long"), F.lit(0)))
    return documents.groupBy(key).agg(F.sum(folded).alias(out_col))


def unnest_children(documents: DataFrame, key: str, list_col: str) -> DataFrame:
    """One row per embedded child."""
    return documents.select(key, F.explode(list_col).alias("_e")).select(key, "_e.*")


def embed_parent(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
                 prefix: str, **skew) -> DataFrame:
    """Children with the columns of their single parent, prefixed; orphans are kept."""
    columns = [F.col(c).alias(prefix + c) for c in parent.columns if c != parent_key]
    side = parent.select(F.col(parent_key).alias(child_key), *columns)
    return salted_join(child, side, [child_key], "left", **skew)


def copies_available(parent: DataFrame, child: DataFrame, borrowed: DataFrame, key: str,
                     child_key: str, field: str, borrowed_key: str) -> DataFrame:
    """Owned copies (summed over the children) minus borrowed ones, per parent key.

    The children are summed before they meet their parent; no list is built.
    """
    owned = sum_children(parent, child, key, child_key, field, "owned")
    out = borrowed.groupBy(F.col(borrowed_key).alias(key)).agg(F.count("*").alias("borrowed"))
    lent: Column = F.coalesce("borrowed", F.lit(0))
    return owned.join(out, key, "left").select(key, "owned", lent.alias("borrowed"),
                                               (F.col("owned") - lent).alias("available"))
