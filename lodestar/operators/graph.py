"""Property-graph patterns over ``nodes(id, label, …)`` and ``edges(src, dst, type)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import semi_join


def label_scan(nodes: DataFrame, label: str, **props) -> DataFrame:
    """Nodes of a label whose properties equal the given values."""
    out = nodes.where(F.col("label") == label)
    for name, value in props.items():
        out = out.where(F.col(name) == value)
    return out


def typed(edges: DataFrame, *types: str) -> DataFrame:
    return edges.where(F.col("type").isin(*types))


def one_hop(nodes: DataFrame, edges: DataFrame, src_label: str, type_: str, dst_label: str,
            **dst_props) -> DataFrame:
    """Distinct ``src_label`` nodes with an edge to a matching ``dst_label`` node.

    Both steps are semi joins, so parallel edges do not multiply rows.
    """
    targets = label_scan(nodes, dst_label, **dst_props).select(F.col("id").alias("dst"))
    sources = semi_join(typed(edges, type_), targets, ["dst"]).select(F.col("src").alias("id"))
    return semi_join(label_scan(nodes, src_label), sources, ["id"])


def neighbours(nodes: DataFrame, edges: DataFrame, type_: str, **dst_props) -> DataFrame:
    """Distinct source nodes of ``type_`` edges into nodes with the given properties."""
    targets = nodes
    for name, value in dst_props.items():
        targets = targets.where(F.col(name) == value)
    into = semi_join(typed(edges, type_), targets.select(F.col("id").alias("dst")), ["dst"])
    return semi_join(nodes, into.select(F.col("src").alias("id")), ["id"])


def degree(edges: DataFrame, type_: str, direction: str = "out", out_col: str = "degree") -> DataFrame:
    """Edges of a type per node."""
    end = "src" if direction == "out" else "dst"
    return (typed(edges, type_).groupBy(F.col(end).alias("id"))
            .agg(F.count("*").alias(out_col)))


def degree_product(nodes: DataFrame, edges: DataFrame, label: str, type1: str, type2: str,
                   by: str) -> DataFrame:
    """Size of the product of two independent out-edge patterns, grouped by a node property.

    A node with m and o edges contributes m · o bindings; they are multiplied as counts
    and never listed. Both counts of the pattern equal this number.
    """
    wanted = F.col("type") == F.lit(type1)
    other = F.col("type") == F.lit(type2)
    degrees = (edges.where(wanted | other).groupBy(F.col("src").alias("id"))
               .agg(F.count_if(wanted).alias("_m"), F.count_if(other).alias("_o"))
               .where((F.col("_m") > 0) & (F.col("_o") > 0)))
    group = label_scan(nodes, label).select("id", *([] if by == "id" else [by]))
    return (group.join(degrees, "id").groupBy(by)
            .agg(F.sum(F.col("_m") * F.col("_o")).alias("n_bindings")))


def expand(edges: DataFrame, ids: DataFrame, exclude_types: list[str]) -> DataFrame:
    """Out-edges of the given nodes except those of the excluded types."""
    kept = edges.where(~F.col("type").isin(*exclude_types))
    return semi_join(kept, ids.select(F.col("id").alias("src")), ["src"])


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once; empty when the uniqueness rule holds."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def assert_unique(df: DataFrame, key: list[str]) -> DataFrame:
    """``df`` itself, after checking that no key repeats."""
    found = duplicate_keys(df, key).first()
    if found is not None:
        raise ValueError(f"key {tuple(found[k] for k in key)} occurs {found['n']} times")
    return df


def enforced_unique(df: DataFrame, key: list[str]) -> DataFrame:
    """``df`` with the rule that no key repeats built into its plan.

    A write of the result checks and writes in one job: a repeated key fails a task, so the write is
    never committed. Rows are combined by key before the shuffle, a repeated key to one row and its count.
    """
    others = [c for c in df.columns if c not in key]
    rows = F.any_value(F.struct(*others)) if others else F.lit(None)
    named = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in key])
    message = F.concat(F.lit("key ("), named, F.lit(") occurs "), F.col("_n").cast("string"), F.lit(" times"))
    held = F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.col("_n")).cast("long")
    grouped = df.groupBy(*key).agg(rows.alias("_row"), F.count("*").alias("_n")).withColumn("_n", held)
    # the count is part of a filter, so column pruning cannot drop the check
    return grouped.where(F.col("_n") == 1).select(
        *[F.col(c) if c in key else F.col("_row")[c].alias(c) for c in df.columns])


def merge_keys(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Existing keys plus the distinct incoming ones that are missing.

    One aggregation over the union: a key of any frequency is combined before the
    shuffle and comes out once.
    """
    return existing.select(*key).unionByName(incoming.select(*key)).distinct()


def single_valued(col: str, separator: str = ";") -> Column:
    """Set and without the separator of a multi-valued property."""
    return F.col(col).isNotNull() & ~F.contains(F.col(col), F.lit(separator))

