"""Profiles of columns and keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profiling
from .registry import query

_POST_COLUMNS = ["posttypeid", "owneruserid", "creationdate", "tags"]

_POST_NDV = " union all ".join(
    f"select '{c}' as column_name, count(*) as n_rows, count(*) - count({c}) as n_null, "
    f"count(distinct {c}) as ndv from posts" for c in _POST_COLUMNS)


@query(_POST_NDV)
def ndv_profile(t):
    return profiling.ndv_profile(t.posts, _POST_COLUMNS)


@query(f"""select column_name, ndv, round(1.0::double / ndv, 9) as sel_equal,
    round(1 - 1.0::double / ndv, 9) as sel_not_equal from ({_POST_NDV})""")
def predicate_selectivity(t):
    sel = profiling.predicate_selectivity(profiling.ndv_profile(t.posts, _POST_COLUMNS))
    return sel.select("column_name", "ndv", F.round("sel_equal", 9).alias("sel_equal"),
                      F.round("sel_not_equal", 9).alias("sel_not_equal"))


_BOUNDS = """bounds as (
    select i as bound, (select l_extendedprice from ranked where rn = greatest(ceil(i * n / 10.0), 1)) as value
    from range(0, 11) g(i), (select count(*) as n from lineitem)),
    """
_RANKED = "ranked as (select l_extendedprice, row_number() over (order by l_extendedprice) as rn from lineitem)"


@query(f"with {_RANKED}, {_BOUNDS.rstrip().rstrip(',')} select bound, value from bounds")
def equi_depth_histogram(t):
    histogram = profiling.equi_depth_histogram(t.lineitem, "l_extendedprice", 10)
    return histogram.select(F.col("bound").cast("long").alias("bound"), "value")


@query(f"""with {_RANKED}, {_BOUNDS}
    cells as (select a.value as lo, b.value as hi from bounds a join bounds b on b.bound = a.bound + 1)
    select round(avg(greatest(least(hi, 50000) - greatest(lo, 20000), 0) / (hi - lo)), 6) as estimated,
        (select round(count(*) filter (l_extendedprice > 20000 and l_extendedprice < 50000) / count(*), 6)
         from lineitem) as actual
    from cells""")
def range_selectivity(t):
    """Share of prices in a range, from a ten-bucket histogram and by counting."""
    histogram = profiling.equi_depth_histogram(t.lineitem, "l_extendedprice", 10)
    price = F.col("l_extendedprice")
    actual = t.lineitem.agg((F.count_if((price > 20000) & (price < 50000)) / F.count("*"))
                            .alias("actual")).scalar()
    return profiling.range_selectivity(histogram, 20000, 50000).select(
        F.round("selectivity", 6).alias("estimated"), F.round(actual, 6).alias("actual"))


@query("""with g as (select o_custkey, count(*) as size from orders group by o_custkey)
    select count(*) as n_keys, sum(size)::bigint as n_rows, max(size) as max_group,
        min(size) as min_group, round(avg(size), 6) as avg_group,
        round(max(size) / sum(size), 9) as max_share from g""")
def key_skew_profile(t):
    return profiling.key_skew_profile(t.orders, ["o_custkey"]).select(
        "n_keys", "n_rows", "max_group", "min_group", F.round("avg_group", 6).alias("avg_group"),
        F.round("max_share", 9).alias("max_share"))
