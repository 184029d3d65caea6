"""Queries over the shop event log."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, ordering, profiling, relational
from .registry import query

_PURCHASES = "event_type = 'purchase' and brand <> '' and product_id is not null"

_COUNTED = f"""p as (select user_id, brand, event_time >= timestamp '2024-01-16 00:00:00' as is_nov
                     from shop where {_PURCHASES}),
    c as (select user_id, brand, count(*) as n from p group by all),
    ranked as (select *, rank() over (partition by user_id order by n desc) as rk from c)"""
_STRICT = f"""{_COUNTED}, strict as (
    select user_id, min(brand) as brand from ranked where rk = 1 group by user_id having count(*) = 1)"""
_BOTH = """both_periods as (
    select user_id from p group by user_id having count(distinct is_nov) = 2)"""


def _purchases(t):
    return t.shop.where(_PURCHASES).withColumn(
        "period", F.when(F.col("event_time") < F.lit("2024-01-16").cast("timestamp_ntz"), "oct")
        .otherwise("nov"))


@query("select count(*) as n from oct where brand = 'brand3'")
def count_by_brand_filter(t):
    return t.oct.where(F.col("brand") == "brand3").agg(F.count("*").alias("n"))


@query("select brand, count(*) as n from nov group by brand")
def group_count(t):
    return t.nov.groupBy("brand").agg(F.count("*").alias("n"))


@query(f"select event_id, user_id, brand from shop where {_PURCHASES}")
def valid_purchases(t):
    return t.shop.where(_PURCHASES).select("event_id", "user_id", "brand")


@query("""select event_id, event_type, 'oct' as period from oct
    union all select event_id, event_type, 'nov' from nov""")
def union_periods(t):
    def part(df, name):
        return df.select("event_id", "event_type", F.lit(name).alias("period"))
    return part(t.oct, "oct").unionByName(part(t.nov, "nov"))


@query("""select o.category_id, round(avg(n.price), 6) as avg_price from oct o join nov n
    on o.user_id = n.user_id where o.event_type = 'view' group by o.category_id""")
def join_avg_price(t):
    views = t.oct.where("event_type = 'view'")
    return (relational.avg_over_join(views, t.nov, ["user_id"], "category_id", "price", "avg_price")
            .orderBy(F.desc("avg_price"))
            .select("category_id", F.round("avg_price", 6).alias("avg_price")))


# a brand that is both the first and the last of its buyer's by name is the only one
_SINGLE = """select mine.buyer_id, mine.brand, count(*) as n_bought from {oct} as mine
    where mine.event_type = 'purchase' group by mine.buyer_id, mine.brand
    having mine.brand = (select min(brand) from {oct} as low
                         where low.event_type = 'purchase' and low.buyer_id = mine.buyer_id)
       and mine.brand = (select max(brand) from {oct} as high
                         where high.event_type = 'purchase' and high.buyer_id = mine.buyer_id)"""


@query("""select buyer_id, min(brand) as brand from oct where event_type = 'purchase' and buyer_id is not null
    group by buyer_id having count(distinct brand) = 1""")
def single_brand_buyers(t):
    return relational.single_value_keys(t.oct, "buyer_id", "brand",
                                        F.col("event_type") == "purchase")


@query("""with c as (select buyer_id, brand, count(*) as n from oct
        where event_type = 'purchase' and brand is not null group by all),
    a as (select buyer_id, sum(n) as total from c group by buyer_id)
    select buyer_id, brand, n as n_bought from c join a using (buyer_id) where n >= total""")
def single_brand_buyers_sql(t):
    return t.spark.sql(_SINGLE, oct=t.oct)


@query(f"""with {_COUNTED} select user_id, min(brand) as brand from ranked where rk = 1
    group by user_id""")
def favourite_brand(t):
    return aggregates.favourite(_purchases(t), "user_id", "brand")


@query(f"with {_STRICT} select user_id, brand from strict")
def strict_favourite_brand(t):
    return aggregates.strict_favourite(_purchases(t), "user_id", "brand")


@query(f"with {_COUNTED}, {_BOTH} select user_id from both_periods")
def both_periods_users(t):
    return aggregates.present_in_all(_purchases(t), "user_id", "period", ["oct", "nov"])


@query(f"""with {_STRICT}, {_BOTH} select brand, count(*) as n_fans
    from strict join both_periods using (user_id) group by brand""")
def brand_fan_counts(t):
    strict = aggregates.strict_favourite_in_all(_purchases(t), "user_id", "brand", "period",
                                                ["oct", "nov"])
    return aggregates.fan_counts(strict, "brand")


@query(f"""select (select count(*) from shop) as n_in, count(*) as n_out,
        round(count(*) / (select count(*) from shop), 9) as rate from shop where {_PURCHASES}""")
def replication_rate(t):
    return profiling.replication_rate(t.shop, _purchases(t)).select(
        "n_in", "n_out", F.round("rate", 9).alias("rate"))


@query("select o_orderkey, o_custkey from orders where o_custkey % 3 = 0 and o_custkey > 0")
def multiples_of_three(t):
    return t.orders.where((F.col("o_custkey") % 3 == 0) & (F.col("o_custkey") > 0)).select(
        "o_orderkey", "o_custkey")


@query("select round(median(l_extendedprice), 4) as median from lineitem")
def median_value(t):
    return ordering.median_value(t.lineitem, "l_extendedprice").select(
        F.round("median", 4).alias("median"))


@query("select round(stddev_pop(l_extendedprice), 4) as stddev_pop from lineitem")
def stddev_pop_value(t):
    return aggregates.stddev_pop_value(t.lineitem, "l_extendedprice").select(
        F.round("stddev_pop", 4).alias("stddev_pop"))


@query("""select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events""")
def json_fields(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))
