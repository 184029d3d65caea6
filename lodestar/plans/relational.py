"""Filters, scalar functions, joins and bag operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import ordering, relational, skew, words
from .registry import query


@query("select id, userid from badges where name like 'signup'")
def like_exact(t):
    return t.badges.where(F.col("name").like("signup")).select("id", "userid")


@query("""select name, count(*) filter (name ilike 'S%') as n_ilike,
        count(*) filter (lower(name) like 's%') as n_lower from badges group by name""")
def ilike_prefix(t):
    return t.badges.groupBy("name").agg(
        F.count_if(F.col("name").ilike("S%")).alias("n_ilike"),
        F.count_if(F.lower("name").like("s%")).alias("n_lower"))


@query("select count(*) as n from reviews where regexp_matches(review_text, '[mn][eo]{2,}')")
def regex_count(t):
    return t.reviews.where(F.col("review_text").rlike("[mn][eo]{2,}")).agg(F.count("*").alias("n"))


@query("""select review_id, regexp_extract(review_text, '[mn][eo]{2,}') as part from reviews
    where regexp_matches(review_text, '[mn][eo]{2,}')""")
def regex_extract(t):
    part = F.regexp_extract("review_text", "[mn][eo]{2,}", 0)
    return t.reviews.select("review_id", part.alias("part")).where("part <> ''")


_MIXED = """case when event_id % 7 = 0 then 'n/a' when event_id % 7 = 1 then concat(product_id, 'x')
    else cast(product_id as string) end"""


@query(f"""select event_id, cast({_MIXED} as bigint) as value from shop
    where regexp_matches({_MIXED}, '^[0-9]+$')""")
def numeric_guard(t):
    raw = t.shop.select("event_id", F.expr(_MIXED).alias("raw"))
    return raw.where(F.col("raw").rlike("^[0-9]+$")).select(
        "event_id", F.try_to_number("raw", F.lit("999999999999999999")).cast("long").alias("value"))


@query("select id, name from badges where lower(name) = 'signup' or lower(name) = lower('Error')")
def badge_or_filter(t):
    wanted = [n.lower() for n in ("signup", "Error")]
    return t.badges.where(F.lower("name").isin(wanted)).select("id", "name")


@query("""select p_partkey from part
    where p_size < 30 and (p_type = 'ECONOMY' or p_size > 6) and p_name = 'red widget'""")
def compound_filter(t):
    size = F.col("p_size")
    return t.part.where((size < 30) & ((F.col("p_type") == "ECONOMY") | (size > 6))
                        & (F.col("p_name") == "red widget")).select("p_partkey")


@query("""select o_orderkey, starts_with(o_orderpriority, '1') as urgent,
        split_part(o_orderpriority, '-', 1) as code, split_part(o_orderpriority, ' ', 1) as first_word,
        regexp_extract(o_orderpriority, '[A-Z]+') as word from orders""")
def string_funcs(t):
    p = F.col("o_orderpriority")
    return t.orders.select("o_orderkey", p.startswith("1").alias("urgent"),
                           F.split(p, "-")[0].alias("code"), F.split(p, r"\s+")[0].alias("first_word"),
                           F.regexp_extract(p, "[A-Z]+", 0).alias("word"))


@query("""select o_orderkey, month(o_orderdate) as month, day(o_orderdate) as day from orders
    where o_orderkey % 13 <> 0""")
def month_of(t):
    """Date cells as text, some of them empty or broken; those rows are dropped."""
    cell = (F.when(F.col("o_orderkey") % 26 == 0, "").when(F.col("o_orderkey") % 13 == 0, "soon")
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")))
    day = F.try_to_date(F.split(cell, r"\s+")[0], "yyyy-MM-dd")
    return (t.orders.select("o_orderkey", day.alias("d")).where("d is not null")
            .select("o_orderkey", F.month("d").cast("long").alias("month"),
                    F.day("d").cast("long").alias("day")))


@query("""select l_orderkey, l_linenumber, (l_partkey % 7)::bigint as remainder,
        pow(l_quantity, 2) as square, sqrt(l_extendedprice) as root,
        ceil(l_extendedprice)::bigint as up, l_extendedprice / nullif(l_quantity, 0) as unit_price
    from lineitem""")
def math_funcs(t):
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") % 7).alias("remainder"),
        F.pow(quantity, F.lit(2)).alias("square"), F.sqrt(price).alias("root"),
        F.ceil(price).cast("long").alias("up"), F.try_divide(price, quantity).alias("unit_price"))


@query("select review_id, category from reviews order by review_id limit 100")
def limit_rows(t):
    return ordering.ordered_limit(t.reviews.select("review_id", "category"), [F.asc("review_id")], 100)


@query("""select a, b, c, d, count(*) as n from r natural join s natural join t natural join u
    group by all""")
def natural_join(t):
    """The four-table natural join as distinct rows with their multiplicity."""
    joined = relational.natural_join_counted([t.u, t.t, t.s, t.r])
    return joined.select("a", "b", "c", "d", "n")


def _distinct_ut(t):
    """Set semantics: duplicates go before the join."""
    return relational.natural_join(t.u.distinct(), t.t.distinct())


# which (a, b, c, d) of u and t are known to r by (a, b, c) and to s by (b, c, d)
_WITNESSED = """known_r as (select distinct a, b, c from r), known_s as (select distinct b, c, d from s),
    pairs as (select a, d, b, c from (select distinct * from u) left_side join (select distinct * from t) right_side
              using (a, d)),
    witnessed as (select p.a, p.b, p.c, p.d from pairs p
                  semi join known_r using (a, b, c) semi join known_s using (b, c, d))"""


@query(f"""with {_WITNESSED}, asked as (
        select a, d, b, c from pairs where (a, b, c) in (from known_r) and (b, c, d) in (from known_s))
    select a, b, c, d from asked""")
def semi_join_in(t):
    """Each (a, b, c, d) of the joined tables with known triples on both sides, one row each."""
    with_r = skew.semi_join(_distinct_ut(t), t.r, ["a", "b", "c"])
    return skew.semi_join(with_r, t.s, ["b", "c", "d"]).select("a", "b", "c", "d")


def _witnessed(t):
    """Rows of u x t (equal a and d) that both r and s have a row for."""
    return skew.semi_join(skew.semi_join(_distinct_ut(t), t.s, ["b", "c", "d"]), t.r, ["a", "b", "c"])


@query(f"with {_WITNESSED} select a, b, c, d from witnessed group by all")
def semi_join_exists(t):
    return _witnessed(t).select("a", "b", "c", "d")


@query(f"with {_WITNESSED} select count(*) as n from (select a, b, c, d from witnessed group by all)")
def count_distinct_tuple(t):
    return _witnessed(t).select("a", "b", "c", "d").agg(F.count_distinct("a", "b", "c", "d").alias("n"))


@query("""select a, b, c from r where not exists (
        select * from s where s.b = r.b and s.c = r.c)""")
def anti_join_subset(t):
    return skew.anti_join(t.r, t.s, ["b", "c"])


@query("""select l_partkey from lineitem except all
    select l_partkey from lineitem where l_linenumber <= 3""")
def bag_difference(t):
    parts = t.lineitem.select("l_partkey")
    return relational.bag_difference(parts, t.lineitem.where("l_linenumber <= 3").select("l_partkey"))


@query("select distinct name, class, date_ from badges")
def distinct_rows(t):
    return t.badges.select("name", "class", "date_").distinct()


@query("""with g as (select userid, count(*) as n from badges where name ilike 's%' or name ilike 'e%'
        group by userid)
    select userid from g where n = (
        select count(distinct name) from badges where name ilike 's%' or name ilike 'e%')""")
def having_count_distinct(t):
    wanted = F.col("name").ilike("s%") | F.col("name").ilike("e%")
    return relational.having_equals_scalar(t.badges, "userid", "name", wanted).select("userid")


@query("""select method, posttypeid, count(*) as n, sum(reputation)::bigint as reputation
    from posts p join users u on u.id = p.owneruserid,
        (values ('merge'), ('shuffle_hash'), ('broadcast')) m(method) group by all""")
def join_hints(t):
    """One join under each method; all methods must agree."""
    left = t.posts.select(F.col("owneruserid").alias("id"), "posttypeid")
    right = t.users.select("id", "reputation")

    def under(method):
        return (relational.join_by_method(left, right, ["id"], method).groupBy("posttypeid")
                .agg(F.count("*").alias("n"), F.sum("reputation").alias("reputation"))
                .select(F.lit(method).alias("method"), "posttypeid", "n", "reputation"))

    return reduce(lambda a, b: a.unionByName(b), map(under, ["merge", "shuffle_hash", "broadcast"]))


@query("select info, available from libraries join books on libid = home")
def semijoin_reduction(t):
    return relational.semijoin_reduced(
        t.libraries.withColumnRenamed("libid", "home"), t.books, ["home"], ["info"], ["available"])


def _held(t):
    """Books held by a library, with the library's information."""
    return t.libraries.withColumnRenamed("libid", "home").join(t.books, "home").select("info", "bid")


@query("""with held as (select info, bid from libraries join books on libid = home)
    select rid, v.bid, count(h.info) as n_held, min(h.info) as first_info
    from book_reviews v left join held h on h.bid = v.bid group by rid, v.bid""")
def outer_join_left(t):
    """All reviews; the held books are summed per title first, so a much reviewed title
    costs one row per review."""
    per_title = _held(t).groupBy("bid").agg(F.count("*").alias("n_held"),
                                            F.min("info").alias("first_info"))
    reviews = t.book_reviews.select("rid", "bid")
    return (skew.salted_join(reviews, per_title, ["bid"], "left", spread_by=["rid"])
            .withColumn("n_held", F.coalesce("n_held", F.lit(0))))


@query("""with held as (select info, bid from libraries join books on libid = home)
    select info, h.bid, count(v.rid) as n_reviews
    from held h left join book_reviews v on h.bid = v.bid group by info, h.bid""")
def outer_join_right(t):
    """All held books; the reviews are counted per title first."""
    counted = t.book_reviews.groupBy("bid").agg(F.count("*").alias("n_reviews"))
    return (relational.outer_join(counted, _held(t), ["bid"], "right")
            .select("info", "bid", F.coalesce("n_reviews", F.lit(0)).alias("n_reviews")))


@query("""with recursive names as (select distinct event_type as word from events),
    step as (
        select word, '' as permutation, word as rest from names
        union
        select word, concat(permutation, substr(rest, i, 1)),
               concat(substr(rest, 1, i - 1), substr(rest, i + 1))
        from (select word, permutation, rest, unnest(range(1, length(rest) + 1)) as i from step))
    select word, permutation from step where rest = ''""")
def distinct_permutations(t):
    names = t.events.select(F.col("event_type").alias("word")).distinct()
    return words.distinct_permutations(names, "word")
