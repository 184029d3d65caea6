"""The tables the queries run on, derived from the driver's parquet files.

Each view is a DataFrame over whole tables; column pruning and filters reach the scans.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BASE = ("region nation customer supplier part orders lineitem events documents embeddings "
        "pages benchmark labels conversations").split()

PERIOD_START = "2024-01-16 00:00:00"


class Tables:
    """Base tables and views of one data folder, built on first use: ``t.orders``, ``t.posts``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def register(self) -> None:
        """All tables and views under their names, for use from SQL."""
        for name in [*BASE, *VIEWS]:
            getattr(self, name).createOrReplaceTempView(name)

    def _read(self, path: str) -> DataFrame:
        """The schema is taken from a file footer once per session and path."""
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            value = self._read(os.path.join(self.path, f"{name}.parquet"))
        elif name in VIEWS:
            value = VIEWS[name](self)
        else:
            raise AttributeError(name)
        setattr(self, name, value)
        return value


_SCHEMAS: dict[str, StructType] = {}


def _k(column: str = "props"):
    """The number inside an event's properties."""
    return F.regexp_extract(column, "[0-9]+", 0).cast("long")


def reviews(t):
    return t.documents.select(F.col("doc_id").alias("review_id"), F.col("lang").alias("category"),
                              F.col("text").alias("review_text"))


def shop(t):
    k = _k()
    brand = F.when(k % 10 == 0, None).otherwise(F.concat(F.lit("brand"), (k % 7).cast("string")))
    return t.events.select(
        "event_id", F.col("ts").alias("event_time"), "event_type", k.alias("product_id"),
        (k % 5).alias("category_id"), brand.alias("brand"), F.col("value").alias("price"),
        (F.col("user_id") * 50 + F.col("event_id") % 50).alias("buyer_id"), "user_id")


def oct_(t):
    return t.shop.where(F.col("event_time") < F.lit(PERIOD_START).cast("timestamp_ntz"))


def nov(t):
    return t.shop.where(F.col("event_time") >= F.lit(PERIOD_START).cast("timestamp_ntz"))


def users(t):
    return t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("displayname"),
        F.floor("c_acctbal").cast("long").alias("upvotes"),
        (F.col("c_custkey") % 400).alias("reputation"),
        F.date_add(F.lit("1995-01-01").cast("date"),
                   ((F.col("c_custkey") * 37) % 2400).cast("int")).alias("creationdate"))


def posts(t):
    return t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("owneruserid"),
        F.col("o_orderdate").cast("date").alias("creationdate"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("posttypeid"),
        F.col("o_orderpriority").alias("tags"))


def _line_id():
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def comments(t):
    return t.lineitem.select(_line_id().alias("id"), F.col("l_orderkey").alias("postid"),
                             F.col("l_suppkey").alias("userid"))


def postlinks(t):
    return t.lineitem.where("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("postid"), (F.col("l_partkey") * 8).alias("relatedpostid"))


def badges(t):
    return t.events.select(
        F.col("event_id").alias("id"),
        (F.col("user_id") * 10 + F.col("event_id") % 10).alias("userid"),
        F.col("event_type").alias("name"), (_k() % 3 + 1).alias("class"),
        F.col("ts").cast("date").alias("date_"))


def votes(t):
    return t.lineitem.select(_line_id().alias("id"), F.col("l_orderkey").alias("postid"),
                             F.col("l_linenumber").alias("votetypeid"))


def posthistory(t):
    named = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return t.orders.join(named, "o_custkey").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("userid"),
        F.col("o_orderkey").alias("postid"), F.col("c_name").alias("userdisplayname"))


def r(t):
    return t.lineitem.select((F.col("l_suppkey") % 51).alias("a"),
                             (F.col("l_partkey") % 51).alias("b"),
                             F.col("l_quantity").cast("long").alias("c"))


def s(t):
    quantity = F.col("l_quantity").cast("long")
    return t.lineitem.select(
        (F.col("l_suppkey") % 21).alias("d"), (F.col("l_partkey") % 51).alias("b"),
        (quantity - quantity % 2).alias("c"))


def t_(t):
    return t.orders.select(
        (F.col("o_custkey") % 51).alias("a"), (F.col("o_orderkey") % 21).alias("d"),
        ((F.col("o_custkey") + F.col("o_orderkey")) % 51).alias("c"))


def u(t):
    return t.customer.select((F.col("c_custkey") % 21).alias("a"),
                             (F.col("c_custkey") % 17).alias("b"),
                             (F.col("c_nationkey") % 21).cast("long").alias("d"))


def libraries(t):
    return t.supplier.select(
        F.col("s_suppkey").alias("libid"), F.col("s_name").alias("info"),
        F.col("s_nationkey").alias("city"))


def books(t):
    return t.lineitem.select(F.col("l_partkey").alias("bid"), F.col("l_suppkey").alias("home"),
                             (F.col("l_partkey") % 2).alias("available")).distinct()


def book_reviews(t):
    return t.events.select(F.col("event_id").alias("rid"), (_k() * 30).alias("bid"),
                           F.col("event_type").alias("body"))


def book(t):
    return t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                         F.concat("p_brand", F.lit(", "), "p_type").alias("authors"))


def edition(t):
    return t.lineitem.select(F.col("l_partkey").alias("book"), _line_id().alias("edition"),
                             F.year("l_shipdate").alias("year"),
                             (F.col("l_quantity").cast("long") % 5).alias("owned"))


def person(t):
    return t.customer.select(F.col("c_custkey").alias("pid"), F.col("c_name").alias("name"),
                             F.col("c_mktsegment").alias("address"))


def borrowed(t):
    return t.events.where("event_type = 'click'").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("who"), (_k() * 20).alias("book"),
        F.col("ts").cast("date").alias("from_date"))


# Start of each label's id range in the graph.
ADDRESS, OFFICER, INTERMEDIARY, ENTITY, OTHER = (i * 1_000_000_000 for i in range(1, 6))


def _node(df, id_, label, name=None, countries=None, codes=None, jurisdiction=None):
    def text(c):
        return (F.lit(None) if c is None else c).cast("string")
    return df.select(id_.cast("long").alias("id"), F.lit(label).alias("label"),
                     text(name).alias("name"), text(countries).alias("countries"),
                     text(codes).alias("country_codes"), text(jurisdiction).alias("jurisdiction"))


def nodes(t):
    key = F.col("n_nationkey")
    # nation and region have 25 and 5 rows at any scale
    placed = t.nation.join(F.broadcast(t.region), F.col("r_regionkey") == F.col("n_regionkey"))
    country = (F.when(key % 6 == 0, None).when(key % 7 == 0, F.concat("r_name", F.lit(";OTHER")))
               .otherwise(F.col("r_name")))
    order, customer = F.col("o_orderkey") % 5, F.col("o_custkey") % 5
    size = F.col("p_size") % 9
    kind = F.when(size == 0, None).when(size == 1, "AFRICA;ASIA").otherwise(F.col("p_type"))
    return (_node(placed, ADDRESS + key, "Address", F.col("n_name"), country)
            .unionByName(_node(t.customer, OFFICER + F.col("c_custkey"), "Officer", F.col("c_name")))
            .unionByName(_node(t.supplier, INTERMEDIARY + F.col("s_suppkey"), "Intermediary",
                               F.concat(F.lit("I"), F.col("s_suppkey") % 40)))
            .unionByName(_node(t.orders, ENTITY + F.col("o_orderkey"), "Entity", None,
                               F.concat(F.lit("C"), order), F.concat(F.lit("K"), order),
                               F.concat(F.lit("K"), customer)))
            .unionByName(_node(t.part, OTHER + F.col("p_partkey"), "Other", F.col("p_name"), kind)))


def edges(t):
    def edge(df, src, dst, type_):
        return df.select(src.cast("long").alias("src"), dst.cast("long").alias("dst"),
                         F.lit(type_).alias("type"))

    part = F.col("p_partkey")
    n_parts = t.part.agg(F.count("*")).scalar()
    supplied = t.lineitem.select("l_suppkey", "l_orderkey")
    sevenths = t.lineitem.where("l_linenumber = 7").select("l_suppkey", "l_orderkey")
    sup, order = INTERMEDIARY + F.col("l_suppkey"), ENTITY + F.col("l_orderkey")
    nearest = t.part.where((part % 40 != 39) & (part + 1 < n_parts))
    skips = t.part.where((part % 110 == 0) & (part + 7 < n_parts))
    return (edge(t.customer, OFFICER + F.col("c_custkey"), ADDRESS + F.col("c_nationkey"),
                 "REGISTERED_ADDRESS")
            .unionByName(edge(t.supplier, INTERMEDIARY + F.col("s_suppkey"),
                              ADDRESS + F.col("s_nationkey"), "REGISTERED_ADDRESS"))
            .unionByName(edge(supplied.distinct(), sup, order, "INTERMEDIARY_OF"))
            .unionByName(edge(t.orders, OFFICER + F.col("o_custkey"), ENTITY + F.col("o_orderkey"),
                              "OFFICER_OF"))
            .unionByName(edge(sevenths.distinct(), sup, order, "OFFICER_OF"))
            .unionByName(edge(nearest, OTHER + part, OTHER + part + 1, "LINKED"))
            .unionByName(edge(skips, OTHER + part, OTHER + part + 7, "LINKED")))


VIEWS = {
    "reviews": reviews, "shop": shop, "oct": oct_, "nov": nov, "users": users, "posts": posts,
    "comments": comments, "postlinks": postlinks, "badges": badges, "votes": votes,
    "posthistory": posthistory, "r": r, "s": s, "t": t_, "u": u, "libraries": libraries,
    "books": books, "book_reviews": book_reviews, "book": book, "edition": edition,
    "person": person, "borrowed": borrowed, "nodes": nodes, "edges": edges,
}
