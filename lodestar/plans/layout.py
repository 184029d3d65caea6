"""File round trips and table layouts, each written to a new folder of the shared directory."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path, shuffle_width
from ..sources import csv_ranges, generators, layout, readers
from .registry import query

_KEEP_SPACE = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _table_name(stem):
    return f"{stem}_{uuid.uuid4().hex}"


@query("""select cast(event_id as varchar) as event_id, event_type, brand,
        cast(product_id as varchar) as product_id, cast(user_id as varchar) as user_id from shop""")
def scan_shop_csv(t):
    """Two CSV files with a header, all cells as strings."""
    columns = ["event_id", "event_type", "brand", "product_id", "user_id"]
    paths = [scratch_path(t.spark, name) for name in ("oct-csv", "nov-csv")]
    for part, path in zip((t.oct, t.nov), paths):
        layout.write_csv(part.select(*columns), path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return readers.read_csv_typed(t.spark, paths, schema, multi_line=False)


@query("""select doc_id, lang, case when lang = 'fr' then -1 else n_chars end as n_chars, text
    from documents""")
def typed_csv_load(t):
    """Texts with quotes, commas and line breaks; the counts of one language are no numbers
    and read as null, shown as -1."""
    path = scratch_path(t.spark, "documents-csv")
    cell = F.when(F.col("lang") == "fr", "unknown").otherwise(F.col("n_chars").cast("string"))
    layout.write_csv(t.documents.select("doc_id", "lang", cell.alias("n_chars"), "text"), path,
                     escape='"', **_KEEP_SPACE)
    schema = T.StructType.fromDDL("doc_id long, lang string, n_chars long, text string")
    return csv_ranges.read_csv_ranges(t.spark, path, schema, **_KEEP_SPACE).withColumn(
        "n_chars", F.coalesce("n_chars", F.lit(-1)))


@query("""select case when doc_id % 10 = 3 then null else doc_id end as doc_id, length(text) as n_chars,
    doc_id % 10 = 3 as set_aside from documents""")
def csv_quarantine(t):
    """Texts with line breaks; of every tenth row the id is no number, and it is set aside with its raw text."""
    path = scratch_path(t.spark, "quarantine-csv")
    bad = F.col("doc_id") % 10 == 3
    cell = F.when(bad, F.lit("none")).otherwise(F.col("doc_id").cast("string"))
    layout.write_csv(t.documents.select(cell.alias("doc_id"), F.length("text").alias("n_chars"), "text"), path,
                     escape='"', **_KEEP_SPACE)
    schema = T.StructType.fromDDL("doc_id long, n_chars long, text string")
    read = csv_ranges.read_csv_ranges(t.spark, path, schema, keep_corrupt=True, **_KEEP_SPACE)
    clean, aside = readers.split_corrupt(read)
    rows = clean.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.lit(False).alias("set_aside"))
    # what is set aside still has its text: after the two plain cells, with its quotes
    raw = F.regexp_replace(F.regexp_extract(readers.CORRUPT, r"(?s)^[^,]*,[^,]*,(.*)$", 1), r'(?s)^"(.*)"$', "$1")
    text = F.replace(raw, F.lit('""'), F.lit('"'))
    return rows.unionAll(aside.select(F.lit(None).cast("long"), F.length(text).cast("long"), F.lit(True)))


@query("""select event_id, month(ts) as month, cast(epoch(date_trunc('second', ts)) as bigint) as seconds
    from events where event_id % 11 <> 0""")
def parse_timestamps(t):
    """Timestamps in a custom format; rows whose cell does not parse are dropped."""
    path = scratch_path(t.spark, "times-csv")
    cell = F.when(F.col("event_id") % 11 == 0, "unknown").otherwise(
        F.date_format("ts", "dd-MM-yyyy HH.mm.ss"))
    layout.write_csv(t.events.select("event_id", cell.alias("at")), path)
    schema = T.StructType.fromDDL("event_id long, at timestamp")
    read = readers.read_csv_typed(t.spark, path, schema, timestamp_format="dd-MM-yyyy HH.mm.ss",
                                  multi_line=False)
    return read.where("at is not null").select(
        "event_id", F.month("at").cast("long").alias("month"), F.unix_timestamp("at").alias("seconds"))


@query("""select name, (select count(*) from orders) as n_rows, (select count(*) from orders) as n_in_range,
        (top + 1)::bigint as n_values from (values ('a', 50), ('b', 50), ('d', 20)) k(name, top)""")
def gen_uniform_ints(t):
    """Random rows, as many as there are orders; checked for range and for use of every value."""
    tops = {"a": 50, "b": 50, "d": 20}
    drawn = generators.uniform_ints_like(t.orders, tops, seed=7)
    rows = F.array(*[F.struct(
        F.lit(c).alias("name"), F.col("n").alias("n_rows"), F.col(f"in_{c}").alias("n_in_range"),
        F.col(f"ndv_{c}").alias("n_values")) for c in tops])
    measures = [m for c, top in tops.items() for m in (
        F.count_if(F.col(c).between(0, top)).alias(f"in_{c}"), F.count_distinct(c).alias(f"ndv_{c}"))]
    return drawn.agg(F.count("*").alias("n"), *measures).select(F.inline(rows))


@query("""select id, reputation, 101 as rep from users where reputation > 100""")
def partition_marker(t):
    """Users partitioned by a marker; the filter on it reads one folder."""
    path = scratch_path(t.spark, "users-by-marker")
    marked = layout.partition_marker(t.users.select("id", "reputation"),
                                     F.col("reputation") > 100, "rep", 101, 100)
    layout.write_partitioned(marked, path, ["rep"])
    schema = T.StructType.fromDDL("id long, reputation long, rep int")
    return t.spark.read.schema(schema).parquet(path).where("rep > 100")


@query("""select id, case when reputation > 100 then 101 else 100 end as rep from users""")
def static_partition_insert(t):
    table = _table_name("users_partitioned")
    layout.create_partitioned_table(t.spark, table, "id bigint, rep int", "rep")
    layout.insert_static_partition(t.users.where("reputation > 100").select("id"), table, {"rep": 101})
    layout.insert_static_partition(t.users.where("reputation <= 100").select("id"), table, {"rep": 100})
    return t.spark.table(table)


@query("select posttypeid, id, owneruserid from posts where posttypeid > 2")
def dynamic_partition_insert(t):
    """One folder per post type, made from the values in the rows."""
    table = _table_name("posts_partitioned")
    layout.create_partitioned_table(t.spark, table, "id bigint, owneruserid bigint, posttypeid int",
                                    "posttypeid")
    layout.insert_dynamic_partitions(t.posts.select("posttypeid", "id", "owneruserid"), table,
                                     ["posttypeid"])
    return t.spark.table(table).where("posttypeid > 2")


@query("""select posttypeid, count(*) as n, sum(reputation)::bigint as reputation
    from posts p join users u on u.id = p.owneruserid group by posttypeid""")
def bucketed_join(t):
    """Posts, partitioned by type, and users in equal buckets: the join needs no shuffle at any skew."""
    posts = t.posts.select("id", F.col("owneruserid").alias("userid"), "posttypeid")
    users = t.users.select(F.col("id").alias("userid"), "reputation")
    names = tuple(_table_name(n) for n in ("posts_bucketed", "users_bucketed", "posts_layout"))
    left, right = layout.write_bucketed_pair(posts, users, ["userid"], shuffle_width(t.spark), names, ["id"],
                                             partition_cols=["posttypeid"])
    joined = left.join(right.hint("merge"), ["userid", "salt"])
    return joined.groupBy("posttypeid").agg(F.count("*").alias("n"),
                                            F.sum("reputation").alias("reputation"))


@query("select id, displayname, reputation from users where reputation <= 100 or id % 2 = 0")
def replaced_table(t):
    """A table made, replaced twice and read by name: the last content, and one table."""
    table = _table_name("users_current")
    users = t.users.select("id", "displayname", "reputation")
    layout.replace_table(users.where("reputation > 100"), table)
    layout.replace_table(users, table)
    # reads the table that it replaces
    return layout.replace_table(t.spark.table(table).where("reputation <= 100 or id % 2 = 0"), table)
