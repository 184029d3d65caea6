"""Bucketed layouts with hot keys, replaced tables, upserts to storage, and large CSV files."""

import csv
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.operators import graph, relational, skew
from lodestar.sources import csv_ranges, layout, readers, versions


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot_rows", [0, 6000])
def test_buckets_join_without_a_shuffle_at_any_skew(spark, hot_rows):
    rows = spark.range(3000).select("id", (F.col("id") % 50).alias("k"), (F.col("id") % 3).alias("p"))
    rows = rows.unionAll(spark.range(10_000, 10_000 + hot_rows).select("id", F.lit(7), F.lit(1)))
    # a null key matches nothing and stays in one row each
    rows = rows.unionAll(spark.range(20_000, 20_005).select("id", F.lit(None), F.lit(2)))
    keys = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = skew.heavy_keys(rows, ["k"], share=0.2, min_rows=1000, width=8)
    assert len(hot) == (1 if hot_rows else 0)
    names = tuple(f"pair_{part}_{hot_rows}" for part in ("l", "r", "t"))
    left, right = layout.write_bucketed_pair(rows, keys, ["k"], 8, names, ["id"], ["p"], hot=hot)
    joined = left.join(right.hint("merge"), ["k", "salt"])
    assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
    assert joined.count() == 3000 + hot_rows
    assert joined.agg(F.sum("v")).first()[0] == rows.where("k is not null").agg(F.sum(F.col("k") * 2)).first()[0]
    files = left.where("k = 7").groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()
    if hot_rows:  # the hot key fills several buckets, evenly
        assert len({r["f"].split("_")[-1] for r in files}) >= 3 and max(r["n"] for r in files) < 4000
    assert left.count() == rows.count() and spark.table(names[2]).count() == len(hot)


def test_replacing_is_whole_or_nothing(spark):
    table = "replaced_whole"
    layout.replace_table(spark.range(10), table)
    before = spark.table(table)
    begun = before.where("id >= 0").persist()
    assert begun.count() == 10
    layout.replace_table(spark.range(100, 103), table)
    assert sorted(r["id"] for r in spark.table(table).collect()) == [100, 101, 102]
    assert begun.count() == 10
    begun.unpersist()
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("no"))).otherwise(F.col("id"))
                                   .cast("long").alias("id"))
    with pytest.raises(Exception):
        layout.replace_table(broken, table)
    assert spark.table(table).count() == 3
    with pytest.raises(ValueError):
        layout.replace_table(spark.range(2).withColumnRenamed("id", "other"), table)
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(table)] == [table]
    layout.drop_table(spark, table)
    layout.drop_table(spark, table)
    assert not spark.catalog.tableExists(table)


# ---- large CSV files

SCHEMA = T.StructType().add("id", T.LongType()).add("body", T.StringType()).add("n", T.IntegerType())


def csv_file(tmp_path, rows, name="big.csv"):
    with open(tmp_path / name, "w", newline="") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(["id", "body", "n"])
        writer.writerows(rows)
    return str(tmp_path / name)


@pytest.mark.parametrize("split", ["97", "1000", "100000"])
def test_one_file_is_read_by_many_tasks(spark, tmp_path, split):
    rng = random.Random(split)
    bits = ["plain", "a,b", 'say "x"', "two\nlines", "\n", "\n\n\n", "é\r\nß", '"', '""\n"', "x" * 300, "end "]
    rows = [(k, "".join(rng.choice(bits) for _ in range(rng.randrange(1, 6))), k % 7) for k in range(400)]
    paths = [csv_file(tmp_path, rows[:390]), csv_file(tmp_path, rows[390:], "small.csv"),
             csv_file(tmp_path, [], "empty.csv")]
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        lines = spark.read.text(paths[0])
        read = csv_ranges.read_csv_ranges(spark, paths, SCHEMA, ignoreLeadingWhiteSpace="false",
                                          ignoreTrailingWhiteSpace="false")
        found = sorted((tuple(r) for r in read.collect()), key=lambda r: r[0])
        tasks = lines.rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == rows
    assert tasks > 5 or split == "100000"


def test_bad_rows_have_a_table_of_their_own(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text('id,body,n\n1,"a\nb",5\nx,"c\nd",6\n2,e\n\n3,f,7,8\n4,g,9\n5,"cut off\n')
    read = csv_ranges.read_csv_ranges(spark, str(path), SCHEMA, keep_corrupt=True)
    clean, bad = readers.split_corrupt(read.persist())
    assert sorted(tuple(r) for r in clean.collect()) == [(1, "a\nb", 5), (4, "g", 9)]
    assert sorted(r[readers.CORRUPT] for r in bad.collect()) == ["2,e", "3,f,7,8", '5,"cut off', 'x,"c\nd",6']


# ---- upserts and rules of storage

def test_two_upserts_in_a_row(spark):
    first = spark.createDataFrame([(k, "old", k) for k in range(40)] + [(None, "old", 0), (3, "older", 9)],
                                  "k long, v string, n int")
    table = versions.VersionedTable.create(first, "upserted", ["k"], 8)
    files = table.files()
    assert table.read().count() == 41
    assert table.read().where("k = 3").first()["v"] == "older"  # larger than "old"
    few = spark.createDataFrame([(5, "new", -1), (100, "new", 1), (100, "next", 0), (None, "new", 2)],
                                "k long, v string, n int")
    touched = table.upsert(few)
    now = table.files()
    assert 1 <= len(touched) <= 3
    assert {k for k in now if now[k] != files.get(k)} == set(touched)
    found = {r["k"]: (r["v"], r["n"]) for r in table.read().collect()}
    assert len(found) == 42 and found[5] == ("new", -1) and found[100] == ("next", 0) and found[None] == ("new", 2)
    assert found[6] == ("old", 6)
    begun = table.read()
    table.upsert(spark.createDataFrame([(5, "again", 7)], "k long, v string, n int"))
    assert {r["k"]: r["v"] for r in table.read().collect()}[5] == "again"
    assert {r["k"]: r["v"] for r in begun.collect()}[5] == "new"  # a reader keeps the list that it began with
    assert table.upsert(few.limit(0)) == [] and table.read().count() == 42


def test_upsert_into_an_empty_table_of_keys_only(spark):
    none = spark.createDataFrame([], "a long, b string")
    table = versions.VersionedTable.create(none, "keys_only", ["a", "b"], 4)
    assert table.read().count() == 0
    rows = spark.createDataFrame([(1, "x")] * 50 + [(2, "y"), (None, None)], "a long, b string")
    table.upsert(rows)
    table.upsert(rows)
    assert sorted((tuple(r) for r in table.read().collect()), key=repr) == [(1, "x"), (2, "y"), (None, None)]


def test_a_violating_write_leaves_nothing(spark):
    good = spark.createDataFrame([(k, k % 2, f"v{k}") for k in range(100)] + [(None, 1, "n")], "a long, b long, v string")
    layout.replace_table(graph.enforced_unique(good, ["a", "b"]), "ruled")
    assert spark.table("ruled").count() == 101
    assert {tuple(r) for r in spark.table("ruled").collect()} == {tuple(r) for r in good.collect()}
    bad = good.unionAll(spark.createDataFrame([(7, 1, "v7")], good.schema))
    with pytest.raises(Exception, match="key .7, 1. occurs 2 times"):
        layout.replace_table(graph.enforced_unique(bad, ["a", "b"]), "ruled")
    assert spark.table("ruled").count() == 101
    with pytest.raises(Exception, match="occurs"):
        layout.replace_table(graph.enforced_unique(bad.select("a", "b"), ["a", "b"]), "never_made")
    assert not spark.catalog.tableExists("never_made")
    # the check is not pruned away with the columns
    with pytest.raises(Exception, match="occurs"):
        graph.enforced_unique(bad, ["a", "b"]).agg(F.count("*")).collect()


def test_copies_of_one_value_come_from_many_tasks(spark):
    left = spark.range(1).select(F.lit("x").alias("v"), F.explode(F.sequence(F.lit(1), F.lit(1000))).alias("i")).select("v")
    right = spark.createDataFrame([("x",)] * 30 + [("y",)], "w string")
    out = relational.bag_difference(left, right, block=50)
    assert out.count() == 970
    tasks = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
    assert len(tasks) >= 4
    both = spark.createDataFrame([(None, 1.0), (None, 1.0), ("a", None)], "s string, d double")
    assert sorted(map(tuple, relational.bag_difference(both, both.limit(0)).collect()), key=repr) == sorted(
        map(tuple, both.collect()), key=repr)
    assert relational.bag_difference(both, both).count() == 0
