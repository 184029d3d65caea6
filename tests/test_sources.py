import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar import session
from lodestar.operators import aggregates, profiling, words
from lodestar.sources import generators, layout, readers


def write(path, text):
    path.write_text(text)
    return str(path)


def test_reviews_read_only_their_fields(spark, tmp_path):
    path = write(tmp_path / "r.json", json.dumps({"category": "Toys", "reviewText": "fun", "x": 1}) + "\n")
    assert [tuple(r) for r in readers.read_reviews(spark, path).collect()] == [("Toys", "fun")]


def test_csv_keeps_quotes_commas_and_breaks(spark, tmp_path, rows):
    path = write(tmp_path / "a.csv", 'id,name,n\n1,"a, ""b""\nc",5\n2,,oops\n3,d,\n')
    schema = T.StructType.fromDDL("id long, name string, n int")
    assert rows(readers.read_csv_typed(spark, path, schema, multi_line=True)) == [
        (1, 'a, "b"\nc', 5), (2, None, None), (3, "d", None)]


def test_shop_log_by_position(spark, tmp_path, rows):
    """Columns by place, whatever the header calls them; both months as one input."""
    head = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
    october = write(tmp_path / "oct.csv", head
                    + '2019-10-01 00:00:00 UTC,purchase,1,9,"a,b",acme,1.5,7,s\n'
                    + "2019-10-02 00:00:00 UTC,purchase,2,9,c,,2.5,7,s\n"
                    + ",purchase,3,9,c,acme,2.5,8,s\n")
    november = write(tmp_path / "nov.csv", head
                     + "2019-11-03 00:00:00 UTC,purchase,1,9,c,acme,oops,7,s\n"
                     + "2019-11-03 00:00:00 UTC,view,1,9,c,best,1.0,8,s\n")
    schema = T.StructType.fromDDL("at string, kind string, product long, category long, code string, "
                                  "brand string, price double, user_id long, session string")
    log = readers.read_csv_typed(spark, [october, november], schema, multi_line=False)
    day = F.try_to_date(F.split("at", r"\s+")[0], "yyyy-MM-dd")
    bought = (log.where("kind = 'purchase' and brand <> '' and product is not null")
              .withColumn("month", F.month(day)).where("month is not null"))
    assert rows(bought.select("user_id", "brand", "month", "price")) == [
        (7, "acme", 10, 1.5), (7, "acme", 11, None)]
    found = aggregates.strict_favourite_in_all(bought, "user_id", "brand", "month", [10, 11])
    assert rows(aggregates.fan_counts(found, "brand")) == [("acme", 1)]


def test_bad_rows_are_set_aside_whole(spark, tmp_path, rows):
    paths = [write(tmp_path / f"{n}.csv", f"id,n\n{n},1\nx{n},2\n") for n in (1, 2)]
    schema = T.StructType.fromDDL("id long, n int")
    read = readers.read_csv_typed(spark, paths, schema, multi_line=False, keep_corrupt=True).cache()
    clean, bad = readers.split_corrupt(read)
    assert rows(clean) == [(1, 1), (2, 1)]
    assert rows(bad.select(readers.CORRUPT)) == [("x1,2",), ("x2,2",)]


def test_uniform_ints(spark):
    df = generators.uniform_ints(spark, 20_000, {"a": 3}, seed=1)
    share = {r["a"]: r["count"] / 20_000 for r in df.groupBy("a").count().collect()}
    assert set(share) == {0, 1, 2, 3}
    # rounding leaves the ends half as frequent
    assert share[0] == pytest.approx(1 / 6, abs=0.02) and share[1] == pytest.approx(1 / 3, abs=0.02)


def test_marker_partition_is_pruned(spark):
    path = session.scratch_path(spark, "marker")
    df = layout.partition_marker(spark.range(300), F.col("id") > 100, "rep", 101, 100)
    # what counts as large is lowered to this test's size
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500")
    try:
        layout.write_partitioned(df.repartition(8), path, ["rep"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    read = spark.read.parquet(path).where("rep > 100")
    assert read.count() == 199
    assert "PartitionFilters: [isnotnull(rep" in read._jdf.queryExecution().executedPlan().toString()
    # a large value is written by several tasks
    assert len([f for f in read.inputFiles() if 'rep=101' in f]) >= 4


def test_buckets_join_without_a_shuffle(spark):
    left = layout.write_bucketed(spark.range(1000), "tb_left", "id", 4)
    right = layout.write_bucketed(spark.range(500), "tb_right", "id", 4)
    joined = left.join(right.hint("merge"), "id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 500
    both = layout.write_bucketed(spark.range(100).withColumn("p", F.col("id") % 2), "tb_both", "id", 2,
                                 partition_cols=["p"])
    assert both.where("p = 1").count() == 50


def test_text_sinks(spark, rows):
    path = session.scratch_path(spark, "lines")
    layout.write_lines(spark.createDataFrame([("x\ta:1",)], "line string"), path)
    assert rows(spark.read.text(path)) == [("x\ta:1",)]


def test_table_statistics(spark):
    """Statistics on a written table, as the planner's cost model wants them."""
    layout.write_bucketed(spark.range(50), "tb_stats", "id", 2)
    layout.collect_statistics(spark, "tb_stats", ["id"])
    facts = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED tb_stats id").collect()}
    assert facts["distinct_count"] == "50"


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


class Unset:
    """A session without the setting."""

    def __init__(self, master):
        self.conf = self.sparkContext = self
        self.master, self.applicationId = master, f"app-{master}"

    def get(self, key, default):
        return default


def test_local_fallback_only_for_local_sessions():
    assert session.shared_dir(Unset("local[2]")) == session.shared_dir(Unset("local[2]"))
    with pytest.raises(RuntimeError):
        session.shared_dir(Unset("spark://host:7077"))


def test_favourites_and_ties(spark, rows):
    df = spark.createDataFrame(
        [(1, "b", 10), (1, "a", 11), (2, "a", 10), (2, "a", 10), (2, "b", 11), (3, "c", 10)],
        "u int, brand string, month int")
    assert rows(aggregates.favourite(df, "u", "brand")) == [(1, "a"), (2, "a"), (3, "c")]
    assert rows(aggregates.strict_favourite(df, "u", "brand")) == [(2, "a"), (3, "c")]
    assert rows(aggregates.present_in_all(df, "u", "month", [11, 10])) == [(1,), (2,)]
    both = aggregates.strict_favourite_in_all(df, "u", "brand", "month", [10, 11])
    assert rows(both) == [(2, "a")]
    assert rows(aggregates.fan_counts(both, "brand")) == [("a", 1)]


def test_deviation_of_known_sample(spark):
    fib = [0, 1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610, 987, 1597, 2584, 4181]
    df = spark.createDataFrame([(v,) for v in fib], "v int")
    assert aggregates.stddev_pop_value(df, "v").first()[0] == pytest.approx(1055.812808929689)
    assert [r[0] for r in df.where("v % 3 = 0 and v > 0").collect()] == [3, 21, 144, 987]


def test_permutations_of_known_words(spark):
    df = spark.createDataFrame([("vaccine",), ("virion",), ("",), (None,)], "w string")
    counts = {r["w"]: r["count"] for r in words.distinct_permutations(df, "w").groupBy("w").count().collect()}
    assert counts == {"vaccine": 2520, "virion": 360, "": 1}


def test_histogram_interpolation(spark):
    bounds = [4, 12, 23, 32, 40, 59, 70, 78, 85, 91, 100]
    histogram = spark.createDataFrame(list(enumerate(bounds)), "bound int, value int")
    below = profiling.range_selectivity(histogram, None, 50).first()[0]
    above = profiling.range_selectivity(histogram, 87, None).first()[0]
    assert below == pytest.approx(0.453, abs=1e-3) and above == pytest.approx(0.167, abs=1e-3)


def test_selectivity_arithmetic(spark):
    from lodestar.functions import scores
    row = spark.range(1).select(
        scores.equality_selectivity(F.lit(78)).alias("eq"),
        scores.inequality_selectivity(F.lit(78)).alias("ne"),
        scores.join_selectivity(F.lit(15), F.lit(9)).alias("join"),
        scores.or_selectivity(F.lit(0.7), F.lit(0.6)).alias("either"),
        scores.equality_selectivity(F.lit(0)).alias("none")).first()
    assert row["eq"] == pytest.approx(0.0128, abs=1e-4) and row["ne"] == pytest.approx(0.987, abs=1e-3)
    assert row["join"] == pytest.approx(0.067, abs=1e-3) and row["either"] == 1.0 and row["none"] is None


def test_approximate_profile(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 10)
    got = {r["column_name"]: r["ndv"] for r in profiling.ndv_profile(df, ["id", "k"], approx=True).collect()}
    assert got["k"] == 10 and abs(got["id"] - 1000) < 100
