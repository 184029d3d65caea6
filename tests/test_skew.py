"""A third of all rows on one key: same results as brute force, and spread out."""

import random
from collections import Counter, defaultdict
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lodestar.operators import graph, motif, nested, ordering, relational, skew, suffix
from lodestar.plans import nested as plans

HOT = dict(share=0.1, min_rows=1)


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(5)
    keys = [7 if i % 3 == 0 else rng.randrange(40) for i in range(900)] + [None] * 20
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, k long")


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame([(k, f"v{k}") for k in range(0, 40, 7)], "k long, v string")


def test_heavy_keys_are_found(spark, skewed):
    want = spark.sql("select xxhash64(7L)").first()[0]
    # a bit more than a third of the rows, so four of ten tasks
    assert skew.heavy_keys(skewed.dropna(), ["k"], width=10, **HOT) == {want: 4}
    assert skew.heavy_keys(skewed.limit(0), ["k"], **HOT) == {}


def test_number_of_hot_keys_is_bounded():
    assert skew.hot_share(8) == 1 / 64 and skew.hot_share(1024) == 4 / 1024
    assert skew.hot_share(20_000) == 1 / 2048
    assert skew.salts_for(333, 1000, 900) == 300 and skew.salts_for(1, 1000, 9) == 2


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("spread_by", [None, ["id"]])
def test_salted_join_equals_plain_join(skewed, lookup, rows, how, spread_by):
    salted = skew.salted_join(skewed, lookup, ["k"], how, width=24, spread_by=spread_by, **HOT)
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert rows(salted) == rows(skewed.join(lookup, "k", how))


def test_salts_do_not_depend_on_the_order_of_rows(skewed, lookup):
    def dealt(left):
        joined = skew.salted_join(left, lookup, ["k"], "left", width=24, **HOT)
        salted = joined._jdf.queryExecution().optimizedPlan().toString()
        assert "_salt" in salted and "monotonically" not in salted
        return sorted(map(repr, joined.collect()))
    assert dealt(skewed) == dealt(skewed.orderBy(F.desc("id")).repartition(3))


def test_hot_key_reaches_several_partitions(spark, skewed, lookup):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew.salted_join(skewed, lookup, ["k"], "left", width=24, spread_by=["id"], **HOT)
        parts = joined.where("k = 7").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert parts > 1


def test_key_types_must_agree(spark, skewed):
    other = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(TypeError):
        skew.salted_join(skewed, other, ["k"])


def test_semi_and_anti_keep_copies(spark, rows):
    left = spark.createDataFrame([(1, 1), (1, 1), (2, 2)], "a int, b int")
    right = spark.createDataFrame([(1,), (1,)], "b int")
    assert rows(skew.semi_join(left, right, ["b"])) == [(1, 1), (1, 1)]
    assert rows(skew.anti_join(left, right, ["b"])) == [(2, 2)]


def test_broadcast_only_below_the_bound(skewed, lookup):
    assert skew.checked_broadcast(lookup, 6)[1]
    assert not skew.checked_broadcast(skewed, 100)[1]


@pytest.mark.parametrize("buckets", [1, 4, 50])
def test_values_at_ranks(spark, buckets):
    rng = random.Random(buckets)
    values = [5] * 200 + [rng.randrange(1000) for _ in range(401)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    wanted = [1, 2, 300, 300, 601]
    got = {r["pos"]: r["value"] for r in
           ordering.values_at_ranks(df, "v", lambda n: wanted, buckets).collect()}
    assert got == {i: sorted(values)[rank - 1] for i, rank in enumerate(wanted)}


def test_median_of_known_sample(spark):
    fib = [0, 1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610, 987, 1597, 2584, 4181]
    df = spark.createDataFrame([(v,) for v in fib], "v int")
    assert ordering.median_value(df, "v").first()[0] == 44.5
    odd = spark.createDataFrame([(3,), (1,), (2,)], "v int")
    assert ordering.median_value(odd, "v").first()[0] == 2.0


def test_top_k_is_limited_before_the_shuffle(skewed):
    top = ordering.top_k_per_group(skewed, ["k"], [F.desc("id")], 2)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert top.where("k = 7").count() == 2


@pytest.mark.parametrize("buckets", [1, 3, 40])
def test_suffix_aggregates_equal_brute_force(spark, buckets):
    rng = random.Random(buckets)
    left = [(i, 50 if i % 3 == 0 else rng.randrange(100)) for i in range(300)] + [(999, None)]
    right = [(50 if i % 3 == 0 else rng.randrange(20, 95), rng.choice([None, rng.randrange(-50, 50)]))
             for i in range(200)] + [(None, 10**6)]
    got = {r["id"]: (r["suffix_max"], r["suffix_sum"], r["suffix_count"], r["suffix_avg"])
           for r in suffix.suffix_agg(spark.createDataFrame(left, "id long, t long"), "t",
                                      spark.createDataFrame(right, "t long, v long"), "t", "v",
                                      buckets, spread_by=["id"], **HOT).collect()}
    for i, t in left:
        later = [v for u, v in right if t is not None and u is not None and u > t and v is not None]
        want = (max(later), sum(later), len(later), sum(later) / len(later)) if later else (None, None, 0, None)
        assert got[i] == pytest.approx(want) if later else got[i] == want


def test_exists_greater_on_nothing(spark):
    left = spark.createDataFrame([(1,)], "a int")
    right = spark.createDataFrame([], "b int")
    assert relational.exists_greater(left, "a", right, "b").count() == 0


def test_average_over_join_equals_the_join(spark, skewed, rows):
    left = skewed.withColumn("g", F.col("id") % 3)
    right = skewed.withColumn("v", (F.col("id") % 11).cast("double"))
    want = (left.join(right.select("k", "v"), "k").groupBy("g").agg(F.avg("v").alias("m")))
    got = relational.avg_over_join(left, right, ["k"], "g", "v", "m")
    assert [(g, pytest.approx(m)) for g, m in rows(want)] == rows(got)


def test_counted_natural_join_equals_the_bag(spark, rows):
    rng = random.Random(1)

    def table(columns, n):
        return spark.createDataFrame([tuple(rng.randrange(3) for _ in columns) for _ in range(n)],
                                     ", ".join(f"{c} int" for c in columns))

    r, s, t = table("abc", 40), table("dbc", 30), table("adc", 30)
    bag = r.join(s, ["b", "c"]).join(t, ["a", "d", "c"]).select("a", "b", "c", "d")
    want = Counter(tuple(x) for x in bag.collect())
    counted = relational.natural_join_counted([r, s, t]).select("a", "b", "c", "d", "n")
    assert {tuple(x)[:4]: x["n"] for x in counted.collect()} == want
    with pytest.raises(ValueError):
        relational.natural_join(r, spark.range(1))


def test_bag_difference(spark, rows):
    left = spark.createDataFrame([(1,), (1,), (1,), (2,)], "a int")
    right = spark.createDataFrame([(1,), (2,), (2,)], "a int")
    assert rows(relational.bag_difference(left, right)) == [(1,), (1,)]


def test_single_value_keys(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b"), (3, None)],
                               "u int, b string")
    assert rows(relational.single_value_keys(df, "u", "b", F.lit(True))) == [(1, "a")]


def test_children_are_embedded_by_pages(spark):
    parent = spark.createDataFrame([(1, "p"), (2, "q"), (3, "none")], "id long, name string")
    child = spark.createDataFrame([(1, i % 5, i % 4) for i in range(100)] + [(2, 1, 3)],
                                  "pid long, e long, owned long")
    docs = nested.embed_children(parent, child, "id", "pid", "list", F.col("e")).cache()
    assert {(r["id"], r["chunk"], len(r["list"])) for r in docs.collect()} == {
        *((1, k, 20) for k in range(5)), (2, 1, 1), (3, 0, 0)}
    apart = nested.unnest_children(docs, "id", "list")
    straight = nested.children_of(parent, child, "id", "pid")
    assert sorted(map(tuple, apart.collect())) == sorted(map(tuple, straight.collect())) and apart.count() == 101
    owned = {r["id"]: r["n"] for r in nested.sum_nested(docs, "id", "list", "owned", "n").collect()}
    assert owned == {1: sum(i % 4 for i in range(100)), 2: 3, 3: 0}
    sums = nested.sum_children(parent, child, "id", "pid", "owned", "n")
    assert {r["id"]: r["n"] for r in sums.collect()} == owned


def test_embedding_query_has_one_document_of_each_book(spark):
    book = spark.createDataFrame([(1, "p", "x"), (2, "q", "y")], "id long, name string, authors string")
    edition = spark.range(10_001).select(
        F.lit(1).cast("long").alias("book"), F.col("id").alias("edition"), F.lit(2000).alias("year"),
        F.lit(1).alias("owned"))
    found = plans.embed_children(SimpleNamespace(book=book, edition=edition)).collect()
    assert sorted((r["id"], r["chunk"], r["n_editions"]) for r in found) == [(1, 0, 10_001), (2, 0, 0)]


def test_known_documents(spark):
    book = spark.createDataFrame([("3", "Systems")], "id string, name string").withColumn(
        "id", F.col("id").cast("long"))
    edition = spark.createDataFrame([(3, 7, 2017, 1), (3, 6, 2010, 2), (3, 2, 1994, 6)],
                                    "book long, edition int, year int, owned int")
    docs = nested.embed_children(book, edition, "id", "book", "editions")
    borrowed = spark.createDataFrame([(3, "01-05-2019"), (3, None)], "book long, since string")
    found = nested.copies_available(book, edition, borrowed, "id", "book", "owned", "book").first()
    assert (found["owned"], found["borrowed"], found["available"]) == (9, 2, 7)


def brute_motif(nodes, edges):
    label = {n[0]: n[1] for n in nodes}
    facts = {n[0]: n[2:] for n in nodes}
    met = defaultdict(set)
    firsts = {(s, d) for s, d, t in edges if t == "A" and label[s] == "I"}
    seconds = {(s, d) for s, d, t in edges if t == "B" and label[s] == "O"}
    for i, e in firsts:
        for o, e2 in seconds:
            if e == e2 and label[e] == "E":
                met[i, o].add(e)
    counts = Counter()
    for pair, found in met.items():
        for x in found:
            for y in found:
                (c, k, j), (c2, k2, j2) = facts[x], facts[y]
                if c and c2 and c != c2 and ((k and j and k != j) or (k2 and j2 and k2 != j2)):
                    counts[pair] += 1
    return {p: n for p, n in counts.items() if n}


@pytest.mark.parametrize("budget", [0, 6, 40, 10**9])
def test_motif_with_hubs_equals_brute_force(spark, budget):
    rng = random.Random(3)
    nodes = ([(i, "I", None, None, None) for i in range(100, 112)]
             + [(o, "O", None, None, None) for o in range(200, 215)]
             + [(e, "E", rng.choice(["C1", "C2", None]), rng.choice(["K1", "K2", None]),
                 rng.choice(["K1", "K2"])) for e in range(300, 318)]
             + [(e, "E", f"C{e % 3}", "K1", "K1" if e < 321 else "K2") for e in range(318, 323)])
    edges = [(rng.randrange(100, 112), rng.randrange(300, 318), "A") for _ in range(40)]
    edges += [(rng.randrange(200, 215), rng.randrange(300, 318), "B") for _ in range(40)]
    # five hubs that most nodes share
    edges += [(i, e, "A") for i in range(100, 112) for e in range(318, 323) if rng.random() < 0.7]
    edges += [(o, e, "B") for o in range(200, 215) for e in range(318, 323) if rng.random() < 0.7]
    n = spark.createDataFrame(nodes, "id long, label string, countries string, "
                                     "country_codes string, jurisdiction string")
    e = spark.createDataFrame(edges, "src long, dst long, type string")
    found = motif.shared_pair_motif(n, e, "A", "B", "I", "O", "E", pair_budget=budget)
    assert {(r["i"], r["o"]): r["n_matches"] for r in found.collect()} == brute_motif(nodes, edges)


def test_motif_with_a_thousand_hubs(spark):
    rng = random.Random(5)
    nodes = ([(i, "I", None, None, None) for i in range(8)] + [(o, "O", None, None, None) for o in range(20, 28)]
             + [(e, "E", f"C{e % 7}", "K1", "K2" if e % 5 == 0 else "K1") for e in range(100, 1140)])
    edges = [(k, e, kind) for e in range(100, 1140) for kind, first in (("A", 0), ("B", 20))
             for k in range(first, first + 8) if rng.random() < 0.4]
    n = spark.createDataFrame(nodes, "id long, label string, countries string, "
                                     "country_codes string, jurisdiction string")
    e = spark.createDataFrame(edges, "src long, dst long, type string")
    found = motif.shared_pair_motif(n, e, "A", "B", "I", "O", "E", pair_budget=0)
    assert {(r["i"], r["o"]): r["n_matches"] for r in found.collect()} == brute_motif(nodes, edges)


def test_hub_numbers_are_rows_of_a_table(spark):
    side = spark.range(300).select(F.col("id").alias("i"), (F.col("id") % 150).alias("e"))
    shared = spark.range(150).select(F.col("id").alias("e"), F.lit("C").alias("c"), (F.col("id") == 3).alias("bad"))
    hubs = motif._hubs(side, side.withColumnRenamed("i", "o"), shared, 0).orderBy("e").collect()
    assert [(h["word"], h["bit"]) for h in hubs] == [divmod(k, 64) for k in range(150)]


def test_degree_product_is_not_listed(spark, rows):
    nodes = spark.createDataFrame([(1, "I", "x"), (2, "I", "x"), (3, "I", "y")],
                                  "id long, label string, name string")
    edges = spark.createDataFrame([(1, 9, "A")] * 3 + [(1, 9, "B")] * 2 + [(2, 9, "A"), (2, 9, "B"),
                                                                          (3, 9, "A")],
                                  "src long, dst long, type string")
    assert rows(graph.degree_product(nodes, edges, "I", "A", "B", "name")) == [("x", 7)]


def test_upsert_and_uniqueness(spark, rows):
    old = spark.createDataFrame([("a",), ("b",)], "name string")
    new = spark.createDataFrame([("b",), ("c",), ("c",)], "name string")
    merged = graph.merge_keys(old, new, ["name"])
    assert rows(merged) == [("a",), ("b",), ("c",)]
    graph.assert_unique(merged, ["name"])
    with pytest.raises(ValueError):
        graph.assert_unique(new, ["name"])
