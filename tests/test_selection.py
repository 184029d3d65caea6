"""p-values, the term selector as an ML stage, and the search over a parameter grid."""

import math

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import ChiSqSelector, CountVectorizer, StringIndexer
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import functions as F

from lodestar.functions.scores import chi2_log_p
from lodestar.operators import classification as cl
from lodestar.operators.features import hash_split, weighted_f1
from lodestar.operators.selection import TermSelector, TermSelectorModel
from lodestar.plans import QUERIES
from lodestar.session import scratch_path


def log_p_by_sum(chi2, dof):
    """Finite sums: whole and half-whole orders have a closed form. Terms in logarithms."""
    x, a = chi2 / 2, dof / 2
    if x == 0:
        return 0.0
    logs = [k * math.log(x) - x - math.lgamma(k + 1) for k in ([i for i in range(dof // 2)] if dof % 2 == 0 else
                                                                [i + 0.5 for i in range(dof // 2)])]
    if dof % 2:
        root = math.erfc(math.sqrt(x))
        # beyond the range of erfc its first terms say enough
        logs.append(math.log(root) if root > 1e-300 else -x - 0.5 * math.log(math.pi * x) + math.log1p(
            -1 / (2 * x) + 3 / (4 * x * x) - 15 / (8 * x ** 3)))
    top = max(logs)
    return top + math.log(math.fsum(math.exp(v - top) for v in logs))


def test_p_values_equal_closed_forms(spark):
    cases = [(float(c), d) for d in (1, 2, 3, 4, 7, 30, 99, 300, 1001) for c in (
        0, 0.01, 0.5, d / 3, d * 0.9, d, d + 2, d + 2.1, 2 * d + 5, 10 * d + 50, 5000, 80_000)]
    df = spark.createDataFrame([*cases, (None, 3), (3.0, 0)], "chi2 double, dof int")
    found = df.select("chi2", "dof", chi2_log_p(F.col("chi2"), F.col("dof")).alias("p")).collect()
    assert [r["p"] for r in found[-2:]] == [None, None]
    for r in found[:-2]:
        assert r["p"] == pytest.approx(log_p_by_sum(r["chi2"], r["dof"]), rel=1e-8, abs=1e-8), r


@pytest.fixture(scope="module")
def rows(spark):
    """Tokens of 300 rows of three labels: one telling word each, one rare telling one, noise, odd rows."""
    data = []
    for i in range(300):
        label = ["food", "cars", "books"][i % 3]
        own = [["apple"], ["wheel"], ["novel"]][i % 3] * (1 + i % 4)
        data.append((i, label, own + [f"n{i % 7}", f"m{i % 11}"] + ["plum"] * (i % 30 == 0)))
    return spark.createDataFrame(data + [(900, "food", []), (901, "cars", None), (902, None, ["apple"])],
                                 "id long, category string, tokens array<string>")


@pytest.mark.parametrize("by", ["chi2", "p"])
def test_selector_ranks_like_the_dense_one(rows, by):
    known = rows.where("category is not null and tokens is not null")
    model = TermSelector(inputCol="tokens", labelCol="category", numTop=5, rankBy=by).fit(known)
    assert {"apple", "wheel", "novel"} <= set(model.terms) and len(model.terms) == 5
    if by == "p":
        dense = Pipeline(stages=[StringIndexer(inputCol="category", outputCol="y"),
                                 CountVectorizer(inputCol="tokens", outputCol="x"),
                                 ChiSqSelector(numTopFeatures=5, featuresCol="x", labelCol="y", outputCol="z")])
        fitted = dense.fit(known)
        vocabulary = fitted.stages[1].vocabulary
        # the dense one breaks ties of underflowing p-values by place: compare what is certain
        assert set(model.terms[:3]) <= {vocabulary[i] for i in fitted.stages[2].selectedFeatures}


def test_odd_rows_and_empty_tables(rows):
    model = TermSelector(inputCol="tokens", labelCol="category", numTop=4).fit(rows)
    vectors = {r["id"]: r["selectedTerms"] for r in model.transform(rows.where("tokens is not null")).collect()}
    assert vectors[900].numNonzeros() == 0 and vectors[902].numNonzeros() == 1
    assert TermSelector(inputCol="tokens", labelCol="category").fit(rows.limit(0)).terms == []


def test_selector_survives_saving(spark, rows):
    known = rows.where("category is not null and tokens is not null")
    indexed = StringIndexer(inputCol="category", outputCol="categoryIndex").fit(known).transform(known)
    fitted = cl.term_pipeline("decision_tree", "tokens", num_top=6).fit(indexed)
    path = scratch_path(spark, "selected-model")
    fitted.write().save(path)
    loaded = PipelineModel.load(path)
    assert isinstance(loaded.stages[0], TermSelectorModel) and loaded.stages[0].terms == fitted.stages[0].terms
    both = [m.transform(indexed).select("id", "prediction").orderBy("id").collect() for m in (fitted, loaded)]
    assert both[0] == both[1]
    assert spark.read.parquet(path + "/stages/0_" + fitted.stages[0].uid + "/terms").count() == 6
    again = scratch_path(spark, "selector")
    selector = TermSelector(inputCol="tokens", labelCol="category", numTop=3, rankBy="chi2")
    selector.save(again)
    assert TermSelector.load(again).getOrDefault("rankBy") == "chi2"
    terms = scratch_path(spark, "terms")
    cl.write_terms(fitted.stages[0], spark, terms)
    assert [r["value"] for r in spark.read.text(terms).collect()] == fitted.stages[0].terms


def test_selector_in_a_grid(rows):
    known = rows.where("category is not null and tokens is not null")
    indexed = StringIndexer(inputCol="category", outputCol="categoryIndex").fit(known).transform(known)
    pipeline = cl.term_pipeline("decision_tree", "tokens")
    assert len(cl.param_grid(pipeline)) == 32 and len(cl.param_grid(cl.term_pipeline("svm"))) == 24
    selector = pipeline.getStages()[0]
    grid = ParamGridBuilder().addGrid(selector.numTop, [1, 5]).build()
    found = TrainValidationSplit(estimator=pipeline, estimatorParamMaps=grid, evaluator=cl.f1_evaluator(),
                                 seed=1).fit(indexed)
    assert found.validationMetrics[1] > found.validationMetrics[0]
    assert len(found.bestModel.stages[0].terms) == 5


def test_best_row_equals_a_direct_fit(spark):
    texts = [(i, ["food", "cars", "books"][i % 3], " ".join(
        [["apple", "wheel", "novel"][(i if i % 9 else i + 1) % 3]] * (1 + i % 3) + [chr(97 + i % 23) * 3]))
        for i in range(400)]
    df = hash_split(spark.createDataFrame(texts, "id long, category string, body string"), "id")
    grid = {"numTop": [2, 6], "maxDepth": [1, 4], "impurity": ["gini"], "minInstancesPerNode": [1]}
    table = cl.grid_search(df, "id", "body", "category", "decision_tree", grid).collect()
    assert len(table) == 4 and sorted(r["rank"] for r in table) == [1, 2, 3, 4]
    best = min(table, key=lambda r: r["rank"])
    assert best["f1"] == max(r["f1"] for r in table) > 0.8

    inner = hash_split(df.where("is_train").drop("is_train"), "id", seed=7)
    tokens = PipelineModel(cl.tokenising_stages("body")).transform(inner)
    train, held = tokens.where("is_train"), tokens.where("not is_train")
    index = StringIndexer(inputCol="category", outputCol="categoryIndex").fit(train)
    pipeline = cl.term_pipeline("decision_tree", num_top=best["numTop"], max_depth=best["maxDepth"])
    scored = pipeline.fit(index.transform(train)).transform(index.transform(held))
    assert weighted_f1(scored, "categoryIndex", "prediction").first()[0] == pytest.approx(best["f1"])
    assert MulticlassClassificationEvaluator(labelCol="categoryIndex", metricName="f1").evaluate(
        scored) == pytest.approx(best["f1"])
    path = scratch_path(spark, "metrics")
    cl.write_metrics(spark.createDataFrame(table), path)
    assert spark.read.option("header", True).csv(path).count() == 4


def test_registered_search_has_the_whole_grid(spark):
    table = QUERIES["tuned_decision_tree"](spark, "/root/testdata/sf0.001").collect()
    assert len(table) == 32 and {r["numTop"] for r in table} == {400, 4000}
    assert min(table, key=lambda r: r["rank"])["f1"] > 0.5
