"""Trees of a grid grown together over sparse rows, against Spark's tree; terms that can be among the best by p-value."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lodestar.functions.scores import chi2_log_p
from lodestar.operators import classification as cl
from lodestar.operators import terms, tree_grid
from lodestar.operators.features import hash_split
from lodestar.session import write_scratch

WIDTH = 30
GRID = [{"maxDepth": d, "impurity": i, "minInstancesPerNode": n}
        for d in (2, 7) for i in ("gini", "entropy") for n in (1, 25)]


@pytest.fixture(scope="module")
def vectors(spark):
    """Rows of three noisy labels; a held row's label is its number, so that it can be found again."""
    rng = random.Random(5)
    rows = []
    for i in range(900):
        label = rng.choice([0, 0, 1, 2])
        values = {rng.randrange(WIDTH - 2): rng.random() if rng.random() < 0.8 else rng.choice([0.0, 0.25, 0.5, -0.5])
                  for _ in range(rng.randrange(8))}
        if rng.random() < 0.8:
            values[label] = 0.2 + rng.random() * rng.choice([1, 3])
        values[WIDTH - 2] = 0.7  # one value for all; the last feature has none
        train = i % 3 > 0
        rows.append((train, float(label if train else i), Vectors.sparse(WIDTH, values)))
    df = spark.createDataFrame(rows, ["is_train", "label", "vector"])
    path = write_scratch(df, "made-vectors")
    return df, spark.read.schema(f"is_train boolean, label double, vector {tree_grid.VECTOR}").parquet(path)


@pytest.mark.parametrize("limits", [{}, {"DENSE_CELLS": 0, "KEYS_AT_ONCE": 500, "CELLS_AT_ONCE": 200, "CHUNK": 7,
                                         "MANY_NODES": 9}])
def test_trees_predict_like_sparks(vectors, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(tree_grid, name, value)
    df, stored = vectors
    said, columns = tree_grid.predictions(stored, df.where("is_train").count(), WIDTH, GRID, "test")
    found = {r["label"]: r for r in said.collect()}
    assert len(found) == 300
    for parameters, column in zip(GRID, columns):
        if limits and parameters["maxDepth"] < 7:
            continue
        tree = DecisionTreeClassifier(featuresCol="vector", labelCol="label", seed=cl.SEED, **parameters)
        scored = tree.fit(df.where("is_train")).transform(df.where("not is_train")).collect()
        assert [found[r["label"]][column] for r in scored] == [r["prediction"] for r in scored], parameters


def test_thresholds_of_more_rows_than_a_sample(vectors, monkeypatch):
    _, stored = vectors
    monkeypatch.setattr(tree_grid, "SAMPLE_ROWS", 0)
    monkeypatch.setattr(tree_grid, "MAX_BINS", 8)
    flat = stored.select(F.col("vector.indices").alias("indices"), F.col("vector.values").alias("values"))
    limits = tree_grid.thresholds(flat, flat.count(), WIDTH)
    assert limits.shape == (WIDTH, 7) and not np.isfinite(limits[WIDTH - 2:]).any()
    assert np.isfinite(limits[:3]).any(axis=1).all() and (limits[:3, 1:] >= limits[:3, :-1]).all()


def test_bins_count_the_thresholds_below():
    for width in (1, 2, 3, 7, 12, 31):
        limits = np.sort(np.random.default_rng(width).random((4, width)), axis=1)
        limits[1, width // 2:] = np.inf
        features = np.arange(400) % 4
        values = np.where(np.arange(400) % 5, np.linspace(-0.1, 1.1, 400), limits[features, 0])
        assert tree_grid.bins_of(limits, features, values).tolist() == [
            int(np.searchsorted(limits[f], v)) for f, v in zip(features, values)]


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(3)
    rows = [(i, None if i == 5 else ["food", "cars", "books"][i % 3], " ".join(
        rng.choices(["apple", "wheel", "novel", "plum", "road", "page", "tea"],
                    [1 + 5 * (i % 3 == k % 3) for k in range(7)], k=rng.randrange(9)))) for i in range(500)]
    return hash_split(spark.createDataFrame(rows, "id long, category string, body string"), "id")


def test_a_large_search_keeps_no_dense_rows(texts, monkeypatch):
    """Each of its fits made and read dense rows anew."""
    grid = {"numTop": [3, 6], "maxDepth": [2, 5], "impurity": ["entropy"], "minInstancesPerNode": [1, 30]}
    search = [texts, "id", "body", "category", "decision_tree", grid]
    fits, fit = [], DecisionTreeClassifier._fit
    monkeypatch.setattr(DecisionTreeClassifier, "_fit", lambda self, df: fits.append(1) or fit(self, df))
    dense = {tuple(r)[:4]: r["f1"] for r in cl.grid_search(*search).collect()}
    assert len(fits) == 8 == len(dense)
    monkeypatch.setattr(cl, "DENSE_BYTES", 0, raising=False)
    sparse = {tuple(r)[:4]: r["f1"] for r in cl.grid_search(*search).collect()}
    assert len(fits) == 8
    assert sparse == pytest.approx(dense) and min(sparse.values()) > 0.4


def test_only_terms_that_can_be_best_get_a_p_value(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(f"t{i}", 1, rng.choice([rng.expovariate(0.2), rng.expovariate(0.01), float(rng.randrange(40)), 0.0, -1e-12]),
             rng.choice([3, 3, 3, 3, 8, 60])) for i in range(3000)]
    scores = spark.createDataFrame(rows, "term string, df long, chi2 double, dof long")
    exact = scores.withColumn("log_p", chi2_log_p(F.col("chi2"), F.col("dof"))).orderBy("log_p", "term")
    for k in (1, 400, 5000):
        found = terms.chi2_top_terms_overall(scores, k, by="p").collect()
        assert [tuple(r) for r in found] == [tuple(r) for r in exact.limit(k).collect()]
    assert 20 <= terms.contenders_by_p(scores, 20).count() < 300
