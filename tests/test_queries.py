"""Every query against its SQL, and rules that all plans must keep."""

from collections import Counter

import pytest

from __spark_entry__ import entry
from lodestar.operators.features import weighted_f1
from lodestar.plans import ORACLE, QUERIES
from tools.compare import canonical, connect

SF_DIR = "/root/testdata/sf0.001"
MODELS = {"classify_decision_tree", "classify_linear_svm"}
ROWS_ONLY = MODELS | {"tuned_decision_tree"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_only_models_lack_sql():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert banned not in plan
    assert canonical(df.toPandas()) == canonical(con.execute(ORACLE[name]).df())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["category", "term", "chi2", "rank"]
    assert df.count() == 800


@pytest.mark.parametrize("name", sorted(MODELS))
def test_model_queries(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    found = df.collect()
    f1 = weighted_f1(df, "category", "predicted").first()[0]
    share = max(Counter(r["category"] for r in found).values()) / len(found)
    # always saying the largest class scores 2 share^2 / (1 + share)
    assert f1 > 2 * share ** 2 / (1 + share) + 0.2
