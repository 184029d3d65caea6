import math
import re
from collections import Counter
from itertools import product

import pytest
from pyspark.sql import functions as F

from lodestar.functions.text import DELIMITERS
from lodestar.operators import features, terms

ALTERNATIVES = r"""\s|\d|\.|!|\?|,|;|:|\(|\)|\[|]|\{|}|-|_|"|`|~|#|&|\*|%|\$|\|/"""


def reviews(spark, rows):
    return spark.createDataFrame(rows, "id long, category string, text string")


def terms_of(df):
    return sorted(r["term"] for r in df.collect())


def test_class_and_alternatives_split_alike():
    text = "".join(chr(c) for c in range(32, 400)) + " a|b |/c/ it's x\ty\nz"
    assert re.split(DELIMITERS, text) == re.split(ALTERNATIVES, text)


def test_pipe_and_slash_do_not_split_alone(spark):
    df = reviews(spark, [(1, "x", "b|/c/d|e don't")])
    assert terms_of(terms.tokenize_terms(df, "text", [])) == ["b", "c/d|e", "don't"]
    assert terms_of(terms.tokenize_terms(df, "text", [], split_pipe_slash=True)) == [
        "b", "c", "d", "don't", "e"]


def test_folding_comes_before_stop_words(spark):
    df = reviews(spark, [(1, "x", "The the cat Cat THE")])
    assert terms_of(terms.tokenize_terms(df, "text", ["the"])) == ["cat"]
    kept = terms.tokenize_terms(df, "text", ["the"], stop_before_fold=True)
    assert terms_of(kept) == ["cat", "the"]


def test_stop_words_as_a_table(spark):
    df = reviews(spark, [(1, "x", "The cat sat"), (2, "x", "the dog")])
    stop = spark.createDataFrame([("the",), ("sat",)], "w string")
    assert terms_of(terms.tokenize_terms(df, "text", stop)) == ["cat", "dog"]


def test_documents_without_terms_still_count(spark):
    df = reviews(spark, [(1, "x", None), (2, "x", " .. "), (3, "y", "cat")])
    found = terms.tokenize_terms(df, "text", [])
    cells = terms.chi2_contingency(found, df).collect()
    assert [(r["category"], r["a"], r["b"], r["c"], r["d"]) for r in cells] == [("y", 1, 0, 0, 2)]
    assert terms.term_counts(df, "text", []).count() == 1


def test_scores_and_ties(spark):
    docs = reviews(spark, [(1, "x", "a b"), (2, "x", "a c"), (3, "y", "d a"), (4, "y", "e a")])
    found = terms.tokenize_terms(docs, "text", [])
    scores = terms.chi2_scores(found, docs)
    assert scores.where("term = 'a'").where("chi2 is not null").count() == 0
    top = terms.chi2_top_terms(scores, 1).collect()
    assert {(r["category"], r["term"]) for r in top} == {("x", "b"), ("y", "d")}
    assert all(math.isclose(r["chi2"], 1 / 3) for r in top)
    scaled = {r["term"]: r["chi2"] for r in terms.chi2_scores(found, docs, scaled=True).collect()}
    assert math.isclose(scaled["b"], 4 / 3)


def test_report_lines(spark):
    top = spark.createDataFrame([("x", "b", 0.5, 2), ("x", "a", 1.0, 1)],
                                "category string, term string, chi2 double, rank int")
    assert [r["line"] for r in terms.chi2_report_lines(top).collect()] == ["x\ta:1.000000 b:0.500000"]


def test_counts_equal_a_counter(spark):
    texts = ["b a b", "", None, "a", "z y x z z-y", "  lead trail  ", "The the"]
    df = reviews(spark, [(i, "x", t) for i, t in enumerate(texts)])
    want = {(i, w, n) for i, t in enumerate(texts)
            for w, n in Counter(x for x in re.split(ALTERNATIVES, (t or "").lower()) if x).items()
            if w != "lead"}
    got = {(r["id"], r["term"], r["tf"]) for r in terms.term_counts(df, "text", ["lead"]).collect()}
    assert got == want


def test_overall_scores_equal_the_chi_square_test(spark):
    from pyspark.ml.feature import CountVectorizer, StringIndexer
    from pyspark.ml.stat import ChiSquareTest
    words = ["a", "b", "c", "d"]
    rows = [(i, "xyz"[i % 3],
             " ".join(w for j, w in enumerate(words) for _ in range((i * (j + 2) + i // 5) % 3)))
            for i in range(60)]
    df = reviews(spark, rows)
    split = df.withColumn("words", F.filter(F.split("text", " "), lambda w: w != ""))
    vectors = CountVectorizer(inputCol="words", outputCol="v").fit(split)
    indexed = StringIndexer(inputCol="category", outputCol="y").fit(split).transform(split)
    result = ChiSquareTest.test(vectors.transform(indexed), "v", "y").first()
    want = {w: (s, d) for w, s, d in zip(vectors.vocabulary, result["statistics"],
                                         result["degreesOfFreedom"])}
    got = {r["term"]: (r["chi2"], r["dof"])
           for r in terms.chi2_overall(terms.term_counts(df, "text", []), df).collect()}
    assert set(got) == set(want)
    for word, (statistic, dof) in want.items():
        assert got[word][0] == pytest.approx(statistic, abs=1e-9) and got[word][1] == dof


def test_weights_equal_the_ml_stages(spark):
    from pyspark.ml.feature import IDF, CountVectorizer, Normalizer
    df = reviews(spark, [(1, "x", "a b a"), (2, "x", "b c"), (3, "y", "a c c c"), (4, "y", "b")])
    counts = terms.term_counts(df.drop("category"), "text", [])
    weights = features.tfidf_weights(counts, df)
    unit = {(r["id"], r["term"]): r["weight"] for r in features.l2_normalised(weights, "id").collect()}
    split = df.withColumn("words", F.split("text", " "))
    vec = CountVectorizer(inputCol="words", outputCol="v").fit(split)
    idf = IDF(inputCol="v", outputCol="w")
    v = vec.transform(split)
    out = Normalizer(p=2.0, inputCol="w", outputCol="u").transform(idf.fit(v).transform(v))
    for row, (i, word) in product(out.collect(), enumerate(vec.vocabulary)):
        assert unit.get((row["id"], word), 0.0) == pytest.approx(row["u"][i], abs=1e-12)


def test_hot_terms_are_salted_without_changing_weights(spark):
    df = reviews(spark, [(i, "x", f"hot w{i}") for i in range(30)])
    counts = terms.term_counts(df, "text", [])
    plain = features.tfidf_weights(counts, df)
    salted = features.tfidf_weights(counts, df, share=0.2, min_rows=1)
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.collect()))


def test_texts_are_split_once_and_only_rows_of_rare_terms_move(spark, rows):
    df = reviews(spark, [(i, "x", f"hot hot {'abcd'[i % 4] * 2} {chr(ord('A') + i)}x") for i in range(26)])
    counts = terms.term_counts(df, "text", [])
    all_common = features.tfidf_weights(counts, df)
    some = features.tfidf_weights(counts, df, common=4)  # hot alone reaches 8; the others move
    salted = features.tfidf_weights(counts, df, share=0.2, min_rows=1)
    assert rows(all_common) == rows(some) == rows(salted) and all_common.count() == 78
    assert "split(" not in some._jdf.queryExecution().optimizedPlan().toString()
    plan = all_common._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert some.where("n_docs = 1").count() == 26


def test_common_terms_are_cut_at_a_power_of_two(spark):
    freq = spark.createDataFrame([("a", 9), ("b", 8), ("c", 7), ("d", 4), ("e", 3), ("f", 1)], "term string, n_docs long")
    assert [features.common_floor(freq, k) for k in (0, 1, 2, 3, 4, 5, 6)] == [2 ** 63 - 1] * 2 + [8, 8, 4, 2, 1]
    assert features.common_floor(freq.where("n_docs > 9"), 5) == 2 ** 63 - 1
