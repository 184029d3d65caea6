import math
import re

import numpy as np
from pyspark.sql import functions as F

from lodestar.llm import byte_cnn, quality_rules
from tests.llm.conftest import prose


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    hit = {p for at in seen.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(hit))


def test_counts_equal_brute_force(docs):
    texts = [None, "", " \n ", "a b", "a b c a b c a b c", "a a a a", "x\ny\nx\n\n \nx", "#a |b <c>\n" * 7,
             prose(1, 200), " a  b\x0bc\x1cd", "é É ß " * 30, prose(2, 50) + "\n" + prose(2, 50)]
    found = {r["doc_id"]: r for r in quality_rules.measured(docs(texts).drop("n_words")).collect()}
    for k, text in enumerate(texts):
        want = base(text)
        got = found[k]
        assert tuple(got[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_repeat_words")) == want
        assert got["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_binomial_tail(spark):
    cases = [(0, 10), (3, 200), (0, 3000), (9, 2500), (40, 20_000), (900, 250_000)]
    df = spark.createDataFrame(cases, "k long, n long")
    got = df.select("k", "n", quality_rules.binomial_tail(F.col("k"), F.col("n"), 0.004).alias("p")).collect()
    for r in got:
        want = sum(math.exp(math.lgamma(r.n + 1) - math.lgamma(i + 1) - math.lgamma(r.n - i + 1)
                            + i * math.log(0.004) + (r.n - i) * math.log(0.996)) for i in range(r.k + 1))
        assert math.isclose(r.p, want, rel_tol=1e-8)


def test_cutoffs_limit_false_rejections(spark, docs):
    # without a false rejection the tail is (1 - ALPHA / rules) ** n: the level needs 1,551 good documents
    n_good = 1600
    good = [prose(k, 60) for k in range(n_good)]
    bad = ["%%% ".join(prose(k, 60).split()) for k in range(5000, 5060)]
    table = docs(good + bad)
    labels = spark.createDataFrame([(k, int(k < n_good)) for k in range(n_good + 60)] + [(3, None)],
                                   "doc_id long, quality int")
    judged = {r["doc_id"]: r for r in quality_rules.judge(table, labels).collect()}
    assert all(judged[k]["kept"] for k in range(n_good))
    bad = [judged[k] for k in range(n_good, n_good + 60)]
    assert {r["rejected_by"] for r in bad if not r["base_failed"]} == {"symbols"}
    assert not any(r["kept"] for r in bad)
    kept = quality_rules.kept(table, labels)
    assert kept.columns == table.columns and kept.count() == n_good
    # too few labels certify nothing
    assert quality_rules.kept(table, labels.where("doc_id % 100 = 0")).count() == n_good + 60


def test_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.judge(odd, none).count() == odd.count()
    assert sorted(r["doc_id"] or -1 for r in quality_rules.kept(odd, none).collect()) == [-1, 4, 4, 5, 6]
    assert quality_rules.kept(odd.limit(0), none).count() == 0


def test_chunks_cover_the_text():
    for size in (0, 1, 63, 64, 511, 512, 513, 960, 961, 5000):
        text = bytes(k % 251 for k in range(size))
        cut = byte_cnn.chunks(text)
        step = byte_cnn.CHUNK - byte_cnn.OVERLAP
        joined = np.concatenate([cut[0], *[c[byte_cnn.OVERLAP:] for c in cut[1:]]])
        assert bytes(joined[:size].astype(np.uint8)) == text and (joined[size:] == byte_cnn.BLANK).all()
        assert len(cut) == 1 or (len(cut) - 1) * step + byte_cnn.OVERLAP < size


def test_gradients_equal_differences():
    net = byte_cnn.ByteCNN()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    texts = [byte_cnn.chunks(prose(k, n).encode()) for k, n in ((1, 5), (2, 300), (3, 90))]
    y, w = np.array([0, 1, 1.0]), np.array([1, 2, 1.0])

    def loss():
        total = 0
        for t, label, weight in zip(texts, y, w):
            act = np.tanh(net.pooled(t))
            z = act.mean(axis=0) @ net.p["mean"] + act.max(axis=0) @ net.p["peak"] + net.p["shift"][0]
            p = 1 / (1 + np.exp(-z))
            total -= weight * np.log(p if label else 1 - p)
        return total / w.sum()

    grad = net.gradients(texts, y, w)
    for name, at in (("bytes", (105, 2)), ("filters", (7, 3)), ("bias", (4,)), ("mean", (1,)),
                     ("peak", (2,)), ("shift", (0,))):
        net.p[name][at] += 1e-5
        up = loss()
        net.p[name][at] -= 2e-5
        down = loss()
        net.p[name][at] += 1e-5
        assert math.isclose((up - down) / 2e-5, grad[name][at], rel_tol=1e-2, abs_tol=1e-6)


def test_learns_and_scores_held_out(spark, docs, odd):
    texts = [prose(k, 60) if k % 3 else "## | ".join(prose(k, 60).split()) for k in range(300)]
    table = docs(texts)
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(300)], "doc_id long, quality int")
    net = byte_cnn.learn(table, labels)
    rows = byte_cnn.scored(table, net).collect()
    held = [r for r in rows if r["held_out"]]
    assert 30 < len(held) < 90
    assert np.mean([(r["score"] >= 0.3) == (r["doc_id"] % 3 > 0) for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in byte_cnn.scored(odd, net).collect())
    assert byte_cnn.scored(odd, net).count() == odd.count()
    blind = byte_cnn.learn(table, labels.limit(0))
    assert {r["score"] for r in byte_cnn.scored(table, blind).collect()} == {0.5}
