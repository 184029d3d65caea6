"""Window packing, the filter audit and hard negatives, each against brute force."""

import random
import zlib
from collections import defaultdict
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestar.llm import filter_audit, hard_negatives, window_packing
from lodestar.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import prose
from tools.compare import canonical, connect

BPE = public_tokenizers.path("byte_bpe_50k.json")
SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op12_filter_audit", "op13_threshold_negatives"])
def test_query_equals_sql(spark, name):
    found = QUERIES[name](spark, SF_DIR).toPandas()
    assert len(found) and canonical(found) == canonical(connect(SF_DIR).execute(ORACLE[name]).df())


# ---- window packing

def padding(sequences, capacity):
    """Ids that padding adds: none at the capacity or a power of two."""
    return sum(capacity - n for n in sequences.values() if n & (n - 1) or n > capacity)


def check_packing(texts, rows, capacity, end_id=1):
    """Every id of every text lies in one piece, sequences have no gaps; gives their lengths."""
    encode = Tokenizer.from_file(BPE).encode
    wanted = defaultdict(list)
    for doc_id, text in texts:
        wanted[doc_id].append(encode(text or "", add_special_tokens=False).ids + [end_id])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert by_doc.keys() == wanted.keys()
    for doc_id, own in by_doc.items():
        left = sorted((r["doc_tokens"], r["start"], r["length"], r["ids_crc32"]) for r in own)
        for ids in sorted(wanted[doc_id], key=len):
            at = 0
            while at < len(ids):
                n, start, size, crc = next(x for x in left if x[:2] == (len(ids), at))
                assert size > 0 and crc == zlib.crc32(np.array(ids[at:at + size], "<u4").tobytes())
                left.remove((n, start, size, crc))
                at += size
            assert at == len(ids)
        assert not left
    sizes = {}
    for sequence, own in by_sequence.items():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        sizes[sequence] = at
    return sizes


def test_odd_texts_are_packed(spark, odd):
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    rows = window_packing.packed_windows(odd, BPE).collect()
    sizes = check_packing(texts, rows, 2048)
    assert padding(sizes, 2048) == 0  # one group: the last merge leaves powers of two
    assert window_packing.packed_windows(odd.limit(0), BPE).count() == 0


def test_rounds_end_and_padding_is_small(spark, docs):
    texts = [(k, prose(k, 1 + k * 37 % 90)) for k in range(300)] + [(7, prose(1, 500))]
    table = docs(texts).repartition(5)
    rows = window_packing.packed_windows(table, BPE, capacity=256, open_windows=2, group_windows=4).collect()
    sizes = check_packing(texts, rows, 256)
    assert padding(sizes, 256) < 0.02 * sum(sizes.values())
    assert max(r["sequence_id"] for r in rows) >> 56 >= 2  # several rounds
    assert not [r for r in rows if r["sequence_id"] >> 56 == 0 and r["doc_tokens"] <= 256
                and r["length"] < 8 and r["length"] != r["doc_tokens"]]


def test_the_fullest_window_leaves(spark):
    packer = window_packing.Packer(capacity=100, open_windows=2, least_piece=8)

    def place(name, size):
        item = window_packing.Window()
        item.add([window_packing.Piece(name, 0, np.arange(size, dtype="<u4"), size)])
        return [[(p.doc_id, p.start, len(p.ids)) for p in w.pieces] for w in packer.place(item)]

    assert place("a", 60) == [] and place("b", 50) == []
    assert place("c", 40) == [[("a", 0, 60), ("c", 0, 40)]]          # best fit, and full
    assert place("d", 95) == []
    # none has room for e: d's window leaves with 5 ids of padding, too few for a cut
    assert place("e", 70) == [[("d", 0, 95)]]
    assert place("f", 60) == [[("e", 0, 70), ("f", 0, 30)]]          # filled up by a cut
    assert [[(p.doc_id, p.start, len(p.ids)) for p in w.pieces] for w in packer.merged()] == [
        [("b", 0, 50), ("f", 30, 14)], [("f", 44, 16)]]              # 80 = 64 + 16
    assert place("g", 250) == [[("g", 0, 100)], [("g", 100, 100)]]


# ---- filter audit

def audit_by_hand(rows, labels):
    """All figures by walking every document through every order."""
    good = {i for i, q, t in labels if q == 1 and i is not None}
    toxic = {i for i, q, t in labels if t == 1 and i is not None}
    out = defaultdict(lambda: [0] * 6)
    for doc_id, text, lang in rows:
        text = text or ""
        words = [w for w in "".join("\x20" if c in "\t\n\v\f\r" else c for c in text).split("\x20") if w]
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": doc_id is not None and any(o is not None and o < doc_id and (t or "") == text for o, t, _ in rows)}
        for order in permutations("ABCDE"):
            alive = True
            for step, f in enumerate(order, 1):
                cell = out[lang or "", "".join(order), step]
                cell[0] += alive and not fails[f]
                cell[1] += alive and fails[f]
                cell[2] += not alive and fails[f]
                cell[3] += fails[f] and sum(fails.values()) == 1
                cell[4] += alive and fails[f] and doc_id in good
                cell[5] += alive and fails[f] and doc_id in toxic
                alive = alive and not fails[f]
    shapley = defaultdict(int)
    for (part, order, step), cell in out.items():
        shapley[part, order[step - 1]] += cell[1]
    return sorted((p, o, s, *map(int, cell), shapley[p, o[s - 1]]) for (p, o, s), cell in out.items())


def test_audit_equals_walking_each_document(spark):
    rng = random.Random(5)
    texts = [None, "", " \n", prose(1, 250), "x " * 300, "AB " + prose(2, 3), prose(3, 220) + " 5%",
             "A" * 50 + " | " + "y " * 250, "é ß " * 150, prose(4, 3000)]
    rows = [(rng.choice([None, *range(12)]), rng.choice(texts), rng.choice(["en", "de", None, ""]), k)
            for k in range(90)]
    rows += [rows[0], rows[0]]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(8)] + [
        (3, 1, 1), (3, 0, 0), (None, 1, 1), (99, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, mask int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filter_audit.audit(docs, marks)
    wanted = audit_by_hand([r[:3] for r in rows], labels)
    assert sorted(tuple(r) for r in found.collect()) == wanted
    assert found.columns == ["part", "filter_order", "step", *filter_audit.COUNTS, "shapley"]
    assert filter_audit.audit(docs.limit(0), marks).count() == 0
    alone = filter_audit.audit(docs, marks.limit(0))
    assert alone.count() == 120 * 5 * 3
    assert alone.agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0


# ---- hard negatives

def negatives_by_hand(rows, is_anchor):
    one = {}
    for i, label, v in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1], r[2])):
        one.setdefault(i, (label, v))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (label, v) in one.items():
        if not is_anchor(a):
            continue
        scored = sorted((-dot(v, w), i, other) for i, (other, w) in one.items() if i != a)
        for s, i, _ in [x for x in scored if x[2] == label][:5]:
            inside = [x for x in scored if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s]
            out += [(a, i, k, j, -s, -t) for k, (t, j, _) in enumerate(inside[:5], 1)]
    return sorted(out)


@pytest.mark.parametrize("case", ["random", "ties", "one label", "few values"])
def test_negatives_equal_all_pairs(spark, case):
    rng = random.Random(case)
    spread = {"random": 200, "ties": 2, "one label": 50, "few values": 1}[case]
    rows = [(k, rng.randrange(1 if case == "one label" else 3),
             [rng.randint(-spread, spread) for _ in range(rng.choice([3, 6]))]) for k in range(400)]
    rows += [(1000 + k, 1, [spread, 0, spread]) for k in range(300)]  # a common vector
    rows += [rows[0], rows[10], (10, 2, [9]), (500, 0, []), (510, 1, [0, 0, 0])]
    table = spark.createDataFrame(rows, "vec_id long, label long, v array<int>")
    found = hard_negatives.mined(table.dropDuplicates().groupBy("vec_id").agg(
        F.min(F.struct("label", "v")).alias("o")).select("vec_id", "o.*"), F.col("vec_id") % 10 == 0, block_rows=64)
    wanted = negatives_by_hand(rows, lambda a: a % 10 == 0)
    assert sorted(tuple(r) for r in found.collect()) == wanted
    if case != "one label":
        assert wanted


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 0, [0.5, -0.001]), (2, None, [1.0]), (3, 1, None), (4, 1, [1.0, None]), (5, 1, [nan]),
            (6, 1, [inf, 1.0]), (None, 1, [1.0]), (7, 2, [0.25]), (7, 2, [0.25]), (7, 3, [0.1]), (8, 0, []),
            (9, 0, [1e30, -1e30])]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("v", F.lit(1))
    found = hard_negatives.usable(table, F.col("label"))
    most = hard_negatives.LARGEST
    assert sorted(tuple(r) for r in found.collect()) == [
        (1, 0, [128, -1]), (7, 2, [64]), (8, 0, []), (9, 0, [most, -most])]
    assert hard_negatives.mined(found.limit(0), F.col("vec_id") % 7 == 0).count() == 0


def test_the_search_stops_early(spark):
    """Far from an anchor nothing is scored: the threshold falls below the kth score first."""
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, 5, (20_000, 4)).astype(np.int64)
    vectors[:50] += 200
    block = hard_negatives.Block(np.arange(20_000), np.arange(20_000) % 2, vectors)
    span = hard_negatives.Span(-(1 << 62), 1 << 62)
    (places,), score = block.best(vectors[0], 0, 0, True, [span], 5)
    exact = vectors @ vectors[0]
    own = [k for k in range(2, 20_000, 2)]
    assert places.tolist() == sorted(own, key=lambda k: (-exact[k], k))[:5]
    assert np.count_nonzero(score) < 2_000
