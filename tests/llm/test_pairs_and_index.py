import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from lodestar.llm import bitsliced_simhash as simhash
from lodestar.llm import positional_index
from lodestar.llm.components import components
from tests.llm.conftest import prose


def groups(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("m,octets,radius", [(1, 8, 2), (63, 8, 2), (130, 8, 20), (700, 8, 24), (90, 32, 100)])
def test_close_pairs(m, octets, radius):
    sigs = np.random.default_rng(m).integers(0, 256, (m, octets), np.uint8)
    sigs[m // 2:] = sigs[: m - m // 2] ^ (np.arange(m - m // 2)[:, None] % 3 == 0)
    got = {(int(i), int(j)) for a, b in simhash.close_pairs(sigs, radius) for i, j in zip(a, b)}
    bits = np.unpackbits(sigs, axis=1)
    want = {(i, j) for i in range(m) for j in range(i + 1, m) if (bits[i] != bits[j]).sum() <= radius}
    assert got == want


def test_fingerprint_is_the_majority_of_shingle_hashes(odd):
    for r in simhash.fingerprints(odd).collect():
        text = {1: "", 2: "", 3: "", 7: "é ß 日本 \U0001f600", 8: "x" * 5000}.get(r["id"])
        if text is None:
            continue
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        runs = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in runs]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert r["fp"] == f"{want:016x}"


@pytest.mark.parametrize("max_bucket", [1, 1 << 15])
def test_links_equal_brute_force(spark, max_bucket):
    rng = np.random.default_rng(3)
    values = [0, 2**64 - 1]
    for seed in rng.integers(0, 2**63, 12):
        near = int(seed)
        for _ in range(12):  # chains that stray by one or two bits a step
            near ^= sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(1, 4)))
            values.append(near)
    values = sorted(set(values))
    fps = spark.createDataFrame([(f"{v:016x}",) for v in values], "fp string")
    edges = simhash.fingerprint_links(fps, max_bucket).collect()
    at = {f"{v:016x}": k for k, v in enumerate(values)}
    got = groups(len(values), [(at[e["a"]], at[e["b"]]) for e in edges])
    want = groups(len(values), [(i, j) for i in range(len(values)) for j in range(i)
                                if (values[i] ^ values[j]).bit_count() <= 2])
    assert got == want


def test_components(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(50)] + [(5000, 5000), (None, 3)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    label = {r["node"]: r["label"] for r in rows}
    assert len({label[k] for k in range(301)}) == 1 == len({label[1000 + k] for k in range(50)})
    assert len(set(label.values())) == 2 and len(label) == len(rows)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_documents(odd):
    rows = {(r["id"], r["component_id"]) for r in simhash.fingerprint_components(odd).collect()}
    assert {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6)} <= rows and (None, None) in rows
    assert simhash.fingerprint_components(odd.limit(0)).count() == 0


@pytest.mark.parametrize("max_bucket", [1, 1 << 15])
def test_first_of_each_component(docs, odd, max_bucket):
    texts = []
    for k in range(60):  # exact copies, copies in capitals, and some changed words in long texts
        own = prose(100 + k % 40, 300 + 90 * k % 1500).split()
        texts += [" ".join(own), " ".join(own).upper(), " ".join("new" if w == 40 else x for w, x in enumerate(own))]
    texts += [None, "", " \n"]
    table = docs(texts)
    prints = {r["id"]: int(r["fp"], 16) for r in simhash.fingerprints(table).collect()}
    pairs = [(i, j) for i in prints for j in prints if j < i and (prints[i] ^ prints[j]).bit_count() <= 2]
    want = sorted(set(groups(len(texts), pairs)))
    kept = simhash.first_of_each_component(table, max_bucket=max_bucket)
    assert sorted(r["doc_id"] for r in kept.collect()) == want
    assert kept.columns == table.columns and len(want) < 180 - 60
    twice = simhash.first_of_each_component(table.unionAll(table), max_bucket=max_bucket)
    assert sorted(r["doc_id"] for r in twice.collect()) == want
    first = {r["doc_id"]: r for r in kept.collect()}
    assert all(first[k]["text"] == texts[k] for k in want)
    found = simhash.first_of_each_component(odd, max_bucket=max_bucket)
    assert found.columns == odd.columns and {1, 4, 6} <= {r["doc_id"] for r in found.collect()}
    assert simhash.first_of_each_component(odd.limit(0)).count() == 0


def test_links_stay_inside_their_bucket():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 1, 2, 3], pa.int64()), pa.array(list("abcd")),
                                        pa.array([b"\0" * 32] * 4)], names=["key", "id", "sig"])
    links = [x for out in simhash.linked_in_buckets(48)([batch]) for x in zip(*map(pa.Array.to_pylist, out.columns))]
    assert links == [("b", "a")]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items):
    out = {}
    for k, text in texts.items():
        own, hit, found = words(text), set(), set()
        for item, content in items:
            q = words(content)
            for s in range(max(1, len(q) - 9) if q else 0):
                window = q[s:s + 10]
                for at in range(len(own) - len(window) + 1):
                    if own[at:at + len(window)] == window:
                        hit.update(range(at, at + len(window)))
                        found.add(item)
        out[k] = (len(own), len(hit), len(found))
    return out


def brute_near(texts, items, repeated, slop=2):
    """Windows whose three rarest occurring terms stand near their places, but not the phrase."""
    corpus = Counter(w for text in [*texts.values(), repeated] for w in words(text))
    windows = {tuple(q[s:s + 10]) for _, content in items for q in [words(content)]
               for s in range(max(1, len(q) - 9) if q else 0)}
    out = Counter()
    for window in windows:
        terms = sorted((t for t in set(window) if corpus[t]), key=lambda t: (corpus[t], t))
        if len(terms) < min(3, len(set(window))) or len(terms) < len(set(window)) and len(terms) < 3:
            continue
        rare = [(t, window.index(t)) for t in terms[:3]]
        for k, text in texts.items():
            own = words(text)
            for pos, w in enumerate(own):
                start = pos - rare[0][1]
                if w != rare[0][0] or start < 0 or tuple(own[start:start + len(window)]) == window:
                    continue
                out[k] += all(t in own[max(start + o - slop, 0):start + o + slop + 1] for t, o in rare[1:])
    return out


def test_contamination_equals_brute_force(spark, docs):
    a, b = prose(1, 40), prose(2, 12)
    items = [(1, a), (2, b), (3, "Oak PINE"), (4, ""), (5, None), (6, "the the the the the the the the the the the"),
             (7, a[:200]), (11, "É ß-x"), (12, "the end")]
    texts = {0: prose(3, 50) + " " + a + " " + prose(4, 20), 1: b.upper() + "; " + b, 2: "oak, pine oak pine",
             3: None, 4: "", 5: "the " * 25, 6: "--É  ß/x!", 7: " ".join(a.split()[5:16]), 8: prose(3, 400),
             9: "the end", 10: " ".join(a.split()[:5] + ["new"] + a.split()[5:12])}
    items.append((8, " ".join("swapped" if k == 4 else w for k, w in enumerate(b.split()))))
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = docs(list(texts.items()) + [(0, texts[0])])
    rows = positional_index.contamination(table, bench).collect()
    want, near = brute(texts, items), brute_near(texts, items, texts[0])
    assert len(rows) == 12
    for r in rows:
        assert r["n_near"] == near[r["doc_id"]], r
        assert (r["n_words"], r["n_hit"], r["n_items"]) == want[r["doc_id"]], r
        assert r["contaminated"] == (r["n_hit"] > 0)
    assert near[10] > 2 and near[1] > 0  # a word put in; an item with a word that occurs nowhere
    clean = positional_index.clean(table, bench)
    assert clean.columns == table.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == [k for k in texts if not want[k][1]]
    assert positional_index.clean(table, bench.limit(0)).count() == 12
    assert positional_index.clean(table.limit(0), bench).count() == 0


def test_odd_rows_stay(spark, odd):
    bench = spark.createDataFrame([(1, prose(4, 30)), (None, prose(6, 30))], "item_id long, text string")
    assert sorted(r["doc_id"] or -1 for r in positional_index.clean(odd, bench).collect()) == [-1, 1, 2, 3, 6, 7, 8]
