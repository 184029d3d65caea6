import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from lodestar.llm import kneser_ney, pii_boosting
from lodestar.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import prose
from tools.compare import canonical, connect

SF_DIR = "/root/testdata/sf0.001"


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    number = lambda m: re.sub("[^0-9]", "", m)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(number(m)) <= 19 and luhn(number(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(number(m)) <= 15)]
    return [(k, *m.span()) for k, p, ok in kinds for m in re.finditer(p, text or "") if ok(m[0])]


TRICKY = [
    None, "", "a@b.c_d@e.f@g.h", "x@y x@y.z. @a.b é%+-@1.2-3.x", "1.2.3.4.5.6.7.8 0000255.1.1.1 256.1.1.1 1.2.3",
    "4111 1111 1111 1111, 4111-1111-1111-1112 41111111111111110000 5500 0000 0000 0004 7", "+1 (017) 555-7713 ++49.30.123456",
    "+1 2 +123456789012345 +1234567890123456 +12345678", "日本 a@b.co \U0001f600 +1 (974) 555-3436", "9" * 5000, "a" * 5000 + "@",
    "1 " * 3000, "." * 3000 + "1.1.1.1", "+" * 50 + "12345678-9"]


def test_base_spans_equal_brute_force(docs):
    table = docs(TRICKY + [(3, TRICKY[3])])
    for r in pii_boosting.spans_by_document(table).collect():
        want = base_spans(TRICKY[r["doc_id"]])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest(), (r, text)
        assert [r[f"n_{k}"] for k in pii_boosting.BASE] == [
            sum(w[0] == k for w in want) for k in pii_boosting.BASE]
        assert r["spans"].startswith(text)


def test_trees_add_spans_that_look_alike(docs):
    texts = []
    for k in range(400):
        digits = f"{4000 + k}12345678{k % 1000:03d}"
        last = next(c for c in "0123456789" if luhn(digits + c))
        texts.append(f"{prose(k, 12)} card: {digits}{last} {prose(k + 1, 12)} id {k}-{k + 7}-2021 done")
    texts.append("the card: 4000123456780011 ends")
    assert not luhn("4000123456780011")
    rows = {r["doc_id"]: r for r in pii_boosting.spans_by_document(docs(texts)).collect()}
    assert rows[400]["n_card"] == 0 and rows[400]["spans"] in ("number:10:26", "token:10:26")
    kind = rows[400]["spans"].split(":")[0]
    assert all(kind not in rows[k]["spans"] for k in range(400))
    out = pii_boosting.redacted(docs(texts)).collect()
    assert next(r for r in out if r["doc_id"] == 400)["text"] == f"the card: <{kind}> ends"
    assert all(r["n_chars"] == len(r["text"]) for r in out)


def test_secrets_after_a_hint_are_added_and_failed_cards_are_not(docs):
    texts, secrets = [], {}
    for k in range(400):
        secret = hashlib.sha1(str(k).encode()).hexdigest()
        digits = f"{4000 + k}12345678{k % 1000:03d}"
        last = next(c for c in "0123456789" if luhn(digits + c) == (k % 2 == 0))
        before = f"{prose(k, 9)} of {digits}{last} for {prose(k + 1, 9)} token = \""
        secrets[k] = f"token:{len(before)}:{len(before) + 40}"
        texts.append(f'{before}{secret}" {prose(k + 2, 9)}')
    rows = {r["doc_id"]: r for r in pii_boosting.spans_by_document(docs(texts)).collect()}
    assert all(secrets[k] in rows[k]["spans"] for k in range(400))
    assert all(rows[k]["spans"] == secrets[k] for k in range(1, 400, 2))
    assert all(rows[k]["n_card"] == 1 for k in range(0, 400, 2))


def test_trees_beat_the_hint_list(docs):
    """Keys without a hint word are found by their format, part numbers after a hint word are left alone."""
    texts, secrets, hinted = [], {}, {}
    for k in range(600):
        secret = hashlib.sha1(str(k).encode()).hexdigest()
        part = f"part-{k % 9}-2021-{k:06d}-x{k % 7}"
        before = f"{prose(k, 9)} {'token' if k % 50 else 'so'} = \""
        middle = f"\" {prose(k + 1, 9)} {'secret' if k % 25 == 3 else 'of'} "
        texts.append(f"{before}{secret}{middle}{part} {prose(k + 2, 9)}")
        secrets[k] = {("token", len(before), len(before) + 40)}
        at = len(before) + 40 + len(middle)
        hinted[k] = (secrets[k] if k % 50 else set()) | ({("token", at, at + len(part))} if k % 25 == 3 else set())
    rows = pii_boosting.spans_by_document(docs(texts)).collect()
    found = {r["doc_id"]: {(s.split(":")[0], *map(int, s.split(":")[1:])) for s in r["spans"].split(",") if s}
             for r in rows}

    def wrong(spans):
        return sum(len(spans[k] ^ secrets[k]) for k in secrets)

    assert wrong(found) == 0 and wrong(hinted) == 12 + 24


def test_redaction_keeps_the_rest(docs, odd):
    texts = ["mail a@b.co now", "a@b.co", "x +1 (974) 555-3436", "plain", None, ""]
    out = pii_boosting.redacted(docs(texts))
    assert out.columns == docs(texts).columns
    assert [r["text"] for r in sorted(out.collect(), key=lambda r: r["doc_id"])] == [
        "mail <email> now", "<email>", "x <phone>", "plain", None, ""]
    assert sorted(map(repr, pii_boosting.redacted(odd).collect())) == sorted(map(repr, odd.collect()))
    assert pii_boosting.redacted(odd.limit(0)).count() == 0


def test_model_equals_brute_force(spark, docs, odd):
    texts = [" ".join(prose(k % 7, 30 + k).split()[:25 + k % 9]).upper() for k in range(120)] + [None, "", " \n"]
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    tokens = [[*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(lower)), b""] for t in texts]
    table = docs(texts)
    model = kneser_ney.learn(table.where(kneser_ney.in_training()))
    c, b = Counter(), Counter()
    for k, t in enumerate(tokens):
        if zlib.crc32(str(k).encode()) % 10:
            c.update(t)
            b.update(zip([None, *t[:-1]], t))
    n, v = sum(c.values()), len(c)
    high, kinds = kneser_ney.discounts_from(Counter(b.values())), Counter(w for _, w in b)
    low = kneser_ney.discounts_from(Counter(kinds.values()))
    unknown = sum(low[min(x, 3) - 1] for x in kinds.values()) / len(b) / (v + 1)
    after = defaultdict(list)
    for (first, _), x in b.items():
        after[first].append(x)

    def single(w):
        return unknown + (max(kinds[w] - low[min(kinds[w], 3) - 1], 0) / len(b) if w in kinds else 0)

    def p(first, w):
        if first not in after:
            return single(w)
        total, x = sum(after[first]), b.get((first, w), 0)
        back = sum(high[min(y, 3) - 1] for y in after[first]) / total
        return (x - high[min(x, 3) - 1] if x else 0) / total + back * single(w)

    for first in (None, tokens[0][0], b"never seen"):
        assert math.isclose(sum(p(first, w) for w in c) + p(first, b"never seen"), 1)
    for r in kneser_ney.scored(table, model).collect():
        t = tokens[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(w in c for w in t), n)
        assert math.isclose(r["score"], sum(math.log10(p(a, w)) for a, w in zip([None, *t[:-1]], t)), rel_tol=1e-9)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), rel_tol=1e-9)
    assert kneser_ney.scored(odd, model).count() == odd.count()
    empty = kneser_ney.learn(odd.limit(0))
    assert all(math.isfinite(r["score"]) for r in kneser_ney.scored(odd, empty).collect())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert canonical(got) == canonical(connect(SF_DIR).execute(ORACLE[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_returns_every_document(spark, name):
    want = {r["doc_id"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect()}
    assert {r["doc_id"] for r in QUERIES[name](spark, SF_DIR).select("doc_id").collect()} == want


def test_pipeline(spark, odd):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before, rows = docs, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_DIR)
        assert after.columns == docs.columns and after.count() <= rows
        before, rows = after, after.count()
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF_DIR).select("doc_id").collect()} == {
        r["doc_id"] for r in before.select("doc_id").collect()}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), SF_DIR).count() == 0
        stage(spark, odd, SF_DIR).count()


def test_tokens_of_odd_columns():
    texts = [None, "", "\x0b a B\x1fc\t", "A é É", " ", "x" * 9_000_000, "b a"]
    found = []
    for at, tokens in kneser_ney.tokenised(pa.array(texts)):
        ends = np.cumsum(tokens.sizes)
        assert at == len(found)
        found += [[tokens.kinds[c] for c in tokens.codes[b - n:b]] for b, n in zip(ends, tokens.sizes)]
    assert found == [[b""], [b""], [b"a", b"b\x1fc", b""], [b"a", "é É".encode(), b""], [b""],
                     [b"x" * 9_000_000, b""], [b"b", b"a", b""]]


def test_pairs_of_one_word_lie_in_several_shards():
    model = kneser_ney.Model("", [], pair_shards=100, fan=10)
    assert {model.shard_of(7, k) for k in range(1000)} == {7 + 10 * k for k in range(10)}
    several = model.shard_of(np.full(5, 95), np.arange(5))
    assert several.tolist() == [95, 5, 15, 25, 35]
