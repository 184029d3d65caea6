import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestar.llm import external_shuffle, queries, residual_packing, url_automaton, warc_writer
from tests.llm.conftest import prose

SF_DIR = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, range int")


def test_archives_round_trip(spark):
    big = "<p>" + prose(1, 40_000) + "</p>"
    texts = {1: big, 2: "x" * 100, 3: "x" * 100, 4: "x" * 99, 5: "x" * 99, 6: None, 7: "", 8: "é\r\n\r\n " * 40,
             9: "x" * 100, 12: prose(3, 90)}
    table = pages(spark, [(k, "http://a/é b\r\nc" if k == 2 else None if k == 3 else f"http://h/{k}", t, "d", 1)
                          for k, t in texts.items()] + [(None, "u", "x" * 100, "d", 1), (12, "v", prose(3, 90), "d", 1)])
    folder, manifest = warc_writer.write_warc(table, roll_bytes=2000)
    files = manifest.collect()
    assert len(files) > 1 and sum(f["records"] for f in files) == 12
    assert sorted(os.listdir(folder.removeprefix("file:"))) == sorted(f["name"] for f in files)
    rows = warc_writer.read_warc(folder, manifest, with_payload=True).collect()
    assert len(rows) == 12
    for r in rows:
        text = texts[r["page_id"]] if r["page_id"] else "x" * 100
        assert r["payload_bytes"] == len((text or "").encode())
        if r["page_id"] in (3, 9, None):
            assert (r["record_type"], r["refers_to"], r["payload"]) == ("revisit", 2, None)
        else:
            assert (r["record_type"], r["refers_to"]) == ("response", None)
            assert r["payload"].decode() == (text or "")
    again = warc_writer.write_warc(table.repartition(5), roll_bytes=2000)[1]
    assert {tuple(f) for f in again.collect()} == {tuple(f) for f in files}
    folder, none = warc_writer.write_warc(table.limit(0))
    assert warc_writer.read_warc(folder, none).count() == 0


def test_ranges_follow_bytes_and_not_ids(spark):
    far = [(k, "u", prose(k % 150, 60), "d", 1) for k in range(300)] + [(2**62, "u", prose(7, 60), "d", 1)]
    far += [(None, f"v{k}", prose(k % 40, 60), "d", 1) for k in range(80)] + [(5, "w", "z" * 300, "d", 1)] * 3
    table = pages(spark, far)
    folder, manifest = warc_writer.write_warc(table, range_bytes=10_000)
    files = manifest.collect()
    assert 15 < len(files) < 30 and max(f["records"] for f in files) < 40
    first = {}
    for page, _, text, *_ in far:
        if page is not None:
            first[text] = min(page, first.get(text, page))
    want = Counter((page, len(text), None if page == first[text] else first[text]) for page, _, text, *_ in far)
    rows = warc_writer.read_warc(folder, manifest).collect()
    assert Counter((r["page_id"], r["payload_bytes"], r["refers_to"]) for r in rows) == want
    # a table that is dealt otherwise gives the same files
    other = warc_writer.write_warc(table.repartition(7, "html"), range_bytes=10_000)[1]
    assert {tuple(f) for f in other.collect()} == {tuple(f) for f in files}
    keys = spark.createDataFrame([(k, bytes([k]), 1, 10) for k in range(50)],
                                 "page_id long, digest binary, n long, size long")
    assert len(warc_writer._bounds(keys, 1, most=8)) == 7


def test_damage_is_found(spark):
    member = warc_writer.record(1, "http://a/", b"payload", None)
    import io
    import zlib
    whole = next(warc_writer.members(io.BytesIO(member)))
    assert warc_writer.parsed(whole)[2] == b"payload"
    for bad in (whole.replace(b"payload\r", b"pAyload\r"), whole[:-5]):
        try:
            warc_writer.parsed(bad)
        except ValueError:
            continue
        raise AssertionError("damage not found")
    try:
        list(warc_writer.members(io.BytesIO(member[:-9])))
    except (ValueError, zlib.error):
        return
    raise AssertionError("a cut file was read")


def test_shuffle_is_a_permutation_in_equal_shards(docs, odd):
    crowd = [(77, "same")] * 3000
    for table, buckets in ((docs([prose(k, 30) for k in range(500)] + crowd), 4000), (odd, 1 << 20)):
        out = external_shuffle.write_shuffled(table, 7, bucket_bytes=buckets)
        assert out.columns == [*table.columns, "slot_", "shard_"]
        rows = out.collect()
        assert Counter(tuple(r)[:3] for r in rows) == Counter(tuple(r)[:3] for r in table.collect())
        sizes = Counter(r["shard_"] for r in rows)
        assert max(sizes.values()) - min(sizes[s] for s in range(7)) <= 1
        for s in sizes:
            assert sorted(r["slot_"] for r in rows if r["shard_"] == s) == list(range(sizes[s]))
    assert external_shuffle.write_shuffled(odd.limit(0), 7).count() == 0


def test_a_bucket_is_a_task_of_its_own(docs):
    table = docs([prose(k, 30) for k in range(300)]).select("doc_id", "text")
    digests = table.groupBy(F.xxhash64("doc_id", "text").alias("d")).agg(F.count("*").alias("n"))
    dealt = external_shuffle._scatter(table, digests, 40, 1).repartitionById(40, "bucket")
    held = dealt.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("bucket").alias("n")).collect()
    assert len(held) == 40 and {r["n"] for r in held} == {1}


def test_fixed_columns_of_the_shuffle(spark):
    import duckdb
    want = duckdb.sql(f"select doc_id, strlen(coalesce(text, '')) + 8, coalesce(text, '') "
                      f"from '{SF_DIR}/documents.parquet'").fetchall()
    rows = queries.op5_external_shuffle(spark, SF_DIR).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in rows) == Counter(
        (doc, size, zlib.crc32(text.encode()), "rows", None) for doc, size, text in want)


def test_shuffle_mixes(docs):
    rows = external_shuffle.write_shuffled(docs([prose(k, 30) for k in range(2000)]).drop("slot", "shard"), 4,
                                           bucket_bytes=60_000).collect()
    place = {r["doc_id"]: r["shard"] * 500 + r["slot"] for r in rows}
    assert abs(np.corrcoef(range(2000), [place[k] for k in range(2000)])[0, 1]) < 0.1
    low = Counter(place[k] // 500 for k in range(500))
    assert all(85 < low[s] < 165 for s in range(4))


def test_automaton_equals_regular_expressions():
    rng = random.Random(5)
    part = lambda: "".join(rng.choice(["a", "b", "/", ".", "*", "**", "?", "é"]) for _ in range(rng.randint(0, 9)))
    globs = [part() for _ in range(60)] + ["**", "*", "", "ab" * 40]
    texts = ["".join(rng.choice("ab/.é\n") for _ in range(rng.randint(0, 12))) for _ in range(300)] + ["ab" * 40, ""]
    found = url_automaton.Automaton(globs).matches([t.encode() for t in texts])

    def pattern(glob):
        table = {b"**": b"(?s:.*)", b"*": b"[^/]*", b"?": b"[^/]"}
        return re.compile(b"".join(table.get(x, re.escape(x)) for x in re.findall(
            rb"(?s)\*\*|.", glob.encode())), re.S)
    for k, glob in enumerate(globs):
        want = [pattern(glob).fullmatch(t.encode()) is not None for t in texts]
        assert found[:, k].tolist() == want, glob


def test_urls(spark):
    rules = [url_automaton.host_rule("com", "/", False), url_automaton.host_rule("example.com", "/en/", True),
             url_automaton.Rule("*.ads-*/**", True)]
    cases = {"http://Example.COM/en/x?y": ("example.com", "/en/x", "example.com/en/", "block"),
             "https://a.example.com/fr": ("a.example.com", "/fr", "com/", "allow"),
             "http://notexample.org/": ("notexample.org", "/", None, "allow"),
             "http://evil.org/.example.com/en/": ("evil.org", "/.example.com/en/", None, "allow"),
             "http://x.ads-y.net/p": ("x.ads-y.net", "/p", None, "block"),
             "http://com": ("com", "", None, "allow"), "no scheme": ("", "", None, "allow"),
             "": ("", "", None, "allow"), None: ("", "", None, "allow"),
             "http://É.com/" + "é" * 4000 + "#z": ("É.com", "/" + "é" * 4000, "com/", "allow")}
    table = spark.createDataFrame([(k, u, "h") for k, u in enumerate([*cases, *cases])],
                                  "page_id long, url string, host string")
    rows = url_automaton.judge(table, rules).collect()
    urls = [*cases, *cases]
    assert len(rows) == len(urls)
    for r in rows:
        assert tuple(r)[1:] == cases[urls[r["id"]]]
    assert url_automaton.judge(table.limit(0), rules).count() == 0


def test_encoder_equals_tokenizer():
    encode, plain = residual_packing.WordCachedEncoder(BPE), Tokenizer.from_file(BPE)
    rng = random.Random(2)
    texts = ["", " ", "  a", "a  b ", "a\n b", "a \n b\n", "x<|endoftext|> y <|endoftext|>", "it's 'll, don't.",
             "　a  b\x1c c\xa0 d", "a, b. c,, d., e,", "é, 日本. 5, ²."]
    texts += ["".join(rng.choice("ab ,.\n'sé5\t ") for _ in range(60)) for _ in range(400)]
    for text in texts + texts:
        want = np.array(plain.encode(text, add_special_tokens=False).ids, np.uint32)
        assert np.frombuffer(encode(text), np.uint32).tolist() == want.tolist(), text


def test_best_fit():
    for seed, low, high in ((0, 1, 2048), (1, 1100, 2048), (2, 1, 90), (3, 683, 1024)):
        sizes = np.random.default_rng(seed).integers(low, high, 3000)
        head, offset, fill = residual_packing.best_fit(sizes, 2048)
        total = np.bincount(head, sizes, len(sizes)).astype(int)
        assert total.max() <= 2048 and (total[head] == fill).all()
        spans = sorted(zip(head.tolist(), offset.tolist(), sizes.tolist()))
        for (h1, o1, s1), (h2, o2, _) in zip(spans, spans[1:]):
            assert o2 == (o1 + s1 if h1 == h2 else 0)
        assert (total > 0).sum() <= 1.23 * -(-sizes.sum() // 2048) or low > 1024


def test_a_group_is_a_task_of_its_own(spark):
    live = spark.range(5000).select(F.col("id").alias("bin"), F.lit(7).cast("long").alias("fill"))
    held = residual_packing.dealt(live, 50, 3).groupBy(F.spark_partition_id().alias("task")).agg(
        F.count_distinct("_g").alias("groups"), F.count("*").alias("n")).collect()
    assert len(held) == 50 and {r["groups"] for r in held} == {1} and max(r["n"] for r in held) < 150


def test_packed_ids_have_their_checksums(docs, odd):
    table = docs([(1000 + k, prose(k, 40 + k * 37 % 900)) for k in range(60)]).unionAll(odd)
    rows = residual_packing.packed_sequences(table, BPE, 512, with_ids=True).collect()
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())


def test_packing_places_every_piece(docs, odd):
    table = docs([(1000 + k, prose(k, 40 + k * 37 % 900)) for k in range(300)]).unionAll(odd)
    cut = residual_packing.pieces(table, BPE, 512, with_ids=True)
    for group_rows in (40, 1 << 16):
        rows = residual_packing.placed(cut, 512, group_rows).collect()
        assert len(rows) == cut.count() == len({r["uid"] for r in rows})
        bins = {}
        for r in rows:
            assert len(r["ids"]) == r["length"] <= 512
            bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for spans in bins.values():
            at = 0
            for offset, length in sorted(spans):
                assert offset == at
                at += length
            assert at <= 512
        least = -(-sum(r["length"] for r in rows) // 512)
        assert len(bins) <= 1.03 * least + 2
    plain = Tokenizer.from_file(BPE)
    for doc, text in ((1, ""), (6, prose(6, 30_000)), (7, "é ß 日本 \U0001f600"), (1005, prose(5, 40 + 5 * 37))):
        own = sorted((r["start"], r["piece"], r["ids"]) for r in rows if r["doc_id"] == doc)
        whole = plain.encode(text, add_special_tokens=False).ids + [0]
        assert [i for _, _, ids in own for i in ids] == whole
        assert [k for _, k, _ in own] == list(range(len(own)))
        assert all(len(ids) == 512 for _, _, ids in own[1:])
    assert residual_packing.packed_sequences(odd.limit(0), BPE).count() == 0
