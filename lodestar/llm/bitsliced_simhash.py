"""SimHash near-duplicates compared bit by bit over many documents at once.

Signatures of a block are stored vertically: one row of packed bits per signature bit. The
distances of a query to all members are counters, also stored as bit planes, to which each
plane's disagreements are added with carry-save logic. A counter starts so that it overflows
when the distance exceeds the radius; members whose 64-bit word has overflowed for all queries
are abandoned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import salted_join
from .common import ASCII_LOWER, mixed, packed, stored, text_bytes
from .components import components

SEED = 42
SHINGLES_AT_ONCE = 1 << 16
BLOCK_ROWS = 512
MAX_BUCKET = 1 << 15
FULL = np.uint64(2**64 - 1)


def shingle_hashes(words: list[bytes], width: int) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``width`` words, repeats included, in pieces of bounded size."""
    if not words:
        return
    if len(words) < width:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
        return
    for at in range(0, len(words) - width + 1, SHINGLES_AT_ONCE):
        part = words[at: at + SHINGLES_AT_ONCE + width - 1]
        runs = map(b" ".join, zip(*(part[i:] for i in range(width))))
        n = len(part) - width + 1
        yield np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), np.uint64, n)


def signature(words: list[bytes], width: int, lanes: int = 1) -> np.ndarray:
    """``lanes`` x 64 bits; a bit is set if it is set in over half of the shingle hashes.

    The first lane takes the hashes as they are, the others mixes of them. No words: all zero.
    """
    counts, total = np.zeros(64 * lanes, np.int64), 0
    for hashes in shingle_hashes(words, width):
        lane = [hashes] + [mixed(hashes, k) for k in range(1, lanes)]
        # the most significant bit first
        octets = np.stack(lane, axis=1).astype(">u8").view(np.uint8).reshape(len(hashes), -1)
        counts += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return np.packbits(2 * counts > total)


def close_pairs(signatures: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j), i < j, of signatures (rows of octets) at ``radius`` bits or fewer.

    Yields pairs of a few queries at a time, so memory stays bounded for dense blocks.
    """
    m = len(signatures)
    bits = np.unpackbits(signatures, axis=1)
    words = -(-m // 64)
    padded = np.zeros((bits.shape[1], words * 64), np.uint8)
    padded[:, :m] = bits.T
    planes = np.packbits(padded, axis=1, bitorder="little").view(np.uint64)
    padding = np.ones(words * 64, np.uint8)
    padding[:m] = 0
    outside = np.packbits(padding, bitorder="little").view(np.uint64)
    width = (radius + 1).bit_length()
    start = (1 << width) - 1 - radius
    rows = max(64, min(512, (1 << 21) // m))
    for low in range(0, m, rows):
        query = bits[low: low + rows].astype(np.uint64) * FULL
        first = low // 64  # earlier members have had their turn as queries
        kept = np.arange(first, words)
        over = np.repeat(outside[None, first:], len(query), axis=0)
        counter = [np.full(over.shape, FULL if start >> k & 1 else 0, np.uint64)
                   for k in range(width)]
        for b in range(bits.shape[1]):
            carry = planes[b][kept][None, :] ^ query[:, b][:, None]
            for k in range(width):
                counter[k], carry = counter[k] ^ carry, counter[k] & carry
            over |= carry
            if b > radius and b % 4 == 3:
                alive = ~(over == FULL).all(axis=0)
                if not alive.all():
                    kept, over = kept[alive], over[:, alive]
                    counter = [c[:, alive] for c in counter]
                if not len(kept):
                    break
        if len(kept):
            near = np.unpackbits(np.ascontiguousarray(~over).view(np.uint8), axis=1,
                                 bitorder="little")
            i, at = np.nonzero(near)
            i, j = i + low, kept[at // 64] * 64 + at % 64
            yield i[i < j], j[i < j]


def join_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merges, in ``label`` itself, the groups of positions i and j; labels are smallest members."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def linked_in_buckets(radius: int):
    """Function for mapInArrow over (key, id, sig) sorted by key: links that join each bucket.

    Only a spanning forest of a block's pairs leaves it, so a group of m near copies gives
    m - 1 links and not their square. Small buckets share a block, but only members of one are linked.
    """
    def links(batches):
        keys, ids, sigs = np.empty(0, np.int64), np.empty(0, object), np.empty((0, 0), np.uint8)
        waiting, n = [], 0
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                n += batch.num_rows
            if n >= 8 * BLOCK_ROWS:
                keys, ids, sigs = _gathered(keys, ids, sigs, waiting)
                waiting, n, ends = [], 0, _ends(keys)
                done = ends[-2] if len(ends) > 1 else 0
                yield from _forests(keys[:done], ids[:done], sigs[:done], radius)
                keys, ids, sigs = keys[done:], ids[done:], sigs[done:]
        keys, ids, sigs = _gathered(keys, ids, sigs, waiting)
        yield from _forests(keys, ids, sigs, radius)

    return links


def _gathered(keys, ids, sigs, batches):
    if not batches:
        return keys, ids, sigs
    table = pa.Table.from_batches(batches)
    octets = np.frombuffer(b"".join(table.column(2).to_pylist()), np.uint8)
    octets = octets.reshape(table.num_rows, -1)
    return (np.concatenate([keys, table.column(0).to_numpy()]),
            np.concatenate([ids, np.array(table.column(1).to_pylist(), object)]),
            np.concatenate([sigs, octets]) if len(sigs) else octets)


def _ends(keys: np.ndarray) -> np.ndarray:
    return np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys))


def _forests(keys, ids, sigs, radius):
    ends, at = _ends(keys), 0
    while at < len(keys):
        full = np.searchsorted(ends, at + BLOCK_ROWS, "right") - 1
        to = ends[max(full, np.searchsorted(ends, at, "right"))]
        label = np.arange(to - at)
        for i, j in close_pairs(sigs[at:to], radius):
            same = keys[at + i] == keys[at + j]
            join_labels(label, i[same], j[same])
        hung = np.flatnonzero(label != np.arange(to - at))
        if len(hung):
            block = ids[at:to]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[hung].tolist(), pa.string()),
                 pa.array(block[label[hung]].tolist(), pa.string())], names=["a", "b"])
        at = to


def _bucket_links(keyed: DataFrame, radius: int) -> DataFrame:
    return (keyed.repartition("key").sortWithinPartitions("key")
            .mapInArrow(linked_in_buckets(radius), "a string, b string"))


def _hot_keys(keyed: DataFrame, max_bucket: int) -> DataFrame:
    return stored(keyed.groupBy("key").agg(F.count("*").alias("members"))
                  .where(F.col("members") > max_bucket), "hot-buckets")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = 3) -> DataFrame:
    """(id, fp): 16 hex digits for each row of ``docs``, over lower-cased words between blanks.

    Null and blank texts have the fingerprint zero.
    """
    def run(batches):
        for batch in batches:
            found = [signature(text.translate(ASCII_LOWER).split(), width).tobytes().hex()
                     for text in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.string())], names=["id", "fp"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, f"id {slim.schema['id'].dataType.simpleString()}, fp string")


def fingerprint_links(fps: DataFrame, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints differing in two bits or fewer.

    ``fps`` has one row per fingerprint (fp). Of four 16-bit quarters at least two are equal
    in such a pair, so the six pairs of quarters are bucket keys. A bucket above ``max_bucket``
    is not compared: its members meet at the fingerprints that differ from them in at most one
    bit (two members do if and only if they differ in two at most), where at most 65 can meet.
    """
    high, low = _half("fp", 1), _half("fp", 9)
    quarters = [F.shiftright(high, 16), high.bitwiseAND(0xFFFF),
                F.shiftright(low, 16), low.bitwiseAND(0xFFFF)]
    keys = [F.lit(t << 32) + F.shiftleft(quarters[i], 16) + quarters[j]
            for t, (i, j) in enumerate(combinations(range(4), 2))]
    keyed = fps.select(F.explode(F.array(*keys)).alias("key"), F.col("fp").alias("id"),
                       F.unhex("fp").alias("sig"))
    hot = _hot_keys(keyed, max_bucket)
    if hot.isEmpty():
        return _bucket_links(keyed, 2)
    crowd = keyed.join(hot, "key", "left_semi").select("id").distinct()
    return _bucket_links(keyed.join(hot, "key", "left_anti"), 2).unionAll(_meetings(crowd))


def _half(fp: str, at: int):
    return F.conv(F.substring(fp, at, 8), 16, 10).cast("long")


def _meetings(crowd: DataFrame) -> DataFrame:
    """Links of fingerprints (id) that have a neighbour at one bit or fewer in common."""
    own = crowd.select("id", _half("id", 1).alias("h"), _half("id", 9).alias("l"))
    meets = F.expr("""explode(concat(array(struct(h, l)),
        transform(sequence(0, 31), k -> struct(h ^ shiftleft(1L, k) as h, l)),
        transform(sequence(0, 31), k -> struct(h, l ^ shiftleft(1L, k) as l))))""")
    groups = own.select("id", meets.alias("at")).groupBy("at").agg(
        F.min("id").alias("a"), F.collect_set("id").alias("members"))
    return groups.select("a", F.explode("members").alias("b")).where("a <> b")


def fingerprint_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(id, fingerprint, component_id) per row of ``docs``.

    component_id is the smallest id reachable over links of two bits or fewer, the row's own
    included; null ids are passed over (null if a component has no other). Rows that repeat an id
    each have a row.
    """
    fps = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = stored(fps.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    groups = components(fingerprint_links(distinct.select("fp"), max_bucket))
    labelled = distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label"))
    least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    found = stored(labelled.join(least, "label").select("fp", "component_id"), "components")
    return salted_join(fps, found, ["fp"], min_rows=4096, spread_by=["id"]).select(
        "id", F.col("fp").alias("fingerprint"), "component_id")


def first_of_each_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                            max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Rows of ``docs`` without near copies: of each component the row with the smallest id stays.

    Components are those of ``fingerprint_components``: shingles of three words, two bits. Null ids come last;
    of rows that share an id the one with the smallest hash of its text is first, and identical rows leave
    one row. Texts without words (null, empty, blank) have the fingerprint zero and are linked like any others.
    An empty table gives an empty one.
    """
    place = F.struct(F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"))
    found = fingerprint_components(docs.select(place.alias("place"), F.col(text_col).alias("text")),
                                   "place", "text", max_bucket)
    first = F.col("component_id")
    staying = found.select(_never_null(first["id"]).alias("_id"), first["h"].alias("_h")).distinct()
    rows = packed(docs, _id=_never_null(F.col(id_col)), _h=F.xxhash64(text_col))
    order = Window.partitionBy("_id", "_h").orderBy(F.lit(0))
    # the same join at every size; the numbering uses its partitions, so texts are moved once
    return (rows.join(staying.hint("merge"), ["_id", "_h"], "left_semi")
            .withColumn("_n", F.row_number().over(order)).where("_n = 1").select("_row.*"))


def _never_null(value: Column) -> Column:
    return F.coalesce(F.concat(F.lit("i"), value.cast("string")), F.lit(""))
