"""WARC archives from a table of pages: sorted, rolled by size, committed by rename and manifest.

Records are ordered by page id and payload digest. That order is cut wherever another RANGE_BYTES of payload
are full, whatever gaps the ids have, so the same table always gives the same files. What a record refers to
is found on ids and digests alone and travels beside the records, so a payload moves once. A task writes
one range in order, one gzip member per record, to a temporary name, and renames each file when it is
complete; a task that runs again writes the same bytes to the same names. Files count only if the manifest,
written when all are done, lists them.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from bisect import bisect_right
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import salted_join
from ..session import scratch_path
from .common import stored, text_bytes

ROLL_BYTES = 32 << 20
RANGE_BYTES = 32 << 20
MOST_RANGES = 1 << 16  # beyond 2 TB of payload ranges grow instead, so their bounds stay a few MB
KEYS_AT_ONCE = 1 << 22  # keys that one task puts in order to add up their bytes
LEAST_HOT = 1 << 12
ROW_BYTES = 64
LEAST_SHARED = 100  # smaller payloads are stored again rather than referred to
DATE = "2024-01-01T00:00:00Z"
READ_AT_ONCE = 1 << 20
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
           date: str = DATE) -> bytes:
    """One WARC record, with its headers and digests made from the payload, as a gzip member."""
    digest = hashlib.sha256(payload).hexdigest()
    kind = "response" if refers_to is None else "revisit"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" \
            b"Content-Length: %d\r\n\r\n" % len(payload)
    if refers_to is None:
        block += payload
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Target-URI: {quote(url, safe=_URL_CHARS) if url else f'urn:page:{page_id}'}",
        f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"X-Payload-Length: {len(payload)}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: {_record_id(refers_to, digest)}",
                 f"X-Refers-To-Page: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(whole) + packer.flush()


_URL_CHARS = ":/?#[]@!$&'()*+,;=%-._~"


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


class RollingFile:
    """Files ``<name>-<number>.warc.gz`` of about ``roll_bytes``, visible only when complete."""

    def __init__(self, folder: str, name: str, roll_bytes: int):
        self._fs, self._folder = fs.FileSystem.from_uri(folder)
        self._name, self._roll, self._number = name, roll_bytes, 0
        self._out = self._hash = None
        self._bytes = self._records = 0

    def add(self, member: bytes):
        """Writes one record; yields the manifest entry of a file that it completes."""
        if self._out is None:
            self._temporary = f"{self._folder}/{self._name}-{uuid.uuid4().hex}.open"
            self._out, self._hash = self._fs.open_output_stream(self._temporary, compression=None), hashlib.sha256()
            self._bytes = self._records = 0
        self._out.write(member)
        self._hash.update(member)
        self._bytes += len(member)
        self._records += 1
        if self._bytes >= self._roll:
            yield from self.close()

    def close(self):
        if self._out is not None:
            self._out.close()
            self._out = None
            final = f"{self._name}-{self._number:05d}.warc.gz"
            self._fs.move(self._temporary, f"{self._folder}/{final}")
            self._number += 1
            yield final, self._records, self._bytes, self._hash.hexdigest()


def _bounds(keys: DataFrame, range_bytes: int = RANGE_BYTES, most: int = MOST_RANGES) -> list[tuple]:
    """The least (page_id, digest) of every range but the first, in order; at most ``most`` ranges.

    A key belongs to the range in which the bytes before it end. Bytes before a key are those of the
    parts before its part, which are as many rows as there are parts, and those before it in its part.
    Where parts are cut does not change the sums.
    """
    weighed = keys.select("page_id", "digest", (F.col("n") * (F.col("size") + ROW_BYTES)).alias("bytes"))
    count, total = weighed.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    width = max(range_bytes, -(-total // most))
    parted = stored(weighed.repartitionByRange(count // KEYS_AT_ONCE + 1, "page_id", "digest")
                    .withColumn("part", F.spark_partition_id()), "keys-in-parts")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parted.groupBy("part").agg(F.sum("bytes").alias("bytes")).select(
        "part", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("part").orderBy("page_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    upto = parted.withColumn("upto", F.coalesce(F.sum("bytes").over(inside), F.lit(0))).join(
        F.broadcast(starts), "part").withColumn("range", F.expr(f"(start + upto) div {width}L"))
    # an id and a digest order like the struct of both, in which a null id comes first
    least = upto.groupBy("range").agg(F.min(F.struct("page_id", "digest")).alias("key"))
    rows = least.select("key.page_id", "key.digest").collect()  # one per range
    return sorted(_ordered(r["page_id"], bytes(r["digest"])) for r in rows)[1:]


def _ordered(page_id: int | None, digest: bytes) -> tuple:
    return page_id is not None, page_id or 0, digest


def _range_of(bounds: list[tuple]):
    """Column function: the number of the range that holds (page_id, digest)."""
    @F.arrow_udf("int")
    def found(page_ids: pa.Array, digests: pa.Array) -> pa.Array:
        keys = zip(page_ids.to_pylist(), digests.to_pylist())
        return pa.array([bisect_right(bounds, _ordered(*key)) for key in keys], pa.int32())
    return found


def _links(keys: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) for every key that revisits a page with an equal payload."""
    shared = keys.where(f"size >= {LEAST_SHARED}")
    first = (shared.groupBy("digest").agg(F.count("*").alias("pages"), F.min("page_id").alias("refers_to"))
             .where("pages > 1").drop("pages"))
    return (salted_join(shared.select("page_id", "digest"), first, ["digest"], min_rows=LEAST_HOT,
                        spread_by=["page_id"])
            .where(~F.col("refers_to").eqNullSafe(F.col("page_id"))).select("page_id", "digest", "refers_to"))


def write_warc(pages: DataFrame, roll_bytes: int = ROLL_BYTES,
               range_bytes: int = RANGE_BYTES) -> tuple[str, DataFrame]:
    """Archives ``pages`` (page_id, url, html); returns the folder and the manifest.

    The manifest has name, records, bytes and sha256 of every file. Of records with equal payloads of
    at least LEAST_SHARED bytes the one with the smallest page_id is a response (every row with that
    page_id, if it repeats), the others revisit it. Null html is an empty payload; a null page_id sorts first
    and is never referred to; a null url becomes a urn. An empty table gives no files. Rows that share both
    page id and payload lie in one range, however many they are; all others are cut by bytes.
    """
    spark = pages.sparkSession
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", F.unhex(F.sha2(html, 256)).alias("digest"), "url", html.alias("html"))
    keys = stored(rows.groupBy("page_id", "digest").agg(
        F.count("*").alias("n"), F.max(F.octet_length("html").cast("long")).alias("size")), "page-digests")
    bounds = _bounds(keys, range_bytes)
    range_of = _range_of(bounds)
    folder = scratch_path(spark, "warc")
    target, path = fs.FileSystem.from_uri(folder)
    target.create_dir(path)

    def run(batches):
        out, link = None, None
        for batch in batches:
            done = []
            number, page, digest, url, refers = (batch.column(k).to_pylist() for k in (0, 1, 2, 3, 5))
            for row, payload in enumerate(text_bytes(batch.column(4))):
                if refers[row] is not None:  # says what the rows after it with this key refer to
                    link = page[row], digest[row], refers[row]
                    continue
                out = out or RollingFile(folder, f"range-{number[row]:06d}", roll_bytes)
                first = link[2] if link and link[:2] == (page[row], digest[row]) else None
                done += list(out.add(record(page[row], url[row], payload, first)))
            yield _manifest(done)
        if out:
            yield _manifest(list(out.close()))

    place = range_of("page_id", "digest").alias("range")
    records = rows.select(place, "page_id", "digest", "url", "html", F.lit(None).cast("long").alias("refers_to"))
    links = _links(keys).select(place, "page_id", "digest", F.lit(None).cast("string").alias("url"),
                                F.lit(None).cast("string").alias("html"), "refers_to")
    in_order = (records.unionByName(links).repartitionById(len(bounds) + 1, "range")
                .sortWithinPartitions("page_id", "digest", F.col("refers_to").asc_nulls_last(), "url"))
    manifest = stored(in_order.mapInArrow(
        run, "name string, records long, bytes long, sha256 string"), "warc-manifest")
    return folder, manifest


def _manifest(entries: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*entries)) or [[], [], [], []]
    kinds = [("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds)],
                                      names=[n for n, _ in kinds])


def members(stream):
    """The decompressed gzip members of an open file, one at a time."""
    packer, parts = zlib.decompressobj(31), []
    data = stream.read(READ_AT_ONCE)
    while data:
        parts.append(packer.decompress(data))
        data = packer.unused_data
        if packer.eof:
            yield b"".join(parts)
            packer, parts = zlib.decompressobj(31), []
        data = data or stream.read(READ_AT_ONCE)
    if parts and any(parts):
        raise ValueError("the file ends inside a record")


def parsed(member: bytes) -> tuple:
    """(page_id, url, payload or None, bytes, digest, type, refers_to); checks length and digests."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    if f"sha256:{hashlib.sha256(block).hexdigest()}" != fields["WARC-Block-Digest"]:
        raise ValueError("a block's digest is wrong")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    size, payload = int(fields["X-Payload-Length"]), None
    if fields["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        size = len(payload)
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("a payload's digest is wrong")
    number = lambda key: int(fields[key]) if key in fields else None
    return (number("X-Page-Id"), fields["WARC-Target-URI"], payload, size, digest,
            fields["WARC-Type"], number("X-Refers-To-Page"))


def read_warc(folder: str, manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url[, payload]) per record.

    Only files that the manifest lists are read. Lengths and digests are computed from what is read;
    a revisit's are those that it shares with its response. A damaged record raises an error.
    """
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
             "record_type": pa.string(), "refers_to": pa.int64(), "url": pa.string()}
    if with_payload:
        kinds["payload"] = pa.binary()

    def out(rows):
        columns = [[r[k] for r in rows] for k in (0, 3, 4, 5, 6, 1)]
        columns += [[r[2] for r in rows]] if with_payload else []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))

    def run(batches):
        source, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with source.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for member in members(stream):
                        rows.append(parsed(member))
                        held += len(rows[-1][2] or b"") if with_payload else 100
                        if held > READ_AT_ONCE:
                            yield out(rows)
                            rows, held = [], 0
                yield out(rows)

    schema = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long, url string" + (", payload binary" if with_payload else ""))
    files = max(manifest.count(), 1)
    return manifest.select("name").repartitionByRange(files, "name").mapInArrow(run, schema)
