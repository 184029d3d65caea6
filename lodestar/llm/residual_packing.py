"""Token sequences of fixed capacity, filled by best-fit and merged up a tree.

Texts are tokenised, ended with an id and cut into pieces. Whole pieces fill a sequence each. The others
are packed by best-fit decreasing within groups of bounded size; nearly full bins leave, underfull ones
are dealt into fewer groups as items of their fill, until one group holds them all or a round merges
hardly any.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_bytes

CAPACITY = 2048
END_ID = 0
GROUP_ROWS = 1 << 16
NEARLY_FULL = 16
LEAST_GAIN = 0.02
CACHED_WORDS, CACHED_LENGTH = 400_000, 40
BLANK_BEFORE_BLANK = re.compile(r"\s ")


class WordCachedEncoder:
    """Ids of a text by a byte-level BPE vocabulary, with those of frequent words remembered.

    Such a vocabulary never joins a blank and what follows it with a visible character before it,
    nor a comma or full stop at a word's end with the letter before it. A text can therefore be
    encoded in segments that start at such blanks, and a word's mark apart from the word. New words
    are merged by tiktoken with the ranks of the same file, which gives the tokenizer's ids in a
    third of its time; texts with a special token's name go to the tokenizer itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        byte = _byte_alphabet()
        ranks = {bytes(byte[c] for c in token): rank for token, rank in self._tokenizer.get_vocab(
            with_added_tokens=False).items() if token not in self._special}
        self._merge = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary
        self._marks = dict(zip(",.", self._encode([",", "."])))
        self._known: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", self._merge(text)).tobytes() for text in texts]

    def __call__(self, text: str) -> bytes:
        """The ids as native unsigned 32-bit integers."""
        if any(name in text for name in self._special):
            return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        segments = _segments(text)
        first, known = segments[0], self._known
        segments[0] = "a"  # any word: its place is taken below
        found = list(map(known.get, segments))
        stems, unknown = {}, []
        for at, ids in enumerate(found):
            if ids is None:
                segment = segments[at]
                stem = segment[:-1] if segment[-1:] in self._marks and segment[-2:-1].isalpha() else segment
                stems[stem] = known.get(stem)
                unknown.append((at, segment, stem))
        new = [stem for stem, ids in stems.items() if ids is None]
        begin, *fresh = self._encode([first] + [" " + stem for stem in new])
        stems.update(zip(new, fresh))
        if len(known) > CACHED_WORDS:
            known.clear()
        for at, segment, stem in unknown:
            ids = stems[stem] if stem == segment else stems[stem] + self._marks[segment[-1]]
            found[at] = ids
            if len(segment) <= CACHED_LENGTH:
                known[segment] = ids
                known[stem] = stems[stem]
        found[0] = begin
        return b"".join(found)


def _byte_alphabet() -> dict[str, int]:
    """The byte for each character of a byte-level vocabulary: visible bytes stand for themselves,
    the others for the characters from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {**{chr(b): b for b in visible}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


def _segments(text: str) -> list[str]:
    """``text`` cut at single blanks that follow a visible character; all but the first lost one."""
    parts = text.split(" ")
    if parts[0] and not BLANK_BEFORE_BLANK.search(text):
        return parts
    segments, open_parts = [], [parts[0]]
    for part in parts[1:]:
        last = open_parts[-1]
        if last and not last[-1].isspace():
            segments.append(" ".join(open_parts))
            open_parts = [part]
        else:
            open_parts.append(part)
    return [*segments, " ".join(open_parts)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False,
           end_id: int = END_ID) -> DataFrame:
    """(uid, doc_id, piece, start, length, ids_crc32[, ids]) for every piece of every row.

    A text's ids and ``end_id`` form one piece if they fit ``capacity``; else full pieces, before
    which a shorter first one takes what is over. Null text counts as empty: one piece of ``end_id``.
    ``uid`` numbers the pieces and is fixed, for the result is a written table.
    """
    def run(batches):
        encode = WordCachedEncoder(tokenizer)
        for batch in batches:
            docs_out, numbers, starts, sizes, crcs, kept = [], [], [], [], [], []
            ids = batch.column(0)
            for row, text in enumerate(text_bytes(batch.column(1))):
                whole = np.frombuffer(encode(text.decode("utf-8")), np.uint32)
                whole = np.append(whole, np.uint32(end_id)).astype("<u4")
                over = len(whole) % capacity or min(capacity, len(whole))
                edges = [0, *range(over, len(whole) + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    docs_out.append(row)
                    numbers.append(k)
                    starts.append(a)
                    sizes.append(b - a)
                    crcs.append(zlib.crc32(whole[a:b].tobytes()))
                    if with_ids:
                        kept.append(whole[a:b].astype(np.int32))
            columns = [ids.take(pa.array(docs_out, pa.int64())), pa.array(numbers, pa.int32()),
                       *[pa.array(c, pa.int64()) for c in (starts, sizes, crcs)]]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    slim = docs.select("doc_id", "text")
    schema = (f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, piece int, start long, "
              "length long, ids_crc32 long" + (", ids array<int>" if with_ids else ""))
    return stored(slim.mapInArrow(run, schema).select(
        F.monotonically_increasing_id().alias("uid"), "*"), "pieces")


def best_fit(fills: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per item: the position of its bin's first item, its offset there, and the bin's fill.

    Items go from the largest down, each into the fullest bin that has room.
    """
    order = np.argsort(-fills, kind="stable")
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room for exactly r
    head, offset = np.empty(len(fills), np.int64), np.empty(len(fills), np.int64)
    for item, size in zip(order.tolist(), fills[order].tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            bin_ = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, bin_ = capacity, item
        head[item], offset[item] = bin_, capacity - room
        left = room - size
        if left:
            open_bins[left].append(bin_)
            rooms |= 1 << left
    fill = np.zeros(len(fills), np.int64)
    np.add.at(fill, head, fills)
    return head, offset, fill[head]


def _packed_groups(capacity: int):
    def run(batches):
        own = pa.Table.from_batches(batches, pa.schema([("bin", pa.int64()), ("fill", pa.int64())]))
        if not own.num_rows:
            return
        bins, fills = own.column(0).to_numpy(), own.column(1).to_numpy()
        head, offset, fill = best_fit(fills, capacity)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a) for a in (bins, bins[head], offset, fill)],
            names=["bin", "up", "offset", "fill"])
    return run


def dealt(live: DataFrame, groups: int, salt: int) -> DataFrame:
    """``live`` with its group ``_g``, each group a partition of its own."""
    group = F.pmod(F.xxhash64("bin", F.lit(salt)), F.lit(groups)).cast("int")
    return live.withColumn("_g", group).repartitionById(groups, "_g")


def placed(cut: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``cut`` (uid, length, ...) with sequence_id and offset for every piece.

    Sequences hold at most ``capacity`` ids and have no gaps. A group is one task. Bins are dealt to groups by
    hash, ``group_rows`` to each on average, and lengths play no part in that; how lengths are distributed
    changes only how full bins get. An empty table gives no rows; repeated rows are pieces like others.
    """
    live = cut.where(F.col("length") < capacity).select(
        F.col("uid").alias("bin"), F.col("length").alias("fill"))
    rounds, count = [], live.count()
    while count:
        groups = -(-count // group_rows)
        merged = stored(
            dealt(live, groups, len(rounds)).select("bin", "fill")
            .mapInArrow(_packed_groups(capacity), "bin long, up long, offset long, fill long"),
            "packing")
        rounds.append(merged)
        live = merged.where((F.col("bin") == F.col("up"))
                            & (F.col("fill") < capacity - NEARLY_FULL)).select("bin", "fill")
        before, count = count, live.count()
        if groups == 1 or count > (1 - LEAST_GAIN) * before:
            break
    full = cut.where(F.col("length") >= capacity).withColumns(
        {"sequence_id": F.col("uid"), "offset": F.lit(0).cast("long")})
    if not rounds:
        return full
    place = rounds[0].select(F.col("bin").alias("uid"), F.col("up").alias("sequence_id"), "offset")
    for merged in rounds[1:]:
        up = merged.select(F.col("bin").alias("sequence_id"), "up", F.col("offset").alias("more"))
        place = place.join(up, "sequence_id", "left").select(
            "uid", F.coalesce("up", "sequence_id").alias("sequence_id"),
            (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset"))
    rest = cut.where(F.col("length") < capacity).join(place, "uid")
    return full.unionByName(rest.select(full.columns))


def packed_sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY,
                     with_ids: bool = False) -> DataFrame:
    """All pieces of ``docs`` (doc_id, text) with their places; see ``pieces`` and ``placed``."""
    return placed(pieces(docs, tokenizer, capacity, with_ids), capacity).drop("uid")
