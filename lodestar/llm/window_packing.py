"""Online packing of token sequences with a fixed number of open windows.

A task reads its texts once, in order, and keeps ``OPEN`` windows. What is to be placed goes into the
open window that it fills best. If none has room, the fullest one leaves: filled up with the beginning
of what did not fit where that is worth a cut, else as it is. So a task's memory does not grow with
its input. The windows that are open at a task's end are items of the next round, which reads them, the
fullest first, in fewer tasks; one task ends the last round by merging what little is left.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_bytes
from .residual_packing import WordCachedEncoder

CAPACITY = 2048
END_ID = 1
OPEN = 32
# a cut leaves at least so many ids on either side; a window with less room is padded instead
LEAST_PIECE = 8
# open windows that one task of a later round reads
GROUP_WINDOWS = 4096
ROWS_OUT = 20_000


@dataclass(slots=True)
class Piece:
    doc_id: Any
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc_id, self.start, self.ids[:at], self.doc_tokens),
                Piece(self.doc_id, self.start + at, self.ids[at:], self.doc_tokens))


@dataclass(slots=True)
class Window:
    """Pieces in a row; also what is to be placed, a new text or an earlier round's window."""

    pieces: list[Piece] = field(default_factory=list)
    fill: int = 0

    def add(self, pieces: list[Piece]) -> None:
        self.pieces += pieces
        for piece in pieces:
            self.fill += len(piece.ids)

    def take(self, size: int) -> list[Piece]:
        """Takes the first ``size`` ids away."""
        if size == self.fill:
            taken, self.pieces, self.fill = self.pieces, [], 0
            return taken
        taken, left = [], size
        while left:
            piece = self.pieces.pop(0)
            if len(piece.ids) > left:
                piece, rest = piece.cut(left)
                self.pieces.insert(0, rest)
            taken.append(piece)
            left -= len(piece.ids)
        self.fill -= size
        return taken


class Packer:
    """Open windows of one task; ``place`` yields the windows that leave."""

    def __init__(self, capacity: int = CAPACITY, open_windows: int = OPEN, least_piece: int = LEAST_PIECE):
        self.capacity, self.open_windows, self.least_piece = capacity, open_windows, least_piece
        self._rooms: list[tuple[int, int]] = []  # (room, number), ascending
        self._windows: dict[int, Window] = {}
        self._next = 0

    def place(self, item: Window) -> Iterator[Window]:
        if item.fill >= self.capacity:
            while item.fill >= self.capacity:
                full = Window()
                full.add(item.take(self.capacity))
                yield full
            for piece in item.pieces:
                piece.ids = piece.ids.copy()  # an open window must not keep a long text
        while item.fill:
            at = bisect_left(self._rooms, (item.fill, -1))
            if at < len(self._rooms):
                window, pieces = self._pop(at), item.take(item.fill)
            elif len(self._rooms) < self.open_windows:
                window, pieces = Window(), item.take(item.fill)
            else:
                window = self._pop(0)  # no room for all of the item: the fullest leaves
                room = self.capacity - window.fill
                if min(room, item.fill - room) >= self.least_piece:
                    window.add(item.take(room))
                yield window
                continue
            window.add(pieces)
            if window.fill == self.capacity:
                yield window
            else:
                self._push(window)

    def left(self) -> Iterator[Window]:
        """The windows that are still open, the fullest first."""
        while self._rooms:
            yield self._pop(0)

    def merged(self) -> Iterator[Window]:
        """What is open put together, cut at the capacity; the rest at powers of two, which need no padding."""
        rest = Window()
        for window in self.left():
            rest.add(window.pieces)
        while rest.fill:
            out = Window()
            out.add(rest.take(min(self.capacity, 1 << (rest.fill.bit_length() - 1))
                              if rest.fill < self.capacity else self.capacity))
            yield out

    def _pop(self, at: int) -> Window:
        return self._windows.pop(self._rooms.pop(at)[1])

    def _push(self, window: Window) -> None:
        self._windows[self._next] = window
        insort(self._rooms, (self.capacity - window.fill, self._next))
        self._next += 1


def _rows(windows: Iterator[tuple[Window, bool]], doc_type: pa.DataType, round_: int) -> Iterator[pa.RecordBatch]:
    """Rows of windows and whether they have left; those that are open keep their ids."""
    number = (round_ << 56) + (TaskContext.get().partitionId() << 32)
    columns: list[list] = [[] for _ in range(9)]

    def batch():
        kinds = [doc_type, *[pa.int64()] * 6, pa.int32(), pa.list_(pa.int32())]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "fill", "ids"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    for window, gone in windows:
        offset = 0
        for p in window.pieces:
            size = len(p.ids)
            row = (p.doc_id, p.start, size, zlib.crc32(p.ids) if gone else 0, p.doc_tokens, number,
                   offset, None if gone else window.fill, None if gone else p.ids.view("<i4"))
            for column, value in zip(columns, row):
                column.append(value)
            offset += size
        number += 1
        if len(columns[0]) >= ROWS_OUT:
            yield batch()
            columns = [[] for _ in range(9)]
    if columns[0]:
        yield batch()


def _schema(doc_type: str) -> str:
    return (f"doc_id {doc_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
            "offset long, fill int, ids array<int>")


def _first_round(tokenizer: str, end_id: int, **shape: int):
    def run(batches):
        encode, packer, kind = WordCachedEncoder(tokenizer), Packer(**shape), None
        end = np.array([end_id], np.uint32).tobytes()

        def windows():
            nonlocal kind
            for batch in batches:
                kind = batch.column(0).type
                for doc_id, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                    ids = np.frombuffer(encode(text.decode("utf-8")) + end, np.uint32).astype("<u4", copy=False)
                    for window in packer.place(Window([Piece(doc_id, 0, ids, len(ids))], len(ids))):
                        yield window, True
            yield from ((w, False) for w in packer.left())

        source = windows()
        first = next(source, None)
        if first:
            yield from _rows(_chained(first, source), kind, 0)
    return run


def _chained(first, rest):
    yield first
    yield from rest


def _next_round(round_: int, last: bool, **shape: int):
    def run(batches):
        packer, kind, item, number = Packer(**shape), None, Window(), None

        def windows():
            nonlocal kind, item, number
            for batch in batches:
                kind = batch.column(0).type
                docs, starts, tokens, numbers = (batch.column(c).to_pylist() for c in range(4))
                ids = batch.column(4)
                for k, own in enumerate(numbers):
                    if own != number:
                        yield from ((w, True) for w in packer.place(item))
                        item, number = Window(), own
                    piece = ids[k].values.to_numpy(zero_copy_only=False).astype("<u4")
                    item.add([Piece(docs[k], starts[k], piece, tokens[k])])
            yield from ((w, True) for w in packer.place(item))
            yield from ((w, last) for w in (packer.merged() if last else packer.left()))

        source = windows()
        first = next(source, None)
        if first:
            yield from _rows(_chained(first, source), kind, round_)
    return run


def packed_windows(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   open_windows: int = OPEN, least_piece: int = LEAST_PIECE,
                   group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) for every piece of ``docs``.

    ``docs`` has doc_id and text; other columns are not read. A text's ids and ``end_id`` are cut at the
    capacity, and where a window is filled up so that either side keeps ``least_piece`` ids; later rounds cut
    windows of several pieces in the same way, and the last merge cuts freely. A null or empty text is its end id alone; rows that repeat an id are documents of their own; an empty table
    gives no rows. The table is written round by round, so numbers do not change on a retry.
    """
    shape = {"capacity": capacity, "open_windows": open_windows, "least_piece": least_piece}
    slim = docs.select("doc_id", "text")
    schema = _schema(slim.schema["doc_id"].dataType.simpleString())
    rounds = [stored(slim.mapInArrow(_first_round(tokenizer, end_id, **shape), schema), "windows")]
    while True:
        open_ = rounds[-1].where("fill is not null")
        count = open_.where("offset = 0").count()
        if not count:
            break
        # a group leaves open_windows behind: fewer groups in each round
        groups = -(-count // max(group_windows, 2 * open_windows))
        dealt = (open_.withColumn("_g", F.pmod(F.xxhash64("sequence_id"), F.lit(groups)).cast("int"))
                 .repartitionById(groups, F.col("_g"))
                 .sortWithinPartitions(F.desc("fill"), "sequence_id", "offset")
                 .select("doc_id", "start", "doc_tokens", "sequence_id", "ids"))
        rounds.append(stored(dealt.mapInArrow(
            _next_round(len(rounds), groups == 1, **shape), schema), "windows"))
    done = [r.where("fill is null").drop("fill", "ids") for r in rounds]
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    return out
