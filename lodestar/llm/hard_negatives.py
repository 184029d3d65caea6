"""Hard negatives by Fagin's threshold algorithm over blocks of vectors.

All vectors are dealt to blocks. A block sorts its vectors once along every dimension; anchors stream
past it. An anchor reads each list from the end that its own sign favours, scores what it meets by
an integer inner product, and stops once the threshold, the score of an imagined vector made of the
last values read, is strictly below the kth score of each of its windows, or below the window itself.
What is unseen then cannot come in, not even by a tie. Blocks give their own best; the best of a few
candidates per block are the best of all. A first pass finds positives, a second one the negatives
in the windows that the positives' scores open.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

POSITIVES = NEGATIVES = 5
# a negative scores between these percentages of the positive
LOW, HIGH = 80, 100
SCALE = 256
# components are integers of at most this size, so a score of 2,000 dimensions fits 64 bits
LARGEST = 1 << 24
BLOCK_ROWS = 1 << 16
FIRST_DEPTH = 16


def usable(rows: DataFrame, label: Column) -> DataFrame:
    """(vec_id, label, v): integer vectors of the rows that take part, one for each id.

    Rows with a null id, label or vector or with a null or non-finite component take no part. Of
    several rows with one id that with the smallest label and vector counts. Components beyond
    ``LARGEST`` count as that; a vector that is shorter than another has zeros in its place.
    """
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    whole = lambda x: F.greatest(F.least(F.floor(x * SCALE), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int")
    slim = rows.select("vec_id", label.cast("long").alias("label"),
                       F.col("embedding").cast("array<double>").alias("e")).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("e").isNotNull()
        & ~F.exists("e", bad))
    one = F.min(F.struct("label", F.transform("e", whole).alias("v"))).alias("one")
    return slim.groupBy("vec_id").agg(one).select("vec_id", "one.label", "one.v")


def _matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of a list column, zeros behind shorter ones, at least ``width`` wide."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), max(width, int(sizes.max(initial=0)))), np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, place] = column.flatten().to_numpy()
    return out


@dataclass
class Span:
    """Scores that are asked for, both ends included, of rows with the anchor's label or with another."""

    low: int
    high: int


class Block:
    """Vectors with a list of their places for every dimension, sorted by the component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels = ids, labels
        most = int(np.abs(vectors).max(initial=0))
        # doubles add up exactly below 2 ** 53 and are faster
        self._exact = most * most * max(1, vectors.shape[1]) < 1 << 53
        self.vectors = vectors.astype(np.float64) if self._exact else vectors
        self.most = most
        self.order = np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32)
        self.sorted = np.take_along_axis(vectors, self.order.T, axis=0).T

    def best(self, anchor: np.ndarray, anchor_id: int, label: int, same: bool, spans: list[Span],
             k: int) -> list[np.ndarray]:
        """For each span the places of its k best rows, by score and then by id, and all scores seen.

        ``same`` asks for rows of the anchor's label, the anchor left out; else for all other labels.
        """
        n = len(self.ids)
        plus, minus = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        exact = self._exact and int(np.abs(anchor).max(initial=0)) * self.most * max(1, len(anchor)) < 1 << 53
        by = anchor.astype(np.float64) if exact else anchor
        vectors = self.vectors if exact else self.vectors.astype(np.int64)
        asked = (self.labels == label) & (self.ids != anchor_id) if same else self.labels != label
        seen, score = np.zeros(n, bool), np.zeros(n, np.int64)
        last, depth = 0, min(FIRST_DEPTH, n)
        while True:
            met = np.zeros(n, bool)
            met[self.order[plus, n - depth: n - last].ravel()] = True
            met[self.order[minus, last: depth].ravel()] = True
            if depth == n or not (len(plus) or len(minus)):
                met[:] = True  # a list's end; without lists every score is 0
            new = np.flatnonzero(met & ~seen & asked)
            seen |= met
            if len(new):
                score[new] = (vectors[new] @ by).astype(np.int64)
            if seen.all():
                break
            bound = int(anchor[plus] @ self.sorted[plus, n - depth] + anchor[minus] @ self.sorted[minus, depth - 1])
            own = score[seen & asked]
            if all(bound < self._least(own, span, k) for span in spans):
                break
            last, depth = depth, min(2 * depth, n)
        places = np.flatnonzero(seen & asked)
        return [self._first(places, score, span, k) for span in spans], score

    @staticmethod
    def _least(scores: np.ndarray, span: Span, k: int) -> int:
        """The kth score of a span so far; its lower end if there are fewer."""
        inside = scores[(scores >= span.low) & (scores <= span.high)]
        if len(inside) < k:
            return span.low
        return int(np.partition(inside, len(inside) - k)[len(inside) - k])

    def _first(self, places: np.ndarray, score: np.ndarray, span: Span, k: int) -> np.ndarray:
        own = score[places]
        places = places[(own >= span.low) & (own <= span.high)]
        return places[np.lexsort((self.ids[places], -score[places]))[:k]]


_ANY = Span(-(1 << 62), 1 << 62)


def _search(positives: int, negatives: int, low: int, high: int):
    """Blocks, each followed by its anchors, to candidates. Anchors without scores ask for positives."""
    def run(batches):
        held, block = [], None
        for batch in batches:
            asks = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            first = int(np.argmax(asks)) if asks.any() else len(asks)
            if first:
                held.append(batch.slice(0, first))
            if first == len(asks) or not held and block is None:
                continue  # more of the block to come, or a block of no rows
            if block is None:
                rows = pa.Table.from_batches(held).combine_chunks()
                block = Block(rows.column(1).to_numpy(), rows.column(2).to_numpy(),
                              _matrix(rows.column(3).combine_chunks()))
                held = []
            yield found(block, batch.slice(first))

    def found(block, anchors):
        out: list[list] = [[] for _ in range(5)]
        width = block.vectors.shape[1]
        vectors = _matrix(anchors.column(3), width)
        ids, labels = anchors.column(1).to_pylist(), anchors.column(2).to_pylist()
        for k, scores in enumerate(anchors.column(4).to_pylist()):
            anchor = vectors[k, :width]  # beyond, all vectors of the block are 0
            if scores is None:
                places, score = block.best(anchor, ids[k], labels[k], True, [_ANY], positives)
                wanted = [(None, None)]
            else:
                wanted = [(s["id"], s["score"]) for s in scores]
                spans = [Span(-(-low * s // 100), high * s // 100) for _, s in wanted]
                places, score = block.best(anchor, ids[k], labels[k], False, spans, negatives)
            for (other, value), own in zip(wanted, places):
                for c, values in zip(out, ([ids[k]] * len(own), [other] * len(own), [value] * len(own),
                                           block.ids[own].tolist(), score[own].tolist())):
                    c += values
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in out],
            names=["anchor_id", "positive_id", "positive_score", "other_id", "score"])
    return run


def _candidates(rows: DataFrame, anchors: DataFrame, blocks: int, limits: tuple[int, ...]) -> DataFrame:
    """Every anchor (vec_id, label, v, asked) against every block of ``rows``."""
    kind = "array<struct<id:bigint,score:bigint>>"
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    held = rows.select(block.alias("_b"), F.lit(0).alias("asks"), "vec_id", "label", "v",
                       F.lit(None).cast(kind).alias("asked"))
    asking = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_b"),
                            F.lit(1).alias("asks"), "vec_id", "label", "v", F.col("asked").cast(kind))
    return (held.unionAll(asking).repartitionById(blocks, F.col("_b"))
            .sortWithinPartitions("asks", "vec_id").drop("_b")
            .mapInArrow(_search(*limits), "anchor_id long, positive_id long, positive_score long, "
                                          "other_id long, score long"))


def mined(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
          low: int = LOW, high: int = HIGH, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over ``usable`` rows.

    ``is_anchor`` is a condition on vec_id. An anchor's positives are its best ``positives`` other rows
    of its label; for each, the best ``negatives`` rows of other labels with ``low`` to ``high`` percent
    of the positive's score follow, by score and then by id. Anchors without positives, and positives
    without negatives, give no rows; nor does an empty table.

    The rows are split into blocks of about ``block_rows``, at least one for each core. Only
    anchors are repeated, once for each block.
    """
    rows = stored(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "v"), "vectors")
    count = rows.count()
    blocks = max(-(-count // block_rows), rows.sparkSession.sparkContext.defaultParallelism)
    limits = (positives, negatives, low, high)
    anchors = rows.where(is_anchor)

    def best(found: DataFrame, k: int, *key: str) -> DataFrame:
        order = Window.partitionBy(*key).orderBy(F.desc("score"), "other_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    near = best(_candidates(rows, anchors.withColumn("asked", F.lit(None)), blocks, limits), positives, "anchor_id")
    asked = stored(near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(
        F.struct(F.col("other_id").alias("id"), "score")).alias("asked")).join(anchors, "vec_id"), "positives")
    hard = stored(_candidates(rows, asked, blocks, limits), "negatives")
    return best(hard, negatives, "anchor_id", "positive_id").select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
