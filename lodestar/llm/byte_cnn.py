"""A byte-level convolutional network in numpy that scores a text's quality.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. Learned filters slide over
the embedded bytes of each chunk and are max-pooled; a text is described by the mean and the maximum of
its chunks' pooled filters, which a logistic layer combines into one probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_of_id, text_bytes

CHUNK, OVERLAP = 512, 64
WIDTH, STRIDE, FILTERS, DEPTH = 8, 2, 24, 4
CHUNKS_AT_ONCE = 64
# training: at most so many documents of each class, and bytes in all
TRAIN_DOCS, TRAIN_BYTES = 1200, 48 << 20
EPOCHS, BATCH, RATE, DECAY = 8, 32, 0.01, 1e-4
BLANK = 256  # what fills the last chunk


def chunks(text: bytes) -> np.ndarray:
    """(chunks, CHUNK) byte values; neighbours share OVERLAP bytes, the end is filled with BLANK."""
    step = CHUNK - OVERLAP
    count = max(1, -(-(len(text) - OVERLAP) // step))
    padded = np.full(count * step + OVERLAP, BLANK, np.int16)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]


class ByteCNN:
    """The network: byte vectors, filters, biases, and weights of the logistic layer."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.p = {
            "bytes": rng.normal(0, 0.5, (BLANK + 1, DEPTH)).astype(np.float32),
            "filters": rng.normal(0, (WIDTH * DEPTH) ** -0.5, (WIDTH * DEPTH, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "mean": rng.normal(0, 0.1, FILTERS).astype(np.float32),
            "peak": rng.normal(0, 0.1, FILTERS).astype(np.float32),
            "shift": np.zeros(1, np.float32)}

    def _windows(self, part: np.ndarray) -> np.ndarray:
        embedded = self.p["bytes"][part].reshape(len(part), CHUNK * DEPTH)
        view = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH * DEPTH, axis=1)
        return view[:, :: STRIDE * DEPTH]

    def pooled(self, part: np.ndarray, places: bool = False):
        """(chunks, FILTERS) maxima over each chunk, and where they are if asked for."""
        windows = self._windows(part)
        raw = windows.reshape(-1, WIDTH * DEPTH) @ self.p["filters"]
        raw = raw.reshape(len(part), -1, FILTERS)
        if places:
            at = raw.argmax(axis=1)
            return np.take_along_axis(raw, at[:, None], axis=1)[:, 0] + self.p["bias"], at, windows
        return raw.max(axis=1) + self.p["bias"]

    def score(self, text: bytes) -> float:
        """Probability of label 1, between 0 and 1; an empty text is one blank chunk."""
        cut, total, peak = chunks(text), 0.0, None
        for at in range(0, len(cut), CHUNKS_AT_ONCE):
            part = np.tanh(self.pooled(cut[at: at + CHUNKS_AT_ONCE]))
            total = total + part.sum(axis=0, dtype=np.float64)
            peak = part.max(axis=0) if peak is None else np.maximum(peak, part.max(axis=0))
        z = total / len(cut) @ self.p["mean"] + peak @ self.p["peak"] + self.p["shift"][0]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def gradients(self, texts: list[np.ndarray], labels: np.ndarray, weights: np.ndarray):
        """Gradients of the weighted log loss over a batch of chunked texts."""
        part, starts = np.concatenate(texts), np.cumsum([0, *map(len, texts)])[:-1]
        sizes = np.array([len(t) for t in texts])
        of = np.repeat(np.arange(len(texts)), sizes)
        raw, at, windows = self.pooled(part, places=True)
        act = np.tanh(raw)
        mean = np.add.reduceat(act, starts) / sizes[:, None]
        peak = np.maximum.reduceat(act, starts)
        z = mean @ self.p["mean"] + peak @ self.p["peak"] + self.p["shift"][0]
        error = ((1 / (1 + np.exp(-z)) - labels) * weights / weights.sum()).astype(np.float32)
        top = (act == peak[of]).astype(np.float32)
        top /= np.add.reduceat(top, starts)[of]
        d = error[of, None] * (self.p["mean"] / sizes[of, None] + top * self.p["peak"]) * (1 - act ** 2)
        hit = windows[np.arange(len(part))[:, None], at]  # (chunks, FILTERS, WIDTH * DEPTH)
        grad = {"bias": d.sum(axis=0), "shift": error.sum(keepdims=True),
                "mean": error @ mean, "peak": error @ peak,
                "filters": np.einsum("cf,cfw->wf", d, hit)}
        back = (d[:, :, None] * self.p["filters"].T).reshape(-1, DEPTH)
        byte = part[np.arange(len(part))[:, None, None], at[:, :, None] * STRIDE + np.arange(WIDTH)]
        grad["bytes"] = np.stack([np.bincount(byte.ravel(), back[:, k], BLANK + 1)
                                  for k in range(DEPTH)], axis=1)
        return grad

    def fit(self, texts: list[bytes], labels: np.ndarray, weights: np.ndarray, seed: int = 3):
        """Adam over EPOCHS passes in a seeded order; returns the network."""
        cut, rng = [chunks(t) for t in texts], np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        steps, last = 0, EPOCHS * -(-len(cut) // BATCH)
        for _ in range(EPOCHS):
            order = rng.permutation(len(cut))
            for low in range(0, len(cut), BATCH):
                pick = order[low: low + BATCH]
                grad = self.gradients([cut[k] for k in pick], labels[pick], weights[pick])
                steps += 1
                for k, g in grad.items():
                    g = g.astype(np.float32) + DECAY * self.p[k]
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    fair = first[k] / (1 - 0.9 ** steps)
                    scale = np.sqrt(second[k] / (1 - 0.999 ** steps)) + 1e-8
                    self.p[k] -= RATE * (1 - 0.9 * steps / last) * fair / scale
        return self


def held_out(id_col: str = "doc_id"):
    return crc_of_id(id_col) % 5 == 0


def learn(docs: DataFrame, labels: DataFrame) -> ByteCNN:
    """A network fitted to labelled documents that are not held out.

    At most TRAIN_DOCS of each class, those of smallest id hash, and TRAIN_BYTES of text in all reach
    the driver. Classes are weighed by their share of all labels used, so scores are probabilities.
    Without labels the network is not fitted and every text scores one half.
    """
    marks = labels.where("quality is not null and doc_id is not null").where(~held_out()).groupBy(
        "doc_id").agg(F.min("quality").alias("quality"))
    share = {r["quality"]: r["n"] for r in marks.where("quality in (0, 1)").groupBy("quality").agg(
        F.count("*").alias("n")).collect()}
    order = F.xxhash64("doc_id")
    picked = [(r["doc_id"], q) for q in sorted(share) for r in marks.where(F.col("quality") == q)
              .orderBy(order, "doc_id").limit(TRAIN_DOCS).collect()]
    network = ByteCNN()
    if not picked:
        for name in ("mean", "peak"):
            network.p[name][:] = 0
        return network
    spark = docs.sparkSession
    ids = spark.createDataFrame(picked, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, quality int")
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(ids), "doc_id")
    # the longest are left out where the whole would pass the bound
    sizes = sorted((r[0], r[1]) for r in found.select(
        F.octet_length("text"), "doc_id").limit(2 * TRAIN_DOCS).collect())
    total, kept = 0, []
    for size, doc in sizes:
        total += size
        if total > TRAIN_BYTES:
            break
        kept.append(doc)
    rows = found.where(F.col("doc_id").isin(kept)) if len(kept) < len(sizes) else found
    rows = rows.limit(len(kept)).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    y = np.array([r["quality"] for r in rows], np.float32)
    each = {q: max(1, int((y == q).sum())) for q in (0, 1)}
    w = np.array([share[int(q)] / each[int(q)] for q in y], np.float32)
    return network.fit([r["text"].encode() for r in rows], y, w / w.mean())


def scored(docs: DataFrame, network: ByteCNN) -> DataFrame:
    """(doc_id, held_out, score) for each row of ``docs``: only the text is looked at.

    Null and empty texts are one blank chunk. Rows that repeat an id each have a row.
    """
    def run(batches):
        for batch in batches:
            scores = [network.score(text) for text in text_bytes(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "score"])

    slim = docs.select("doc_id", held_out().alias("held_out"), "text")
    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, "
                                "held_out boolean, score double")
