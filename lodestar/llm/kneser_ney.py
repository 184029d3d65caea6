"""An interpolated modified Kneser-Ney bigram model, counted in Spark and mapped by its readers.

Words are known by a 64-bit hash and numbered by their place among all hashes. Pairs of numbers are
counted, and words and pairs written as sorted arrays to the shared folder, in shards. Tasks that score
map these files into memory and look a batch's words and pairs up by binary search; nothing of the
model passes through the driver but its sizes and discounts.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from dataclasses import dataclass
from math import isqrt
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import crc_of_id, stored

END = b""  # no word is empty
WORD_SHARDS = 64  # by the highest six bits of the hash
STATE_ROWS = 1 << 16
PAIRS_A_SHARD = 2_000_000
WORDS_AT_ONCE, TOKENS_AT_ONCE, CACHED = 400_000, 2_000_000, 300_000
# bytes of texts that are split into words together; a longer text goes alone
BYTES_AT_ONCE = 1 << 22
SHIFT = 32  # a pair is the first word's number, shifted, and the second's; both below 2 ** 31


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - 2**63


def local_folder(uri: str) -> str:
    """The path of a mounted shared folder; others cannot be mapped into memory."""
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{uri}: the model needs a shared folder that is mounted on all executors")
    return unquote(parts.path)


def _write(folder: str, name: str, values: np.ndarray) -> None:
    """A whole file or none: a task that runs again replaces it with the same content."""
    hidden = os.path.join(folder, f".{name}-{uuid.uuid4().hex}")
    values.tofile(hidden)
    os.replace(hidden, os.path.join(folder, name))


def _map(folder: str, name: str, kind: str) -> np.ndarray:
    path = os.path.join(folder, name)
    if not os.path.exists(path) or not os.path.getsize(path):
        return np.empty(0, kind)
    return np.memmap(path, kind, "r")


@dataclass
class Model:
    """Where the arrays lie, and what is small enough to travel with the tasks."""

    folder: str
    bases: list[int]        # number of the first word of each word shard
    pair_shards: int = 1
    fan: int = 1            # shards that hold the pairs of one first word
    tokens: int = 0         # N
    words: int = 0          # V
    discounts: tuple = (0.0, 0.0, 0.0)
    unknown: float = 1.0    # probability of a word that is not in the vocabulary

    @property
    def start(self) -> int:
        """The number of the context before a text's first word."""
        return self.words

    def shard_of(self, first, second):
        """The shard of a pair, for arrays and for columns: a first word's pairs lie ``fan`` shards apart."""
        return (first + second % self.fan * (self.pair_shards // self.fan)) % self.pair_shards


def discounts_from(n: dict[int, int]) -> tuple[float, float, float]:
    """The three discounts from how many entries occur once to four times.

    Too small a corpus to tell: one half of each count.
    """
    if not all(n.get(k) for k in (1, 2, 3, 4)):
        return 0.5, 1.0, 1.5
    y = n[1] / (n[1] + 2 * n[2])
    return tuple(min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.0), float(k)) for k in (1, 2, 3))


class Numbers:
    """Numbers of words in a model; -1 for words that it lacks. Remembers frequent ones."""

    def __init__(self, model: Model):
        self._bases = np.array(model.bases, np.int64)
        self._shards = [_map(model.folder, f"word-{s}", "i8") for s in range(WORD_SHARDS)]
        self._known: dict[bytes, int] = {}

    def __call__(self, tokens: Tokens) -> np.ndarray:
        """The number of every token; each different word is looked up once."""
        words = tokens.kinds
        new = [w for w in words if w not in self._known]
        if new:
            if len(self._known) > CACHED:
                self._known.clear()
                new = words
            hashes = np.fromiter(map(word_hash, new), np.int64, len(new))
            found = np.full(len(new), -1, np.int64)
            shard = (hashes >> 58) + WORD_SHARDS // 2
            for s in np.unique(shard):
                here = np.flatnonzero(shard == s)
                found[here] = _find(self._shards[s], hashes[here], self._bases[s])
            self._known.update(zip(new, found.tolist()))
        return np.fromiter(map(self._known.__getitem__, words), np.int64, len(words))[tokens.codes]


def _find(array: np.ndarray, values: np.ndarray, base: int = 0) -> np.ndarray:
    """Places of ``values`` in a sorted array, from ``base`` on; -1 where missing."""
    if not len(array):
        return np.full(len(values), -1, np.int64)
    at = np.searchsorted(array, values)
    at[at == len(array)] = 0
    return np.where(array[at] == values, at + base, -1)


@dataclass
class Tokens:
    """Words of some texts: the different ones, the place of each among them, and how many a text has."""

    kinds: list[bytes]
    codes: np.ndarray
    sizes: np.ndarray


def tokenised(column: pa.Array):
    """(first row, Tokens) for runs of a string column's rows; null counts as empty.

    Words between ASCII blanks with A-Z in lower case, and one end for each text.
    """
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + BYTES_AT_ONCE, "right")))
        yield at, _split(texts.slice(at, to - at))
        at = to


def _split(texts: pa.Array) -> Tokens:
    words = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts)))
    encoded = words.flatten().dictionary_encode()
    kinds = encoded.dictionary.cast(pa.large_binary()).to_pylist()
    codes = encoded.indices.to_numpy().astype(np.int64)
    sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    # an empty text splits into one empty word, which is its end; the others get theirs
    end = kinds.index(END) if END in kinds else len(kinds)
    if end == len(kinds):
        kinds.append(END)
    ends = np.cumsum(sizes)
    own = codes[ends - 1] == end
    return Tokens(kinds, np.insert(codes, ends[~own], end), sizes + ~own)


def in_training(id_col: str = "doc_id"):
    return crc_of_id(id_col) % 10 != 0


def _count_words(batches):
    count = Counter()
    for batch in batches:
        for _, tokens in tokenised(batch.column(0)):
            count.update(dict(zip(tokens.kinds, np.bincount(tokens.codes, minlength=len(tokens.kinds)).tolist())))
            if len(count) > WORDS_AT_ONCE:
                yield _word_rows(count)
                count = Counter()
    if count:
        yield _word_rows(count)


def _word_rows(count: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(map(word_hash, count)), pa.int64()), pa.array(list(count.values()), pa.int64())],
        names=["word", "n"])


def _by_shard(batches, write):
    """Calls ``write(shard, columns)`` for each run of the first column; yields its results."""
    held, shard = [], None
    for batch in batches:
        table = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        cuts = np.flatnonzero(np.diff(table[0])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(table[0])]):
            if a == b:
                continue
            if shard is not None and table[0][a] != shard:
                yield write(shard, [np.concatenate(c) for c in zip(*held)])
                held = []
            shard = table[0][a]
            held.append([c[a:b] for c in table[1:]])
    if held:
        yield write(shard, [np.concatenate(c) for c in zip(*held)])


def _store_words(folder: str):
    def write(shard, columns):
        _write(folder, f"word-{shard}", columns[0].astype("i8"))
        _write(folder, f"count-{shard}", columns[1].astype("i8"))
        return pa.RecordBatch.from_arrays(
            [pa.array([int(shard)]), pa.array([len(columns[0])]), pa.array([int(columns[1].sum())])],
            names=["shard", "words", "tokens"])
    return lambda batches: _by_shard(batches, write)


def _before(ids: np.ndarray, sizes: np.ndarray, start: int) -> np.ndarray:
    """The token before each token, ``start`` before the first of a text."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[np.cumsum(sizes) - sizes] = start
    return before


def _count_pairs(model: Model):
    def run(batches):
        numbers, held, size = Numbers(model), [], 0

        def flush():
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n.astype(np.int32))],
                                              names=["pair", "n"])

        for batch in batches:
            for _, tokens in tokenised(batch.column(0)):
                own = numbers(tokens)
                held.append((_before(own, tokens.sizes, model.start) << SHIFT) | own)
                size += len(own)
                if size >= TOKENS_AT_ONCE:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
    return run


def _store_pairs(folder: str):
    """Writes a shard's pairs; yields what its contexts and words add up to.

    A word's rows from several shards are added up later. Rows with a negative id -k tell how many pairs occur k
    times.
    """
    def write(shard, columns):
        pairs, n = columns
        _write(folder, f"pair-{shard}", pairs.astype("i8"))
        _write(folder, f"times-{shard}", n.astype("i8"))
        first, second = pairs >> SHIFT, pairs & ((1 << SHIFT) - 1)
        cut = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        sums = [np.add.reduceat(x, cut) for x in (n, n == 1, n == 2, n > 2)]
        words, before = np.unique(second, return_counts=True)
        zero, none, few = np.zeros(len(words), np.int64), np.zeros(len(cut), np.int64), np.zeros(4, np.int64)
        columns = [np.concatenate([first[cut], words, -np.arange(1, 5)]),
                   np.concatenate([none, before, [np.count_nonzero(n == k) for k in range(1, 5)]]),
                   *[np.concatenate([s.astype(np.int64), zero, few]) for s in sums]]
        return pa.RecordBatch.from_arrays(
            [pa.array(c.astype(np.int64)) for c in columns], names=["id", "before", "total", "n1", "n2", "n3"])
    return lambda batches: _by_shard(batches, write)


def _store_states(folder: str):
    def write(shard, columns):
        place = columns[0] - shard * STATE_ROWS
        rows = np.zeros((STATE_ROWS, 3), "f8")
        for k, column in enumerate(columns[1:]):
            rows[place, k] = column
        _write(folder, f"state-{shard}", rows[: place.max() + 1])
        return pa.RecordBatch.from_arrays([pa.array([int(shard)])], names=["shard"])
    return lambda batches: _by_shard(batches, write)


def learn(texts: DataFrame) -> Model:
    """The model of all rows of ``texts`` (text); null counts as empty, a text of one end.

    Every word, pair and count of the rows is in it, whatever their number. An empty table gives a
    model that knows no word.
    """
    spark = texts.sparkSession
    texts = texts.select("text")
    folder = local_folder(scratch_path(spark, "bigrams"))
    os.makedirs(folder, exist_ok=True)
    shard = (F.shiftright("word", 58) + WORD_SHARDS // 2).cast("int")
    words = (texts.mapInArrow(_count_words, "word long, n long")
             .groupBy("word").agg(F.sum("n").alias("n")).select(shard.alias("shard"), "word", "n")
             .repartition(WORD_SHARDS, "shard").sortWithinPartitions("shard", "word"))
    sizes = {r["shard"]: r for r in stored(words.mapInArrow(
        _store_words(folder), "shard long, words long, tokens long"), "word-shards").collect()}
    counts = [sizes[s]["words"] if s in sizes else 0 for s in range(WORD_SHARDS)]
    model = Model(folder, np.cumsum([0, *counts])[:-1].tolist(),
                  tokens=sum(r["tokens"] for r in sizes.values()), words=sum(counts))
    if not model.words:
        return model
    model.pair_shards = max(16, -(-model.tokens // PAIRS_A_SHARD))
    model.fan = isqrt(model.pair_shards)

    second = F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1))
    of = model.shard_of(F.shiftright("pair", SHIFT), second).cast("int")
    pairs = (texts.mapInArrow(_count_pairs(model), "pair long, n int")
             .select(of.alias("shard"), "pair", "n").repartitionById(model.pair_shards, F.col("shard"))
             .groupBy("shard", "pair").agg(F.sum("n").alias("n"))
             .sortWithinPartitions("shard", "pair"))
    sums = stored(pairs.mapInArrow(
        _store_pairs(folder), "id long, before long, total long, n1 long, n2 long, n3 long"), "pair-sums")
    rows = stored(sums.groupBy("id").agg(*[F.sum(c).alias(c) for c in (
        "before", "total", "n1", "n2", "n3")]), "word-sums")
    model.discounts = discounts_from({-r["id"]: r["before"] for r in rows.where("id < 0").collect()})
    known = rows.where("id >= 0")
    few = known.groupBy(F.least("before", F.lit(5)).alias("k")).agg(
        F.count("*").alias("n"), F.sum("before").alias("sum")).collect()
    by = {r["k"]: r["n"] for r in few}
    lower = discounts_from(by)
    kinds = sum(r["sum"] for r in few)  # all different pairs
    more = sum(n for k, n in by.items() if k > 2)
    model.unknown = (lower[0] * by.get(1, 0) + lower[1] * by.get(2, 0) + lower[2] * more) / kinds / (model.words + 1)

    off = F.when(F.col("before") > 2, lower[2]).when(F.col("before") == 2, lower[1]).otherwise(lower[0])
    d = model.discounts
    states = known.select(
        F.expr(f"id div {STATE_ROWS}").alias("shard"), "id",
        (F.greatest(F.col("before") - off, F.lit(0.0)) / kinds + model.unknown).alias("lower"),
        F.when(F.col("total") > 0, (F.col("n1") * d[0] + F.col("n2") * d[1] + F.col("n3") * d[2])
               / F.col("total")).otherwise(1.0).alias("back"), F.col("total").cast("double").alias("total"))
    stored(states.repartition("shard").sortWithinPartitions("shard", "id").mapInArrow(
        _store_states(folder), "shard long"), "state-shards")
    return model


class Scorer:
    """Looks up batches of texts in the mapped arrays."""

    def __init__(self, model: Model):
        self.model, self.numbers = model, Numbers(model)
        self._bases = np.array(model.bases, np.int64)
        shards = -(-(model.words + 1) // STATE_ROWS)
        self._states = [_map(model.folder, f"state-{s}", "f8").reshape(-1, 3) for s in range(shards)]
        self._counts = [_map(model.folder, f"count-{s}", "i8") for s in range(WORD_SHARDS)]
        self._pairs = [_map(model.folder, f"pair-{s}", "i8") for s in range(model.pair_shards)]
        self._times = [_map(model.folder, f"times-{s}", "i8") for s in range(model.pair_shards)]

    def _states_of(self, ids: np.ndarray) -> np.ndarray:
        out = np.empty((len(ids), 3))
        shard = ids // STATE_ROWS
        for a, b in _runs(shard):
            rows, place = self._states[shard[a]], ids[a:b] - shard[a] * STATE_ROWS
            inside = place < len(rows)
            out[a:b] = [0.0, 1.0, 0.0]
            out[a:b][inside] = rows[place[inside]]
        return out

    def _counts_of(self, ids: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ids), np.int64)
        shard = np.searchsorted(self._bases, ids, "right") - 1
        for a, b in _runs(shard):
            out[a:b] = self._counts[shard[a]][ids[a:b] - self._bases[shard[a]]]
        return out

    def _times_of(self, pairs: np.ndarray) -> np.ndarray:
        shard = self.model.shard_of(pairs >> SHIFT, pairs & ((1 << SHIFT) - 1))
        order = np.lexsort((pairs, shard))
        out, pairs, shard = np.zeros(len(pairs), np.int64), pairs[order], shard[order]
        for a, b in _runs(shard):
            at = _find(self._pairs[shard[a]], pairs[a:b])
            hit = at >= 0
            found = np.zeros(b - a, np.int64)
            found[hit] = self._times[shard[a]][at[hit]]
            out[order[a:b]] = found
        return out

    def __call__(self, tokens: Tokens):
        """(n_tokens, n_known, base_score, score) as arrays, one value for each text."""
        model, sizes = self.model, tokens.sizes
        starts = np.cumsum(sizes) - sizes
        ids = self.numbers(tokens)
        known = ids >= 0
        count, lower = np.zeros(len(ids), np.int64), np.full(len(ids), model.unknown)
        back, total = np.ones(len(ids)), np.ones(len(ids))
        before = _before(ids, sizes, model.start)
        times = np.zeros(len(ids), np.int64)
        if model.words:
            kinds, of = np.unique(ids[known], return_inverse=True)
            count[known] = self._counts_of(kinds)[of]
            lower[known] = self._states_of(kinds)[of, 0]
            after = before >= 0
            kinds, of = np.unique(before[after], return_inverse=True)
            states = self._states_of(kinds)
            back[after], total[after] = states[of, 1], np.maximum(states[of, 2], 1)
            both = known & after
            kinds, of = np.unique((before[both] << SHIFT) | ids[both], return_inverse=True)
            times[both] = self._times_of(kinds)[of]
        d = np.array([0.0, *model.discounts])
        p = (times - d[np.minimum(times, 3)]) / total + back * lower
        base = np.log10((count + 0.1) / (model.tokens + 0.1 * (model.words + 1)))
        add = lambda x: np.add.reduceat(x, starts)
        return sizes, add((count > 0).astype(np.int64)), add(base), add(np.log10(p))


def _runs(values: np.ndarray):
    if len(values):
        cuts = (np.flatnonzero(values[1:] != values[:-1]) + 1).tolist()
        yield from zip([0, *cuts], [*cuts, len(values)])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``.

    Null and empty texts consist of their end. Every probability is above 0, so every score is finite.
    """
    def run(batches):
        score = Scorer(model)
        for batch in batches:
            for at, tokens in tokenised(batch.column(2)):
                yield rows(batch.slice(at, len(tokens.sizes)), *score(tokens))

    def rows(part, n, known, base, own):
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), pa.array(n.astype(np.int64)), pa.array(known),
             pa.array(np.full(len(n), model.tokens, np.int64)), pa.array(base), pa.array(own)],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    slim = docs.select("doc_id", (~in_training()).alias("held_out"), "text")
    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, held_out boolean, "
                                "n_tokens long, n_known long, train_tokens long, base_score double, score double")
