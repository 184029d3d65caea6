"""Decision trees of a whole grid, grown together over sparse rows.

Spark's tree keeps a bin of 4 bytes for every feature of a row, zeros too, and each fit of a grid makes and reads
these rows anew. Here a row keeps two or four bytes and a bin for each value that is not zero, and a pass over the rows
splits one level of all trees. The trees are those of ``DecisionTreeClassifier``: the same thresholds
from a sample of as many rows, the same impurities in the same order of operations, the first of equal gains. A tree
that may be less deep is the beginning of a deeper one, so every depth of a grid is read off the deepest.
Bins of zeros hold what the other bins leave of a node's rows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

# executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# what DecisionTreeClassifier has if a grid does not name it
DEFAULTS = {"maxDepth": 5, "impurity": "gini", "minInstancesPerNode": 1}
# as Spark's tree: bins of a feature, and rows that thresholds are taken from
MAX_BINS, SAMPLE_ROWS = 32, 10_000
# features of a node whose counts meet in one task; with many nodes all of them do
CHUNK, MANY_NODES = 128, 64
# keys that a task holds before it counts them, counts that it holds as an array, and counts that it looks at together
KEYS_AT_ONCE, DENSE_CELLS, CELLS_AT_ONCE = 4 << 20, 8 << 20, 1 << 19
EPSILON = float(np.finfo(np.float64).eps)

# a vector as it lies in a file
VECTOR = "struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"


def feature_thresholds(values: np.ndarray, counts: np.ndarray, total: float, most: int) -> list[float]:
    """At most about ``most`` thresholds between sorted values; what ``counts`` lack of ``total`` rows are zeros."""
    zeros = total - counts.sum()
    if zeros > EPSILON * counts.sum() * 100:
        at = np.searchsorted(values, 0.0)
        values, counts = np.insert(values, at, 0.0), np.insert(counts.astype(np.float64), at, zeros)
    middle = ((values[:-1] + values[1:]) / 2).tolist()
    if len(middle) <= most:
        return middle
    stride = total / (most + 1)
    found, current, target = [], float(counts[0]), stride
    for k, n in enumerate(counts[1:].tolist()):
        previous, current = current, current + n
        if abs(previous - target) < abs(current - target):
            found.append(middle[k])
            target += stride
    return found


def thresholds(train: DataFrame, n_rows: int, width: int) -> np.ndarray:
    """(width, bins - 1) sorted thresholds, filled up with infinity; from ``SAMPLE_ROWS`` rows as Spark's tree has them."""
    bins = min(MAX_BINS, n_rows)
    share = min(1.0, max(MAX_BINS ** 2, SAMPLE_ROWS) / n_rows)
    sample = train.sample(fraction=share, seed=42) if share < 1 else train

    def of_feature(key: tuple, table: pa.Table) -> pa.Table:
        value = table.column("value").to_numpy()
        order = np.argsort(value)
        found = feature_thresholds(value[order], table.column("n").to_numpy()[order], share * n_rows, bins - 1)
        return pa.table({"feature": pa.array([key[0].as_py()], pa.int32()),
                         "found": pa.array([found], pa.list_(pa.float64()))})

    pairs = sample.select(F.explode(F.arrays_zip("indices", "values")).alias("p"))
    rows = (pairs.select(F.col("p.indices").alias("feature"), F.col("p.values").alias("value")).where("value <> 0")
            .groupBy("feature", "value").agg(F.count("*").alias("n"))
            .groupBy("feature").applyInArrow(of_feature, "feature int, found array<double>"))
    out = np.full((width, max(bins - 1, 1)), np.inf)
    for r in rows.collect():  # at most a row a feature
        out[r["feature"], :len(r["found"])] = r["found"]
    return out


def bins_of(limits: np.ndarray, features: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Number of thresholds below each value: a value up to a split's threshold has a bin up to the split."""
    low = np.zeros(len(values), np.intp)
    step = 1 << max(limits.shape[1].bit_length() - 1, 0)
    while step:
        there = low + step
        inside = there <= limits.shape[1]
        above = limits[features, np.where(inside, there, 1) - 1] < values
        low = np.where(inside & above, there, low)
        step >>= 1
    return low


def _index_type(width: int) -> type:
    return np.uint16 if width <= 1 << 16 else np.uint32


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and values of a list column without nulls."""
    return np.diff(column.offsets.to_numpy()), column.flatten().to_numpy(zero_copy_only=False)


def _bytes(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and values of a binary column without nulls that holds numbers of ``kind``."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]: offsets[-1]]
    return np.diff(offsets) // np.dtype(kind).itemsize, data.view(kind)


def _binary(lengths: np.ndarray, data: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]) * data.itemsize
    return pa.Array.from_buffers(pa.binary(), len(lengths), [
        None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _binned(limits: np.ndarray) -> Callable:
    """Function for mapInArrow: rows of vectors as features and bins of what is not zero."""
    kind = _index_type(len(limits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, features = _lists(batch.column("indices"))
            values = _lists(batch.column("values"))[1]
            rows = np.repeat(np.arange(len(batch)), lengths)
            kept = values != 0
            features, lengths = features[kept], np.bincount(rows[kept], minlength=len(batch))
            bins = bins_of(limits, features, values[kept]).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("is_train"), batch.column("label").cast(pa.int32()),
                 _binary(lengths, features.astype(kind)), _binary(lengths, bins)],
                ["is_train", "label", "features", "bins"])
    return run


def impurity(kind: str, counts: list[np.ndarray], total: np.ndarray) -> np.ndarray:
    """Gini or entropy of each place over arrays of counts, one for each label, summed in the order of labels."""
    out = np.full(np.shape(total), 1.0 if kind == "gini" else 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        for n in counts:
            share = n / total
            out = out - (share * share if kind == "gini"
                         else np.where(n > 0, share * (np.log(share) / np.log(2.0)), 0.0))
    return np.where(total > 0, out, 0.0)


@dataclass
class Trees:
    """The trees of all pairs of an impurity and a least number of rows. Nodes behind the same splits are one node."""

    kinds: list[tuple[str, int]]
    counts: list[np.ndarray]  # rows by label of each node
    children: dict[tuple[int, int, int], tuple[int, int]] = field(default_factory=dict)
    splits: list[dict[int, tuple[int, int]]] = field(default_factory=list)  # by tree: feature and bin of a node

    def split(self, tree: int, node: int, feature: int, bin_: int, left: np.ndarray) -> tuple[int, int]:
        key = (node, feature, bin_)
        if key not in self.children:
            self.children[key] = len(self.counts), len(self.counts) + 1
            self.counts += [left, self.counts[node] - left]
        self.splits[tree][node] = (feature, bin_)
        return self.children[key]

    def pure(self, tree: int, node: int) -> bool:
        n = [np.float64(x) for x in self.counts[node]]
        return abs(float(impurity(self.kinds[tree][0], n, np.sum(n)))) < EPSILON

    def tables(self) -> list[np.ndarray]:
        """By tree: feature or -1, bin, left and right child of each node."""
        out = []
        for splits in self.splits:
            table = np.full((4, len(self.counts)), -1, np.int32)
            for node, (feature, bin_) in splits.items():
                table[:, node] = feature, bin_, *self.children[node, feature, bin_]
            out.append(table)
        return out


class Walker:
    """Leads rows of a batch down the trees; only features that some tree splits are spread out."""

    def __init__(self, tables: list[np.ndarray], zero_bins: np.ndarray):
        self.tables = tables
        self.used = np.unique(np.concatenate([t[0][t[0] >= 0] for t in tables]))
        self.place = np.full(len(zero_bins), -1, np.int32)
        self.place[self.used] = np.arange(len(self.used))
        self.zeros = zero_bins[self.used].astype(np.uint8)

    def spread(self, rows: np.ndarray, features: np.ndarray, bins: np.ndarray, count: int) -> np.ndarray:
        out = np.tile(self.zeros, (count, 1))
        place = self.place[features]
        kept = place >= 0
        out[rows[kept], place[kept]] = bins[kept]
        return out

    def levels(self, tree: int, wide: np.ndarray, depth: int) -> Iterator[np.ndarray]:
        """Node of each row after 1, 2, ... ``depth`` splits; a row stays in a leaf."""
        feature, bin_, left, right = self.tables[tree]
        node, moving = np.zeros(len(wide), np.int32), np.arange(len(wide))
        for _ in range(depth):
            moving = moving[feature[node[moving]] >= 0]
            at = node[moving]
            low = wide[moving, self.place[feature[at]]] <= bin_[at]
            node[moving] = np.where(low, left[at], right[at])
            yield node


_COUNTS = "slot int, chunk int, cells binary, n binary"


@dataclass
class Shape:
    """How counts are numbered: by slot, feature, bin and label; ``chunk`` features of a slot make a group."""

    width: int
    bins: int
    labels: int
    chunk: int

    @property
    def chunks(self) -> int:
        return -(-self.width // self.chunk)

    @property
    def group(self) -> int:
        return self.chunk * self.bins * self.labels


def _counted(walker: Walker, slots: list[np.ndarray], depth: int, shape: Shape) -> Callable:
    """Function for mapInArrow: rows by node, feature, bin and label, for the nodes that have a slot.

    ``slots`` has the slot of each node for each tree, or -1; a node of several trees has it in one of them.
    """
    kind = _index_type(shape.width)
    cells = (1 + max(int(s.max()) for s in slots)) * shape.chunks * shape.group

    def rows_of(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        group = keys // shape.group
        ends = np.flatnonzero(np.diff(group, append=-1)) + 1
        lengths, first = np.diff(ends, prepend=0), group[ends - 1]
        inside, n = (keys % shape.group).astype(np.int32), n.astype(np.int32)
        for at in range(0, len(ends), 4096):
            some = slice(at, at + 4096)
            part = slice(ends[at - 1] if at else 0, ends[some][-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array((first[some] // shape.chunks).astype(np.int32)),
                 pa.array((first[some] % shape.chunks).astype(np.int32)),
                 _binary(lengths[some], inside[part]), _binary(lengths[some], n[part])],
                ["slot", "chunk", "cells", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64) if cells <= DENSE_CELLS else None
        held, size = [], 0

        def emptied() -> Iterator[pa.RecordBatch]:
            nonlocal total
            keys = np.concatenate(held)
            if total is not None:
                total += np.bincount(keys, minlength=cells)
                return
            keys.sort()
            ends = np.flatnonzero(np.diff(keys, append=-1)) + 1
            yield from rows_of(keys[ends - 1], np.diff(ends, prepend=0))

        for batch in batches:
            label = batch.column("label").to_numpy().astype(np.int64)
            lengths, features = _bytes(batch.column("features"), kind)
            value_bins = _bytes(batch.column("bins"), np.uint8)[1]
            rows = np.repeat(np.arange(len(batch)), lengths)
            wide = walker.spread(rows, features, value_bins, len(batch))
            for tree, slot_of in enumerate(slots):
                if slot_of.max() < 0:
                    continue
                node = np.zeros(len(batch), np.int32)
                for node in walker.levels(tree, wide, depth):
                    pass
                slot = slot_of[node]
                kept = slot[rows] >= 0
                of, feature = rows[kept], features[kept].astype(np.int64)
                keys = slot[of].astype(np.int64) * (shape.chunks * shape.chunk) + feature
                held.append((keys * shape.bins + value_bins[kept]) * shape.labels + label[of])
                size += len(held[-1])
                if size >= KEYS_AT_ONCE:
                    yield from emptied()
                    held, size = [], 0
        if size:
            yield from emptied()
        if total is not None:
            keys = np.flatnonzero(total)
            if len(keys):
                yield from rows_of(keys, total[keys])
    return run


_BEST = "slot int, tree int, gain double, feature int, bin int, rows_left array<long>"


def _sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sum of ``n``, or of its rows, for each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.add.reduceat(n[order], starts, axis=0)


def _best(nodes: np.ndarray, wanted: list[list[int]], kinds: list[tuple[str, int]], n_splits: np.ndarray,
          zero_bins: np.ndarray, shape: Shape) -> Callable:
    """Function for mapInArrow on counts sorted by slot and chunk: for each tree the best split of what comes at once.

    ``nodes`` has the rows by label of each slot, ``wanted`` the trees that split it. Between two bins that occur
    no row changes sides, so only occurring bins and the bin of zeros are tried as splits.
    """
    place = shape.chunks * shape.chunk
    wants = np.zeros((len(kinds), len(nodes)), bool)
    for slot, some in enumerate(wanted):
        wants[some, slot] = True

    def splits(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, n = _sums(keys, n)
        at, label = np.divmod(keys, shape.labels)
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        rows = np.zeros((len(starts), shape.labels), np.int64)
        rows[np.cumsum(np.diff(at, prepend=-1) != 0) - 1, label] = n
        at = at[starts]
        feature_of, seen = _sums(at // shape.bins, rows)
        zeros = nodes[feature_of // place] - seen
        at, rows = _sums(np.concatenate([at, feature_of * shape.bins + zero_bins[feature_of % place]]),
                         np.concatenate([rows, zeros]))
        feature_of, bin_ = np.divmod(at, shape.bins)
        slot, feature = np.divmod(feature_of, place)
        running = rows.cumsum(axis=0)
        starts = np.flatnonzero(np.diff(feature_of, prepend=-1))
        before = np.concatenate([np.zeros((1, shape.labels), np.int64), running])[starts]
        left = running - np.repeat(before, np.diff(starts, append=len(at)), axis=0)
        tried = bin_ < n_splits[feature]
        slot, feature, bin_, left = slot[tried], feature[tried], bin_[tried], left[tried]
        if not len(slot):
            return
        right = nodes[slot] - left
        n_left, n_right = left.sum(axis=1), right.sum(axis=1)
        total = n_left + n_right
        starts = np.flatnonzero(np.diff(slot, prepend=-1))
        gains = {}
        for tree, (kind, least) in enumerate(kinds):
            if kind not in gains:
                whole, low, high = (impurity(kind, [side[:, c] for c in range(shape.labels)], count) for side, count in (
                    (nodes[slot], total), (left, n_left), (right, n_right)))
                gains[kind] = whole - n_left / total * low - n_right / total * high
            gain = np.where(wants[tree][slot] & (n_left >= least) & (n_right >= least), gains[kind], -np.inf)
            top = np.repeat(np.maximum.reduceat(gain, starts), np.diff(starts, append=len(gain)))
            best = np.flatnonzero((gain == top) & (gain > 0))
            best = best[np.unique(slot[best], return_index=True)[1]]  # the first of equal ones
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot[best], pa.int32()), pa.array(np.full(len(best), tree), pa.int32()),
                 pa.array(gain[best]), pa.array(feature[best], pa.int32()), pa.array(bin_[best], pa.int32()),
                 pa.array(left[best].tolist(), pa.list_(pa.int64()))],
                ["slot", "tree", "gain", "feature", "bin", "rows_left"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            group = (batch.column("slot").to_numpy().astype(np.int64) * shape.chunks
                     + batch.column("chunk").to_numpy())
            lengths, cells = _bytes(batch.column("cells"), np.int32)
            keys = np.concatenate([keys, np.repeat(group * shape.group, lengths) + cells])
            n = np.concatenate([n, _bytes(batch.column("n"), np.int32)[1]])
            if len(keys) >= CELLS_AT_ONCE:  # the last group may go on
                whole = keys < group[-1] * shape.group
                if whole.any():
                    yield from splits(keys[whole], n[whole])
                    keys, n = keys[~whole], n[~whole]
                keys, n = _sums(keys, n)
        if len(keys):
            yield from splits(keys, n)
    return run


def grow(train: DataFrame, kinds: list[tuple[str, int]], limits: np.ndarray, depth: int) -> Trees:
    """The tree of each of ``kinds`` over binned rows, a job a level. Only the trees are in the driver."""
    sizes = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    root = np.array([sizes.get(k, 0) for k in range(max(sizes, default=0) + 1)], np.int64)
    trees = Trees(kinds, [root], splits=[{} for _ in kinds])
    n_splits = np.isfinite(limits).sum(axis=1)
    zero_bins = (limits < 0).sum(axis=1)
    bins = limits.shape[1] + 1
    open_nodes = [[0] if root.sum() else [] for _ in kinds]
    for level in range(depth):
        active = sorted({n for nodes in open_nodes for n in nodes})
        if not active:
            break
        at = {n: k for k, n in enumerate(active)}
        slots, wanted = [], [[] for _ in active]
        for tree, nodes in enumerate(open_nodes):
            slot = np.full(len(trees.counts), -1, np.int32)
            for n in nodes:
                if not wanted[at[n]]:  # counted for the first tree that has it
                    slot[n] = at[n]
                wanted[at[n]].append(tree)
            slots.append(slot)
        walker = Walker(trees.tables(), zero_bins)
        shape = Shape(len(limits), bins, len(root), CHUNK if len(active) < MANY_NODES else len(limits))
        split = _best(np.array([trees.counts[n] for n in active]), wanted, kinds, n_splits, zero_bins, shape)
        rows = (train.select("label", "features", "bins")
                .mapInArrow(_counted(walker, slots, level, shape), _COUNTS)
                .repartition("slot", "chunk").sortWithinPartitions("slot", "chunk").mapInArrow(split, _BEST)
                .groupBy("slot", "tree").agg(F.max(F.struct(
                    "gain", (-F.col("feature")).alias("feature"), (-F.col("bin")).alias("bin"), "rows_left")).alias("b")))
        open_nodes = [[] for _ in kinds]
        for r in sorted(rows.collect()):  # at most a row for each tree and open node
            b, tree = r["b"], r["tree"]
            both = trees.split(tree, active[r["slot"]], -b["feature"], -b["bin"], np.array(b["rows_left"], np.int64))
            open_nodes[tree] += [n for n in both if not trees.pure(tree, n)]
    return trees


def _predicted(walker: Walker, labels: np.ndarray, depths: list[int]) -> Callable:
    """Function for mapInArrow: a row's label and what each tree says at each of ``depths``."""
    kind, last = _index_type(len(walker.place)), max(depths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, features = _bytes(batch.column("features"), kind)
            bins = _bytes(batch.column("bins"), np.uint8)[1]
            wide = walker.spread(np.repeat(np.arange(len(batch)), lengths), features, bins, len(batch))
            said = []
            for tree in range(len(walker.tables)):
                at = {0: labels[np.zeros(len(batch), np.int32)]}
                for k, node in enumerate(walker.levels(tree, wide, last), 1):
                    at[k] = labels[node]
                said += [pa.array(at[d].astype(np.float64)) for d in depths]
            yield pa.RecordBatch.from_arrays([batch.column("label").cast(pa.float64()), *said],
                                             ["label", *[f"p{k}" for k in range(len(said))]])
    return run


def predictions(vectors: DataFrame, n_train: int, width: int, grid: list[dict], name: str) -> tuple[DataFrame, list[str]]:
    """Labels of the rows of ``vectors`` that are not for training, and a column of predictions for each of ``grid``.

    ``vectors`` has ``is_train``, ``label`` from 0 and ``vector`` as in ``VECTOR``, ``n_train`` training rows and
    ``width`` features; a row of ``grid`` has the parameters of one tree. Also the columns in the order of ``grid``.
    """
    grid = [{**DEFAULTS, **g} for g in grid]
    kinds = list(dict.fromkeys((g["impurity"], g["minInstancesPerNode"]) for g in grid))
    depths = sorted({g["maxDepth"] for g in grid})
    values = F.col("vector.values")
    every = F.when(F.size(values) > 0, F.sequence(F.lit(0), F.size(values) - 1)).otherwise(F.array().cast("array<int>"))
    flat = vectors.select("is_train", "label", F.coalesce("vector.indices", every).alias("indices"), values.alias("values"))
    limits = thresholds(flat.where("is_train"), n_train, width)
    binned = materialise(flat.mapInArrow(
        _binned(limits), "is_train boolean, label int, features binary, bins binary"), f"binned-{name}")
    trees = grow(binned.where("is_train"), kinds, limits, depths[-1])
    walker = Walker(trees.tables(), (limits < 0).sum(axis=1))
    labels = np.array([n.argmax() for n in trees.counts])
    columns = [f"p{kinds.index((g['impurity'], g['minInstancesPerNode'])) * len(depths) + depths.index(g['maxDepth'])}"
               for g in grid]
    schema = ", ".join(["label double", *[f"p{k} double" for k in range(len(kinds) * len(depths))]])
    said = binned.where("not is_train").select("label", "features", "bins").mapInArrow(
        _predicted(walker, labels, depths), schema)
    return materialise(said, f"predicted-{name}"), columns
