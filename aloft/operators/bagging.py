"""A random forest of two classes, grown level by level from counts.

The trees are those that Spark ML's classifier defines: bags of Poisson(1) copies of every row, a random subset of
features for each node, at most 32 bins a feature with thresholds from a sample of rows, the split of largest Gini gain,
and leaves of one parent that predict the same class made one.  What differs is what is kept and moved:

* rows are staged as the numbers of their bins, and only those bins that a value of 0 does not fall in;
* bags and subsets are functions of hashes (row, tree) and (tree, node), drawn again in every pass and never stored.
  A row's hash is that of its content and of its place among equal rows, so nothing depends on partitions or order;
* a pass over the rows adds one level to all trees.  A task walks its rows down the trees and counts them by node, class
  and bin of the node's features; the counts of a tree are added up in a shuffle, and the task that adds them finds the
  best splits, so that only splits reach the driver.  Counts are whole numbers: splits that part the rows alike have
  exactly the same gain, and the first feature is taken.

What a task holds depends on the number of nodes, not of rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aloft.operators.newton import DENSE
from aloft.session import scratch_path

BINS = 32
#: where a threshold lies between two values: a hair over the middle, so that a value that is the middle stays below also when
#: the last digit of the standard deviation by which it is divided comes out otherwise
MIDDLE = 0.5 + 1e-6
#: rows of different content from which thresholds are taken, about
SAMPLE = 10_000
#: rows that a task holds at once, and rows that go down a tree at once
ROWS = 1 << 19
BLOCK = 1 << 14
#: files for each core, bytes of their row groups (so that splits of a file have about the same rows), and tasks of a pass
#: for each core at most: each task makes counts of its own of all nodes
FILES = 2
ROW_GROUP = 4 << 20
TASKS = 4
#: one sum holds the rows of both classes: class 1 counts as so many
SECOND = float(1 << 26)
GOLDEN = 0x9E3779B97F4A7C15
SPLIT = np.dtype([("feature", "i4"), ("bin", "i4"), ("gain", "f8"), ("counts", "i8", 2), ("left", "i8", 2)])
_HASH_RANGE = 1 << 31


def _at(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """``values[places]`` for places that are in range (the check costs more than what is looked up)."""
    return values.take(places, mode="wrap")


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stream(*numbers: int) -> np.uint64:
    """A number that stands for ``numbers``."""
    x = np.zeros(1, np.uint64)
    for n in numbers:
        x = _mixed(x + np.uint64(n & (1 << 64) - 1) + np.uint64(GOLDEN))
    return x[0]


#: Poisson(1) by 16 random bits
_COPIES = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]),
                          (np.arange(1 << 16) + 0.5) / (1 << 16), side="right").astype(np.uint8)


def copies(words: np.ndarray, tree: int) -> np.ndarray:
    """How often each row is in the bag of ``tree``; ``words`` are those of the tree's four."""
    return _at(_COPIES, ((words >> np.uint64(16 * (tree % 4))) & np.uint64(0xFFFF)).view(np.int64))


def words(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Random bits of each row for four trees."""
    return _mixed(keys + _stream(seed, tree // 4))


def subsets(tree: int, nodes: np.ndarray, width: int, seed: int) -> np.ndarray:
    """The features, in order, among which each node of a tree looks for its split."""
    some = math.ceil(math.sqrt(width))
    own = _mixed(nodes.astype(np.uint64) * np.uint64(GOLDEN) + _stream(seed, tree, width))
    order = _mixed(own[:, None] + (np.arange(width, dtype=np.uint64) + np.uint64(1)) * np.uint64(GOLDEN))
    return np.sort(np.argpartition(order, some - 1, axis=1)[:, :some], axis=1)


def thresholds_of(values: np.ndarray, rows: int) -> np.ndarray:
    """At most BINS - 1 thresholds between the values of one feature; ``values`` are those that are not 0 of ``rows``."""
    found, n = np.unique(values, return_counts=True)
    if rows > len(values):
        at = np.searchsorted(found, 0.0)
        found, n = np.insert(found, at, 0.0), np.insert(n, at, rows - len(values))
    middle = found[:-1] + np.diff(found) * MIDDLE
    if len(middle) < BINS:
        return middle
    taken, stride, upto = [], rows / BINS, np.cumsum(n)
    target = stride
    for i in range(1, len(found)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            taken.append(middle[i - 1])
            target += stride
    return np.array(taken)


@dataclass
class Bins:
    """The bins of all features, numbered through: those of feature f from ``first[f]``."""

    thresholds: list[np.ndarray]
    common: np.ndarray  # features that most rows have a value of: rows keep the bin of these also where 0 is in it

    def __post_init__(self) -> None:
        self.width = len(self.thresholds)
        self.each = np.array([len(t) + 1 for t in self.thresholds], dtype=np.int64)
        self.first = np.cumsum(self.each) - self.each
        self.total = int(self.each.sum())
        self.feature = np.repeat(np.arange(self.width), self.each)
        self.bin = np.arange(self.total) - self.first[self.feature]
        self.of_zero = np.array([np.searchsorted(t, 0.0) for t in self.thresholds], dtype=np.int64)
        self.padded = np.full((self.width, max(self.each)), np.inf)
        for f, t in enumerate(self.thresholds):
            self.padded[f, :len(t)] = t
        self.kind = np.dtype(np.uint16 if self.total < 1 << 16 else np.uint32)

    def entries(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """(row, number of bin) by row of the values that fall elsewhere than 0 does, and of those of common features; the
        batch's columns kind, at, v come first."""
        row, feature, value = vector_entries(batch)
        found = np.empty(len(row), np.int64)
        for s in range(0, len(row), BLOCK):
            e = slice(s, s + BLOCK)
            found[e] = (self.padded[feature[e]] < value[e, None]).sum(axis=1)
        kept = (found != self.of_zero[feature]) | self.common[feature]
        return row[kept], self.first[feature[kept]] + found[kept]

    def dense(self, rows: int, row: np.ndarray, number: np.ndarray) -> np.ndarray:
        """The bin of each feature of each row, row after row."""
        x = np.empty((rows, self.width), np.uint8)
        x[:] = self.of_zero
        x[row, self.feature[number]] = self.bin[number]
        return x.ravel()


def vector_entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, value) of the entries of vectors given as columns kind, at, v, by row."""
    dense = batch.column(0).to_numpy(zero_copy_only=False) == DENSE
    parts = []
    for rows, sparse in ((np.flatnonzero(~dense), True), (np.flatnonzero(dense), False)):
        if len(rows):
            values = batch.column(2).take(pa.array(rows))
            size = np.diff(values.offsets.to_numpy())
            at = (batch.column(1).take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False) if sparse
                  else np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
            parts.append((np.repeat(rows, size), at.astype(np.int64), values.flatten().to_numpy(zero_copy_only=False)))
    row, at, value = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
    order = np.argsort(row, kind="stable")
    return row[order], at[order], value[order]


class Tree:
    """Nodes by number, the root is 0.  Rows whose bin of ``feature`` is over ``bin`` go to the second of ``after``; both
    are the node itself for a leaf.  ``counts``: rows of each class in the bag; ``open``: nodes that may be split yet."""

    def __init__(self) -> None:
        self.feature, self.bin = np.zeros(1, np.int32), np.zeros(1, np.int32)
        self.after, self.counts = np.zeros((1, 2), np.int32), np.zeros((1, 2), np.int64)
        self.gain, self.open = np.zeros(1), np.zeros(1, np.int32)

    def split(self, found: np.ndarray, last: bool) -> None:
        """One level more: ``found`` has a SPLIT for each open node."""
        self.counts[self.open] = found["counts"]
        done = found["gain"] > 0
        at, found = self.open[done], found[done]
        new = len(self.gain) + np.arange(2 * len(at), dtype=np.int32)
        self.feature[at], self.bin[at], self.gain[at] = found["feature"], found["bin"], found["gain"]
        self.after[at] = new.reshape(-1, 2)
        below = np.stack([found["left"], found["counts"] - found["left"]], axis=1).reshape(-1, 2)
        self.open = new[(below > 0).all(axis=1)] if not last else new[:0]
        for name, more in (("feature", 0 * new), ("bin", 0 * new), ("gain", 0.0 * new), ("counts", below), ("after", np.stack([new, new], axis=1))):
            setattr(self, name, np.concatenate([getattr(self, name), more]))

    def is_leaf(self) -> np.ndarray:
        return self.after[:, 0] == np.arange(len(self.after))

    def prune(self, weights: np.ndarray) -> None:
        """Leaves of one parent that predict the same class become one, from the last on."""
        second = (self.counts * weights)[:, 1] > (self.counts * weights)[:, 0]
        leaf = self.is_leaf()
        for i in np.flatnonzero(~leaf)[::-1].tolist():  # children have larger numbers
            a, b = self.after[i]
            if leaf[a] and leaf[b] and second[a] == second[b]:
                leaf[i], self.after[i], self.feature[i], self.bin[i], self.gain[i] = True, i, 0, 0, 0.0


def walked(feature: np.ndarray, most: np.ndarray, after: np.ndarray, dense: np.ndarray, at: np.ndarray, steps: int) -> np.ndarray:
    """The node of a tree that each row reaches; ``at``: where the rows begin in ``dense``."""
    feature, most = np.repeat(feature.astype(np.intp), 2), np.repeat(most.astype(np.uint8), 2)
    after, node = 2 * after.astype(np.intp).ravel(), np.zeros(len(at), np.intp)  # twice the node's number
    for _ in range(steps):
        right = _at(dense, at + _at(feature, node)) > _at(most, node)
        node = _at(after, node + right)
    return node >> 1


@dataclass
class Places:
    """Where the counts of a tree's open nodes stand in one row of numbers: for each node its rows, then the bins of its
    features."""

    features: np.ndarray  # of each node
    start: np.ndarray
    of: np.ndarray  # for each node and feature: where its bins begin
    size: int

    @staticmethod
    def make(bins: Bins, tree: int, nodes: np.ndarray, seed: int) -> Places:
        features = subsets(tree, nodes, bins.width, seed)
        each = bins.each[features]
        ends = np.cumsum(1 + each.sum(axis=1))
        start = ends - 1 - each.sum(axis=1)
        return Places(features, start, start[:, None] + 1 + np.cumsum(each, axis=1) - each, int(ends[-1]))

    def table(self, bins: Bins) -> np.ndarray:
        """For each node and number of bin, and a last one that stands for none: the place after the node's start, 0 if it
        is not counted."""
        of = np.zeros((len(self.start), bins.width), np.int16 if bins.width < 1 << 16 else np.int32)
        np.put_along_axis(of, self.features, (self.of - self.start[:, None]).astype(of.dtype), axis=1)
        out = np.zeros((len(self.start), bins.total + 1), of.dtype)
        of = of[:, bins.feature]
        np.add(of, bins.bin.astype(of.dtype), out=out[:, :-1], where=of > 0)
        return out


@dataclass
class Held:
    """Rows in a task: keys, what each counts by its class, bins by feature, and the numbers of bins, one column a row."""

    keys: np.ndarray
    unit: np.ndarray
    dense: np.ndarray
    numbers: np.ndarray
    has: np.ndarray  # which features are in each line of ``numbers``

    @staticmethod
    def make(bins: Bins, keys: np.ndarray, labels: np.ndarray, length: np.ndarray, numbers: np.ndarray) -> Held:
        row = np.repeat(np.arange(len(keys)), length)
        lines = np.full((max(1, length.max(initial=0)), len(keys)), bins.total, bins.kind)
        line = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
        lines[line, row] = numbers
        has = np.zeros((len(lines), bins.width), np.float32)
        has[line, bins.feature[numbers]] = 1
        return Held(keys.view(np.uint64), np.where(labels == 1, SECOND, 1.0), bins.dense(len(keys), row, numbers), lines, has)

    def counts(self, bins: Bins, tree: int, walk: tuple, nodes: np.ndarray, steps: int, bits: np.ndarray, places: Places) -> np.ndarray:
        """(2, size) of one tree: rows of each class by place."""
        table, across, sums = places.table(bins).ravel(), bins.total + 1, np.zeros(places.size)
        among = np.full(len(walk[0]), -1)
        among[nodes] = np.arange(len(nodes))
        wanted = np.zeros((len(nodes), bins.width), np.float32)
        np.put_along_axis(wanted, places.features, 1, axis=1)
        wanted = (self.has @ wanted.T) > 0  # by line and node
        seldom = wanted.mean(axis=1) < 0.5
        for s in range(0, len(self.keys), BLOCK):
            n = copies(bits[s:s + BLOCK], tree)
            row = np.flatnonzero(n != 0)
            node = _at(among, walked(*walk, self.dense, (row + s) * bins.width, steps))
            here = np.flatnonzero(node >= 0)
            if len(here) < len(node):
                row, node = _at(row, here), _at(node, here)
            if not len(row):
                continue
            unit, start, base = _at(self.unit[s:s + BLOCK], row) * _at(n, row), _at(places.start, node), node * across
            np.add.at(sums, start, unit)
            for line, some, few in zip(self.numbers[:, s:s + BLOCK], wanted, seldom):
                if few:
                    own = np.flatnonzero(_at(some, node))
                    if not len(own):
                        continue
                    place = _at(table, _at(line, _at(row, own)) + _at(base, own))
                    counted = np.flatnonzero(place != 0)
                    own = _at(own, counted) if len(counted) else counted
                else:
                    place = _at(table, _at(line, row) + base)
                    own = counted = np.flatnonzero(place != 0)
                if len(own):
                    np.add.at(sums, _at(start, own) + _at(place, counted), _at(unit, own))
        second = np.floor(sums / SECOND)
        return np.stack([sums - second * SECOND, second])


def best_splits(bins: Bins, places: Places, counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A SPLIT for each node from (2, size) counts; the gain is 0 where no split has one."""
    n, some = places.features.shape
    most = int(bins.each[places.features].max())
    inside = np.arange(most) < bins.each[places.features][..., None]
    at = np.where(inside, places.of[..., None] + np.arange(most), 0)
    left = np.where(inside, counts[:, at], 0)  # class, node, feature, bin
    total = counts[:, places.start]
    zero = np.broadcast_to(bins.of_zero[places.features][None, ..., None], (2, n, some, 1))
    np.put_along_axis(left, zero, 0, axis=3)  # rows may lack it
    np.put_along_axis(left, zero, (total[..., None] - left.sum(axis=3))[..., None], axis=3)
    left = left.cumsum(axis=3)
    right = total[..., None, None] - left
    a, b, whole = ([x * w for x, w in zip(side, weights)] for side in (left, right, total))

    def gini(one: np.ndarray, two: np.ndarray) -> np.ndarray:
        both = np.maximum(one + two, np.finfo(float).tiny)
        return 1 - (one / both) ** 2 - (two / both) ** 2

    every = np.maximum(whole[0] + whole[1], np.finfo(float).tiny)[:, None, None]
    gain = gini(*whole)[:, None, None] - (a[0] + a[1]) / every * gini(*a) - (b[0] + b[1]) / every * gini(*b)
    allowed = inside & (left.sum(axis=0) > 0) & (right.sum(axis=0) > 0)
    gain = np.where(allowed, gain, -1.0).reshape(n, -1)
    best, node = gain.argmax(axis=1), np.arange(n)
    out = np.zeros(n, SPLIT)
    out["feature"], out["bin"] = places.features[node, best // most], best % most
    out["gain"] = np.maximum(gain[node, best], 0.0)
    out["counts"] = total.T
    out["left"] = left.reshape(2, n, -1)[:, node, best].T
    return out


def _level(rows: DataFrame, bins: Bins, trees: list[Tree], steps: int, seed: int, weights: np.ndarray) -> dict[int, np.ndarray]:
    """The best splits of the open nodes of all trees."""
    grown = {t: ((x.feature, x.bin, x.after), x.open) for t, x in enumerate(trees) if len(x.open)}

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[Held]:
        parts: list[tuple] = []
        for batch in (b for b in batches if b.num_rows):
            codes = batch.column(2)
            ends = np.frombuffer(codes.buffers()[1], np.int32)[codes.offset:codes.offset + len(codes) + 1]
            numbers = np.frombuffer(codes.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]].view(bins.kind)
            parts.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), np.diff(ends) // bins.kind.itemsize, numbers))
            if sum(len(p[0]) for p in parts) >= ROWS:
                yield Held.make(bins, *map(np.concatenate, zip(*parts)))
                parts = []
        if parts:
            yield Held.make(bins, *map(np.concatenate, zip(*parts)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for rows_held in held(batches):
            bits = None
            for t, (walk, nodes) in grown.items():
                if bits is None or t // 4 != four:
                    four, bits = t // 4, words(rows_held.keys, t, seed)
                found = rows_held.counts(bins, t, walk, nodes, steps, bits, Places.make(bins, t, nodes, seed))
                sums[t] = found.astype(np.uint32) if t not in sums else sums[t] + found.astype(np.uint32)
        for t, x in sums.items():
            x = x.astype(np.min_scalar_type(x.max()))
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([x.dtype.str]), pa.array([x.tobytes()], pa.binary())],
                                             ["tree", "kind", "data"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for t, kind, data in zip(*(batch.column(k).to_pylist() for k in range(3))):
                sums[t] = np.frombuffer(data, kind) + sums.get(t, np.zeros(1, np.int64))
        for t, x in sums.items():
            places = Places.make(bins, t, grown[t][1], seed)
            found = best_splits(bins, places, x.reshape(2, -1), weights)
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([found.tobytes()], pa.binary())], ["tree", "data"])

    cores = rows.sparkSession.sparkContext.defaultParallelism
    counted = rows.coalesce(TASKS * cores).mapInArrow(count, "tree int, kind string, data binary")
    found = counted.repartition(min(TASKS * cores, len(grown)), "tree").mapInArrow(choose, "tree int, data binary")
    return {r["tree"]: np.frombuffer(r["data"], SPLIT) for r in found.collect()}  # a row for each tree


def _vector(df: DataFrame, *more) -> DataFrame:
    u = F.unwrap_udt("features")
    return df.select(u["type"].alias("kind"), u["indices"].alias("at"), u["values"].alias("v"), *more)


def find_bins(train: DataFrame, rows: int, width: int) -> Bins:
    """Thresholds from rows chosen by the hash ``place``, each content once."""
    if rows > SAMPLE:
        train = train.where(F.pmod("place", F.lit(_HASH_RANGE)) < int(_HASH_RANGE * (SAMPLE / rows)))
    sample = _vector(train.dropDuplicates(["place"])).toArrow().combine_chunks().to_batches()
    if not sample:
        return Bins([np.zeros(0)] * width, np.zeros(width, bool))
    _, at, value = vector_entries(sample[0])
    at, value = at[value != 0], value[value != 0]
    order = np.argsort(at, kind="stable")
    parts = np.split(value[order], np.searchsorted(at[order], np.arange(1, width)))
    return Bins([thresholds_of(p, sample[0].num_rows) for p in parts], np.array([2 * len(p) > sample[0].num_rows for p in parts]))


def stage_rows(train: DataFrame, label: str, bins: Bins) -> DataFrame:
    """(key, label, numbers of bins) of each row, in a Parquet table; equal rows get different keys."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, found = bins.entries(batch)
            ends = np.append(0, np.cumsum(np.bincount(row, minlength=batch.num_rows))) * bins.kind.itemsize
            codes = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends.astype(np.int32)),
                                                                        pa.py_buffer(found.astype(bins.kind))])
            yield pa.RecordBatch.from_arrays([batch.column(3), batch.column(4), codes], ["place", "label", "numbers"])

    spark = train.sparkSession
    binned = _vector(train, "place", F.col(label).cast("tinyint").alias("label")).mapInArrow(
        number, "place bigint, label tinyint, numbers binary")
    nth = F.row_number().over(Window.partitionBy("place").orderBy("label"))
    keyed = binned.repartition(FILES * spark.sparkContext.defaultParallelism, "place").select(
        F.xxhash64("place", nth).alias("key"), "label", "numbers")
    path = scratch_path(spark, f"forest-{uuid.uuid4().hex[:12]}")
    keyed.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(keyed.schema).parquet(path)


@dataclass
class Forest:
    bins: Bins
    trees: list[Tree]
    weights: np.ndarray  # of the classes

    @property
    def hasSummary(self) -> bool:  # noqa: N802 - as models of pyspark.ml have it
        return False

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802
        """Gain times weight of a node's rows by feature, to a sum of 1 in every tree and in all."""
        total = np.zeros(self.bins.width)
        for t in self.trees:
            own = np.zeros(self.bins.width)
            np.add.at(own, t.feature, t.gain * (t.counts @ self.weights))
            total += own / own.sum() if own.sum() else 0
        return Vectors.dense(total / total.sum() if total.sum() else total)

    def scored(self, test: DataFrame, label: str) -> DataFrame:
        """(label, pred, score): the trees' mean share of class 1 in the weight of the leaf, and whether it is the larger."""
        bins, parts = self.bins, []
        for t in self.trees:
            weight = t.counts * self.weights
            depth, level = 0, np.zeros(1, np.int32)
            while len(level := np.setdiff1d(t.after[level], level)):
                depth += 1
            share = weight / np.maximum(weight.sum(axis=1), np.finfo(float).tiny)[:, None]
            parts.append(((t.feature, t.bin, t.after), share, depth))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.num_rows
                dense, votes = bins.dense(n, *bins.entries(batch)), np.zeros((n, 2))
                for walk, share, depth in parts:
                    votes += share[walked(*walk, dense, np.arange(n) * bins.width, depth)]
                score = votes[:, 1] / np.maximum(votes.sum(axis=1), np.finfo(float).tiny)
                yield pa.RecordBatch.from_arrays([batch.column(3), pa.array((votes[:, 1] > votes[:, 0]).astype(np.int32)), pa.array(score)],
                                                 ["label", "pred", "score"])

        kind = test.schema[label].dataType.simpleString()
        return _vector(test, F.col(label).alias("label")).mapInArrow(run, f"label {kind}, pred int, score double")


def fit(train: DataFrame, label: str, weight: str, trees: int, depth: int, seed: int) -> Forest:
    """A forest for ``train`` (features, label, weight, place); weights are those of the classes 0 and 1.

    ``train`` is read three times: stage it first.  The numbers of its bins are then read once a level."""
    if depth < 1:
        raise ValueError("a forest needs a depth of 1 or more")
    size = F.unwrap_udt("features")
    found = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.min(weight).alias("low"), F.max(weight).alias("high"),
                                     F.max(F.coalesce(size["size"], F.size(size["values"]))).alias("width")).collect()
    if not found or any(r[label] not in (0, 1) or r["low"] != r["high"] for r in found):
        raise ValueError("a forest needs rows, labels 0 or 1 and one weight for each label")
    weights = np.ones(2)
    for r in found:
        weights[r[label]] = r["low"]
    bins = find_bins(train, sum(r["n"] for r in found), max(r["width"] for r in found))
    rows = stage_rows(train, label, bins)
    grown = [Tree() for _ in range(trees)]
    for level in range(depth):
        if not any(len(t.open) for t in grown):
            break
        for t, splits in _level(rows, bins, grown, level, seed, weights).items():
            grown[t].split(splits, level + 1 == depth)
    for t in grown:
        t.prune(weights)
    return Forest(bins, grown, weights)
