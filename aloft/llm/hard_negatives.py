"""Hard-negative mining behind angular triangle bounds.

A row's vector becomes whole numbers (floor of 256 times each component); scores are
inner products with an anchor's, higher first, ties by smaller vec_id.  For every
anchor and each of its first positives (rows of its label), the first rows of other
labels are wanted whose score lies in a window under the positive's score.

* Every row stores its norm and its angles to a few reference directions.  By the triangle
  inequality of angles, |t(a) - t(x)| <= angle(a, x) <= min(t(a) + t(x), 2 pi - t(a) - t(x))
  for each direction, so the stored angles give an interval of the cosine, and the norms make of
  it bounds of the score.  Bounds are widened by more than the rounding of angles, cosines
  and products, so no score lies outside (tested).
* Rows are written in the order of their nearest direction and their angle to it, so that
  rows in a sequence of ``WINDOW`` are alike.  An anchor meets first the bounds of a whole
  sequence, then those of its rows; only where they overlap the scores that can still matter
  is the integer product computed.
* Products are exact: by Cauchy and Schwarz no partial sum exceeds the product of the norms,
  so doubles serve below 2**53 and 64-bit integers below 2**63.

Anchors are the query set; they come in blocks of at most ``ANCHOR_BLOCK`` rows and
``ANCHOR_NUMBERS`` components, which are sent to the tasks, against all rows; the result of a block
is written before the next begins.  What a task passes on of a block's answers so far is bounded by
improvements of the first ``positives`` or ``negatives`` of each, ties included.  The directions
are fitted on at most ``SAMPLE`` rows; they decide how much is skipped, never what is found.

Rows with a null label, a null vector or a null or non-finite component take no part.  Vectors of
different lengths have no inner product: such pairs are left out.  An empty or zero vector has score
0.  Repeated rows are rows of their own (each repeated anchor has its answers); a null vec_id is no
anchor and last among equal scores.  Whole numbers of 2**53 or more, and norms whose product reaches
2**63, raise.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aloft.llm.common import stage

SCALE = 256
ANCHOR_STEP = 100
POSITIVES = 5
NEGATIVES = 5
#: a negative's score is at least this share (in per cent) of the positive's, and at most all of it
LOWEST = 80
DIRECTIONS = 16
SAMPLE = 4096
WINDOW = 512
ANCHOR_BLOCK = 8192
ANCHOR_NUMBERS = 1 << 22
NO_ID = np.iinfo(np.int64).max
NOTHING = -NO_ID  # its negative is a number, too


def relabelled(vectors: DataFrame) -> DataFrame:
    """``vectors`` with the label of every seventh vec_id moved on by one, modulo 10."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.select("vec_id", "embedding", moved.cast("long").alias("label"))


def slack(dim: int) -> float:
    """More than the error of a stored angle: the cosine's rounding error passes through an arc cosine."""
    return 4 * float(np.sqrt(dim * np.finfo(float).eps)) + 1e-9


def fit_directions(sample: np.ndarray, count: int = DIRECTIONS, rounds: int = 4) -> np.ndarray:
    """Unit vectors spread over the sample's directions: farthest first, then mean directions."""
    norm = np.linalg.norm(sample, axis=1)
    unit = sample[norm > 0] / norm[norm > 0, None]
    if not len(unit):
        return np.eye(sample.shape[1])[:count]
    picked = [0]
    nearest = unit @ unit[0]
    while len(picked) < min(count, len(unit)):
        picked.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[picked[-1]])
    centre = unit[picked]
    for _ in range(rounds):
        own = (unit @ centre.T).argmax(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, own, unit)
        size = np.linalg.norm(total, axis=1)
        centre = np.where(size[:, None] > 1e-9, total / np.maximum(size, 1e-9)[:, None], centre)
    return centre


def angles(rows: np.ndarray, norms: np.ndarray, directions: np.ndarray) -> np.ndarray:
    cosine = rows @ directions.T / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(cosine, -1, 1))


def score_bounds(low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of scores whose angle lies in [low, high] and whose norms' product in [least, most]."""
    up, down = np.cos(np.clip(low, 0, np.pi)), np.cos(np.clip(high, 0, np.pi))
    margin = 1 + 1e-12 * most
    return (down * np.where(down < 0, most, least) - margin, up * np.where(up < 0, least, most) + margin)


def products(one: np.ndarray, two: np.ndarray, limit: float) -> np.ndarray:
    """Exact inner products of all rows of whole numbers; ``limit``: no product of norms is larger."""
    if limit < 2.0 ** 52:
        return (one @ two.T).astype(np.int64)
    if limit < 2.0 ** 62:
        return one.astype(np.int64) @ two.astype(np.int64).T
    raise OverflowError("inner products of these vectors can exceed 64 bits")


class Anchors:
    """The anchors of one length in a block, with what is known of their answers.

    ``wanted`` has (lowest, highest) of the scores wanted in each slot of an anchor.
    """

    def __init__(self, at: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, labels: np.ndarray, directions: np.ndarray,
                 wanted: np.ndarray):
        self.at, self.rows, self.row_ids, self.labels = at, rows, row_ids, labels
        self.norms = np.linalg.norm(rows, axis=1)
        self.angles = angles(rows, self.norms, directions)
        self.wanted = wanted


class Search:
    """One task's pass over its rows for one length: keeps the first ``top`` of every slot."""

    def __init__(self, anchors: Anchors, same_label: bool, top: int):
        self.a, self.same, self.top = anchors, same_label, top
        n, slots, _ = anchors.wanted.shape
        self.score = np.full((n, slots, top), NOTHING, dtype=np.int64)
        self.ids = np.full((n, slots, top), NO_ID, dtype=np.int64)
        self.scored = 0

    def still(self) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest score that can still be an answer of each anchor."""
        low = np.maximum(self.a.wanted[:, :, 0], self.score[:, :, -1])
        some = self.a.wanted[:, :, 0] <= self.a.wanted[:, :, 1]
        return (np.where(some, low, NO_ID).min(axis=1), np.where(some, self.a.wanted[:, :, 1], NOTHING).max(axis=1))

    def window(self, rows: np.ndarray, norms: np.ndarray, theta: np.ndarray, labels: np.ndarray, ids: np.ndarray,
               row_ids: np.ndarray) -> tuple[np.ndarray, ...]:
        """(anchor, slot, index of the row, score) of new answers among some rows."""
        a, eps = self.a, 2 * slack(rows.shape[1])
        low, high = self.still()
        first, last = theta.min(axis=0), theta.max(axis=0)
        apart = np.maximum(a.angles - last, first - a.angles).max(axis=1, initial=0) - eps
        within = np.minimum(a.angles + last, 2 * np.pi - a.angles - first).min(axis=1, initial=np.pi) + eps
        least, most = score_bounds(apart, within, a.norms * norms.min(), a.norms * norms.max())
        some = (most >= low) & (least <= high)
        if self.same:
            some &= np.isin(a.labels, labels)
        some = np.flatnonzero(some)
        if not len(some):
            return ()
        apart = np.zeros((len(some), len(rows)))
        within = np.full((len(some), len(rows)), np.pi)
        for r in range(theta.shape[1]):
            own = a.angles[some, r][:, None]
            np.maximum(apart, np.abs(own - theta[None, :, r]), out=apart)
            both = own + theta[None, :, r]
            np.minimum(within, np.minimum(both, 2 * np.pi - both), out=within)
        size = a.norms[some][:, None] * norms[None, :]
        least, most = score_bounds(apart - eps, within + eps, size, size)
        near = (most >= low[some][:, None]) & (least <= high[some][:, None])
        near &= (a.labels[some][:, None] == labels[None, :]) == self.same
        near &= a.row_ids[some][:, None] != row_ids[None, :]
        used_a, used_x = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        if not len(used_a):
            return ()
        some, near = some[used_a], near[np.ix_(used_a, used_x)]
        self.scored += near.size
        scores = products(a.rows[some], rows[used_x], float(a.norms[some].max() * norms[used_x].max()))
        u, v = np.nonzero(near)
        return self._answers(some[u], used_x[v], scores[u, v], ids)

    def _answers(self, anchor: np.ndarray, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
        found: list[tuple[np.ndarray, ...]] = []
        for slot in range(self.score.shape[1]):
            lowest, highest = self.a.wanted[anchor, slot, 0], self.a.wanted[anchor, slot, 1]
            worst, worst_id = self.score[anchor, slot, -1], self.ids[anchor, slot, -1]
            own = ids[row]
            good = (score >= lowest) & (score <= highest) & ((score > worst) | ((score == worst) & (own < worst_id)))
            if not good.any():
                continue
            a, x, s, i = anchor[good], row[good], score[good], own[good]
            order = np.lexsort((i, -s, a))
            a, x, s, i = a[order], x[order], s[order], i[order]
            head = np.arange(len(a)) - np.searchsorted(a, a) < self.top
            a, x, s, i = a[head], x[head], s[head], i[head]
            who, place = np.unique(a, return_inverse=True)
            inside = np.arange(len(a)) - np.searchsorted(a, a)
            fresh = np.full((len(who), self.top), NOTHING, dtype=np.int64)
            fresh_id = np.full((len(who), self.top), NO_ID, dtype=np.int64)
            fresh[place, inside], fresh_id[place, inside] = s, i
            both = np.concatenate([self.score[who, slot], fresh], axis=1)
            both_id = np.concatenate([self.ids[who, slot], fresh_id], axis=1)
            order = np.lexsort((both_id, -both), axis=1)[:, :self.top]
            self.score[who, slot] = np.take_along_axis(both, order, 1)
            self.ids[who, slot] = np.take_along_axis(both_id, order, 1)
            found.append((a, np.full(len(a), slot), x, s))
        return tuple(np.concatenate(c) for c in zip(*found)) if found else ()


def prepare(vectors: DataFrame) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """(row, vec_id, label, whole, norm, angles) of the rows that take part, in window order, and the
    reference directions of every length in the sample."""
    spark = vectors.sparkSession
    e = F.col("embedding").cast("array<double>")
    finite = ~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), e.alias("e")).where(
        "label is not null and e is not null").where(finite)
    own = own.select("vec_id", "label", F.transform("e", lambda x: F.floor(x * SCALE).cast("double")).alias("whole"))
    staged = stage(own.withColumn("row", F.monotonically_increasing_id()), "whole-vectors")

    sample: dict[int, list] = {}
    for r in staged.select("whole").orderBy(F.xxhash64("row")).limit(SAMPLE).collect():  # a bounded sample
        sample.setdefault(len(r["whole"]), []).append(r["whole"])
    directions = {dim: fit_directions(np.array(rows, dtype=float)) for dim, rows in sample.items() if dim}
    sent = spark.sparkContext.broadcast(directions)
    schema = T.StructType([*staged.schema.fields, T.StructField("norm", T.DoubleType()), T.StructField("dim", T.IntegerType()),
                           T.StructField("angles", T.ArrayType(T.DoubleType(), False)),
                           T.StructField("nearest", T.IntegerType()), T.StructField("away", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(b.schema.get_field_index("whole"))
            dims = np.diff(column.offsets.to_numpy())
            norm, nearest, away = np.zeros(len(dims)), np.zeros(len(dims), np.int32), np.zeros(len(dims))
            theta: list = [[]] * len(dims)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                rows = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)
                if dim and np.abs(rows).max() >= 2.0 ** 53:
                    raise OverflowError("a scaled component reaches 2**53")
                norm[at] = np.linalg.norm(rows, axis=1)
                if int(dim) in sent.value:
                    t = angles(rows, norm[at], sent.value[int(dim)])
                    nearest[at], away[at] = t.argmin(axis=1), t.min(axis=1)
                    for k, i in enumerate(at):
                        theta[i] = t[k]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(norm), pa.array(dims, pa.int32()), pa.array(theta, pa.list_(pa.float64())),
                 pa.array(nearest), pa.array(away)], schema.names)

    order = ["dim", "nearest", "away", "row"]
    measured = stage(staged.mapInArrow(run, schema), "measured")
    return stage(measured.repartitionByRange(*order).sortWithinPartitions(*order), "windows"), directions


def _anchors(block: list, directions: dict, wanted: np.ndarray) -> dict[int, Anchors]:
    out = {}
    dims = np.array([len(r["whole"]) for r in block])
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        rows = np.array([block[i]["whole"] for i in at], dtype=float).reshape(len(at), int(dim))
        out[int(dim)] = Anchors(at, rows, np.array([block[i]["row"] for i in at], dtype=np.int64),
                                np.array([block[i]["label"] for i in at], dtype=np.int64),
                                directions.get(int(dim), np.zeros((0, int(dim)))), wanted[at])
    return out


def _scan(rows: DataFrame, anchors: dict[int, Anchors], same_label: bool, top: int) -> DataFrame:
    """(at, slot, vec_id, score): what each task's rows can add to the first ``top`` of every slot."""
    sent = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = {dim: Search(a, same_label, top) for dim, a in sent.value.items()}
        for b in batches:
            whole, theta = b.column(3), b.column(5)
            dims = np.diff(whole.offsets.to_numpy())
            cuts = np.flatnonzero(np.diff(dims)) + 1
            row_ids, labels, norms = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 2, 4))
            ids = b.column(1).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            for i, j in zip([0, *cuts], [*cuts, b.num_rows]):
                search = searches.get(int(dims[i])) if i < j else None
                if search is None:
                    continue
                for s in range(i, j, WINDOW):
                    e = min(s + WINDOW, j)
                    x = whole.slice(s, e - s).flatten().to_numpy(zero_copy_only=False).reshape(e - s, dims[i])
                    t = theta.slice(s, e - s).flatten().to_numpy(zero_copy_only=False).reshape(
                        e - s, search.a.angles.shape[1])
                    found = search.window(x, norms[s:e], t, labels[s:e], ids[s:e], row_ids[s:e])
                    if found:
                        a, slot, k, score = found
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(search.a.at[a], pa.int64()), pa.array(slot, pa.int64()),
                             b.column(1).slice(s, e - s).take(pa.array(k)).cast(pa.int64()), pa.array(score, pa.int64())],
                            ["at", "slot", "vec_id", "score"])

    own = rows.select("row", "vec_id", "label", "whole", "norm", "angles")
    return own.mapInArrow(run, "at long, slot long, vec_id long, score long")


def _first(found: DataFrame, top: int) -> DataFrame:
    over = Window.partitionBy("at", "slot").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(over)).where(F.col("rank") <= top)


def _mine_block(rows: DataFrame, directions: dict, block: list, positives: int, negatives: int, lowest: int) -> DataFrame:
    spark = rows.sparkSession
    every = np.tile(np.array([NOTHING + 1, NO_ID], dtype=np.int64), (len(block), 1, 1))
    best = _first(_scan(rows, _anchors(block, directions, every), True, positives), positives).collect()  # bounded by the block
    wanted = np.tile(np.array([1, 0], dtype=np.int64), (len(block), positives, 1))
    pairs = []
    for r in best:
        slot, score = r["rank"] - 1, r["score"]
        pairs.append((r["at"], slot, block[r["at"]]["vec_id"], r["vec_id"], score))
        if score >= 0:  # under a negative score, the window is empty
            wanted[r["at"], slot] = -(-lowest * score // 100), score
    found = _first(_scan(rows, _anchors(block, directions, wanted), False, negatives), negatives)
    named = spark.createDataFrame(pairs, "at long, slot long, anchor_id long, positive_id long, positive_score long")
    return stage(found.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(named, ["at", "slot"])
                 .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives")


def _blocks(anchors: DataFrame) -> Iterator[list]:
    """The anchors in blocks of bounded size, read one after the other."""
    block, size = [], 0
    for r in anchors.toLocalIterator():
        if block and (len(block) == ANCHOR_BLOCK or size + len(r["whole"]) > ANCHOR_NUMBERS):
            yield block
            block, size = [], 0
        block.append(r)
        size += len(r["whole"])
    if block:
        yield block


def mine(vectors: DataFrame, step: int = ANCHOR_STEP, positives: int = POSITIVES, negatives: int = NEGATIVES,
         lowest: int = LOWEST) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of all ``vectors`` (vec_id,
    embedding, label); anchors are the rows whose vec_id is divisible by ``step``."""
    rows, directions = prepare(vectors)
    out = vectors.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                                   "positive_score long, negative_score long")
    first = True
    for block in _blocks(rows.where(F.col("vec_id") % step == 0).select("row", "vec_id", "label", "whole")):
        found = _mine_block(rows, directions, block, positives, negatives, lowest)
        out, first = found if first else out.unionByName(found), False
    return out
