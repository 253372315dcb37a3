"""MinHash near-dedup with odd sketches.

Two documents are linked when their sets of five-word shingles have a Jaccard
similarity of 0.75 or more; groups are the connected components of the links.

1. One pass makes of each text its set's size and digest, ``ROWS * BANDS`` MinHash
   samples as band keys, and an odd sketch: every sample flips one bit of a bitmap, so
   the XOR of two bitmaps shows by its population count in how many samples they
   differ.  Documents of equal sets form a class; only classes are compared.
2. Classes that share a band key are candidates.  A bucket first compares every class
   with the bucket's first one; sizes and odd sketches reject what cannot reach the
   threshold, full shingle sets confirm the rest.
3. Where a bucket still holds several components, its classes get a finer odd sketch of
   more samples, and those of different components are compared with each other, in
   blocks: a task holds the sketches and the full sets of two blocks of one bucket, and answers
   for the pairs whose first common bucket it is.  It confirms pairs on their full sets there, the
   likeliest first, and passes on only links that join two components of what it has seen: a
   forest, so what leaves a task grows with its classes, not with its pairs.  Pairs of one
   component need no comparison.  Nothing is capped: where very many pairs are left to confirm, all
   intersections of the two blocks are counted at once by a product of incidence matrices.

A pair of exactly the threshold shares no band with probability
(1 - 0.75**4)**32 = 5e-6; odd sketches reject below estimates of ``REJECT`` and
``FINE_REJECT``, five standard deviations under the threshold.

A text of fewer than five words, but not none, is one shingle; a null text or one
without words is linked with nothing.  The smallest id of a group is its
component_id; repeated rows fall into one class; rows with a null id take part, but
never name a group that has another id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aloft.llm import textops
from aloft.llm.common import free_name, stage
from aloft.llm.components import components
from aloft.llm.minimizers import of_rows, text_hash

SHINGLE = 5
#: similarity of links, in per cent
PERCENT = 75
BANDS = 32
ROWS = 4
#: bits of an odd sketch
BITS = 512
#: estimated similarity below which a pair is not compared in full
REJECT = 0.55
#: the finer sketch of classes whose bucket holds several components
FINE_SAMPLES = 512
FINE_BITS = 2048
FINE_REJECT = 0.65
#: classes, and shingles of classes, in one block of a bucket; members compared with one copy of a leader's text
BLOCK = 1024
BLOCK_SHINGLES = 1 << 21
MEMBERS = 256
#: columns of an incidence matrix made at once; products of matrix elements that take the time of finding one
#: shingle of one set in another
COLUMNS = 4096
FLOPS_A_SHINGLE = 500

_K = BANDS * ROWS
_A = textops.mix(np.arange(1, FINE_SAMPLES + 1, dtype=textops.U64)) | textops.U64(1)
_B = textops.mix(np.arange(1001, 1001 + FINE_SAMPLES, dtype=textops.U64))


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the rows (with repeats) and the offsets of each row's."""
    data = textops.LOWER[data]
    starts, ends, first = textops.words(data, offsets)
    words = textops.word_hashes(data, starts, ends)
    n = np.diff(first)
    size = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    out_first = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(int(out_first[-1]), dtype=textops.U64)
    if len(words) >= SHINGLE:
        grams = textops.window_hash(words, SHINGLE)
        row = np.repeat(np.arange(len(n)), size)
        at = first[row] + np.arange(len(out)) - out_first[row]
        full = n[row] >= SHINGLE
        out[full] = grams[at[full]]
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        out[out_first[short]] = textops.mix(textops.span_hash(words, first[short], first[short + 1])
                                            ^ n[short].astype(textops.U64))
    return out, out_first


def shingle_set(text: str | None) -> np.ndarray:
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    return np.unique(shingles(raw, np.array([0, len(raw)]))[0])


def samples(values: np.ndarray, first: np.ndarray, k: int = _K) -> np.ndarray:
    """MinHash samples (rows x k) of rows that are not empty."""
    out = np.empty((len(first) - 1, k), dtype=textops.U64)
    for i in range(k):
        out[:, i] = np.minimum.reduceat(values * _A[i] + _B[i], first[:-1])
    return out


def band_keys(sample: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=textops.U64)[None, :] * textops.MULT_A
    for r in range(ROWS):
        key = textops.mix(key ^ sample[:, r::ROWS]) * textops.MULT_B
    return textops.mix(key)


def odd_sketches(sample: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Parity bitmaps (rows x bits / 64 words): sample i with value v flips bit h(i, v)."""
    bit = (textops.mix(sample ^ _A[None, :sample.shape[1]]) % textops.U64(bits)).astype(np.int64)
    flips = np.bincount((bit + np.arange(len(sample))[:, None] * bits).ravel(), minlength=len(sample) * bits) & 1
    return np.packbits(flips.reshape(len(sample), bits).astype(np.uint8), axis=1).view(np.uint64)


def estimates(k: int, bits: int) -> np.ndarray:
    """Estimated similarity for each population count of the XOR of two sketches of k samples."""
    z = np.minimum(np.arange(bits + 1), bits // 2 - 1)
    return np.clip(1 - np.log(1 - 2 * z / bits) / np.log(1 - 2 / bits) / (2 * k), 0, 1)


ESTIMATE = estimates(_K, BITS)
FINE_ESTIMATE = estimates(FINE_SAMPLES, FINE_BITS)


def sketch_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, th, n, cls, bands, sketch) of every text; cls is null for an empty set."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("th", T.LongType()),
        T.StructField("n", T.LongType()), T.StructField("cls", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("sketch", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = textops.utf8(b.column(2))
            for i, j in textops.chunks(offsets):
                base = offsets[i]
                values, first = shingles(data[base:offsets[j]], offsets[i:j + 1] - base)
                n, cls = [], []
                for r in range(j - i):
                    own = np.unique(values[first[r]:first[r + 1]])
                    n.append(len(own))
                    cls.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                some = np.flatnonzero(np.diff(first))
                bands: list = [None] * (j - i)
                sketch: list = [None] * (j - i)
                if len(some):
                    sample = samples(values, np.r_[first[some], len(values)])
                    keys, bits = textops.signed(band_keys(sample)), odd_sketches(sample)
                    for k, r in enumerate(some):
                        bands[r], sketch[r] = keys[k], bits[k].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(n, pa.int64()),
                     pa.array(cls, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                     pa.array(sketch, pa.binary())], schema.names)

    return docs.select("doc_id", text_hash(F.col("text")).alias("th"), "text").mapInArrow(run, schema)


def _near(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and odd sketches allow the threshold."""
    side = classes.select("cid", "n", "sketch")
    both = (pairs.join(side.toDF("a", "n_a", "s_a"), "a").join(side.toDF("b", "n_b", "s_b"), "b")
            .where(F.lit(100) * F.least("n_a", "n_b") >= F.lit(PERCENT) * F.greatest("n_a", "n_b")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            one, two = (np.frombuffer(b"".join(t.column(c).to_pylist()), dtype=np.uint64).reshape(t.num_rows, -1)
                        for c in ("s_a", "s_b"))
            far = np.bitwise_count(one ^ two).sum(axis=1, dtype=np.int64)
            keep = pa.array(ESTIMATE[far] >= REJECT)
            yield pa.RecordBatch.from_arrays([t.column("a").filter(keep), t.column("b").filter(keep)], ["a", "b"])

    return both.select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold.

    Pairs are dealt by their first class and a share of its partners, so a leader with
    very many partners is spread; its text goes to every share once.
    """
    share = F.pmod(F.xxhash64("b"), F.greatest(F.lit(1), F.expr(f"n_a div {MEMBERS}")))
    sizes = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n_a"))
    dealt = stage(pairs.join(stage(sizes, "leaders"), "a").select("a", "b", share.alias("share")), "pairs")
    members = dealt.join(texts, F.col("b") == F.col("cid")).select("a", "share", "b", "text")
    leaders = dealt.select("a", "share").distinct().join(texts, F.col("a") == F.col("cid")).select(
        "a", "share", F.lit(None).cast("long").alias("b"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, None
        for t in batches:
            data, offsets = textops.utf8(t.column(3))
            rows = list(zip(*(t.column(k).to_pylist() for k in range(3))))
            found_a, found_b = [], []
            for i, j in textops.chunks(offsets):
                base = offsets[i]
                values, first = shingles(data[base:offsets[j]], offsets[i:j + 1] - base)
                for r, (a, share_, b) in enumerate(rows[i:j]):
                    got = np.unique(values[first[r]:first[r + 1]])
                    if b is None:
                        at, own = (a, share_), got
                        continue
                    assert at == (a, share_)
                    common = len(np.intersect1d(own, got, assume_unique=True))
                    if 100 * common >= PERCENT * (len(own) + len(got) - common):
                        found_a.append(a), found_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], ["a", "b"])

    return (members.unionByName(leaders).repartition("a", "share")
            .sortWithinPartitions("a", "share", F.col("b").asc_nulls_first()).mapInArrow(run, "a long, b long"))


def _mixed(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, cid, comp, size, shingles) of the buckets (key, cid, n) that hold several components."""
    named = stage(buckets.join(labels, buckets["cid"] == labels["node"], "left").select(
        "key", "cid", "n", F.coalesce("component", "cid").alias("comp")), "named")
    several = stage(named.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("size"),
                                             F.sum("n").alias("shingles")).where("x < y").select("key", "size", "shingles"),
                    "several")
    return stage(named.drop("n").join(several, "key"), "mixed")


def _fine_sketches(texts: DataFrame, mixed: DataFrame) -> DataFrame:
    """(cid, fine, short, own): the finer odd sketch of the classes in mixed buckets, the lower 32
    bits of all their band keys, and their sorted shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = textops.utf8(b.column(1))
            for i, j in textops.chunks(offsets):
                base = offsets[i]
                values, first = shingles(data[base:offsets[j]], offsets[i:j + 1] - base)  # no text is without words
                sample = samples(values, first, FINE_SAMPLES)
                bits, keys = odd_sketches(sample, FINE_BITS), band_keys(sample[:, :_K]).astype(np.uint32)
                own = [np.unique(values[s:e]).tobytes() for s, e in zip(first, first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array([x.tobytes() for x in bits], pa.binary()),
                     pa.array([x.tobytes() for x in keys], pa.binary()), pa.array(own, pa.binary())],
                    ["cid", "fine", "short", "own"])

    return texts.join(mixed.select("cid").distinct(), "cid").select("cid", "text").mapInArrow(
        run, "cid long, fine binary, short binary, own binary")


class Block:
    """Classes of one block of a bucket."""

    def __init__(self, rows: list):
        bits = lambda k: np.frombuffer(b"".join(r[k] for r in rows), dtype=np.uint64).reshape(len(rows), -1)
        self.cid, self.comp, self.n = (np.array([r[k] for r in rows], dtype=np.int64) for k in range(3))
        self.sketch, self.fine = bits(3), bits(4)
        self.short = bits(5).view(np.uint32).reshape(len(rows), -1)
        self.own = [np.frombuffer(r[6], dtype=np.uint64) for r in rows]

    def candidates(self, other: Block, band: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of different components whose sketches allow the threshold, the likeliest first; only those
        that share no earlier band."""
        far = np.zeros((len(self.cid), len(other.cid)), dtype=np.int64)
        for w in range(self.sketch.shape[1]):
            far += np.bitwise_count(self.sketch[:, w][:, None] ^ other.sketch[:, w][None, :])
        ok = (ESTIMATE[far] >= REJECT) & (self.comp[:, None] != other.comp[None, :])
        small, large = np.minimum(self.n[:, None], other.n[None, :]), np.maximum(self.n[:, None], other.n[None, :])
        ok &= 100 * small >= PERCENT * large
        if self is other:
            ok &= self.cid[:, None] < other.cid[None, :]
        u, v = np.nonzero(ok)
        here, likely = np.zeros(len(u), dtype=bool), np.empty(len(u))
        for s in range(0, len(u), 1 << 15):
            e = s + (1 << 15)
            here[s:e] = (self.short[u[s:e]] == other.short[v[s:e]]).argmax(axis=1) == band
            likely[s:e] = FINE_ESTIMATE[np.bitwise_count(self.fine[u[s:e]] ^ other.fine[v[s:e]]).sum(axis=1, dtype=np.int64)]
        near = np.flatnonzero(here & (likely >= FINE_REJECT))
        near = near[np.argsort(-likely[near], kind="stable")]
        return u[near], v[near]

    def common(self, other: Block, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of some pairs, by whichever way is shorter."""
        rows, cols = np.unique(u), np.unique(v)
        left, right = [self.own[k] for k in rows], [other.own[k] for k in cols]
        both = np.intersect1d(np.concatenate(left), np.concatenate(right))
        if len(u) * int(self.n[rows].mean()) * FLOPS_A_SHINGLE < len(rows) * len(cols) * len(both):
            return np.array([len(np.intersect1d(self.own[a], other.own[b], assume_unique=True))
                             for a, b in zip(u.tolist(), v.tolist())], dtype=np.int64)

        def places(sets: list) -> tuple[np.ndarray, np.ndarray]:
            flat = np.concatenate(sets)
            at = np.minimum(np.searchsorted(both, flat), len(both) - 1)
            row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
            shared = both[at] == flat
            order = np.argsort(at[shared], kind="stable")
            return row[shared][order], at[shared][order]

        total = np.zeros((len(left), len(right)), dtype=np.int64)
        if len(both):
            (lr, lc), (rr, rc) = places(left), places(right)
            for s in range(0, len(both), COLUMNS):
                sides = []
                for r, c, n in ((lr, lc, len(left)), (rr, rc, len(right))):
                    i, j = np.searchsorted(c, [s, s + COLUMNS])
                    m = np.zeros((n, COLUMNS), dtype=np.float32)
                    m[r[i:j], c[i:j] - s] = 1
                    sides.append(m)
                total += (sides[0] @ sides[1].T).astype(np.int64)
        return total[np.searchsorted(rows, u), np.searchsorted(cols, v)]

    def forest(self, other: Block, band: int) -> list[tuple[int, int]]:
        """Confirmed links (cid, cid) that join different components; those that join the same ones again are
        left out."""
        parent: dict[int, int] = {}

        def root(c: int) -> int:
            while (up := parent.get(c, c)) != c:
                parent[c] = c = parent.get(up, up)
            return c

        u, v = self.candidates(other, band)
        out, step = [], 256
        while len(u):
            # a few at first: what they join need not be compared any more
            a, b = u[:step], v[:step]
            shared = self.common(other, a, b)
            linked = 100 * shared >= PERCENT * (self.n[a] + other.n[b] - shared)
            for x, y in zip(a[linked].tolist(), b[linked].tolist()):
                one, two = root(int(self.comp[x])), root(int(other.comp[y]))
                if one != two:
                    parent[max(one, two)] = min(one, two)
                    out.append((int(self.cid[x]), int(other.cid[y])))
            u, v = u[step:], v[step:]
            if len(u) and linked.any():
                names = np.unique(np.concatenate([self.comp, other.comp]))
                roots = np.array([root(int(c)) for c in names.tolist()])
                apart = roots[np.searchsorted(names, self.comp[u])] != roots[np.searchsorted(names, other.comp[v])]
                u, v = u[apart], v[apart]
            step *= 4
        return out


def _links_across(mixed: DataFrame, sketches: DataFrame) -> DataFrame:
    """Links (a, b) between classes of one bucket, but different components: all that are needed to join them.

    A bucket is cut into blocks; a pair of blocks is one group of rows, solved in one task.
    """
    blocks = F.expr(f"greatest((size + {BLOCK} - 1) div {BLOCK}, (shingles + {BLOCK_SHINGLES} - 1) div {BLOCK_SHINGLES})")
    rows = mixed.withColumn("blocks", blocks)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    # every pair of blocks (i <= j): a row goes to all pairs that have its block
    dealt = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cid", "comp")
    dealt = dealt.join(sketches, "cid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: dict[int, list] = {}
        at = None

        def solve() -> Iterator[pa.RecordBatch]:
            sides = [Block(g) for g in group.values()]
            if len(sides) == 2 or (len(sides) == 1 and at[1] == at[2]):
                band = int(np.flatnonzero(sides[0].short[0] == np.uint32(at[0] & 0xFFFFFFFF))[0])
                found = sides[0].forest(sides[-1], band)
                if found:
                    a, b = np.array(found, dtype=np.int64).T
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        for t in batches:
            for key, i, j, block, *row in zip(*(c.to_pylist() for c in t.columns)):
                if at != (key, i, j):
                    if group:
                        yield from solve()
                    at, group = (key, i, j), {}
                group.setdefault(block, []).append(row)
        if group:
            yield from solve()

    return (dealt.select("key", "i", "j", "block", "cid", "comp", "n", "sketch", "fine", "short", "own")
            .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(run, "a long, b long"))


def group_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, th, n_shingles, component_id, first (the row's text stands
    for its group: the smallest id, then the smallest hash)."""
    docs = docs.select("doc_id", "text")
    sketched = stage(sketch_documents(docs), "sketches")
    classes = stage(sketched.where("cls is not null").groupBy("cls").agg(
        F.min_by(F.struct("th", "n", "bands", "sketch"), F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("r"),
        F.min("doc_id").alias("doc_id")).select(
        F.monotonically_increasing_id().alias("cid"), "cls", "doc_id", "r.*"), "classes")

    bands = classes.select(F.explode("bands").alias("key"), "cid", "n")
    leaders = stage(bands.groupBy("key").agg(F.min("cid").alias("leader"), F.count(F.lit(1)).alias("size"))
                    .where("size > 1").select("key", "leader"), "leaders")
    buckets = stage(bands.join(leaders, "key").select("key", "cid", "n", "leader"), "buckets")
    star = buckets.where("cid <> leader").select(F.col("leader").alias("a"), F.col("cid").alias("b")).distinct()
    involved = classes.join(buckets.select("cid").distinct(), "cid").select(
        "cid", F.col("doc_id").alias("l_doc"), F.col("th").alias("l_th"))
    # identical rows give the same text more than once
    texts = stage(of_rows(docs, involved).select("cid", "text").dropDuplicates(["cid"]), "texts")

    links = _confirm(stage(_near(star, classes), "near"), texts)
    star = lambda labels: labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
    labels = stage(components(links), "labels")
    mixed = _mixed(buckets.select("key", "cid", "n"), labels)
    sketches = stage(classes.select("cid", "n", "sketch").join(_fine_sketches(texts, mixed), "cid"), "fine")
    labels = components(star(labels).unionByName(stage(_links_across(mixed, sketches), "across")))

    grouped = classes.join(labels, classes["cid"] == labels["node"], "left").select(
        "cls", F.coalesce("component", "cid").alias("component"), "doc_id", "th")
    heads = grouped.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("head"))
    of_class = stage(grouped.join(heads, "component").select(
        "cls", F.col("head.doc_id").alias("component_id"), F.col("head.th").alias("head_th")), "of-class")
    out = sketched.select("doc_id", "th", "n", "cls").join(of_class, "cls", "left")
    alone = F.col("cls").isNull()
    return out.select(
        "doc_id", "th", F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("th") == F.col("head_th")))).alias("first"))


def dedup(docs: DataFrame) -> DataFrame:
    """The documents that stay: one of each group, and all without words (columns of ``docs``)."""
    th, own, doc, place = free_name(docs, "near_th", "near_own", "near_doc", "near_place")
    keep = group_documents(docs).where("first").select(
        F.col("doc_id").alias(doc), F.col("th").alias(th), (F.col("n_shingles") > 0).alias("one")).distinct()
    named = docs.withColumn(own, text_hash(F.col("text")))
    kept = named.join(keep, (F.col(own) == F.col(th)) & F.col("doc_id").eqNullSafe(F.col(doc)))
    # rows of the same id and text: one stays
    over = Window.partitionBy(th, doc).orderBy(F.lit(0))
    return kept.withColumn(place, F.row_number().over(over)).where(
        (F.col(place) == 1) | ~F.col("one")).select(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return group_documents(docs).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
