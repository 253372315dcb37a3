"""Ranked lexical search with bag deduplication.

For each item the documents are ranked by an integer BM25-like score (see
``search``).  Most of the work is done once for all documents that look alike to the
items:

1. One pass over the texts counts each document's terms (n) and restricts it to the
   vocabulary of the items: its bag is the sorted list of item terms it holds, with
   their counts.  Terms are found by hash and verified byte by byte.
2. n only acts through the score's length part m.  Documents of the same bag and m form
   a class: rows are dealt by a hash of both and verified by comparing them, so a hash
   collision never merges two classes.  A class is scored once, whatever its size.
3. A task scores its classes against all items of a block through the postings of their
   terms, and passes on what can still be among an item's first k.  A class's place is its
   score, then its smallest doc_id: the first k documents lie in the first k classes.
4. The classes found are expanded into their members by ascending doc_id, at most the
   first k of each, and ranked.

Items come in blocks of at most ``ITEM_BLOCK`` items and about ``BLOCK_TERMS`` different
terms (one item with more stands alone); the result of a block is written before the next
one begins.  Only a block's vocabulary, weights and postings are sent to the tasks; bags
and classes never leave them.

A null or empty text has no terms: such a document is not counted and never found, such an
item finds nothing.  Repeated rows are rows of their own: equal documents are listed next
to each other, equal items each get their list.  Null ids sort last among equal scores.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aloft.llm import textops
from aloft.llm.common import stage

TOP = 50
ITEM_BLOCK = 1024
BLOCK_TERMS = 1 << 20
#: classes scored at once
CLASS_BATCH = 2048
#: bytes that part terms: all of ASCII but letters and digits
IS_GAP = np.ones(256, dtype=bool)
IS_GAP[0x30:0x3A] = IS_GAP[0x41:0x5B] = IS_GAP[0x61:0x7B] = IS_GAP[0x80:] = False


def weight(documents: int, holding: int) -> int:
    """A term's weight from the number of documents and of those that hold it."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Vocabulary:
    """A block's terms, found by hash and verified by their bytes."""

    def __init__(self, terms: list[bytes]):
        data = np.frombuffer(b"".join(terms), dtype=np.uint8)
        ends = np.cumsum([len(t) for t in terms], dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        hashes = textops.word_hashes(data, starts, ends)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.number = hashes[order], order.astype(np.int64)
        self.data, self.starts, self.ends = data, starts, ends
        if len(np.unique(hashes)) != len(terms):
            raise ValueError("two terms of one block have the same 64-bit hash; use smaller blocks")

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the word, number of the term) for all words that are terms."""
        if not len(self.hashes) or not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes = textops.word_hashes(data, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        word = np.flatnonzero(self.hashes[at] == hashes)
        term = self.number[at[word]]
        size = ends[word] - starts[word]
        same = size == self.ends[term] - self.starts[term]
        word, term, size = word[same], term[same], size[same]
        if len(word):
            first = np.concatenate([[0], np.cumsum(size)[:-1]])
            inside = np.arange(int(size.sum())) - np.repeat(first, size)
            equal = data[np.repeat(starts[word], size) + inside] == self.data[np.repeat(self.starts[term], size) + inside]
            same = np.logical_and.reduceat(equal, first)
            word, term = word[same], term[same]
        return word, term


def _terms_of(text: str | None) -> list[bytes]:
    raw = textops.LOWER[np.frombuffer((text or "").encode("utf-8"), dtype=np.uint8)]
    starts, ends, _ = textops.words(raw, np.array([0, len(raw)]), IS_GAP)
    data = raw.tobytes()
    return [data[s:e] for s, e in zip(starts.tolist(), ends.tolist())]


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, item, terms): the different terms of every item; ``item`` names the row."""
    schema = T.StructType([items.schema["item_id"], T.StructField("terms", T.ArrayType(T.BinaryType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([sorted(set(_terms_of(t))) for t in b.column(1).to_pylist()],
                                       pa.list_(pa.binary()))], schema.names)

    return items.select("item_id", "text").mapInArrow(run, schema).withColumn("item", F.monotonically_increasing_id())


def bags(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n, terms, counts): each text's number of terms, and its bag of vocabulary terms."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n", T.LongType()),
                           T.StructField("terms", T.ArrayType(T.IntegerType(), False)),
                           T.StructField("counts", T.ArrayType(T.IntegerType(), False))])
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for b in batches:
            data, offsets = textops.utf8(b.column(1))
            for i, j in textops.chunks(offsets):
                base = offsets[i]
                part = textops.LOWER[data[base:offsets[j]]]
                starts, ends, first = textops.words(part, offsets[i:j + 1] - base, IS_GAP)
                word, term = known.find(part, starts, ends)
                row = np.searchsorted(first, word, side="right") - 1
                pair, count = np.unique(row * len(known.number) + term, return_counts=True)
                row, term = np.divmod(pair, max(1, len(known.number)))
                at = pa.array(np.searchsorted(row, np.arange(j - i + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(np.diff(first), pa.int64()),
                     pa.ListArray.from_arrays(at, pa.array(term, pa.int32())),
                     pa.ListArray.from_arrays(at, pa.array(count, pa.int32()))], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


class Scorer:
    """Scores of bags against the items of a block, through the postings of their terms."""

    def __init__(self, weights: np.ndarray, items: list[list[int]]):
        self.weights, self.items = weights, len(items)
        term = np.array([t for own in items for t in own], dtype=np.int64)
        item = np.repeat(np.arange(len(items)), [len(own) for own in items])
        order = np.argsort(term, kind="stable")
        self.posted, self.first = item[order], np.searchsorted(term[order], np.arange(len(weights) + 1))
        # each part is below weight * 10**6, so that sums below 2**53 are exact in doubles
        longest = max(map(len, items), default=0)
        self.exact = longest * int(weights.max(initial=0)) * 10 ** 6 < 1 << 53

    def score(self, rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, m: np.ndarray) -> np.ndarray:
        """(bags x items) scores; rows names the bag of each entry, m holds a value for each bag."""
        part = self.weights[terms] * ((10 ** 9 * counts) // (1000 * counts + 20 * m[rows]))
        size = self.first[terms + 1] - self.first[terms]
        entry = np.repeat(np.arange(len(terms)), size)
        inside = np.arange(len(entry)) - np.repeat(np.cumsum(size) - size, size)
        place = rows[entry] * self.items + self.posted[self.first[terms[entry]] + inside]
        if self.exact:
            out = np.bincount(place, weights=part[entry], minlength=len(m) * self.items).astype(np.int64)
        else:
            out = np.zeros(len(m) * self.items, dtype=np.int64)
            np.add.at(out, place, part[entry])
        return out.reshape(len(m), self.items)


def _best_classes(classes: DataFrame, scorer: Scorer, top: int) -> DataFrame:
    """(at, cls, score): of each task's classes all that can be among an item's first ``top``.

    A task reads its classes by ascending doc_id, so a later class of the same score is behind.
    """
    sent = classes.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        # the scores of an item's best classes so far: what stays below the last of them is out
        best = np.zeros((own.items, top), dtype=np.int64)
        for whole in batches:
            for s in range(0, whole.num_rows, CLASS_BATCH):
                b = whole.slice(s, CLASS_BATCH)
                terms, counts = (b.column(k) for k in (2, 3))
                size = np.diff(terms.offsets.to_numpy())
                rows = np.repeat(np.arange(b.num_rows), size)
                flat = [c.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in (terms, counts)]
                scores = own.score(rows, *flat, b.column(1).to_numpy(zero_copy_only=False))
                row, item = np.nonzero(scores > best[:, -1][None, :])
                if not len(row):
                    continue
                found = scores[row, item]
                order = np.lexsort((-found, item))
                row, item, found = row[order], item[order], found[order]
                place = np.arange(len(item)) - np.searchsorted(item, item)
                head = place < top
                fresh = np.zeros((own.items, top), dtype=np.int64)
                fresh[item[head], place[head]] = found[head]
                best = -np.sort(-np.concatenate([best, fresh], axis=1), axis=1)[:, :top]
                keep = head & (found >= best[item, -1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item[keep], pa.int64()), b.column(0).take(pa.array(row[keep])),
                     pa.array(found[keep], pa.int64())], ["at", "cls", "score"])

    ordered = classes.sortWithinPartitions(F.col("least").asc_nulls_last())
    return ordered.select("cls", "m", "terms", "counts").mapInArrow(run, "at long, cls long, score long")


def _search_block(docs: DataFrame, block: list, item_type: T.DataType, top: int) -> DataFrame:
    """The ranked documents of one block of items [(item, item_id, terms)]."""
    spark = docs.sparkSession
    terms = sorted({bytes(t) for _, _, own in block for t in own})
    number = {t: i for i, t in enumerate(terms)}
    bagged = stage(bags(docs, Vocabulary(terms)), "bags")

    totals = bagged.agg(F.count_if(F.col("n") > 0).alias("N"), F.sum("n").alias("L")).first()
    documents, all_terms = totals["N"], totals["L"] or 0
    holding = {r["term"]: r["df"] for r in bagged.select(F.explode("terms").alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("df")).collect()}  # at most one row for each term of the block
    weights = np.array([weight(documents, holding[t]) if t in holding else 0 for t in range(len(terms))], dtype=np.int64)

    length = F.expr(f"50 + ((50 * n * {documents}L) div {max(1, all_terms)}L)")
    rows = bagged.where(F.size("terms") > 0).select("doc_id", "terms", "counts", length.alias("m"))
    rows = rows.withColumn("hash", F.xxhash64("terms", "counts", "m"))
    bag = ["hash", "m", "terms", "counts"]
    classes = stage(rows.groupBy(*bag).agg(F.min("doc_id").alias("least"))
                    .withColumn("cls", F.monotonically_increasing_id()), "classes")

    scorer = Scorer(weights, [[number[bytes(t)] for t in own] for _, _, own in block])
    best = stage(_best_classes(classes, scorer, top), "best")
    order = Window.partitionBy("at").orderBy(F.col("score").desc(), F.col("least").asc_nulls_last())
    named = best.join(classes.select("cls", "least"), "cls")
    first = stage(named.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
                  .select("at", "cls", "score"), "first-classes")

    # members of the classes that were found, at most the first ``top`` of each; their hashes are at
    # most ITEM_BLOCK * top numbers, and thin out the rows before they are compared
    wanted = stage(classes.join(first.select("cls").distinct(), "cls").select("cls", *bag), "wanted")
    likely = rows.join(F.broadcast(wanted.select("hash").distinct()), "hash", "left_semi")
    members = (likely.join(wanted, bag).select("cls", "doc_id")
               .withColumn("place", F.row_number().over(Window.partitionBy("cls").orderBy(F.col("doc_id").asc_nulls_last())))
               .where(F.col("place") <= top).select("cls", "doc_id"))
    final = Window.partitionBy("at").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = (first.join(members, "cls").withColumn("rank", F.row_number().over(final))
              .where(F.col("rank") <= top).select("at", "rank", "doc_id", "score"))
    names = spark.createDataFrame([(i, r[1]) for i, r in enumerate(block)], T.StructType([
        T.StructField("at", T.LongType()), T.StructField("item_id", item_type)]))
    return stage(ranked.join(names, "at").select("item_id", "rank", "doc_id", "score"), "ranked")


def _blocks(items: DataFrame) -> Iterator[list]:
    """The items in blocks that fit into the driver's and a task's memory, read one after the other."""
    block, size = [], 0
    for r in items.orderBy("item").toLocalIterator():
        if block and (len(block) == ITEM_BLOCK or size + len(r["terms"]) > BLOCK_TERMS):
            yield block
            block, size = [], 0
        block.append((r["item"], r["item_id"], r["terms"]))
        size += len(r["terms"])
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """Each item's ``top`` best documents: item_id, rank, doc_id, score.

    Terms are maximal runs of letters and digits (ASCII) and non-ASCII characters, A-Z
    lower-cased.  With N documents that have terms, L terms in them, n terms in a document and
    df documents that hold a term: the term's weight is floor(1000 ln((2N+2)/(2df+1))), a
    document's m is 50 + (50 n N div L), and its score is the sum of
    weight * (10**9 tf div (1000 tf + 20 m)) over the item's different terms.
    """
    docs = docs.select("doc_id", "text")
    held = stage(item_terms(items), "items")
    item_type = items.schema["item_id"].dataType
    out = None
    for block in _blocks(held):
        ranked = _search_block(docs, block, item_type, top)
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        out = docs.sparkSession.createDataFrame([], T.StructType([
            items.schema["item_id"], T.StructField("rank", T.IntegerType()), docs.schema["doc_id"],
            T.StructField("score", T.LongType())]))
    return out
