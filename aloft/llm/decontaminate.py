"""Benchmark decontamination with training suffix arrays.

The documents are the training text.  Each task takes its documents in shards,
builds a suffix array of the shard's word sequences and binary-searches every
suffix of every benchmark item in it.  The search gives the locations in the shard
of the window at each item position, and thereby the document words that an item's
windows cover.  A match is not followed beyond one window: its full length, and its
place in the item, are not obtained.

* Words: A-Z lower-cased, runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` (digits,
  letters, anything beyond ASCII), over whole texts.
* A window is ``window`` (13) consecutive words of an item; an item of fewer
  words, but not none, is one window.  A document word inside any occurrence of a
  window is hit; an item with an occurring window is one of the document's items.
* Contaminated: n_hit > 0 and share * n_hit >= n_words (share 20: five per cent).

The suffix array is sparse: a suffix is left out only when its first words do
not occur together in any item, so no window can start there.  Suffixes are
compared to the depth of the longest window; that orders them for every search.

The benchmark is read in blocks of at most ``block_words`` words (an item longer
than that is a block of its own); each block is sent to the tasks as the query
set, and documents carry what earlier blocks found.  With one block, the usual
case, that is one pass without a shuffle.  Documents never meet in one task
beyond their input split, so hot sources and copies cost nothing extra.

A null text or item has no words; an empty benchmark hits nothing; repeated rows
are judged alike; repeated item ids count once; null item ids are not reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aloft.llm import textops
from aloft.llm.common import free_name, stage

WINDOW = 13
SHARE = 20
#: words of benchmark items searched at once
BLOCK_WORDS = 2_000_000
#: bytes of document text in one shard (one suffix array)
SHARD_BYTES = 4 << 20

ADDED = {"n_words", "hit_spans", "items", "n_hit", "contaminated"}

#: separators of the contract become a space, A-Z become a-z
_FOLD = bytearray(range(256))
for _b in (*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)):
    _FOLD[_b] = 0x20
for _b in range(0x41, 0x5B):
    _FOLD[_b] = _b + 0x20
FOLD = bytes(_FOLD)


def fold_words(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(FOLD).split()


class QuerySuffixes:
    """The suffixes of one block of benchmark items, ready to be searched.

    ``needles``: one row of word numbers per window, in order of first occurrence;
    ``needle_len``: its words; ``needle_items``: the items that contain it.
    """

    def __init__(self, items: list[tuple[int | None, str | None]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary
        seen: dict[tuple[int, ...], set] = {}
        for item_id, text in items:
            ids = [number.setdefault(w, len(number) + 1) for w in fold_words(text)]
            size = min(window, len(ids))
            for s in range(len(ids) - size + 1 if size else 0):
                seen.setdefault(tuple(ids[s:s + size]), set()).add(item_id)
        self.window = window
        self.needle_items = [sorted(str(i) for i in v if i is not None) for v in seen.values()]
        self.needle_len = np.array([len(k) for k in seen], dtype=np.int64)
        # 0 pads short windows: it is below every word, as the end of a suffix must be
        self.needles = np.zeros((len(seen), window), dtype=np.int32)
        for r, k in enumerate(seen):
            self.needles[r, :len(k)] = k
        #: words that every window has at its start, at most three
        self.gram = int(min(3, self.needle_len.min())) if len(seen) else 0
        self.starts = np.unique(_gram_codes(self.needles, self.gram)) if len(seen) else np.zeros(0, np.uint64)


def _gram_codes(rows: np.ndarray, n: int) -> np.ndarray:
    code = np.zeros(len(rows), dtype=np.uint64)
    for k in range(n):
        code = code * np.uint64(0x9E3779B97F4A7C15) + rows[:, k].astype(np.uint64)
    return code


def suffix_array(ids: np.ndarray, row_end: np.ndarray, query: QuerySuffixes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted start positions of the shard's suffixes, and their words to window depth.

    ``ids``: word numbers (0: a word of no item), ``row_end``: for each position the end
    of its document.  A suffix ends at its document's end or at a word of no item.
    """
    depth = query.window
    padded = np.concatenate([ids, np.zeros(depth, ids.dtype)])
    at = np.flatnonzero(ids)
    if query.gram > 1 and len(at):
        code = np.zeros(len(at), dtype=np.uint64)
        for k in range(query.gram):
            inside = at + k < row_end[at]
            code = code * np.uint64(0x9E3779B97F4A7C15) + np.where(inside, padded[at + k], 0).astype(np.uint64)
        pos = np.minimum(np.searchsorted(query.starts, code), len(query.starts) - 1)
        at = at[query.starts[pos] == code]
    if not len(at):
        return at, np.zeros((0, depth), np.int32)
    rows = np.zeros((len(at), depth), np.int32)
    alive = np.ones(len(at), bool)
    for k in range(depth):
        word = np.where(at + k < row_end[at], padded[at + k], 0)
        alive &= word > 0
        rows[:, k] = np.where(alive, word, 0)
    order = np.lexsort([at, *rows.T[::-1]])
    return at[order], rows[order]


def _search(rows: np.ndarray, needles: np.ndarray, lengths: np.ndarray, upper: bool) -> np.ndarray:
    """Binary search of all needles at once: the first suffix not below the needle, or
    (``upper``) the first above all suffixes that begin with it."""
    lo = np.zeros(len(needles), np.int64)
    hi = np.full(len(needles), len(rows), np.int64)
    depth = np.arange(needles.shape[1])
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) // 2
        diff = rows[mid].astype(np.int64) - needles[open_]
        diff[depth[None, :] >= lengths[open_, None]] = 0  # only the needle's own words count
        first = (diff != 0).argmax(axis=1)
        sign = diff[np.arange(len(open_)), first]
        below = sign <= 0 if upper else sign < 0
        lo[open_[below]] = mid[below] + 1
        hi[open_[~below]] = mid[~below]
    return lo


def match_shard(texts: list[str | None], query: QuerySuffixes):
    """For each text: words, [start, end) runs of hit words, ids of items found."""
    get = query.vocabulary.get
    rows = [[get(w, 0) for w in fold_words(t)] for t in texts]
    sizes = np.array([len(r) for r in rows], dtype=np.int64)
    ends = np.cumsum(sizes)
    ids = np.array([w for r in rows for w in r], dtype=np.int32)
    empty: list[tuple[int, list, set]] = [(int(n), [], set()) for n in sizes]
    if not len(ids) or not len(query.needles):
        return empty
    at, words = suffix_array(ids, np.repeat(ends, sizes), query)
    if not len(at):
        return empty
    lo = _search(words, query.needles, query.needle_len, False)
    hi = _search(words, query.needles, query.needle_len, True)
    found = np.flatnonzero(hi > lo)
    if not len(found):
        return empty
    n = hi[found] - lo[found]
    which = np.repeat(found, n)
    place = at[np.repeat(lo[found] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())]
    doc = np.searchsorted(ends, place, side="right")
    order = np.argsort(place, kind="stable")
    for k in order:
        d = int(doc[k])
        base = int(ends[d] - sizes[d])
        s = int(place[k]) - base
        e = s + int(query.needle_len[which[k]])
        _, spans, items = empty[d]
        if spans and s <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], e)
        else:
            spans.append([s, e])
        items.update(query.needle_items[which[k]])
    return empty


def _merge(spans: list) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[int | None, str | None]]]:
    """The benchmark in blocks of bounded size, one after the other, in a fixed order."""
    size = F.size(F.split(F.coalesce(F.col("text"), F.lit("")), " "))
    items = benchmark.select("item_id", "text", F.length("text").alias("chars"), size.alias("n"))
    total = items.agg(F.coalesce(F.sum(F.coalesce(F.col("chars"), F.lit(0))), F.lit(0))).first()[0]
    n = max(1, -(-int(total) // (4 * block_words)))  # an item word and its separator: four bytes or more
    if n == 1:
        yield [(r["item_id"], r["text"]) for r in items.collect()]
        return
    items = stage(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))), "benchmark-blocks")
    for b in range(n):
        # a block's own size is a third off at most times; it is cut again when it is not
        upto = Window.orderBy("item_id", F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, -1)
        part = items.where(F.col("block") == b).withColumn(
            "cut", F.floor(F.coalesce(F.sum("chars").over(upto), F.lit(0)) / (8 * block_words)))
        for c in sorted(r[0] for r in part.select("cut").distinct().collect()):
            yield [(r["item_id"], r["text"]) for r in part.where(F.col("cut") == c).collect()]


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` with n_words, hit_spans (word runs covered by benchmark windows) and items (ids)."""
    docs = docs.drop("n_words", "hit_spans", "items")
    spark = docs.sparkSession
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()),
                           T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.LongType()))),
                           T.StructField("items", T.ArrayType(T.StringType()))])
    out, first = docs, True
    for items in _blocks(benchmark, block_words):
        sent = spark.sparkContext.broadcast(items)

        def search(batches, sent=sent, first=first):
            query = QuerySuffixes(sent.value, window)
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text"))
                sizes = np.cumsum([0, *(len(t) if t is not None else 0 for t in texts.to_pylist())])
                n_words, spans, ids = [], [], []
                for i, j in textops.chunks(sizes, shard_bytes):
                    for n, s, found in match_shard(texts.slice(i, j - i).to_pylist(), query):
                        n_words.append(n), spans.append(s), ids.append(found)
                if not first:
                    old_s = batch.column(batch.schema.get_field_index("hit_spans")).to_pylist()
                    old_i = batch.column(batch.schema.get_field_index("items")).to_pylist()
                    spans = [_merge(a + b) for a, b in zip(old_s, spans)]
                    ids = [b | set(a) for a, b in zip(old_i, ids)]
                keep = [batch.column(batch.schema.get_field_index(f)) for f in names]
                yield pa.RecordBatch.from_arrays(
                    [*keep, pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                     pa.array([sorted(x) for x in ids], pa.list_(pa.string()))],
                    [*names, "n_words", "hit_spans", "items"])

        names = docs.columns
        out, first = out.mapInArrow(search, schema), False
    return out


def judge(docs: DataFrame, benchmark: DataFrame, share: int = SHARE, **options) -> DataFrame:
    """``docs`` with n_words, hit_spans, items, n_hit and contaminated."""
    found = find_matches(docs.drop("n_hit", "contaminated"), benchmark, **options)
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    if not ADDED & {c.lower() for c in docs.columns}:
        return judge(docs, benchmark, **options).where(~F.col("contaminated")).select(*docs.columns)
    keep, = free_name(docs, "judged_row")
    packed = docs.select(F.struct(*docs.columns).alias(keep), "text")
    return judge(packed, benchmark, **options).where(~F.col("contaminated")).select(f"{keep}.*")


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    judged = judge(docs.select("doc_id", "text"), benchmark, **options)
    return judged.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
