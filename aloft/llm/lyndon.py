"""Substring dedup on bytes with linearly grouped suffix arrays.

Removed is every byte covered by a ``window`` (200) byte string that also starts
anywhere else, in the same document or another; strings are judged on the input.

1. Strings are dealt by minimizer (see ``minimizers``) as super windows; keys that
   occur once are done.  Equal super windows form a class; all strings in a class of
   two or more occurrences are repeated, without a comparison.
2. Where a key has several classes, their strings may be equal in part.  Strings of one
   key can only be equal if the minimizer stands at the same place in them, so a class is
   cut into bins of ``BIN`` places.  All strings of a bin share its core, the bytes that
   each of them holds; parts of classes are dealt by key, bin and core, and again parts
   that are equal are counted, not compared.
3. Parts that share a core, but differ, make a small text collection, whose suffix array
   is built by Lyndon grouping (``suffix_order``): suffixes with the same Lyndon prefix are
   a group, the groups stand in the order of these words, and a group's suffixes stand in
   the order of the suffixes that follow their Lyndon prefixes, so one ascending pass
   over the array emits every group in order, without renaming or recursion.
   Neighbours in the array that share ``window`` bytes are repeated strings.
4. A core with more than ``hot`` different parts is not sorted in one task: its strings are
   counted by two independent hashes with an ordinary group-by, which partial aggregation
   spreads.

A null text is empty.  Matches never cross documents.  Repeated rows are rows of
their own, so each removes from the other; null and repeated ids are fine, rows are
named by id and content.  Removal works on bytes and can cut a character.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aloft.llm import minimizers, textops
from aloft.llm.common import stage

WINDOW = 200
#: bytes of a minimizer
GRAM = 32
#: places of the minimizer in one bin
BIN = 32
#: different parts of one core that are sorted in one task
HOT = 500


def lyndon_ends(text: bytes) -> list[int]:
    """For each position the end of its Lyndon prefix: the longest Lyndon word that starts
    there, which ends where the next smaller suffix begins.

    From right to left: a word is extended by the Lyndon word behind it as long as it
    is smaller than that; the pointers jump over whole words.
    """
    n = len(text)
    end = [n] * n
    for i in range(n - 2, -1, -1):
        j = i + 1
        while j < n:
            e = end[j]
            if text[i:j] < text[j:e]:
                j = e
            else:
                break
        end[i] = j
    return end


def suffix_order(segments: list[bytes]) -> list[int]:
    """All suffixes of all segments in lexicographic order (a suffix that is a prefix of
    another comes first), as positions in the concatenation of the segments."""
    follow: dict[int, list[int]] = {}  # next smaller suffix -> the suffixes that point to it
    first: list[int] = []  # whose Lyndon prefix ends with the segment
    base = 0
    size: dict[bytes, int] = defaultdict(int)
    word_of: list[bytes] = []
    for s in segments:
        n = len(s)
        for i, e in enumerate(lyndon_ends(s)):
            w = s[i:e]
            word_of.append(w)
            size[w] += 1
            if e == n:
                first.append(base + i)
            else:
                e += base
                have = follow.get(e)
                if have is None:
                    follow[e] = [base + i]
                else:
                    have.append(base + i)
        base += n
    # groups in the order of their words; each has its stretch of the array
    slot, at = {}, 0
    for w in sorted(size):
        slot[w] = at
        at += size[w]
    order = [-1] * base
    for p in first:
        w = word_of[p]
        order[slot[w]] = p
        slot[w] += 1
    for k in range(base):  # ascending: what follows a suffix's prefix is placed before it
        for p in follow.get(order[k], ()):
            w = word_of[p]
            order[slot[w]] = p
            slot[w] += 1
    return order


def repeated_starts(segments: list[bytes], n_win: list[int], window: int) -> list[list[int]]:
    """For each segment the starts (below its n_win) of strings of ``window`` bytes that also
    start at another such place of the collection."""
    text = b"".join(segments)
    offsets = np.cumsum([0, *map(len, segments)])
    order = np.array(suffix_order(segments), dtype=np.int64)
    owner = np.searchsorted(offsets, order, side="right") - 1
    starts = order - offsets[owner]
    use = starts < np.asarray(n_win)[owner]
    order, owner, starts = order[use].tolist(), owner[use].tolist(), starts[use].tolist()
    out: list[list[int]] = [[] for _ in segments]
    before, last = None, -1
    for k, p in enumerate(order):
        this = text[p:p + window]
        if this == before:
            if last != k - 1:
                out[owner[k - 1]].append(starts[k - 1])
            out[owner[k]].append(starts[k])
            last = k
        before = this
    return out


def parts_of(values: np.ndarray, start: np.ndarray, n_win: np.ndarray, anchor: np.ndarray, key: np.ndarray,
             window: int):
    """(class, core, dig, first, m) of the parts of classes in one text: the number of the class,
    hashes of key, bin and core and of the part's bytes, and its m strings from first."""
    low, high = (anchor - n_win + 1) // BIN, anchor // BIN
    n = high - low + 1
    of = np.repeat(np.arange(len(start)), n)
    b = low[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    first = np.maximum(0, anchor[of] - (b + 1) * BIN + 1)
    last = np.minimum(n_win[of] - 1, anchor[of] - b * BIN)
    m = last - first + 1
    first = start[of] + first
    at = start[of] + anchor[of]
    core = textops.span_hash(values, at - b * BIN, at - (b + 1) * BIN + 1 + window)
    core = textops.mix(core ^ (key[of].view(textops.U64) + b.astype(textops.U64) * textops.MULT_B))
    dig = textops.span_hash(values, first, first + m + window - 1, textops.MULT_B)
    return of, core, dig, first, m


def _segments(docs: DataFrame, chosen: DataFrame, window: int) -> DataFrame:
    """(key, dig, n, doc_id, th, start, seg, parts): classes with the text of their super window and
    their parts (core, part, first, m)."""
    lists = chosen.groupBy(F.col("doc_id").alias("l_doc"), F.col("th").alias("l_th")).agg(
        F.collect_list(F.struct("key", "dig", "n", "start", "n_win", "anchor")).alias("items"))
    part = T.StructType([T.StructField("core", T.LongType()), T.StructField("part", T.LongType()),
                         T.StructField("first", T.LongType()), T.StructField("m", T.LongType())])
    schema = T.StructType([
        T.StructField("key", T.LongType()), T.StructField("dig", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("th", T.LongType()),
        T.StructField("start", T.LongType()), T.StructField("seg", T.BinaryType()),
        T.StructField("parts", T.ArrayType(part))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = textops.utf8(b.column(2))
            for r in range(b.num_rows):
                raw = data[offsets[r]:offsets[r + 1]]
                text = raw.tobytes()
                items = b.column(3)[r].as_py()
                key, dig, n, start, n_win, anchor = (
                    np.array([x[c] for x in items], dtype=np.int64) for c in ("key", "dig", "n", "start", "n_win", "anchor"))
                of, core, part_dig, first, m = parts_of(textops.byte_values(raw), start, n_win, anchor, key, window)
                flat = pa.StructArray.from_arrays(
                    [pa.array(textops.signed(core)), pa.array(textops.signed(part_dig)), pa.array(first), pa.array(m)],
                    ["core", "part", "first", "m"])
                parts = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(of, np.arange(len(items) + 1)).astype(np.int32)), flat)
                rows = pa.array(np.full(len(items), r))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(dig), pa.array(n), b.column(0).take(rows), b.column(1).take(rows),
                     pa.array(start), pa.array([text[s:s + w + window - 1] for s, w in zip(start, n_win)], pa.binary()),
                     parts], schema.names)

    return minimizers.of_rows(docs, lists).select("doc_id", "th", "text", "items").mapInArrow(run, schema)


def _sorted_groups(segments: DataFrame, window: int) -> DataFrame:
    """Runs of repeated strings in the parts of one occurrence, by suffix array of each core."""
    schema = T.StructType([segments.schema["doc_id"], segments.schema["th"],
                           T.StructField("from_byte", T.LongType()), T.StructField("to_byte", T.LongType())])

    def solve(group: list[dict]) -> Iterator[tuple]:
        found = repeated_starts([x["seg"] for x in group], [x["n_win"] for x in group], window)
        for x, starts in zip(group, found):
            if x["n"] == 1 and starts:
                for s, e in minimizers.merge_runs([(p, p + window) for p in starts]):
                    yield x["doc_id"], x["th"], x["start"] + s, x["start"] + e

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows)) if rows else [[]] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (id_type, pa.int64(), pa.int64(), pa.int64()))], schema.names)

        group: list[dict] = []
        rows: list[tuple] = []
        id_type = None
        for b in batches:
            id_type = b.schema.field("doc_id").type
            for x in b.to_pylist():
                if group and group[0]["core"] != x["core"]:
                    rows.extend(solve(group))
                    group = []
                group.append(x)
            if len(rows) > 10_000:
                yield out(rows)
                rows = []
        if group:
            rows.extend(solve(group))
        if id_type is not None:
            yield out(rows)

    return segments.repartition("core").sortWithinPartitions("core").mapInArrow(run, schema)


def _counted_strings(segments: DataFrame, window: int) -> DataFrame:
    """The same runs for hot cores: strings counted by two hashes beside the core."""
    id_type = segments.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("core", T.LongType()), T.StructField("one", T.LongType()),
                           T.StructField("two", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("doc_id", id_type), T.StructField("th", T.LongType()),
                           T.StructField("at", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r, x in enumerate(b.select(["core", "n", "start", "seg"]).to_pylist()):
                v = textops.byte_values(np.frombuffer(x["seg"], dtype=np.uint8))
                one = textops.window_hash(v, window, textops.MULT_B)
                two = textops.window_hash(textops.mix(v), window, textops.MULT_A)
                m = len(one)
                rows = pa.array(np.full(m, r))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, x["core"])), pa.array(textops.signed(one)), pa.array(textops.signed(two)),
                     pa.array(np.full(m, x["n"])), b.column("doc_id").take(rows), b.column("th").take(rows),
                     pa.array(x["start"] + np.arange(m))], schema.names)

    strings = stage(segments.mapInArrow(run, schema), "bytes-hot")
    twice = stage(strings.groupBy("core", "one", "two").agg(F.sum("n").alias("c")).where("c > 1")
                  .select("core", "one", "two"), "bytes-hot-twice")
    return strings.where("n = 1").join(twice, ["core", "one", "two"]).select(
        "doc_id", "th", F.col("at").alias("from_byte"), (F.col("at") + window).alias("to_byte"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, k: int = GRAM, hot: int = HOT) -> DataFrame:
    """Spans of repeated strings (doc_id, th, from_byte, to_byte); they may overlap."""
    records = minimizers.records(docs, minimizers.byte_units, window, k)
    keys = stage(records.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "bytes-keys")
    found = stage(records.join(keys, "key"), "bytes-found")
    classes = stage(found.groupBy("key", "dig").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "th", "start", "n_win", "anchor")).alias("first")),
        "bytes-classes")
    whole = found.join(classes.where("n > 1").select("key", "dig"), ["key", "dig"]).select(
        "doc_id", "th", F.col("start").alias("from_byte"),
        (F.col("start") + F.col("n_win") + window - 1).alias("to_byte"))

    # several classes of one key, of which at least one occurs only once
    several = stage(classes.groupBy("key").agg(F.count(F.lit(1)).alias("n_classes"), F.min("n").alias("least"))
                    .where("n_classes > 1 and least = 1").select("key"), "bytes-branching")
    chosen = classes.join(several, "key").select("key", "dig", "n", "first.*")
    segments = stage(_segments(docs, chosen, window), "bytes-segments")
    parts = segments.select("key", "dig", "n", "doc_id", "th", F.inline("parts"))
    equal = stage(parts.groupBy("core", "part").agg(
        F.sum("n").alias("n"), F.min(F.struct("key", "dig", "first", "m")).alias("r")), "bytes-parts")
    equal_parts = parts.where("n = 1").join(equal.where("n > 1").select("core", "part"), ["core", "part"]).select(
        "doc_id", "th", F.col("first").alias("from_byte"), (F.col("first") + F.col("m") + window - 1).alias("to_byte"))

    cores = stage(equal.groupBy("core").agg(F.count(F.lit(1)).alias("n_parts"), F.min("n").alias("least"))
                  .where("n_parts > 1 and least = 1").select("core", (F.col("n_parts") > hot).alias("hot")), "bytes-cores")
    compared = equal.join(cores, "core").select("core", "n", "r.*", "hot").join(
        segments.select("key", "dig", "doc_id", "th", "start", "seg"), ["key", "dig"])
    compared = stage(compared.select(
        "core", "n", "doc_id", "th", F.col("first").alias("start"), F.col("m").cast("int").alias("n_win"), "hot",
        F.substring("seg", (F.col("first") - F.col("start") + 1).cast("int"), (F.col("m") + window - 1).cast("int"))
        .alias("seg")), "bytes-compared")
    return (whole.unionByName(equal_parts).unionByName(_sorted_groups(compared.where(~F.col("hot")), window))
            .unionByName(_counted_strings(compared.where("hot"), window)))


def remove_repeats(docs: DataFrame, window: int = WINDOW, k: int = GRAM, hot: int = HOT,
                   keep_bytes: bool = True) -> DataFrame:
    """One row per document: doc_id, kept (bytes; null without ``keep_bytes``), n_bytes, n_removed,
    n_spans, kept_sha256 and removed (byte runs).  ``docs`` needs doc_id and text."""
    docs = docs.select("doc_id", "text")
    lists = repeated_spans(docs, window, k, hot).groupBy(
        F.col("doc_id").alias("l_doc"), F.col("th").alias("l_th")).agg(
        F.collect_list(F.struct("from_byte", "to_byte")).alias("spans"))
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("kept", T.BinaryType()), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                           T.StructField("kept_sha256", T.StringType()),
                           T.StructField("removed", T.ArrayType(T.ArrayType(T.LongType())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = textops.utf8(b.column(1))
            kept, size, gone, digest, runs = [], [], [], [], []
            for r, spans in enumerate(b.column(2).to_pylist()):
                text = data[offsets[r]:offsets[r + 1]].tobytes()
                cut = minimizers.merge_runs([(s["from_byte"], s["to_byte"]) for s in spans or ()])
                edges = [0, *(x for run_ in cut for x in run_), len(text)]
                left = b"".join(text[s:e] for s, e in zip(edges[::2], edges[1::2]))
                size.append(len(text))
                gone.append(len(text) - len(left))
                digest.append(hashlib.sha256(left).hexdigest())
                kept.append(left if keep_bytes else None)
                runs.append(cut)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(kept, pa.binary()), pa.array(size, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array([len(x) for x in runs], pa.int64()), pa.array(digest, pa.string()),
                 pa.array(runs, pa.list_(pa.list_(pa.int64())))], schema.names)

    return minimizers.of_rows(docs, lists, "left").select("doc_id", "text", "spans").mapInArrow(run, schema)


def report(docs: DataFrame, **options) -> DataFrame:
    return remove_repeats(docs, keep_bytes=False, **options).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
