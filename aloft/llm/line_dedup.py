"""Line dedup: a suffix array over line-ID sequences by distributed prefix doubling.

A text's lines (split at \n) that have a word form its sequence; other lines are
skipped and never deleted.  A run of consecutive lines of the sequence that has
``min_words`` words or more and also starts at an earlier place (a smaller doc_id, or further
up in the same text) is a later copy, and all its lines are deleted.  So each maximal
repeated run stays where it stands first, and goes to its last line everywhere else.  A repeat
of fewer words stays.

1. Lines become line-IDs: ordered ranks of their two 64-bit hashes; a line that
   occurs once cannot be part of a repeated run and leaves.
2. Prefix doubling: the rank of the 2h lines from a position is the rank of the pair
   (rank of the first h, rank of the next h); a position whose pair occurs once
   leaves.  Ranks are numbered by a distributed sort of the distinct pairs.
3. All suffixes that agree in their first m lines form one interval of the suffix array with a
   longest common prefix of m lines or more; two overlapping ranks of h <= m < 2h lines name
   it.  The interval's first place in document order is the original, every other one a later
   copy.  Of all runs only two kinds are looked up: the shortest one with ``min_words`` words
   from each line on, and the shortest one that ends with each line.  They add up to the
   maximal runs: a line of a repeated run lies in the shortest run from the run's start, or
   else the shortest run that ends with the line lies in the repeated run, and is repeated, too.

No line has fewer than one word, so m <= min_words and the number of doublings is
bounded by it, not by the longest run.  Every step is a partial aggregate, a
range sort or an equi-join that adaptive execution can split, so a line that
stands in a third of all documents is spread.

A null text has no lines.  Null ids come last in document order.  Rows that repeat id
and text count as one place and are treated alike.  Columns beside text stay as
they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aloft.llm import textops
from aloft.llm.common import free_name, stage
from aloft.llm.minimizers import merge_runs, of_rows, text_hash
from aloft.operators.ordered import global_row_number

MIN_WORDS = 20
NEWLINE = 0x0A


def lines_of(data: np.ndarray, offsets: np.ndarray):
    """(row, start, end, words) of all lines that have a word, in order."""
    starts, ends, _ = textops.words(data, offsets)
    if not len(starts):
        z = np.zeros(0, np.int64)
        return z, z, z, z
    breaks = np.flatnonzero(data == NEWLINE)
    # a line begins at a row's start or behind a newline
    begin = np.unique(np.concatenate([offsets[:-1][offsets[:-1] < offsets[1:]], breaks + 1]))
    begin = begin[begin < len(data)]
    of_word = np.searchsorted(begin, starts, side="right") - 1
    used, n = np.unique(of_word, return_counts=True)
    first = begin[used]
    row = np.searchsorted(offsets, first, side="right") - 1
    nxt = np.searchsorted(breaks, first)
    stop = np.where(nxt < len(breaks), breaks[np.minimum(nxt, len(breaks) - 1)] if len(breaks) else 0, len(data))
    return row, first, np.minimum(stop, offsets[row + 1]), n


def shortest_runs(words: np.ndarray, first: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, lines) of the shortest runs with ``min_words`` words: from each line on and up to each line,
    inside the rows that begin at ``first``; every run once, in order."""
    total = np.concatenate([[0], np.cumsum(words)])
    at = np.arange(len(words))
    row = np.searchsorted(first, at, side="right") - 1
    stop = np.searchsorted(total, total[:-1] + min_words)  # lines before it hold enough
    start = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    on, upto = stop <= first[row + 1], (total[1:] >= min_words) & (start >= first[row])
    # a run has at most min_words lines
    runs = np.unique(np.concatenate([at[on] * (min_words + 1) + (stop - at)[on],
                                     start[upto] * (min_words + 1) + (at + 1 - start)[upto]]))
    return np.divmod(runs, min_words + 1)


def line_rows(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, th, pos, one, two, runs): hashes of every line that has a word, and the lengths in lines of
    the shortest runs that start with it (none: no run that is looked up does)."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("th", T.LongType()),
        T.StructField("pos", T.LongType()), T.StructField("one", T.LongType()), T.StructField("two", T.LongType()),
        T.StructField("runs", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = textops.utf8(b.column(2))
            for i, j in textops.chunks(offsets):
                base = offsets[i]
                piece = data[base:offsets[j]]
                row, s, e, n = lines_of(piece, offsets[i:j + 1] - base)
                if not len(row):
                    continue
                first = np.searchsorted(row, np.arange(j - i + 1))
                at = np.arange(len(row))
                start, size = shortest_runs(n, first, min_words)
                runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(start, np.arange(len(row) + 1)), pa.int32()),
                                                pa.array(size, pa.int64()))
                values = textops.byte_values(piece)
                rows = pa.array(row + i)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(rows), b.column(1).take(rows), pa.array(at - first[row]),
                     pa.array(textops.signed(textops.span_hash(values, s, e))),
                     pa.array(textops.signed(textops.span_hash(values, s, e, textops.MULT_B))), runs], schema.names)

    return docs.select("doc_id", text_hash(F.col("text")).alias("th"), "text").mapInArrow(run, schema)


def _ranked(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows whose keys occur more than once, with the keys' rank in ``name``."""
    seen = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("times")).where("times > 1").select(*keys)
    numbers = stage(global_row_number(seen, keys, name), "line-ranks")
    return rows.join(numbers, keys)


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Later copies (doc_id, th, pos, m): m lines from pos also start at an earlier place."""
    rows = line_rows(docs, min_words)
    rank = stage(_ranked(rows, ["one", "two"], "rank").select("doc_id", "th", "pos", "runs", "rank"), "line-rank-1")
    place = ["doc_id", "th", "pos"]
    intervals, h = None, 1
    while True:
        # runs of h <= m < 2h lines: named by the ranks of their first and their last h lines
        own = rank.select(*place, "rank", F.explode(F.filter("runs", lambda m: (m >= h) & (m < 2 * h))).alias("m"))
        last = rank.select(*[F.col(c).alias(f"o_{c}") for c in place], F.col("rank").alias("last"))
        found = own.join(last, F.col("doc_id").eqNullSafe(F.col("o_doc_id")) & (F.col("th") == F.col("o_th"))
                         & (F.col("pos") + F.col("m") - h == F.col("o_pos"))).select(*place, "m", "rank", "last") \
            if h > 1 else own.select(*place, "m", "rank", F.lit(0).cast("long").alias("last"))
        intervals = found if intervals is None else intervals.unionByName(found)
        if 2 * h > min_words or rank.where(F.exists("runs", lambda m: m >= 2 * h)).isEmpty():
            break
        paired = rank.join(last, F.col("doc_id").eqNullSafe(F.col("o_doc_id")) & (F.col("th") == F.col("o_th"))
                           & (F.col("pos") + h == F.col("o_pos"))).select(
            *place, "runs", F.col("rank").alias("head"), F.col("last").alias("tail"))
        h *= 2
        rank = stage(_ranked(paired, ["head", "tail"], "rank").select(*place, "runs", "rank"), f"line-rank-{h}")
    intervals = stage(intervals, "line-intervals")
    order = F.struct(F.col("doc_id").isNull().alias("n"), *place)
    originals = stage(intervals.groupBy("m", "rank", "last").agg(
        F.min(order).alias("first"), F.max(order).alias("end")).where("first < end").select(
        "m", "rank", "last", "first"), "line-originals")
    return intervals.join(originals, ["m", "rank", "last"]).where(order > F.col("first")).select(*place, "m")


def delete_copies(docs: DataFrame, min_words: int = MIN_WORDS, keep_text: bool = True) -> DataFrame:
    """One row per document: doc_id, th, kept_text (null without ``keep_text``), n_lines (lines that
    have a word), n_deleted, kept_sha256."""
    docs = docs.select("doc_id", "text")
    lists = repeated_runs(docs, min_words).groupBy(F.col("doc_id").alias("l_doc"), F.col("th").alias("l_th")).agg(
        F.collect_set(F.struct("pos", "m")).alias("copies"))
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("th", T.LongType()),
        T.StructField("kept_text", T.StringType()), T.StructField("n_lines", T.LongType()),
        T.StructField("n_deleted", T.LongType()), T.StructField("kept_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, size, gone, digest = [], [], [], []
            for text, copies in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                lines = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
                used = [k for k, x in enumerate(lines) if x.translate(None, _SPACES)]
                out = {used[p] for s, e in merge_runs([(c["pos"], c["pos"] + c["m"]) for c in copies or ()])
                       for p in range(s, e)}
                left = b"\n".join(x for k, x in enumerate(lines) if k not in out)
                size.append(len(used))
                gone.append(len(out))
                digest.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode("utf-8", "surrogatepass") if keep_text and text is not None else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(kept, pa.string()), pa.array(size, pa.int64()),
                 pa.array(gone, pa.int64()), pa.array(digest, pa.string())], schema.names)

    return of_rows(docs, lists, "left").select("doc_id", "th", "text", "copies").mapInArrow(run, schema)


_SPACES = bytes(c for c in range(256) if textops.IS_SPACE[c])


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the later copies of line runs; a document of which nothing is left goes.

    ``n_chars``, where there is one (in any case), follows the text.
    """
    th, doc, text, left = free_name(docs, "line_th", "line_doc", "line_text", "line_left")
    done = delete_copies(docs, min_words).where("n_deleted > 0").select(
        F.col("doc_id").alias(doc), F.col("th").alias(th), F.col("kept_text").alias(text),
        (F.col("n_lines") > F.col("n_deleted")).alias(left)).dropDuplicates([doc, th])
    changed = F.col(text).isNotNull()
    out = docs.join(done, (text_hash(docs["text"]) == F.col(th)) & docs["doc_id"].eqNullSafe(F.col(doc)), "left")
    out = out.where(~changed | F.col(left)).withColumn("text", F.when(changed, F.col(text)).otherwise(docs["text"]))
    for c in (c for c in docs.columns if c.lower() == "n_chars"):
        out = out.withColumn(c, F.when(changed, F.char_length("text").cast(docs.schema[c].dataType)).otherwise(F.col(c)))
    return out.select(*docs.columns)


def report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    return delete_copies(docs, min_words, keep_text=False).select("doc_id", "n_lines", "n_deleted", "kept_sha256")
