"""Partitioning of long windows by content, shared by the substring operators.

A window is ``window`` consecutive units (words or bytes) of one document.  Its
minimizer is the k-gram in it with the smallest hash (the last among equals), so
equal windows have the same minimizer at the same place.  Consecutive windows
with one minimizer occurrence form a *super window*, the record that is moved
instead of its windows: two equal windows always lie in super windows of the same
key, and a key that occurs once cannot hold a repeated window.

A super window also carries a digest of its whole content; key and digest use
independent 64-bit hashes.  Super windows of equal key and digest are equal and
form a class, so copies collapse before anything is compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aloft.llm import textops

#: units worked on at once (window_argmin numbers them in 24 bits)
PIECE = 1 << 22


def word_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and the offsets of each row's words."""
    starts, ends, first = textops.words(data, offsets)
    return textops.word_hashes(data, starts, ends), first


def byte_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return textops.byte_values(data), offsets


Units = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def super_windows(values: np.ndarray, offsets: np.ndarray, window: int, k: int):
    """(row, start in row, windows, key, digest, place of the minimizer behind the start) of all
    super windows of the rows."""
    parts = []
    ends = offsets[1:]
    for a in range(0, max(1, len(values)), PIECE):
        piece = values[a: a + PIECE + window - 1]
        if len(piece) < window:
            break
        grams = textops.window_hash(piece, k)
        best = textops.window_argmin(grams, window - k + 1)[:PIECE]
        at = np.arange(a, a + len(best))
        row = np.searchsorted(ends, at, side="right")
        inside = at + window <= ends[np.minimum(row, len(ends) - 1)]
        at, row, best = at[inside], row[inside], best[inside]
        s, e = textops.runs(best)
        if not len(s):
            continue
        n = e - s
        start = at[s]
        digest = textops.span_hash(piece, start - a, start - a + n + window - 1, textops.MULT_B)
        parts.append((row[s], start - offsets[row[s]], n, grams[best[s]], digest, best[s] + a - start))
    if not parts:
        z = np.zeros(0, np.int64)
        return z, z, z, z.view(textops.U64), z.view(textops.U64), z
    return tuple(np.concatenate(x) for x in zip(*parts))


def text_hash(text: Column) -> Column:
    return F.xxhash64(text)


def records(docs: DataFrame, units: Units, window: int, k: int) -> DataFrame:
    """Rows (doc_id, th, key, dig, start, n_win, anchor), one per super window of every text;
    anchor: the minimizer's place behind start.

    (doc_id, th) names a row by its content, so that rows which share an id stay apart.
    A pure function of the input: computed again where it is read twice.
    """
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("th", T.LongType()),
                           T.StructField("key", T.LongType()), T.StructField("dig", T.LongType()),
                           T.StructField("start", T.LongType()), T.StructField("n_win", T.IntegerType()),
                           T.StructField("anchor", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = textops.utf8(b.column(2))
            for i, j in textops.chunks(offsets):
                base = offsets[i]
                values, first = units(data[base:offsets[j]], offsets[i:j + 1] - base)
                row, start, n, key, dig, anchor = super_windows(values, first, window, k)
                if not len(row):
                    continue
                rows = pa.array(row + i)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(rows), b.column(1).take(rows), pa.array(textops.signed(key)),
                     pa.array(textops.signed(dig)), pa.array(start), pa.array(n.astype(np.int32)),
                     pa.array(anchor.astype(np.int32))],
                    schema.names)

    return docs.select("doc_id", text_hash(F.col("text")).alias("th"), "text").mapInArrow(run, schema)


def of_rows(docs: DataFrame, lists: DataFrame, how: str = "inner") -> DataFrame:
    """(doc_id, th, text) joined with one list per row (columns l_doc, l_th, ...)."""
    named = docs.select("doc_id", text_hash(F.col("text")).alias("th"), "text")
    return named.join(lists, (F.col("th") == F.col("l_th")) & F.col("doc_id").eqNullSafe(F.col("l_doc")), how)


def merge_runs(pairs: list[tuple[int, int]]) -> list[list[int]]:
    """Union of half-open runs, ascending; runs that touch become one."""
    out: list[list[int]] = []
    for s, e in sorted(pairs):
        if out and s <= out[-1][1]:
            if e > out[-1][1]:
                out[-1][1] = e
        else:
            out.append([s, e])
    return out
