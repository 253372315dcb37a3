"""Substring dedup on words by De Bruijn compaction.

An edge of the graph is a window of ``window`` (50) consecutive words, its nodes
are the window's first and last 49 words.  A word is removed when a window that
covers it also starts in a document with a smaller id; windows are judged on the
input.  So an edge needs only the smallest document it occurs in.

1. Edges are dealt by minimizer (see ``minimizers``): a super window is a chain
   of consecutive edges of one document, its class all equal chains.  Only keys that
   occur in two documents go on.
2. A class takes the smallest document id of its chains: every chain of a larger
   document is removed as a whole.  A key with one class has no branching node, its
   chain is a compacted path already.
3. Where a key has several classes, paths branch.  Their chains are opened into
   edges, once for each class; edges that are equal (two independent hashes beside the
   key) meet by a group-by, the smallest source coordinates come back by a join, and
   neighbouring edges with the same source path compact again into repeated spans.

Every step is a group-by with map-side partial aggregation or an equi-join that
adaptive execution can split, so a passage in a third of all documents is spread.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged, over whole texts.  A null text has no
words.  A null id is neither smaller nor larger than any: such rows stay whole and
remove nothing.  Rows with the same id never remove from one another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aloft.llm import minimizers, textops
from aloft.llm.common import stage

WINDOW = 50
#: words of a minimizer
GRAM = 12


def edges_of_chains(docs: DataFrame, chains: DataFrame, window: int) -> DataFrame:
    """Opens chains (doc_id, th, start, n_win, key, dig) of documents into edges."""
    lists = chains.groupBy(F.col("doc_id").alias("l_doc"), F.col("th").alias("l_th")).agg(
        F.collect_list(F.struct("start", "n_win", "key", "dig")).alias("chains"))
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("dig", T.LongType()),
                           T.StructField("doc", id_type), T.StructField("word", T.LongType()),
                           T.StructField("pos", T.IntegerType()), T.StructField("edge", T.LongType()),
                           T.StructField("check", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0)
            data, offsets = textops.utf8(b.column(1))
            for r in range(len(ids)):
                h, _ = minimizers.word_units(data[offsets[r]:offsets[r + 1]], offsets[r:r + 2] - offsets[r])
                one = textops.window_hash(h, window, textops.MULT_B)
                two = textops.window_hash(textops.mix(h), window, textops.MULT_A)
                rows = b.column(2)[r].as_py()
                n = np.array([c["n_win"] for c in rows])
                pos = np.concatenate([np.arange(x) for x in n])
                at = np.repeat([c["start"] for c in rows], n) + pos
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([c["key"] for c in rows], n)), pa.array(np.repeat([c["dig"] for c in rows], n)),
                     ids.take(pa.array(np.full(len(at), r))), pa.array(at), pa.array(pos.astype(np.int32)),
                     pa.array(textops.signed(one[at])), pa.array(textops.signed(two[at]))], schema.names)

    return minimizers.of_rows(docs, lists).select("doc_id", "text", "chains").mapInArrow(run, schema)


def repeated_spans(docs: DataFrame, window: int = WINDOW, k: int = GRAM) -> DataFrame:
    """Spans to remove: (doc_id, th, from_word, to_word, source_doc, source_word); the source is
    where the same words stand in a document with a smaller id (null for whole chains,
    whose source is the first document of their class, in ``source_doc``)."""
    records = minimizers.records(docs, minimizers.word_units, window, k).drop("anchor")
    keys = stage(records.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
                 .where(F.col("a") < F.col("b")).select("key"), "graph-keys")
    chains = stage(records.join(keys, "key"), "graph-chains")
    classes = stage(chains.groupBy("key", "dig").agg(
        F.min(F.struct("doc_id", "th", "start", "n_win")).alias("first"),
        F.min("doc_id").alias("least")).where(F.col("least").isNotNull()), "graph-classes")

    # whole chains of documents behind the first of their class
    first = chains.join(classes.select("key", "dig", "least"), ["key", "dig"])
    whole = first.where(F.col("doc_id") > F.col("least")).select(
        "doc_id", "th", F.col("start").alias("from_word"), (F.col("start") + F.col("n_win") + window - 1)
        .alias("to_word"), F.col("least").alias("source_doc"), F.lit(None).cast("long").alias("source_word"))

    # branching: several classes of one key
    several = stage(classes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"),
                    "graph-branching")
    # staged: behind a stage of its own the join may split a class with very many chains
    firsts = stage(chains.select("key", "dig", "doc_id", "th", "start", "n_win").join(
        classes.join(several, "key").select("key", "dig", "least"), ["key", "dig"]).where(
        F.col("doc_id") == F.col("least")), "graph-firsts")
    opened = stage(edges_of_chains(docs, firsts.select("doc_id", "th", "start", "n_win", "key", "dig"), window)
                   .select("key", "dig", "doc", "word", "pos", "edge", "check"), "graph-edges")
    sources = stage(opened.groupBy("key", "edge", "check").agg(
        F.min(F.struct("doc", "word")).alias("source"), F.min("doc").alias("a"), F.max("doc").alias("b"))
        .where(F.col("a") < F.col("b")).select("key", "edge", "check", "source"), "graph-sources")
    hit = opened.join(sources, ["key", "edge", "check"]).where(F.col("doc") > F.col("source.doc"))
    # neighbouring edges with one source path: the difference of the coordinates is the same
    path = hit.withColumn("lead", F.col("word") - F.col("source.word"))
    over = Window.partitionBy("key", "dig", "doc", "word_0").orderBy("pos")
    path = path.withColumn("word_0", F.col("word") - F.col("pos")).withColumn(
        "new", F.when((F.col("pos") - F.lag("pos").over(over) == 1) & (F.col("lead") == F.lag("lead").over(over))
                      & (F.col("source.doc") == F.lag("source.doc").over(over)), 0).otherwise(1)).withColumn(
        "island", F.sum("new").over(over))
    spans = path.groupBy("key", "dig", "doc", "word_0", "island").agg(
        F.min("word").alias("from_word"), (F.max("word") + window).alias("to_word"),
        F.min("source.doc").alias("source_doc"), F.min("source.word").alias("source_word"))
    # the coordinates belong to a row: one id may name rows of different texts
    rows = firsts.select("key", "dig", F.col("doc_id"), "th", F.col("start").alias("word_0")).distinct()
    part = spans.join(rows.withColumnRenamed("doc_id", "doc"), ["key", "dig", "doc", "word_0"]).select(
        F.col("doc").alias("doc_id"), "th", "from_word", "to_word", "source_doc", "source_word")
    return whole.unionByName(part)


def remove_repeats(docs: DataFrame, window: int = WINDOW, k: int = GRAM, keep_text: bool = True) -> DataFrame:
    """One row per document: doc_id, kept_text (or null without ``keep_text``), n_words, n_removed,
    kept_sha256 and removed (word runs).  ``docs`` needs doc_id and text."""
    docs = docs.select("doc_id", "text")
    lists = repeated_spans(docs, window, k).groupBy(F.col("doc_id").alias("l_doc"), F.col("th").alias("l_th")).agg(
        F.collect_list(F.struct("from_word", "to_word")).alias("spans"))
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("kept_text", T.StringType()), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType()),
                           T.StructField("removed", T.ArrayType(T.ArrayType(T.LongType())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, size, gone, digest, runs = [], [], [], [], []
            for t, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                words = (t or "").encode("utf-8", "surrogatepass").translate(_BLANK).split(b" ")
                words = [w for w in words if w]
                cut = minimizers.merge_runs([(s["from_word"], s["to_word"]) for s in spans or ()])
                size.append(len(words))
                for s, e in reversed(cut):
                    del words[s:e]
                gone.append(size[-1] - len(words))
                kept = b" ".join(words)
                digest.append(hashlib.sha256(kept).hexdigest())
                text.append(kept.decode("utf-8", "surrogatepass") if keep_text else None)
                runs.append(cut)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(text, pa.string()), pa.array(size, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(digest, pa.string()), pa.array(runs, pa.list_(pa.list_(pa.int64())))], schema.names)

    return minimizers.of_rows(docs, lists, "left").select("doc_id", "text", "spans").mapInArrow(run, schema)


_BLANK = bytes(0x20 if textops.IS_SPACE[c] else c for c in range(256))


def report(docs: DataFrame, **options) -> DataFrame:
    return remove_repeats(docs, keep_text=False, **options).select("doc_id", "n_words", "n_removed", "kept_sha256")
