"""Mixing sources to target weights: seeded random order, prefix sums, exact cut.

Every document gets a hash-random key.  Within its source the documents stand
in the order of that key; prefix sums of their sizes say which fall under the
source's budget.  A budget above the source's size repeats whole epochs first;
the document on which the budget falls is taken in part, so a source's taken
words are its budget exactly (the target cut to whole words).

The prefix sums are distributed: the key's upper bits split each source into
buckets (their number grows with the number of documents), one aggregate gives
the buckets' sizes, a window over the buckets of a source turns them into
offsets, and a second window adds up inside one bucket.  A source with a third
of all rows is spread over as many buckets as it needs.

Targets: sources in code-point order (null last) weigh ``weights`` repeating and
share the total; a target stops at ``max_repeat`` times its source's size and
the excess is shared again by weight until none is above.

A null text counts 0 words; null sources are one source; repeated rows are
rows of their own; a document of size 0 takes nothing.  An empty table gives an
empty result.  Everything depends on the rows' content only, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aloft.llm.common import free_name, stage
from aloft.llm.minimizers import text_hash
from aloft.operators.ordered import global_row_number

#: fixed values: weights of the sources in code-point order, repeating
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = 42
#: documents aimed at in one bucket of the prefix sums
BUCKET_ROWS = 2_000


def word_count(text: Column) -> Column:
    """Number of maximal runs of other than white space (\\x20, \\x09-\\x0D); null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS,
                   max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size) -> the same with weight and target.

    Only sums come to the driver: each round fixes the sources whose share is above
    their limit and shares the rest by weight, until none is above.
    """
    ranked = global_row_number(sources, [F.col("source").asc_nulls_last()], "rank")
    ranked = stage(ranked.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))).drop("rank"), "mix-sources")
    limit = F.lit(float(max_repeat)) * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    capped = F.lit(False)
    level, n_capped = 0.0, -1
    while True:
        row = ranked.agg(F.count_if(capped).alias("n"),
                         F.sum(F.when(capped, limit).otherwise(0.0)).alias("fixed"),
                         F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        if row["n"] == n_capped or not row["open"]:
            break
        n_capped = row["n"]
        level = (total - row["fixed"]) / row["open"]
        capped = F.lit(level) * F.col("weight") > limit
    share = F.lit(level) * F.col("weight")
    return ranked.withColumn("target", F.when(share > limit, limit).otherwise(share))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = SEED,
        bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows (doc_id, th, source, size, source_size, target, taken), one per document.

    ``th`` is the text's hash; ``taken`` counts the words the mix takes from the document over
    all epochs.
    """
    mix_key = F.left(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("text"))),
                     F.lit(16))
    sized = stage(docs.select("doc_id", text_hash(F.col("text")).alias("th"), "source",
                              word_count(F.col("text")).alias("size"), mix_key.alias("mix_key")), "mix-sizes")
    counts = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    targets = source_targets(counts, weights, max_repeat)
    n = sized.count()
    bits = max(0, (max(1, n) // bucket_rows).bit_length())
    bucket = F.shiftright(F.conv(F.left("mix_key", F.lit(8)), 16, 10).cast("long"), 32 - min(bits, 31))
    sized = sized.withColumn("bucket", bucket)

    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    over = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    plan = (sums.withColumn("before_bucket", F.coalesce(F.sum("in_bucket").over(over), F.lit(0))).alias("b")
            .join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
            .select(F.col("b.source").alias("b_source"), F.col("b.bucket").alias("b_bucket"),
                    "before_bucket", "source_size", "target"))
    inside = Window.partitionBy("source", "bucket").orderBy(
        "mix_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (sized.withColumn("upto", F.sum("size").over(inside))
              .join(plan, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket"))))
    budget = F.floor("target").cast("long")
    placed = placed.withColumn("budget", budget).withColumn(
        "epochs", F.expr("if(source_size > 0, budget div source_size, 0L)"))
    epochs, rest = F.col("epochs"), F.col("budget") - F.col("epochs") * F.col("source_size")
    before = F.col("before_bucket") + F.col("upto") - F.col("size")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - before))
    return placed.select("doc_id", "th", "source", "size", "source_size", "target",
                         (epochs * F.col("size") + part).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents the mix takes (columns of ``docs``), with ``taken`` words, ``epochs``
    (how often the whole text is used) and ``part_words`` (words of one more, partial use).

    Identical rows share what they take equally, rounded down.  Columns of ``docs`` with the names of the
    three new ones, in any case, are replaced.
    """
    doc, th, source, taken, size = free_name(docs, "mix_doc", "mix_th", "mix_source", "mix_taken", "mix_size")
    plan = mix(docs, **options).groupBy(F.col("doc_id").alias(doc), F.col("th").alias(th),
                                        F.col("source").alias(source)).agg(
        F.max("size").alias(size), F.expr("sum(taken) div count(1)").alias(taken))
    out = docs.join(plan, (text_hash(docs["text"]) == F.col(th)) & docs["doc_id"].eqNullSafe(F.col(doc))
                    & docs["source"].eqNullSafe(F.col(source))).where(F.col(taken) > 0)
    return out.select(*[docs[c] for c in docs.columns if c.lower() not in ("taken", "epochs", "part_words")],
                      F.col(taken).alias("taken"), F.expr(f"{taken} div {size}").alias("epochs"),
                      F.pmod(F.col(taken), F.col(size)).alias("part_words"))
