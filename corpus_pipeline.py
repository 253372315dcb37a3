"""From raw documents to a training mix, in five stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame.  ``run`` writes every stage's result as Parquet under the shared checkpoint
folder and reads it back as the next stage's input.  All stages but the last return the
columns of ``documents``; the last adds taken, epochs and part_words, and replaces columns that
are called so in any case.

In every stage ids may be of any type, null or repeated (a row is named by its id and its
text); other columns, whatever their names, are passed on as they are.  A table without rows gives one
without rows, and the stages that learn or count nothing from it do not fail.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aloft.llm import decontaminate, langid, line_dedup, mixing, near_dedup
from aloft.llm.common import importable, stage, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go: those without a letter (null and empty texts among them), and
    those farther from every language than its own texts of that length.  Equal texts are judged alike."""
    importable(spark)
    return langid.keep_identified(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs (20 words or more) are deleted from the texts, to their last line; documents that
    are emptied by it go, others stay, null and empty texts too.  The first place is that of the smallest id (null
    last), then the upper one; rows of the same id and text are one place and are treated alike."""
    importable(spark)
    return line_dedup.dedup(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: that of the smallest id (null last), then of the smallest
    text hash; of rows that repeat id and text one.  Texts without words are in no group and stay."""
    importable(spark)
    return near_dedup.dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages (hit words reach a twentieth of theirs) go; null and empty texts have
    no words and stay.  Items without words match nothing; an empty benchmark keeps all."""
    importable(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the source mix takes, and how much of them; those without words are not taken.  A null
    source is a source, the last one.  Rows that repeat id, text and source share what they take."""
    importable(spark)
    return mixing.mixed_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination),
    ("mixing", mixing_stage),
]

#: language ID learns a model; SQL cannot express it (tests/llm compare the stages with brute force)
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"corpus-{name}")
    return docs
