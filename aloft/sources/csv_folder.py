"""Folder-of-CSV source with header drift.

Monthly on-time files do not always share a header: columns move, change
case, gain padding, go missing, or a trailing comma adds a blank header.
Reading a directory in one ``spark.read.csv`` call would map columns by
*position* using the first file's header, silently putting values under the
wrong names.  Instead:

1. list the ``*.csv`` files through the Hadoop FileSystem of the path
   (local disk, HDFS, object stores alike);
2. scan them once as lines, in splits: the tasks find each file's header, and
   whether a line end stands inside quotes (``survey``); the driver gets one row
   for each different header, with its files;
3. read each group with ONE scan (all values as strings, no schema inference).
   Files without line ends inside quotes go to ``spark.read.csv`` line by line, so
   Spark splits them; the others are put together from lines, in splits as well
   (``csv_records``);
4. normalise each group's header (strip + upper-case) and drop blank-header
   columns *before* combining;
5. ``unionByName(allowMissingColumns=True)``: columns are aligned by name,
   a column absent from a file is NULL for its rows;
6. the missing-value spellings become NULL.
"""

from __future__ import annotations

import csv
import io
from collections import OrderedDict
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aloft.functions import fixed
from aloft.operators.clean import replace_null_tokens
from aloft.sources import csv_records


class NoCsvFilesError(FileNotFoundError):
    pass


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_csv_files(spark: SparkSession, folders: str | Sequence[str], pattern: str = "*.csv") -> list[str]:
    """Sorted list of files matching ``folder/pattern`` for each folder."""
    folders = [folders] if isinstance(folders, str) else list(folders)
    files: list[str] = []
    jvm = spark.sparkContext._jvm
    for folder in folders:
        fs, _ = _fs_and_path(spark, folder)
        statuses = fs.globStatus(jvm.org.apache.hadoop.fs.Path(folder.rstrip("/") + "/" + pattern))
        for st in statuses or []:
            if st.isFile():
                files.append(st.getPath().toString())
    return sorted(files)


def read_header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """First record of ``file`` parsed as CSV (only its lines are read; a quoted name may
    hold a line end)."""
    jvm = spark.sparkContext._jvm
    fs, p = _fs_and_path(spark, file)
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine() or ""
        while line.count('"') % 2:
            more = reader.readLine()
            if more is None:
                break
            line += "\n" + more
    finally:
        stream.close()
    line = line.lstrip("﻿")
    return tuple(next(csv.reader(io.StringIO(line)), []))


def normalise_header(name: str) -> str:
    return name.strip().upper()


def group_by_header(spark: SparkSession, files: Iterable[str],
                    threads: int = 16) -> "OrderedDict[tuple[str, ...], list[str]]":
    files = list(files)
    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(files)))) as pool:
        headers = list(pool.map(lambda f: read_header(spark, f), files))
    groups: OrderedDict[tuple[str, ...], list[str]] = OrderedDict()
    for f, h in zip(files, headers):
        groups.setdefault(h, []).append(f)
    return groups


@dataclass
class Group:
    """The files of one header."""

    header: tuple[str, ...]
    lines: list[str] = field(default_factory=list)  # every line end ends a record
    quoted: list[str] = field(default_factory=list)  # line ends stand inside quotes


def survey(spark: SparkSession, files: Sequence[str]) -> list[Group]:
    """The files by header, found by one split scan of their lines.

    A file's header is the first line of its first split; a header that goes on in the next line is
    read on the driver (one short read a file).  The driver gets a row for each different header.
    """
    header = F.regexp_replace(F.regexp_replace(F.col("header"), "^\ufeff", ""), "\r$", "")
    rows = (csv_records.survey(spark, files).select("file", header.alias("header"), "quoted", "content")
            .groupBy("header", "quoted", "content").agg(F.sort_array(F.collect_list("file")).alias("files")).collect())
    groups: dict[tuple[str, ...], Group] = {}
    named = csv_records.by_name(files)
    empty = set(files)
    for r in rows:
        more = r["header"] is not None and csv_records.ends_inside(r["header"], False)
        for file in map(named, r["files"]):
            if r["header"] is None and r["content"]:
                raise ValueError(f"{file}: nothing but blank lines before the end of its first split, so no header")
            if r["header"] is None:
                continue
            empty.discard(file)
            own = read_header(spark, file) if more else tuple(next(csv.reader(io.StringIO(r["header"])), []))
            group = groups.setdefault(own, Group(own))
            (group.quoted if r["quoted"] else group.lines).append(file)
    if empty:  # files without any line have no header and no rows
        groups.setdefault((), Group(())).lines.extend(sorted(empty))
    return sorted(groups.values(), key=lambda g: min(g.lines + g.quoted))


def _reader_options(multiline: bool) -> dict:
    return {"escape": '"', "multiLine": multiline, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__record"}


def _checked(df: DataFrame, width: int, file: Column) -> DataFrame:
    """Raise for records of more fields than the header; ``__record`` holds the text of records whose number of
    fields differs from it."""
    bare = F.regexp_replace("__record", '"([^"]|"")*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    message = F.concat(F.lit("more fields than the header in "), file, F.lit(": "), F.left("__record", F.lit(200)))
    return df.where(F.when(fields > width, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def read_group(spark: SparkSession, files: list[str], header: tuple[str, ...],
               multiline: bool = True) -> DataFrame:
    """One scan for all files sharing ``header``; columns renamed by position from the
    header, normalised, blank-header columns dropped.

    Fields are RFC 4180 text: quotes are doubled inside quotes and, with ``multiline``, a
    quoted field may hold line ends (Spark does not split such a scan; ``read_quoted`` does the
    same in splits).  A record of fewer fields ends in NULLs; one of more fields
    is an error that names its file, never a silent loss.
    """
    keep = _names(files, header)
    df = (spark.read.schema(_schema(header)).option("header", True).options(**_reader_options(multiline))
          .option("columnPruning", False).csv(files))
    return _checked(df, len(header), F.col("_metadata.file_path")).select(*[F.col(f"__c{i}").alias(n) for i, n in keep])


def read_quoted(spark: SparkSession, files: list[str], header: tuple[str, ...]) -> DataFrame:
    """The same for files with line ends inside quotes: records are put together from lines, in splits."""
    keep = _names(files, header)
    records = csv_records.records(spark, files)
    parsed = records.select("file", F.from_csv("record", _schema(header), _reader_options(True)).alias("r"))
    flat = parsed.select("file", "r.*")
    return _checked(flat, len(header), F.col("file")).select(*[F.col(f"__c{i}").alias(n) for i, n in keep])


def _schema(header: tuple[str, ...]) -> str:
    return ", ".join([*(f"__c{i} STRING" for i in range(len(header))), "__record STRING"])


def _names(files: list[str], header: tuple[str, ...]) -> list[tuple[int, str]]:
    """(place, normalised name) of the columns that have one."""
    keep = [(i, n) for i, n in enumerate(map(normalise_header, header)) if n]
    seen = [n for _, n in keep]
    dupes = sorted({n for n in seen if seen.count(n) > 1})
    if dupes:
        raise ValueError(f"{files[0]}: duplicate columns after normalisation: {dupes}")
    return keep


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union aligned by column name; a column missing from a frame is NULL there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_csv_folder(spark: SparkSession, folders: str | Sequence[str], pattern: str = "*.csv",
                    tokens: Sequence[str] | None = fixed.NULL_TOKENS,
                    multiline: bool = True) -> DataFrame:
    """All CSV files of ``folders`` as one all-string frame, aligned by (normalised) name.

    Without ``multiline`` every line end ends a record: the files are not looked through first, only their
    headers are read, on the driver.
    """
    files = list_csv_files(spark, folders, pattern)
    if not files:
        raise NoCsvFilesError(f"no files matching {pattern!r} in {folders!r}")
    if multiline:
        frames = []
        for g in (g for g in survey(spark, files) if g.header):  # a file without any line has no columns and no rows
            frames += [read_group(spark, g.lines, g.header, multiline=False)] if g.lines else []
            frames += [read_quoted(spark, g.quoted, g.header)] if g.quoted else []
    else:
        frames = [read_group(spark, fs, h, multiline=False) for h, fs in group_by_header(spark, files).items() if h]
    out = union_by_name(frames) if frames else spark.createDataFrame([], T.StructType([]))
    return replace_null_tokens(out, tokens) if tokens is not None else out


def write_csv_folder(df: DataFrame, path: str) -> None:
    """CSV sink that keeps surrounding blanks of values (the writer trims them by default) and
    doubles quotes inside quotes."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))
