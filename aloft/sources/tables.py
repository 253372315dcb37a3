"""Tables that are refreshed as a whole: versioned folders behind a pointer.

    <table>/v-<id>/...          the data files of one version (and its zone map)
    <table>/_log/<number>.json  pointers: the name of a version, its rows

A refresh writes a new version, checks it, and then writes one small pointer with the next number;
that is the commit.  Readers take the version of the highest pointer that is whole.  Whatever fails
before the pointer is written leaves readers with the old version; a pointer that was cut off while
it was written does not parse, so the one before it counts.  No data file is renamed or overwritten,
and two writers cannot commit the same number: the second one fails.  The versions of the last
``KEEP`` pointers stay for readers that have begun; older ones are deleted after the commit.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from aloft.session import delete_path, file_system

LOG = "_log"
KEEP = 2


class NoTableError(FileNotFoundError):
    pass


class CommitConflictError(RuntimeError):
    pass


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    rows: int


def new_version(path: str) -> str:
    """The folder for the next version's files."""
    return f"{path.rstrip('/')}/v-{uuid.uuid4().hex}"


def _pointers(spark: SparkSession, path: str) -> list[int]:
    fs, log = file_system(spark, f"{path.rstrip('/')}/{LOG}")
    if not fs.exists(log):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(log)]
    return sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), reverse=True)


def _pointer_file(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/{LOG}/{number:012d}.json"


def _read(spark: SparkSession, path: str, number: int) -> Version | None:
    """The version that a pointer names; None if the pointer is not whole."""
    fs, file = file_system(spark, _pointer_file(path, number))
    stream = fs.open(file)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        found = json.loads(text)
        return Version(number, f"{path.rstrip('/')}/{found['version']}", int(found["rows"]))
    except (ValueError, KeyError, TypeError):
        return None


def current(spark: SparkSession, path: str) -> Version:
    """The version that readers see."""
    for number in _pointers(spark, path):
        found = _read(spark, path, number)
        if found is not None:
            return found
    raise NoTableError(f"no committed version of a table in {path}")


def commit(spark: SparkSession, path: str, folder: str, rows: int) -> Version:
    """Make ``folder`` the version that readers see, and delete those that are out of date."""
    before = _pointers(spark, path)
    number = before[0] + 1 if before else 1
    fs, file = file_system(spark, _pointer_file(path, number))
    text = json.dumps({"version": folder.rsplit("/", 1)[-1], "rows": rows})
    try:
        stream = fs.create(file, False)  # fails if another writer has made this pointer
    except Py4JJavaError as exc:
        raise CommitConflictError(f"another refresh of {path} was committed meanwhile") from exc
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    for old in before[KEEP - 1:]:
        gone = _read(spark, path, old)
        if gone is not None:
            delete_path(spark, gone.folder)
        delete_path(spark, _pointer_file(path, old))
    return Version(number, folder, rows)


def read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The current version of a table."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(current(spark, path).folder)
