"""CSV records with line ends inside quotes, put together from a split scan of lines.

Where a split starts, a quoted field may be open; whether it is depends on everything before.  But a
line, and so a split, only does one of two things to each of the two states (outside or inside
quotes): it is a function of two values, and such functions compose.  So

1. a scan of the lines gives each split's function (``effects``): two booleans;
2. composed over the splits of a file, they give the state at every split's start;
3. a second scan starts every split in its true state and joins the lines of each record.  A record
   that goes on in the next split is passed on in pieces, which meet by file and number.

Quotes open at the start of a field only and are doubled inside (RFC 4180); a quote inside an unquoted
field is a character like any other.  Lines end in \\n or \\r\\n, and the line ends inside a field stay
as they are.  Blank lines between records are skipped, as Spark's CSV reader does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aloft.operators.ordered import written

#: a line of whole fields: one that starts and ends outside quotes
_FIELD = r'(?:"(?:[^"]|"")*"(?:[^",][^,]*)?|[^",][^,]*)?'
_WHOLE = rf"^{_FIELD}(?:,{_FIELD})*$"
#: splits of files with line ends inside quotes whose states the driver composes
MOST_SPLITS = 1 << 22


_PARTS = (pa.string(), pa.int64(), pa.int64(), pa.string())


class SplitsChangedError(RuntimeError):
    pass


def lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """Every line of the files (column ``value``), in splits."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        # the size of splits must not follow the number of executors between two scans
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return spark.read.option("lineSep", "\n").text(list(files))


def by_name(files: Sequence[str]) -> Callable[[str], str]:
    """Finds a file by the spelling that ``_metadata.file_path`` gives it (an encoded URI)."""
    def plain(name: str) -> str:
        scheme, colon, rest = name.partition(":/")
        return f"{scheme}:/{rest.lstrip('/')}" if colon else name

    known = {plain(f): f for f in files}
    return lambda name: known.get(plain(unquote(name))) or known[plain(name)]


def whole(values: pa.Array) -> np.ndarray:
    """Which lines start and end outside quotes, if nothing was open before them; a line that only the state
    machine below can tell counts as not."""
    if not pc.any(pc.match_substring(values, '"')).as_py():
        return np.ones(len(values), dtype=bool)
    return pc.match_substring_regex(values, _WHOLE).to_numpy(zero_copy_only=False)


def ends_inside(line: str, inside: bool) -> bool:
    """The state at a line's end."""
    p = 0
    while True:
        if not inside:
            if not line.startswith('"', p):
                p = line.find(",", p) + 1
                if not p:
                    return False
                continue
            p += 1
        while True:  # the quote that closes the field
            p = line.find('"', p)
            if p < 0:
                return True
            if not line.startswith('"', p + 1):
                break
            p += 2
        inside = False
        p = line.find(",", p) + 1
        if not p:
            return False


def _of_splits(df: DataFrame) -> DataFrame:
    return df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                     F.col("_metadata.file_block_length").alias("length"), "value")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.Array]]:
    """The lines of each split in a batch."""
    keys = list(zip(*(batch.column(k).to_pylist() for k in range(3))))
    i = 0
    while i < len(keys):
        j = i + 1
        if keys[-1] == keys[i]:
            j = len(keys)
        else:
            while j < len(keys) and keys[j] == keys[i]:
                j += 1
        yield keys[i], batch.column(3).slice(i, j - i)
        i = j


def survey(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(file, header, quoted, content), one row a file: the first line of its first split that is not blank, whether
    a line end stands inside quotes, and whether any line is not blank."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, header, quoted, content, out = None, None, False, False, []
        for batch in batches:
            for key, values in _runs(batch):
                if key != at:
                    if at is not None:
                        out.append((at[0], header, quoted, content))
                    at, header, quoted, content = key, None, False, False
                content = content or any(x.strip() for x in values.to_pylist())
                if key[1] == 0 and header is None:
                    header = next((x for x in values.to_pylist() if x.strip()), None)
                if not quoted:
                    doubtful = values.filter(pa.array(~whole(values)))
                    quoted = any(ends_inside(x, False) for x in doubtful.to_pylist())
        if at is not None:
            out.append((at[0], header, quoted, content))
            types = (pa.string(), pa.string(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                             ["file", "header", "quoted", "content"])

    splits = _of_splits(lines(spark, files)).mapInArrow(run, "file string, header string, quoted boolean, content boolean")
    return splits.groupBy("file").agg(*[F.max(c).alias(c) for c in ("header", "quoted", "content")])


def effects(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(file, start, length, from_outside, from_inside): what each split does to the state."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, out = None, (False, True), []
        for batch in batches:
            for key, values in _runs(batch):
                if key != at:
                    if at is not None:
                        out.append((*at, *state))
                    at, state = key, (False, True)
                for line in values.filter(pc.match_substring(values, '"')).to_pylist():
                    state = tuple(ends_inside(line, s) for s in state)
        if at is not None:
            out.append((*at, *state))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["file", "start", "length", "o", "i"])

    return _of_splits(lines(spark, files)).mapInArrow(
        run, "file string, start long, length long, o boolean, i boolean").toDF(
        "file", "start", "length", "from_outside", "from_inside")


def start_states(splits: Sequence) -> dict[tuple, bool]:
    """(file, start, length) -> whether the split starts inside quotes."""
    out, state, file = {}, False, None
    for s in sorted(splits, key=lambda s: (s["file"], s["start"])):
        if s["file"] != file:
            file, state = s["file"], False
        out[s["file"], s["start"], s["length"]] = state
        state = s["from_inside"] if state else s["from_outside"]
    return out


def records(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(file, record) of all records but the files' headers, read in splits.

    The driver holds three values for each split of these files; beyond ``MOST_SPLITS`` of them it refuses.
    """
    splits = effects(spark, files).limit(MOST_SPLITS + 1).collect()
    if len(splits) > MOST_SPLITS:
        raise ValueError(f"{len(files)} files with line ends inside quotes have more than {MOST_SPLITS} splits; "
                         "read fewer files at once, or raise spark.sql.files.maxPartitionBytes")
    states = start_states(splits)
    sent = spark.sparkContext.broadcast(states)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(file, start, part, record): part 0 is a whole record, 1 the end of one that began before this
        split, 2 the middle of one, 3 the beginning of one that goes on behind it."""
        known = sent.value
        at, held, began, header = None, [], True, False  # the lines of the open record; whether it began here

        def close() -> list:
            # a header that goes on behind the split: its beginning is null, and its record is left out below
            return [(at[0], at[1], 3 if began else 2, None if header else "\n".join(held))] if held else []

        for batch in batches:
            out: list = []
            for key, values in _runs(batch):
                if key != at:
                    if at is not None:
                        out += close()
                    if key not in known:
                        raise SplitsChangedError(f"the split of {key[0]} at {key[1]} was not there in the first scan")
                    at, held, inside = key, [], known[key]
                    began, header = not inside, key[1] == 0
                for line, closed in zip(values.to_pylist(), whole(values).tolist()):
                    if not inside and not held and not line.strip("\r"):
                        continue
                    if inside or not closed:
                        inside = ends_inside(line, inside)
                    held.append(line)
                    if not inside:
                        if header:
                            header = False
                        else:
                            out.append((at[0], at[1], 0 if began else 1, "\n".join(held)))
                        held, began = [], True
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _PARTS)], ["file", "start", "part", "record"])
        if at is not None and (rest := close()):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rest), _PARTS)], ["file", "start", "part", "record"])

    found = _of_splits(lines(spark, files)).mapInArrow(run, "file string, start long, part long, record string")
    if any(states.values()):
        found = written(found, "csv-records")  # read twice: the whole records, and the pieces of the others
        whole_ones, pieces = found.where("part = 0"), found.where("part <> 0")
        # a piece's record is the last one that began at or before it in the file
        over = Window.partitionBy("file").orderBy("start", (F.col("part") == 3).cast("int"))
        own = pieces.withColumn("n", F.count_if(F.col("part") == 3).over(over))
        joined = own.groupBy("file", "n").agg(F.sort_array(F.collect_list(F.struct("start", "record"))).alias("p"))
        joined = joined.where(F.col("p")[0]["record"].isNotNull()).select(
            "file", F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"))
        found = whole_ones.select("file", "record").unionByName(joined)
    # with no state to pass on, a piece can only be a record that a file's end cuts off
    found = found.where("record is not null")
    return found.select("file", F.regexp_replace("record", "\r$", "").alias("record"))
