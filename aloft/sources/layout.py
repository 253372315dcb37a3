"""Access paths of a served table: rows along a space-filling curve, and a zone map of its files.

A sort order serves one column; the flights are looked up by origin, destination, route, carrier,
(year, month), label and date.  ``curve`` interleaves the bits of the range ranks of several
columns, so rows that are near in all of them are written next to each other, and every column's
values are confined to few files.  ``zone_map`` has one row for each file: its rows, and for each
column the smallest and largest value, whether there are nulls, and a bitmap of hashed values (for
columns that are not in the curve, such as the route).  ``read_where`` reads only the files that can
hold the rows asked for; Parquet statistics and dictionaries skip row groups inside them.

The curve and the zone map decide what is read, never what is found.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: bits of a column's rank, and the rows whose values set the borders of the ranks
BITS = 5
SAMPLE = 4096
#: words of 64 bits in the bitmap of a file's hashed values
WORDS = 4
#: folder of the zone map, inside a table's version; Spark does not read names that begin like this
ZONES = "_zones"


def borders(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Values that cut each column into at most 2**bits ranges of about equal numbers of rows.

    They are taken from a bounded sample: the rows that come first by a hash of the columns.
    """
    some = df.select(*columns).orderBy(F.xxhash64(*columns)).limit(SAMPLE).collect()
    out = {}
    for c in columns:
        values = sorted(r[c] for r in some if r[c] is not None)
        cut = [values[len(values) * k >> bits] for k in range(1, 1 << bits)] if values else []
        out[c] = sorted(set(cut))
    return out


def rank(column: Column, cuts: Sequence) -> Column:
    """The number of cuts that are not above the value, found by halving; null ranks first."""
    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(column >= F.lit(cuts[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return F.when(column.isNull(), F.lit(0)).otherwise(search(0, len(cuts)))


def curve(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The place on the Z-order curve: the ranks' bits in turn, the highest first."""
    parts = []
    for b in range(bits):
        for k, r in enumerate(ranks):
            bit = F.shiftright(r, b).bitwiseAND(F.lit(1)).cast("long")
            parts.append(F.shiftleft(bit, b * len(ranks) + len(ranks) - 1 - k))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def with_curve(df: DataFrame, columns: Sequence[str], name: str, bits: int = BITS) -> DataFrame:
    cuts = borders(df, columns, bits)
    # the ranks are columns of their own first: an expression as large as their product would not compile
    names = [f"{name}_{k}" for k in range(len(columns))]
    ranked = df.withColumns({n: rank(F.col(c), cuts[c]) for n, c in zip(names, columns)})
    return ranked.withColumn(name, curve([F.col(n) for n in names], bits)).drop(*names)


def _place(h: Column) -> tuple[Column, Column]:
    """(word, mask) of a hash in a file's bitmap."""
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(h, 8), F.lit(64)).cast("int"))
    return F.pmod(h, F.lit(WORDS)).cast("int"), mask


def _bitmap(column: Column) -> Column:
    word, mask = _place(F.xxhash64(column))
    none = F.lit(0).cast("long")
    return F.array(*[F.bit_or(F.when(column.isNotNull() & (word == w), mask).otherwise(none)) for w in range(WORDS)])


def zone_map(files: DataFrame, folder: str, columns: Sequence[str]) -> DataFrame:
    """One row for each file under ``folder``: file (below the folder), rows, and for each column
    <column>_low, _high, _nulls, _bits."""
    path = F.col("_metadata.file_path")
    name = folder.rstrip("/").rsplit("/", 1)[-1]
    parts = []
    for c in columns:
        parts += [F.min(c).alias(f"{c}_low"), F.max(c).alias(f"{c}_high"), F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"),
                  _bitmap(F.col(c)).alias(f"{c}_bits")]
    located = files.select(F.substring_index(path, f"/{name}/", -1).alias("file"), *columns)
    return located.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *parts)


def _may_hold(column: str, value) -> Column:
    """Whether a file can hold rows whose ``column`` has the value, or lies in the range (low, high)."""
    low, high = F.col(f"{column}_low"), F.col(f"{column}_high")
    if isinstance(value, tuple):
        return (low <= F.lit(value[1])) & (high >= F.lit(value[0]))
    if value is None:
        return F.col(f"{column}_nulls") > 0
    within = (low <= F.lit(value)) & (high >= F.lit(value))
    if not isinstance(value, str):
        return within
    word, mask = _place(F.xxhash64(F.lit(value)))
    return within & (F.element_at(f"{column}_bits", word + 1).bitwiseAND(mask) != 0)


def _holds(column: str, value) -> Column:
    if isinstance(value, tuple):
        return F.col(column).between(F.lit(value[0]), F.lit(value[1]))
    return F.col(column).isNull() if value is None else F.col(column) == F.lit(value)


def zones_where(zones: DataFrame, conditions: dict) -> DataFrame:
    """The rows of a zone map whose files can hold rows that meet all conditions."""
    return zones.where(reduce(lambda a, b: a & b, [_may_hold(c, v) for c, v in conditions.items()], F.lit(True)))


def read_files_where(spark: SparkSession, folder: str, schema: str, conditions: dict) -> DataFrame:
    """The rows that meet all conditions, from the files that can hold any (the driver gets their names,
    as it does for every scan)."""
    zones = spark.read.parquet(f"{folder}/{ZONES}")
    files = [f"{folder}/{r['file']}" for r in zones_where(zones, conditions).select("file").collect()]
    reader = spark.read.schema(schema)
    found = reader.option("basePath", folder).parquet(*files) if files else spark.createDataFrame([], schema)
    return found.where(reduce(lambda a, b: a & b, [_holds(c, v) for c, v in conditions.items()], F.lit(True)))


def access_report(spark: SparkSession, folder: str, schema: str, probes: dict[str, dict]) -> DataFrame:
    """For each access path (name -> conditions): files, files_kept, rows, rows_kept (in those files) and
    rows_found.  One row a path; the counts are aggregates of the zone map and of the files kept."""
    zones = spark.read.parquet(f"{folder}/{ZONES}")
    out = None
    for name, conditions in probes.items():
        kept = zones_where(zones, conditions).agg(F.count(F.lit(1)).alias("files_kept"),
                                                  F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_kept"))
        every = zones.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
        found = read_files_where(spark, folder, schema, conditions).agg(F.count(F.lit(1)).alias("rows_found"))
        probe = ", ".join(str(v) for v in conditions.values())
        row = every.crossJoin(kept).crossJoin(found).select(
            F.lit(name).alias("path"), F.lit(probe).alias("probe"), "files", "files_kept", "rows", "rows_kept", "rows_found")
        out = row if out is None else out.unionByName(row)
    return out
