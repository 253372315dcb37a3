"""Served tables: export naming, typed contracts, loads, CSV sink and layout.

The warehouse holds six tables with declared types (``SMALLINT``, ``DATE``,
``CHAR(3)``, ``VARCHAR(n)``, ``DECIMAL(p,s)``).  ``conform`` turns a frame
into exactly that shape (column subset and order, casts, length checks);
``save_table`` writes it as parquet, optionally partitioned and clustered for
pruning, checks its key, and only then lets readers see it.
Double -> decimal casts round HALF_UP and overflow raises (ANSI), which is
what a typed database load does.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aloft.functions import fixed
from aloft.functions.columns import iso_day_of_week, number_text_sql, parse_date, to_double, to_int_half_even
from aloft.operators.ordered import global_row_number
from aloft.session import compile_in_parts, delete_path
from aloft.sources import layout, tables


@dataclass(frozen=True)
class Contract:
    name: str
    ddl: str  # "col TYPE, col TYPE, ..."
    key: tuple[str, ...] = ()
    serial: bool = False  # the key is numbered 1..n by the load

    @property
    def columns(self) -> list[tuple[str, str]]:
        out = []
        for part in _split_ddl(self.ddl):
            col, typ = part.strip().split(None, 1)
            out.append((col, typ.strip().upper()))
        return out

    @property
    def names(self) -> list[str]:
        return [c for c, _ in self.columns]


def _split_ddl(ddl: str) -> list[str]:
    parts, depth, cur = [], 0, ""
    for ch in ddl:
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        if ch == "," and depth == 0:
            parts.append(cur)
            cur = ""
        else:
            cur += ch
    if cur.strip():
        parts.append(cur)
    return parts


# --- fixed values: table contracts of the served tables ---
FLIGHTS = Contract("flights_cleaned", """
    flight_id BIGINT, year SMALLINT, month SMALLINT, day_of_week SMALLINT, fl_date DATE,
    op_unique_carrier VARCHAR(10), tail_num VARCHAR(10), flight_num VARCHAR(10),
    origin CHAR(3), dest CHAR(3), route VARCHAR(8),
    crs_dep_time SMALLINT, dep_time SMALLINT, dep_delay DECIMAL(6,1), dep_del15 SMALLINT,
    taxi_out DECIMAL(5,1), taxi_in DECIMAL(5,1),
    crs_arr_time SMALLINT, arr_time SMALLINT, arr_delay DECIMAL(6,1), arr_del15 SMALLINT,
    cancelled SMALLINT, diverted SMALLINT, air_time DECIMAL(6,1), distance DECIMAL(7,1),
    carrier_delay DECIMAL(6,1), weather_delay DECIMAL(6,1), nas_delay DECIMAL(6,1),
    security_delay DECIMAL(6,1), late_aircraft_delay DECIMAL(6,1),
    disrupted SMALLINT, is_weekend SMALLINT, dep_hour SMALLINT, arr_hour SMALLINT,
    time_block VARCHAR(12)""", ("flight_id",), serial=True)
AIRPORT = Contract("airport_summary", """
    origin CHAR(3), total_flights INT, disrupted_flights INT,
    avg_dep_delay DECIMAL(6,2), avg_arr_delay DECIMAL(6,2),
    cancellation_rate DECIMAL(5,4), diversion_rate DECIMAL(5,4),
    disruption_rate DECIMAL(5,4), afi DECIMAL(5,4)""", ("origin",))
ROUTE = Contract("route_summary", """
    route VARCHAR(8), total_flights INT, disrupted_flights INT,
    avg_dep_delay DECIMAL(6,2), avg_arr_delay DECIMAL(6,2), avg_distance DECIMAL(7,2),
    disruption_rate DECIMAL(5,4), rrs DECIMAL(5,2)""", ("route",))
CARRIER = Contract("carrier_summary", """
    op_unique_carrier VARCHAR(10), total_flights INT, disrupted_flights INT,
    avg_dep_delay DECIMAL(6,2), avg_arr_delay DECIMAL(6,2), cancellations INT, diversions INT,
    disruption_rate DECIMAL(5,4), cancellation_rate DECIMAL(5,4)""", ("op_unique_carrier",))
MONTHLY = Contract("monthly_summary", """
    year SMALLINT, month SMALLINT, total_flights INT, disrupted_flights INT,
    avg_dep_delay DECIMAL(6,2), cancellations INT, disruption_rate DECIMAL(5,4)""",
    ("year", "month"))
CAUSE = Contract("delay_cause_summary", """
    cause VARCHAR(30), total_minutes DECIMAL(12,1), avg_minutes DECIMAL(6,2),
    flight_count INT, pct_of_total DECIMAL(5,2)""", ("cause",))

SUMMARY_CONTRACTS = (AIRPORT, ROUTE, CARRIER, MONTHLY, CAUSE)
# loader-side rename of the exported carrier column onto the warehouse name
LOAD_RENAMES = {"carrier": "op_unique_carrier"}
# columns the flights load re-types as whole numbers (half-to-even), and as decimals
FLIGHT_SMALLINT = tuple(c for c, t in FLIGHTS.columns if t == "SMALLINT")
FLIGHT_DECIMAL = tuple(c for c, t in FLIGHTS.columns if t.startswith("DECIMAL"))
# deterministic stand-in for file order when numbering flights
FLIGHT_ORDER = ("fl_date", "flight_num", "tail_num", "origin", "dest", "crs_dep_time",
                "crs_arr_time", "op_unique_carrier")


# ---------------------------------------------------------------------------------------------
# export naming
# ---------------------------------------------------------------------------------------------

def export_rename(df: DataFrame) -> DataFrame:
    """Export names: strip, apply the fixed renames, lower-case the rest."""
    renames = dict(fixed.EXPORT_RENAMES)
    return df.toDF(*[renames.get(c.strip(), c.strip()).lower() for c in df.columns])


def contract_projection(df: DataFrame, contract: Contract,
                        renames: dict[str, str] | None = None) -> tuple[DataFrame, list[str]]:
    """Keep the contract's columns, in contract order; report the ones missing.

    Extra columns (``norm_*``, ``delay_penalty``) are dropped.
    """
    renames = LOAD_RENAMES if renames is None else renames
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    df = df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})
    have = set(df.columns)
    keep = [c for c in contract.names if c in have]
    missing = [c for c in contract.names if c not in have]
    return df.select(*keep), missing


# ---------------------------------------------------------------------------------------------
# typed casts
# ---------------------------------------------------------------------------------------------

def _fail(msg: str) -> Column:
    return F.raise_error(F.lit(msg))


def varchar(c: Column, n: int, name: str) -> Column:
    """VARCHAR(n): longer values are an error (trailing blanks beyond n are trimmed)."""
    s = c.cast("string")
    fits = F.when(F.length(s) <= n, s).otherwise(F.rtrim(s))
    return F.when(F.length(fits) > n, _fail(f"{name}: value exceeds VARCHAR({n})").cast("string")) \
        .otherwise(fits)


def char(c: Column, n: int, name: str) -> Column:
    """CHAR(n): blank-padded to n; longer values (after trailing blanks) are an error."""
    s = F.rtrim(c.cast("string"))
    return F.when(F.length(s) > n, _fail(f"{name}: value exceeds CHAR({n})").cast("string")) \
        .otherwise(F.rpad(s, n, " "))


def typed(c: Column, typ: str, name: str) -> Column:
    t = typ.upper().replace(" ", "")
    if t.startswith("VARCHAR("):
        return varchar(c, int(t[8:-1]), name)
    if t.startswith("CHAR("):
        return char(c, int(t[5:-1]), name)
    spark_type = {"INT": "int", "INTEGER": "int", "SERIAL": "bigint"}.get(t, t.lower())
    return c.cast(spark_type)


def conform(df: DataFrame, contract: Contract, strict: bool = True) -> DataFrame:
    """Project and cast ``df`` onto the contract.  With ``strict`` a missing column is an
    error; otherwise it is filled with NULL of the declared type."""
    have = set(df.columns)
    cols = []
    for name, typ in contract.columns:
        if name not in have:
            if strict:
                raise ValueError(f"{contract.name}: missing column {name}")
            cols.append(typed(F.lit(None), typ, name).alias(name))
        else:
            cols.append(typed(F.col(name), typ, name).alias(name))
    return df.select(*cols)


def missing_columns(df: DataFrame, contract: Contract) -> list[str]:
    """Contract columns (but the surrogate key) that an exported frame does not have."""
    return [c for c in contract_projection(export_rename(df), contract)[1] if c != "flight_id"]


def load_summary(summary: DataFrame, contract: Contract) -> DataFrame:
    """Exported summary frame -> typed warehouse table (contract projection + casts); a missing
    column is NULL (``missing_columns`` reports it)."""
    projected, _ = contract_projection(export_rename(summary), contract)
    return conform(projected, contract, strict=False)


def prepare_flights(enriched: DataFrame) -> DataFrame:
    """Load-side re-typing of the exported flight frame (before the surrogate key):
    lenient date, ISO weekday recomputed from the date, whole-number columns rounded
    half-to-even, decimal columns coerced, carrier renamed onto the warehouse name."""
    compile_in_parts(enriched.sparkSession)
    df = export_rename(enriched)
    df = df.withColumnsRenamed({k: v for k, v in LOAD_RENAMES.items() if k in df.columns})
    types = {f.name: f.dataType for f in df.schema.fields}
    # numbers still spelled as text are parsed in a projection of their own: the one expression that does it all has
    # lambdas, and a stage with a lambda is not compiled as a whole
    texts = [c for c in (*FLIGHT_SMALLINT, *FLIGHT_DECIMAL)
             if c != "day_of_week" and isinstance(types.get(c), T.StringType)]
    df = df.withColumns({"fl_date": parse_date("fl_date"), **{c: F.expr(number_text_sql(c)) for c in texts}})
    types |= dict.fromkeys(texts, T.DoubleType())
    out = {"day_of_week": iso_day_of_week("fl_date").cast("smallint")}
    for c in FLIGHT_SMALLINT:
        if c in types and c != "day_of_week":
            out[c] = to_int_half_even(c, types[c])
    for c in FLIGHT_DECIMAL:
        if c in types:
            out[c] = to_double(c, types[c])
    return df.withColumns(out)


def load_flights(enriched: DataFrame, order: Sequence[str] = FLIGHT_ORDER, staged: bool = False) -> DataFrame:
    """Typed ``flights_cleaned`` with a consecutive ``flight_id`` (1..n).

    The key is a distributed row number (range partitioning + per-partition
    offsets), never a single-partition window.  ``staged``: the input is cheap to read twice.
    """
    prepared = prepare_flights(enriched)
    keyed = global_row_number(prepared, list(order) + [c for c in prepared.columns
                                                        if c not in order], "flight_id",
                              range_columns=3, staged=staged)
    return conform(keyed, FLIGHTS, strict=False)


# ---------------------------------------------------------------------------------------------
# checks, sinks, layout
# ---------------------------------------------------------------------------------------------

def pk_violations(table: DataFrame, contract: Contract) -> DataFrame:
    """Rows (table, key_nulls, duplicate_keys) — both must be 0 for a valid key."""
    key = list(contract.key)
    null_any = None
    for k in key:
        p = F.col(k).isNull()
        null_any = p if null_any is None else (null_any | p)
    per_key = table.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"),
                                      F.max(null_any.cast("int")).alias("__null"))
    return per_key.agg(
        F.lit(contract.name).alias("table_name"),
        F.coalesce(F.sum(F.col("__null") * F.col("__n")), F.lit(0)).cast("bigint").alias("key_nulls"),
        F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n") - 1)), F.lit(0)).cast("bigint")
        .alias("duplicate_keys"))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV sink with a header; NULL is written as an empty field.  The result is a folder of part
    files, which readers take as a whole."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


def read_csv(spark: SparkSession, path: str, contract: Contract | None = None,
             schema: str | None = None) -> DataFrame:
    """Re-scan an exported CSV with an explicit schema (from a contract or given)."""
    reader = spark.read.option("header", True).option("escape", '"')
    if contract is not None:
        schema = ", ".join(f"{c} {_csv_type(t)}" for c, t in contract.columns)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def table_schema(contract: Contract) -> str:
    """Spark schema string of a contract (CHAR/VARCHAR stored as STRING)."""
    return ", ".join(f"{c} {_csv_type(t)}" for c, t in contract.columns)


def read_table(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """Read the current version of a saved table with its declared schema; columns in contract order."""
    return tables.read(spark, path, table_schema(contract)).select(*contract.names)


def read_table_where(spark: SparkSession, path: str, contract: Contract, **conditions) -> DataFrame:
    """The rows whose columns have the given values (or lie in a (low, high) range), read from the files
    that can hold any; the table was saved with ``zones`` of these columns."""
    folder = tables.current(spark, path).folder
    return layout.read_files_where(spark, folder, table_schema(contract), conditions).select(*contract.names)


def _csv_type(t: str) -> str:
    t = t.upper()
    if t.startswith(("CHAR", "VARCHAR")):
        return "STRING"
    return {"INT": "INT", "SERIAL": "BIGINT"}.get(t, t)


class KeyViolationError(ValueError):
    pass


#: parts of a 64-bit hash whose sums stay far below a long's range for 10**14 rows
_PARTS = range(0, 64, 16)


def _fingerprint(key: str) -> list[Column]:
    """Sums that agree for two tables of the same keys, and by chance only for others (one in 2**64)."""
    h = F.xxhash64(key)
    return [F.coalesce(F.sum(F.shiftright(h, n).bitwiseAND(F.lit(0xFFFF).cast("long"))), F.lit(0)).alias(f"part_{n}")
            for n in _PARTS]


def _observed(contract: Contract | None) -> list[Column]:
    """What a load measures while it writes: rows, rows without a key, the numbers of a serial key."""
    out = [F.count(F.lit(1)).alias("rows")]
    if contract is not None and contract.key:
        missing = F.col(contract.key[0]).isNull()
        for k in contract.key[1:]:
            missing = missing | F.col(k).isNull()
        out.append(F.count_if(missing).alias("null_keys"))
        if contract.serial:
            out += _fingerprint(contract.key[0])
    return out


def check_key(spark: SparkSession, folder: str, contract: Contract, seen: dict) -> None:
    """Raise ``KeyViolationError`` if the files just written break the table's primary key.

    Rows without a key were counted during the write.  A serial key is checked without a shuffle: a
    fingerprint of the numbers written must be that of 1..n.  Other keys are counted in the new files.
    """
    if seen["null_keys"]:
        raise KeyViolationError(f"{contract.name}: {seen['null_keys']} row(s) without {', '.join(contract.key)}")
    if contract.serial:
        key = contract.key[0]
        wanted = spark.range(1, seen["rows"] + 1).select(F.col("id").alias(key)).agg(*_fingerprint(key)).first()
        if any(wanted[f"part_{n}"] != seen[f"part_{n}"] for n in _PARTS):
            raise KeyViolationError(f"{contract.name}: {key} is not 1 to {seen['rows']}, each once")
        return
    written = spark.read.schema(table_schema(contract)).parquet(folder)
    twice = written.groupBy(*contract.key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bad = twice.agg(F.count(F.lit(1)).alias("keys"), F.min(F.struct(*contract.key)).alias("first")).first()
    if bad["keys"]:
        raise KeyViolationError(f"{contract.name}: {bad['keys']} duplicate key(s), the first {tuple(bad['first'])}")


def save_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (),
               tiebreak: Sequence[str] = (), contract: Contract | None = None, cluster_by: Sequence[str] = (),
               zones: Sequence[str] = (), bloom: Sequence[str] = (), rows_per_file: int | None = None) -> int:
    """Refresh a served table; returns its number of rows, counted during the write.

    ``partition_by`` gives directory pruning (e.g. year, month).  Inside, rows are in the order of
    ``sort_by``, then along a space-filling curve of the ``cluster_by`` columns, so that
    files and row groups are narrow in each of them.  ``zones``: columns of the zone map behind
    ``read_table_where``.  ``bloom``: columns with a Parquet bloom filter (written for the chunks that
    have no dictionary, which serves the same).  ``rows_per_file``: a file's most rows.

    Rows are range-partitioned on (partition, sort, curve, tiebreak) columns rather than hashed on
    the partition columns: a month holding a third of all flights is then written by many tasks, not
    one.

    The files are a new version of the table; with a ``contract`` its primary key is checked before the
    version is committed.  A failed write or a broken key leaves the old version in place.
    """
    spark, out = df.sparkSession, df
    keys = [*partition_by, *sort_by]
    if cluster_by:
        out, keys = layout.with_curve(out, cluster_by, "__curve"), [*keys, "__curve"]
    keys += tiebreak
    if keys:
        out = out.repartitionByRange(*keys).sortWithinPartitions(*keys)
    seen = Observation()
    w = out.drop("__curve").observe(seen, *_observed(contract)).write
    if partition_by:
        w = w.partitionBy(*partition_by)
    if rows_per_file:
        w = w.option("maxRecordsPerFile", rows_per_file)
    for c in bloom:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    folder = tables.new_version(path)
    try:
        w.parquet(folder)
        if contract is not None and contract.key:
            check_key(spark, folder, contract, seen.get)
        if zones:
            schema = table_schema(contract) if contract else df.schema
            found = layout.zone_map(spark.read.schema(schema).parquet(folder), folder, zones)
            found.write.parquet(f"{folder}/{layout.ZONES}")
        tables.commit(spark, path, folder, seen.get["rows"])
    except BaseException:
        delete_path(spark, folder)
        raise
    return seen.get["rows"]
