"""Flight-shaped view over the driver's TPC-H-like tables.

The production input of this engine is a folder of monthly on-time CSV
files (see :mod:`aloft.sources.csv_folder`).  The test data instead ships
``lineitem/orders/supplier/customer`` parquet tables; this module derives,
deterministically, one 28-column string row per ``lineitem`` row so that the
pipeline can be run, checked and benchmarked on them.  Every value is a
string, exactly as a CSV scan without schema inference would deliver it.

Plan shape: ``orders`` is joined to the customer nation first, then the
order side is joined to ``lineitem`` on the order key, then the supplier nation
is attached.  There are no hints: adaptive execution turns a shuffle join into a
broadcast join where it has measured a side small.  Only the columns used are
read (the parquet scans show a pruned ``ReadSchema``).

A few values are deliberately awkward, as real files are: delays spelled
``N/A``, half minutes and half miles, dates in a second format or missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aloft.functions import fixed

# Only the columns the view needs; a declared read schema also skips footer-based
# schema inference.
_READ_SCHEMAS = {
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                 "l_quantity DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_shipdate TIMESTAMP_NTZ"),
    "orders": "o_orderkey BIGINT, o_custkey BIGINT",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "customer": "c_custkey BIGINT, c_nationkey INT",
}


def _path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_READ_SCHEMAS[name]).parquet(_path(sf_dir, name))


def flight_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joined narrow inputs: one row per lineitem with the two nation keys."""
    li = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders")
    supp = _table(spark, sf_dir, "supplier")
    cust = _table(spark, sf_dir, "customer")

    order_nation = (orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
                    .select("o_orderkey", "c_nationkey"))
    return (li.join(order_nation, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(supp, F.col("l_suppkey") == F.col("s_suppkey")))


# Shared intermediate values, computed once per row in their own projection.
_HELPERS = (
    "l_orderkey AS ok", "l_partkey AS pk", "l_suppkey AS sk", "l_linenumber AS ln",
    "to_date(l_shipdate) AS sd", "s_nationkey AS sn", "c_nationkey AS cn",
    "l_discount = 0.1D AS canc",
    "l_discount <> 0.1D AND l_tax = 0.08D AND l_linenumber = 7 AS dvt",
    "(l_orderkey * 7 + l_partkey * 3 + l_linenumber * 11) % 60 - 40 + s_nationkey % 12 AS dd",
    "l_quantity",
)
_HELPERS_2 = ("*", "dd + CAST(l_quantity AS INT) % 21 - 12 AS ad")
_HELPERS_3 = ("*", "NOT canc AND NOT dvt AND ad >= 15 AS late", "canc OR dvt AS gone")


def _cause(lines: str) -> str:
    return f"CAST(CASE WHEN late THEN CASE WHEN ln IN ({lines}) THEN ad ELSE 0 END END AS STRING)"


# The 28 columns of the on-time layout, every value as text.
_COLUMNS = (
    "CAST(year(sd) AS STRING) AS YEAR",
    "CAST(month(sd) AS STRING) AS MONTH",
    "CAST(weekday(sd) + 1 AS STRING) AS DAY_OF_WEEK",
    "CASE WHEN pk % 17 = 0 THEN concat(month(sd), '/', day(sd), '/', year(sd), ' 12:00:00 AM') "
    "WHEN pk % 23 = 0 THEN NULL WHEN pk % 29 = 0 THEN 'unknown' ELSE CAST(sd AS STRING) END AS FL_DATE",
    "concat('C', CAST(sk % 12 AS STRING)) AS OP_UNIQUE_CARRIER",
    "concat('N', CAST(pk % 100000 AS STRING), 'S', CAST(sk % 1000 AS STRING)) AS TAIL_NUM",
    "CAST(ok * 10 + ln AS STRING) AS OP_CARRIER_FL_NUM",
    "CASE WHEN pk % 211 <> 0 THEN concat('A', lpad(CAST(sn AS STRING), 2, '0')) END AS ORIGIN",
    "concat('A', lpad(CAST(cn AS STRING), 2, '0'), ' ') AS DEST",
    "CAST(pk % 25 * 100 + sk % 60 AS STRING) AS CRS_DEP_TIME",
    "CAST(CASE WHEN NOT canc THEN pk % 25 * 100 + (sk + 7) % 60 END AS STRING) AS DEP_TIME",
    "CASE WHEN NOT canc THEN CASE WHEN pk % 97 = 0 THEN 'N/A' ELSE CAST(dd AS STRING) END END AS DEP_DELAY",
    "CAST(CASE WHEN NOT canc THEN CASE WHEN dd >= 15 THEN 1 ELSE 0 END END AS STRING) AS DEP_DEL15",
    "CASE WHEN NOT canc THEN concat(10 + ok % 20, CASE WHEN ln % 2 = 0 THEN '.5' ELSE '' END) END AS TAXI_OUT",
    "CAST(CASE WHEN NOT gone THEN 4 + pk % 9 END AS STRING) AS TAXI_IN",
    "CAST((pk + 3 + ln) % 25 * 100 + ok % 60 AS STRING) AS CRS_ARR_TIME",
    "CAST(CASE WHEN NOT gone THEN (pk + 3 + ln) % 25 * 100 + (ok + 5) % 60 END AS STRING) AS ARR_TIME",
    "CAST(CASE WHEN NOT gone THEN ad END AS STRING) AS ARR_DELAY",
    "CAST(CASE WHEN NOT gone THEN CASE WHEN ad >= 15 THEN 1 ELSE 0 END END AS STRING) AS ARR_DEL15",
    "CAST(CASE WHEN canc THEN 1 ELSE 0 END AS STRING) AS CANCELLED",
    "CAST(CASE WHEN dvt THEN 1 ELSE 0 END AS STRING) AS DIVERTED",
    "CAST(CASE WHEN NOT gone THEN 30 + pk % 300 END AS STRING) AS AIR_TIME",
    "concat(200 + pk % 2300, CASE WHEN sk % 3 = 0 THEN '.5' ELSE '' END) AS DISTANCE",
    _cause("1, 2") + " AS CARRIER_DELAY",
    _cause("3") + " AS WEATHER_DELAY",
    _cause("4") + " AS NAS_DELAY",
    _cause("5") + " AS SECURITY_DELAY",
    _cause("6, 7") + " AS LATE_AIRCRAFT_DELAY",
)


def flight_rows(joined: DataFrame) -> DataFrame:
    """Derive the 28 string columns of the on-time layout from the joined rows.

    Shared intermediate values (ship date, delays, cancellation/diversion flags)
    are computed once in their own projections and the string columns refer to
    them; besides avoiding repeated work this keeps each generated method
    small enough for the JIT compiler.
    """
    h = joined.selectExpr(*_HELPERS).selectExpr(*_HELPERS_2).selectExpr(*_HELPERS_3)
    return h.selectExpr(*_COLUMNS)


def flight_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """28-column, all-string flight frame derived from the tables in ``sf_dir``."""
    return flight_rows(flight_source(spark, sf_dir))


def closed_form_score(df: DataFrame) -> DataFrame:
    """A fixed, model-free score per flight of this view, used to check the metric code:
    ((origin number mod 12) * 8 + distance mod 10) / 100, positive above 0.5."""
    origin_no = F.substring("ORIGIN", 2, 2).cast("int")
    score = ((origin_no % 12) * 8 + F.col("DISTANCE").cast("int") % 10) / F.lit(100.0)
    return df.select(F.col(fixed.ML_TARGET).alias("label"), score.alias("score")) \
             .withColumn("pred", (F.col("score") > 0.5).cast("int"))
