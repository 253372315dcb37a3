"""The coercion of the wide flight frame: compiled, and value for value that of ``to_double``."""

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from aloft.functions import fixed
from aloft.functions.columns import DATE_FORMATS, parse_date, to_double
from aloft.operators import clean as C
from aloft.plans import queries as Q
from aloft.session import HUGE_METHOD, compile_in_parts
from aloft.sources import warehouse as W

LIMIT = "spark.sql.codegen.hugeMethodLimit"
ODD = ["12", " 12 ", "12d", "12f", "nan", "inf", "Infinity", "0x10", "0x1p3", "1e3", "1e400", "-1e400", "5.", ".5", "+3e-2", "", None, "N/A",
       "\t12\t", "\x0112", "12\x01", "12\x0b", "1.2.3", "--1", "/5", "5/", "١٢", "-0.0", "1 2", "e5", ".", "12D", "7F", "X", "12x"]


def _plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("simple")
    return buf.getvalue()


def test_values_are_those_of_to_double(spark):
    df = spark.createDataFrame([(v, v) for v in ODD], "k string, DEP_DELAY string")
    got = C.coerce_numeric(df).select("DEP_DELAY").collect()
    want = df.select(to_double("DEP_DELAY").alias("x")).collect()
    assert [str(r[0]) for r in got] == [str(r[0]) for r in want]


def test_numbers_stay_finite(spark):
    df = spark.createDataFrame([(1.5, 2.5), (float("nan"), None), (float("-inf"), float("inf"))], "DEP_DELAY double, MONTH double")
    assert [tuple(r) for r in C.coerce_numeric(df).collect()] == [(1.5, 2), (None, None), (None, None)]


def test_no_lambda_in_the_wide_frame(spark):
    """Lambdas are interpreted; twenty columns of them cost several times the parsing itself."""
    df = spark.createDataFrame([tuple("1" for _ in fixed.RAW_COLUMNS)], ", ".join(f"{c} string" for c in fixed.RAW_COLUMNS))
    assert "lambda" not in _plan(C.coerce_raw(df))


def test_methods_too_large_to_compile_are_split(spark):
    was = spark.conf.get(LIMIT)
    try:
        spark.conf.set(LIMIT, "65535")
        C.coerce_numeric(spark.createDataFrame([("1",)], "MONTH string"))
        assert spark.conf.get(LIMIT) == HUGE_METHOD
        spark.conf.set(LIMIT, "1234")
        compile_in_parts(spark)
        assert spark.conf.get(LIMIT) == "1234"
    finally:
        spark.conf.set(LIMIT, was)


def test_spellings_that_are_numbers_are_still_looked_up(spark):
    df = spark.createDataFrame([("A", "B", "C", "-999", "-999"), ("A", "", "C", "N/A", "7")],
                               "ORIGIN string, DEST string, OP_UNIQUE_CARRIER string, DEP_DELAY string, MONTH string")
    got = [tuple(r) for r in C.coerce_raw(df, ("-999", "")).collect()]
    assert got == [("A", "B", "C", None, None), ("A", None, "C", None, 7)]
    assert [r["DEP_DELAY"] for r in C.coerce_raw(df).collect()] == [-999.0, None]


def test_iso_dates_need_no_formatter(spark):
    rows = ["2024-01-05", "2024-02-30", "2023-02-29", "2024-13-01", "0000-01-01", "9999-12-31", "2024-01-5T", "2024-01-5 ", " 024-01-05", "+024-01-05",
            "-024-01-05", "2024- 1-05", "2024--1-05", "2024-1--05", "2024-1 -05", "2024-01-0a", "1/2/-20-24", "1/20-24-11", "２024-01-05", "2024-01-05 "]
    df = spark.createDataFrame([(v,) for v in rows], "v string")
    plain = F.coalesce(*[F.call_function("try_to_date", F.col("v"), F.lit(f)) for f in DATE_FORMATS])
    got = df.select("v", parse_date("v").cast("string").alias("a"), plain.cast("string").alias("b")).collect()
    assert [(r["v"], r["a"]) for r in got] == [(r["v"], r["b"]) for r in got]
    assert re.search(r"cast\(v#?\d* as date\)|try_cast\(v", _plan(df.select(parse_date("v"))))


def test_no_column_of_last_characters(spark):
    """A BETWEEN on an expression becomes a column in a projection below: twenty more text columns to copy."""
    df = spark.createDataFrame([tuple("1" for _ in fixed.RAW_COLUMNS)], ", ".join(f"{c} string" for c in fixed.RAW_COLUMNS))
    assert "_common_expr" not in _plan(C.coerce_raw(df))


def test_hex_of_any_length_is_no_number(spark):
    rows = ["0x1", "0x1p3", "0X1P3", "-0x1p3", "0x1.8p1", "x1", "1x1", "12345", "123.45", "0x1p-30"]
    df = spark.createDataFrame([(v,) for v in rows], "DEP_DELAY string")
    got = [r[0] for r in C.coerce_numeric(df).collect()]
    assert got == [None] * 7 + [12345.0, 123.45, None]


def test_text_numbers_of_a_load_are_compiled(spark):
    """The values of ``to_double``, and of its rounding, without lambdas."""
    df = spark.createDataFrame([(v, v, "2024-01-05", i) for i, v in enumerate(["12.5", "13.5", "7", "12d", "nan", "inf", "1e400", " 8 ", "-0.0", "0x1p3",
                                                                            "", None, "12\x01"])], "DEP_TIME string, DEP_DELAY string, FL_DATE string, i int")
    got = W.prepare_flights(df)
    assert "lambda" not in _plan(got)
    want = df.select("i", F.rint(to_double("DEP_TIME")).cast("smallint").alias("dep_time"), to_double("DEP_DELAY").alias("dep_delay"))
    assert sorted(map(str, got.select("i", "dep_time", "dep_delay").collect())) == sorted(map(str, want.collect()))
    assert [r["dep_time"] for r in got.orderBy("i").limit(4).collect()] == [12, 14, 7, None]


def test_whole_numbers_stage_only_what_they_read(spark):
    """The rows and values are those of the whole frame's load."""
    sf = "/root/testdata/sf0.001"
    assert not {"TAXI_OUT", "DISTANCE", "WEATHER_DELAY", "TAIL_NUM"} & {*Q.SMALLINT_RAW}
    cols = ("flight_num", *W.FLIGHT_SMALLINT)
    whole = W.prepare_flights(Q.enriched(spark, sf)).select(*cols)
    got = Q.QUERIES["coerce_smallint"](spark, sf)
    assert got.schema == whole.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
