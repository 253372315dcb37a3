import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aloft.functions.columns import DATE_FORMATS, NUMBER_PATTERN, parse_date, to_double, to_double_sql, to_int_half_even

SPELLINGS = ["12", " 12 ", "12d", "12f", "nan", "inf", "1_000", "0x10", "1e3", "N/A", "",
             "\t12\t", "-5", ".5", "5.", "+3e-2", "1e400", "e5", ".", "+", "1e", "1.2.3", "--1",
             "1e+", " -0.0 ", "NaN", "Infinity", "0x1p3", "1D", "7F", "١٢"]


def _expected(v):
    if v is None or not re.match(NUMBER_PATTERN, v):
        return None
    x = float(v.strip(" \t\n\x0b\f\r"))
    return None if math.isinf(x) or math.isnan(x) else x


def test_hand_spellings(spark):
    df = spark.createDataFrame([(v,) for v in SPELLINGS], "v string")
    got = {r["v"]: r["d"] for r in df.select("v", to_double("v").alias("d")).collect()}
    for v in SPELLINGS:
        assert got[v] == _expected(v), v


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="0123456789+-.eEdfxnai \t", max_size=8), min_size=1, max_size=40))
def test_matches_pattern(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = df.select("v", to_double("v").alias("d")).collect()
    for r in rows:
        assert r["d"] == _expected(r["v"]), r["v"]


def test_numeric_input_passthrough(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (float("inf"),), (None,)], "v double")
    got = [r[0] for r in df.select(to_double("v", df.schema["v"].dataType)).collect()]
    assert got == [1.5, None, None, None]


def test_odd_ends_take_the_careful_way(spark):
    """Characters that the cast would trim but no plain number has, exotic digits, suffixes and hex inside."""
    odd = ["\x0112", "12\x01", "\x0b7\x0c", " \x0112", "1 2", "/5", ",5", "0x1p3", "0X1P3", "+0x1p3", "5/", "١", "+1e400", "-1e400"]
    df = spark.createDataFrame([(v,) for v in odd], "v string")
    assert [r[0] for r in df.select(to_double("v")).collect()] == [_expected(v) for v in odd]


def test_a_value_is_parsed_in_one_place(spark):
    """Twenty number columns once made a generated method too large to be compiled: each value was parsed and trimmed in
    several places of it."""
    text = to_double_sql("v")
    assert text.count("`v`") == 1
    df = spark.createDataFrame([("1",)], "v string").selectExpr(f"{text} AS d")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "transform" in plan and df.first()["d"] == 1.0


def test_dates_by_separators(spark):
    rows = ["2024-01-05", "1/5/2024 12:00:00 AM", "1/5/2024", "2024/01/05", "2024-01-05 10:11:12", "unknown", "", None, "-", "1-5/2024", "2024-13-01"]
    df = spark.createDataFrame([(v,) for v in rows], "v string")
    plain = F.coalesce(*[F.call_function("try_to_date", F.col("v"), F.lit(f)) for f in DATE_FORMATS])
    got = df.select(parse_date("v").alias("a"), plain.alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got] and [r["a"] is None for r in got] == [False] * 5 + [True] * 6


def test_whole_numbers_half_to_even(spark):
    df = spark.createDataFrame([(x,) for x in (0.5, 1.5, 2.5, -0.5, -1.5, 2.4999999999999996, None)], "v double")
    assert [r[0] for r in df.select(to_int_half_even("v", df.schema["v"].dataType)).collect()] == [0, 2, 2, 0, -2, 2, None]
