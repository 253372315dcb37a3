from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from aloft.functions.columns import hour_of, iso_day_of_week, month_abbrev, np_round, parse_date, time_block
from aloft.operators import clean as C
from aloft.operators import features as FE
from aloft.operators.summaries import minmax_norm
from aloft.sources import warehouse as W


def test_numpy_rounding(spark):
    vals = [0.125, 1.005, 2.675, 12.345, 99.995]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(np_round(F.col("v"), 2)).collect()]
    assert got == [0.12, 1.0, 2.68, 12.34, 100.0]
    import numpy as np
    assert got == [float(np.round(v, 2)) for v in vals]


def test_hours_and_blocks(spark):
    vals = [None, -50.0, 0.0, 559.0, 600.0, 1159.0, 1759.0, 2359.0, 2400.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    rows = df.select(hour_of("v").alias("h"), time_block(hour_of("v")).alias("b")).collect()
    assert [r.h for r in rows] == [None, 0, 0, 5, 6, 11, 17, 23, 23]
    assert [r.b for r in rows] == [None, "Night", "Night", "Night", "Morning", "Morning", "Afternoon",
                                   "Evening", "Evening"]


def test_disruption_label_nulls(spark):
    rows = [(None, None, 0, 0), (14.9, None, 0, 0), (15.0, None, 0, 0), (None, 15.0, 0, 0),
            (None, None, 1, 0), (None, None, 0, 1), (-3.0, -2.0, 0, 0)]
    df = spark.createDataFrame(rows, "DEP_DELAY double, ARR_DELAY double, CANCELLED int, DIVERTED int")
    got = [r[0] for r in df.select(FE.disrupted_flag()).collect()]
    assert got == [0, 0, 1, 1, 1, 1, 0]


def test_weekday_date_month(spark):
    df = spark.createDataFrame([("2024-01-05",), ("1/5/2024 12:00:00 AM",), ("junk",), ("2024-01-07",)], "s string")
    rows = df.select(parse_date("s").alias("d")).select("d", iso_day_of_week("d").alias("w")).collect()
    assert [str(r.d) if r.d else None for r in rows] == ["2024-01-05", "2024-01-05", None, "2024-01-07"]
    assert [r.w for r in rows] == [5, 5, None, 7]
    m = spark.createDataFrame([(1,), (12,), (13,), (None,)], "m int").select(month_abbrev("m")).collect()
    assert [r[0] for r in m] == ["Jan", "Dec", None, None]


def test_median_exact_interpolated(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (20.0,), (None,)], "DEP_DELAY double")
    assert C.column_medians(df, ["DEP_DELAY"]).first()[0] == 6.0
    filled = C.median_fill(df, ["DEP_DELAY"]).collect()
    assert sorted(r[0] for r in filled) == [1.0, 2.0, 6.0, 10.0, 20.0]


def test_median_all_null_keeps_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "DEP_DELAY double")
    assert [r[0] for r in C.median_fill(df, ["DEP_DELAY"]).collect()] == [None, None]


def test_nan_never_reaches_median(spark):
    df = spark.createDataFrame([("1",), ("nan",), ("3",), ("inf",)], "DEP_DELAY string")
    coerced = C.coerce_numeric(df, ["DEP_DELAY"], [])
    assert C.column_medians(coerced, ["DEP_DELAY"]).first()[0] == 2.0


def test_minmax_constant_and_range(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [r.n for r in minmax_norm(df, {"x": "n"}).collect()] == [0.0, 0.0]
    df = spark.createDataFrame([(1.0,), (3.0,), (2.0,)], "x double")
    assert sorted(r.n for r in minmax_norm(df, {"x": "n"}).collect()) == [0.0, 0.5, 1.0]


def test_decimal_contract_rounds_half_up_and_overflows(spark):
    df = spark.createDataFrame([(12.345,)], "v double")
    two = df.select(F.col("v").cast("decimal(6,2)").alias("v"))
    assert two.first()[0] == Decimal("12.35")  # stored value, then a view rounds again
    assert two.select(F.round("v", 1)).first()[0] == Decimal("12.4")
    bad = spark.createDataFrame([(9.99995,)], "v double").select(F.col("v").cast("decimal(5,4)"))
    with pytest.raises(Exception):
        bad.collect()


def test_char_varchar(spark):
    df = spark.createDataFrame([("A1",), ("ABC  ",)], "s string")
    got = [r[0] for r in df.select(W.char(F.col("s"), 3, "s")).collect()]
    assert got == ["A1 ", "ABC"]
    too_long = spark.createDataFrame([("ABCD",)], "s string").select(W.varchar(F.col("s"), 3, "s"))
    with pytest.raises(Exception):
        too_long.collect()


def test_missing_required_column_fails_before_running(spark):
    df = spark.createDataFrame([("x",)], "ORIGIN string")
    with pytest.raises(C.MissingColumnsError):
        C.clean_flights(df)


def test_null_tokens_exact_match(spark):
    df = spark.createDataFrame([("NA",), ("na",), ("",), (" N/A",), ("null",)], "v string")
    got = [r[0] for r in C.replace_null_tokens(df).collect()]
    assert got == [None, "na", None, " N/A", None]


def test_median_fill(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (20.0,), (None,)], "DEP_DELAY double")
    assert sorted(r[0] for r in C.median_fill(df, ["DEP_DELAY"]).collect()) == [1.0, 2.0, 6.0, 10.0, 20.0]
