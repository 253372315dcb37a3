"""Medians by radix selection against a sort."""

import math
import statistics

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aloft.operators import clean as C
from aloft.operators import selection as S

HARD = {
    "delays": [-5.0] * 30 + [-4.0] * 25 + [float(i) for i in range(-40, 100)],
    "close": [1.0 + k * 2.0 ** -52 for k in range(101)],
    "tiny": [5e-324 * k for k in range(50)] + [1e-300, 1e300],
    "decades": [s * 10.0 ** e for e in range(-300, 300, 3) for s in (1, -1)],
    "zeros": [0.0, -0.0] * 20 + [1e-12, -1e-12, 3.0],
    "infinite": [math.inf] * 5 + [-math.inf] * 4 + [1.0, 2.0],
    "mostly infinite": [math.inf] * 5 + [1.7e308],
    "huge": [1.7e308 - k * 1e300 for k in range(40)] + [-1.7e308] * 3,
    "one": [3.25],
    "two": [1.0, 20.0],
}


def median(values):
    values = sorted(values)
    n = len(values)
    a, b = values[(n - 1) // 2], values[n // 2]
    return a if a == b else a + (b - a) * 0.5


@pytest.mark.parametrize("name", sorted(HARD))
def test_hard_distributions(spark, name):
    values = HARD[name]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (math.nan,)], "v double")
    assert S.medians(df, ["v"])["v"] == median(values)


def test_several_columns_at_once_and_passes(spark, monkeypatch):
    rows = [(float(i % 7 - 3), i * 0.5, None, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d int")
    passes = []
    count = S._count
    monkeypatch.setattr(S, "_count", lambda *a: passes.append(a[1]) or count(*a))
    assert S.medians(df, ["a", "b", "c", "d"]) == {
        "a": statistics.median(r[0] for r in rows), "b": statistics.median(r[1] for r in rows), "c": None,
        "d": statistics.median(r[3] for r in rows)}
    assert len(passes) <= 3
    assert S.medians(df, []) == {} and S.medians(df.where("false"), ["a"]) == {"a": None}


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=30))
def test_any_doubles(values):
    from pyspark.sql import SparkSession
    df = SparkSession.getActiveSession().createDataFrame([(v,) for v in values], "v double")
    got, want = S.medians(df, ["v"])["v"], median(values)
    assert got == want or (math.isnan(got) and math.isnan(want))


def test_column_medians_is_one_row(spark):
    df = spark.createDataFrame([(1.0, 2), (2.0, 4), (10.0, 4), (20.0, None)], "DEP_DELAY double, DISTANCE int")
    out = C.column_medians(df)
    assert [tuple(r) for r in out.collect()] == [(6.0, 4.0)] and out.columns == ["DEP_DELAY", "DISTANCE"]
