"""Spark queries vs their DuckDB statements on the smallest fixture (sf0.001)."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E
from aloft.functions import fixed
from aloft.plans import queries as Q
from aloft.plans.oracle_sql import ORACLE
from aloft.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["lineitem", "orders", "customer", "supplier"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, Decimal):
        return str(v.normalize())
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: [(x is None, str(x)) for x in t])


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="module", autouse=True)
def one_staged_frame():
    """All queries of this module share one staged coerced frame."""
    made, build = {}, Q.staged

    def once(spark, sf, columns=fixed.RAW_COLUMNS):
        if sf not in made:
            made[sf] = build(spark, sf)
        return made[sf].select(*columns)

    Q.staged = once
    yield
    Q.staged = build


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _canon(rows, cols) == _canon(orows, ocols)


def test_every_query_has_oracle_or_is_rows_only():
    assert set(QUERIES) - set(ORACLE) == {"train_logistic", "train_forest", "model_comparison", "rf_importance"}
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
