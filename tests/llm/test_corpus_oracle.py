"""Corpus queries against their DuckDB statements on the smallest tables."""

import duckdb
import pytest

from aloft.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_duckdb(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    res = duck.execute(ORACLE_SQL[name])
    want = [d[0] for d in res.description]
    assert sorted(want) == cols
    at = [want.index(c) for c in cols]
    expected = sorted((tuple(r[i] for i in at) for r in res.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == expected


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) - set(ORACLE_SQL) == {"op4_language_id", "op5_token_counts", "op13_byte_bpe"}
