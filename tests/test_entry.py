"""The entry module stands without the corpus subpackage."""

import importlib.util

import __spark_entry__ as E
from aloft.plans.oracle_sql import ORACLE
from aloft.plans.queries import QUERIES


def test_entry_without_the_corpus_operators(monkeypatch):
    find = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec",
                        lambda name, *a: None if name in ("aloft.llm", "corpus_pipeline") else find(name, *a))
    assert E.queries() == QUERIES and E.oracle_sql() == {k: v for k, v in ORACLE.items() if k in QUERIES}


def test_every_statement_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert not set(QUERIES) & set(E._corpus()[0])
