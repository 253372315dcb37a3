"""Ranked lexical search against a plain evaluation of its score."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from aloft.llm import ranked_search as R
from aloft.llm import textops

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, top=R.TOP):
    bags = [(d, terms(t)) for d, t in docs]
    n_docs, n_terms = sum(1 for _, w in bags if w), sum(len(w) for _, w in bags)
    df = Counter(t for _, w in bags for t in set(w))
    out = []
    for item, text in items:
        scored = []
        for doc, w in bags:
            if not w:
                continue
            tf, m = Counter(w), 100 - 50 + (50 * len(w) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * tf[t] // (1000 * tf[t] + 20 * m))
                        for t in set(terms(text)) if tf[t])
            if score > 0:
                scored.append((-score, doc is None, doc))
        scored.sort(key=lambda x: (x[0], x[1], x[2] if x[2] is not None else 0))
        out += [(item, k, doc, -s) for k, (s, _, doc) in enumerate(scored[:top], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, top=R.TOP, kind="long"):
    d = spark.createDataFrame(docs, f"doc_id {kind}, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in R.search(d, i, top).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


WORDS = ["Alpha", "beta", "GAMMA", "delta2", "é", "ÉA", "Ω", "x", "42", "naïve", "a_b", "tab\tzero\x00z", "don't"]


def made(seed, n):
    r = random.Random(seed)
    return [" ".join(r.choice(WORDS) for _ in range(r.randrange(0, 12))) for _ in range(n)]


def test_matches_brute_force(spark):
    texts = made(1, 60)
    docs = [(i * 7 % 61, t) for i, t in enumerate(texts)]
    docs += [(100 + i, texts[i % 3]) for i in range(40)]  # copies: ties by doc_id
    docs += [(200, None), (201, ""), (202, "   . , "), (203, "beta " * 3000), (5, texts[5]), (5, texts[5])]
    items = [(i, t) for i, t in enumerate(made(2, 9))] + [(50, None), (51, ""), (3, "alpha beta"), (3, "alpha beta"), (60, "nowhere")]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, docs, items, top=3) == brute(docs, items, top=3)


def test_blocks_and_batches(spark, monkeypatch):
    docs, items = list(enumerate(made(3, 80))), list(enumerate(made(4, 7)))
    want = brute(docs, items, top=4)
    monkeypatch.setattr(R, "ITEM_BLOCK", 2)
    monkeypatch.setattr(R, "CLASS_BATCH", 5)
    assert found(spark, docs, items, top=4) == want
    monkeypatch.setattr(R, "BLOCK_TERMS", 3)
    assert found(spark, docs, items, top=4) == want


def test_string_and_null_ids(spark):
    docs = [("b", "alpha"), ("a", "alpha"), (None, "alpha"), ("B", "Alpha"), ("z", "beta gamma")]
    items = [(1, "ALPHA"), (None, "beta")]
    assert found(spark, docs, items, kind="string") == brute(docs, items)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "alpha")]) == []
    assert found(spark, [(1, "alpha")], []) == []
    assert found(spark, [(1, None), (2, "")], [(1, "alpha")]) == []
    d = spark.createDataFrame([], "doc_id string, text string")
    i = spark.createDataFrame([], "item_id string, text string")
    assert R.search(d, i).dtypes == [("item_id", "string"), ("rank", "int"), ("doc_id", "string"), ("score", "bigint")]


def test_extra_columns(spark):
    d = spark.createDataFrame([(1, "alpha", 5, 6, "n")], "doc_id long, text string, item_id int, SCORE int, terms string")
    i = spark.createDataFrame([(1, "alpha", 5)], "item_id long, text string, doc_id int")
    assert [tuple(r)[:3] for r in R.search(d, i).collect()] == [(1, 1, 1)]


def test_terms_are_verified_behind_their_hash(monkeypatch):
    monkeypatch.setattr(textops, "word_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    data = np.frombuffer(b"beta alpha alphb alpha", dtype=np.uint8)
    starts, ends, _ = textops.words(data, np.array([0, len(data)]))
    word, term = R.Vocabulary([b"alpha"]).find(data, starts, ends)
    assert word.tolist() == [1, 3] and term.tolist() == [0, 0]
    with pytest.raises(ValueError, match="hash"):
        R.Vocabulary([b"alpha", b"beta"])


def test_sums_beyond_doubles():
    scorer = R.Scorer(np.full(3, 2 ** 30, dtype=np.int64), [[0, 1, 2]] * 2)
    scorer.exact = False
    args = (np.array([0, 0, 1]), np.array([0, 2, 1]), np.array([1, 5, 2]), np.array([60, 70]))
    slow = scorer.score(*args)
    scorer.exact = True
    assert (slow == scorer.score(*args)).all()


def test_a_class_is_scored_once(spark):
    docs = spark.createDataFrame([(i, "alpha beta" if i % 3 else "beta") for i in range(300)], "doc_id long, text string")
    rows = R.bags(docs, R.Vocabulary([b"alpha", b"beta"]))
    assert rows.select("n", "terms", "counts").distinct().count() == 2
