"""Hard negatives against all integer products, and the bounds behind which products are skipped."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aloft.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label long"


def whole(row):
    vec, e, label = row
    if e is None or label is None or any(x is None or not math.isfinite(x) for x in e):
        return None
    return vec, [math.floor(256 * x) for x in e], label


def brute(rows, step=100, k=5):
    rows = [(i, *w) for i, w in enumerate(map(whole, rows)) if w is not None]
    last = float("inf")
    out = []
    for a, vec, q, label in rows:
        if vec is None or vec % step:
            continue
        scored = [(-sum(x * y for x, y in zip(q, p)), last if v is None else v, other)
                  for i, v, p, other in rows if i != a and len(p) == len(q)]
        scored.sort(key=lambda s: s[:2])
        for pos, pos_id, _ in [s for s in scored if s[2] == label][:k]:
            good = [s for s in scored if s[2] != label and 80 * -pos <= 100 * -s[0] <= 100 * -pos][:k]
            out += [(vec, None if pos_id == last else pos_id, rank, None if v == last else v, -pos, -s)
                    for rank, (s, v, _) in enumerate(good, 1)]
    return sorted(out, key=repr)


def mined(spark, rows, schema=SCHEMA):
    return sorted((tuple(r) for r in H.mine(spark.createDataFrame(rows, schema)).collect()), key=repr)


def clustered(seed, n, dim=12, labels=4):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(6, dim))
    out = []
    for i in range(n):
        x = centre[r.integers(6)] * r.uniform(0.2, 2) + r.normal(size=dim) * 0.25
        out.append((i * 5, [float(v) for v in x], int(r.integers(labels))))
    return out


def test_matches_brute_force(spark, monkeypatch):
    rows = clustered(1, 700)
    want = brute(rows)
    assert want and mined(spark, rows) == want
    monkeypatch.setattr(H, "WINDOW", 16)
    monkeypatch.setattr(H, "ANCHOR_BLOCK", 7)
    assert mined(spark, rows) == want


def test_edges(spark):
    r = random.Random(3)
    vec = lambda d: [r.uniform(-1, 1) for _ in range(d)]
    same = vec(6)
    rows = [(100 * i, vec(6), i % 2) for i in range(6)]
    rows += [(1000 + i, list(same), i % 3) for i in range(60)]  # copies: ties by vec_id
    rows += [(700, list(same), 0), (700, list(same), 0), (None, list(same), 1), (None, list(same), 0)]
    rows += [(800, [0.0] * 6, 0), (801, [0.0] * 6, 1), (802, [-0.0] * 6, 0)]
    rows += [(900, vec(3), 0), (901, vec(3), 0), (902, vec(3), 1), (903, vec(3), 1), (1100, [], 0), (1101, [], 0), (1102, [], 1)]
    rows += [(1200, None, 0), (1201, vec(6), None), (1300, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0),
             (1400, [float("nan")] * 6, 0), (1500, [float("inf")] * 6, 1), (1600, [-1e-9] * 6, 1)]
    assert mined(spark, rows) == brute(rows)


def test_empty_and_other_columns(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0)]) == []
    rows = [(v, e, label, 7, "x") for v, e, label in clustered(2, 60)]
    assert mined(spark, rows, SCHEMA + ", ROW int, at string") == brute([x[:3] for x in rows])
    floats = spark.createDataFrame([(0, [0.5], 1), (1, [0.5], 1), (2, [0.45], 0)], "vec_id int, embedding array<float>, label int")
    assert [tuple(x) for x in H.mine(floats).collect()] == [(0, 1, 1, 2, 128 * 128, 128 * 115)]


def test_labels_move_on(spark):
    rows = spark.createDataFrame([(7, [1.0], 9), (8, [1.0], 9), (0, [1.0], 3), (14, [1.0], None), (None, [1.0], 4)], SCHEMA)
    assert [r["label"] for r in H.relabelled(rows).collect()] == [0, 9, 4, None, 4]


def test_too_large_numbers_raise(spark):
    with pytest.raises(Exception, match="2\\*\\*53"):
        mined(spark, [(0, [1e30], 0), (1, [1.0], 0)])
    with pytest.raises(OverflowError):
        H.products(np.array([[2.0 ** 40]]), np.array([[2.0 ** 40]]), 2.0 ** 80)
    assert H.products(np.array([[2.0 ** 29 + 1]]), np.array([[2.0 ** 29 + 1]]), 2.0 ** 58)[0, 0] == (2 ** 29 + 1) ** 2


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 40), st.sampled_from([1, 30, 10 ** 4, 10 ** 6]))
def test_scores_lie_within_their_bounds(seed, dim, size):
    r = np.random.default_rng(seed)
    rows = r.integers(-size, size + 1, size=(30, dim)).astype(float)
    rows[1], rows[2], rows[3] = rows[0], -rows[0], 3 * rows[0]
    rows[4] = rows[0]
    rows[4, 0] += 1
    norms = np.linalg.norm(rows, axis=1)
    theta = H.angles(rows, norms, H.fit_directions(rows))
    eps = 2 * H.slack(dim)
    apart = np.abs(theta[:, None] - theta[None]).max(axis=2, initial=0) - eps
    both = theta[:, None] + theta[None]
    within = np.minimum(both, 2 * np.pi - both).min(axis=2, initial=np.pi) + eps
    least, most = H.score_bounds(apart, within, np.outer(norms, norms), np.outer(norms, norms))
    scores = H.products(rows, rows, float(norms.max() ** 2))
    assert (scores == rows.astype(np.int64) @ rows.astype(np.int64).T).all()
    assert (least <= scores).all() and (scores <= most).all()


def test_windows_skip_products():
    r = np.random.default_rng(5)
    centre = r.normal(size=(8, 16))
    rows = np.floor(256 * np.concatenate([c + 0.02 * r.normal(size=(200, 16)) for c in centre]))
    norms = np.linalg.norm(rows, axis=1)
    directions = H.fit_directions(rows[::4])
    theta = H.angles(rows, norms, directions)
    labels, ids = np.arange(len(rows)) % 3, np.arange(len(rows))
    every = np.tile(np.array([H.NOTHING + 1, H.NO_ID], dtype=np.int64), (8, 1, 1))
    search = H.Search(H.Anchors(np.arange(8), rows[::200], ids[::200], labels[::200], directions, every), True, 5)
    for s in range(0, len(rows), 200):
        search.window(rows[s:s + 200], norms[s:s + 200], theta[s:s + 200], labels[s:s + 200], ids[s:s + 200], ids[s:s + 200])
    assert search.scored < 0.5 * 8 * len(rows)
