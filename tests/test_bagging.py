"""The forest against a search of every split, row by row, in plain Python."""

import glob

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from aloft.functions import fixed
from aloft.operators import bagging as B
from aloft.operators import ml as M

WEIGHTS = {0: 0.75, 1: 1.5}
WIDTH, TREES, DEPTH = 9, 3, 5


@pytest.fixture(scope="module")
def train(spark):
    r = np.random.default_rng(7)
    rows = []
    for i in range(400):
        x = np.zeros(WIDTH)
        x[0], x[1], x[2] = r.integers(-2, 4), round(r.normal(), 2), i % 7 in (5, 6)
        x[3] = float(i % 7)  # parts the rows as column 2 does, at one of its thresholds
        x[4 + r.integers(0, 4)] = 1  # column 8 is 0 everywhere
        y = int(r.random() < 0.15 + 0.5 * x[2] + 0.2 * x[4] * (x[0] > 0))
        make = Vectors.dense(x) if i % 3 else Vectors.sparse(WIDTH, [(k, v) for k, v in enumerate(x.tolist()) if v])
        rows += [(make, y, WEIGHTS[y])] * (3 if i % 50 == 0 else 1)
    u = F.unwrap_udt("features")
    df = spark.createDataFrame(rows, ["features", M.LABEL, "weight"])
    return df.withColumn("place", F.xxhash64(u["type"], u["size"], u["indices"], u["values"], M.LABEL)).cache()


def staged(train, bins):
    """(keys, labels, bins of every feature) of the staged rows."""
    rows = B.stage_rows(train, M.LABEL, bins).collect()
    numbers = [np.frombuffer(r["numbers"], bins.kind) for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(x) for x in numbers])
    dense = bins.dense(len(rows), row, np.concatenate(numbers)).reshape(-1, bins.width)
    return np.array([r["key"] for r in rows]).view(np.uint64), np.array([r["label"] for r in rows]), dense


def gini(a, b):
    return 1 - (a / (a + b)) ** 2 - (b / (a + b)) ** 2 if a + b else 1.0


def test_every_node_has_its_best_split(train, monkeypatch):
    monkeypatch.setattr(B.Tree, "prune", lambda self, weights: None)
    model = M.forest(train, trees=TREES, depth=DEPTH)
    bins = model.bins
    keys, labels, dense = staged(train, bins)
    assert len(set(keys.tolist())) == train.count() > train.distinct().count()  # equal rows are drawn one by one
    splits = 0
    for t, tree in enumerate(model.trees):
        n = B.copies(B.words(keys, t, fixed.ML_SEED), t).astype(int)
        todo = [(0, np.ones(len(keys), bool), 0)]
        while todo:
            node, here, level = todo.pop()
            of = lambda rows: [int(n[rows & (labels == y)].sum()) for y in (0, 1)]
            total = of(here)
            assert tree.counts[node].tolist() == total
            best = {}
            if level < DEPTH and min(total):
                for f in B.subsets(t, np.array([node]), WIDTH, fixed.ML_SEED)[0].tolist():
                    for b in range(len(bins.thresholds[f])):
                        left, right = (([WEIGHTS[y] * c for y, c in enumerate(of(here & side))]) for side in (dense[:, f] <= b, dense[:, f] > b))
                        whole = sum(left) + sum(right)
                        if sum(left) and sum(right):
                            best[f, b] = (gini(left[0] + right[0], left[1] + right[1]) - sum(left) / whole * gini(*left)
                                          - sum(right) / whole * gini(*right))
            most = max(best.values(), default=0.0)
            if tree.after[node, 0] == node:
                assert most < 1e-12
                continue
            splits += 1
            f, b = int(tree.feature[node]), int(tree.bin[node])
            assert tree.gain[node] == pytest.approx(most, abs=1e-12) and best[f, b] == pytest.approx(most, abs=1e-12)
            assert (f, b) == min(k for k, v in best.items() if v > most - 1e-12)  # of equal splits the first
            todo += [(tree.after[node, k], here & ((dense[:, f] > b) == bool(k)), level + 1) for k in (0, 1)]
    assert splits > 20


def test_bins_are_those_of_the_values(spark, train):
    bins = B.find_bins(train, train.count(), WIDTH)
    rows = train.select("features").collect()
    for f in (0, 2, 3, 4, 8):
        values = sorted({float(r["features"].toArray()[f]) for r in rows})
        assert bins.thresholds[f].tolist() == pytest.approx([(a + b) / 2 for a, b in zip(values, values[1:])], abs=1e-5)
    assert len(bins.thresholds[1]) == B.BINS - 1
    _, labels, dense = staged(train, bins)
    x = np.array([r["features"].toArray() for r in rows])
    want = np.stack([np.searchsorted(t, x[:, f]) for f, t in enumerate(bins.thresholds)], axis=1)
    assert sorted(map(tuple, dense.tolist())) == sorted(map(tuple, want.tolist()))


def test_a_value_between_two_others_follows_no_rounding():
    """In DISTANCE of the sample 10 and 12 may be neighbours; rows of 11 go left whatever the last digit of the divisor."""
    for sd in (np.float64(1 / 3), np.nextafter(1 / 3, 1), np.float64(1.7), np.nextafter(1.7, 0), np.float64(693.1), np.nextafter(693.1, 999)):
        at = B.thresholds_of(np.array([10.0, 12.0, 1500.0, 1501.0]) / sd, 4)
        assert [int(np.searchsorted(at, x / sd)) for x in (10, 11, 12, 756, 1500, 1500.5, 1501)] == [0, 0, 1, 1, 2, 2, 3]


def test_scores_are_the_mean_share_in_the_leaves(train):
    model = M.forest(train, trees=TREES, depth=DEPTH)
    want = []
    for r in train.select("features", M.LABEL).collect():
        x, shares = r["features"].toArray(), []
        for t in model.trees:
            node = 0
            while t.after[node, 0] != node:
                f = t.feature[node]
                node = t.after[node, int(x[f] > model.bins.thresholds[f][t.bin[node]])]
            a, b = t.counts[node] * [WEIGHTS[0], WEIGHTS[1]]
            shares.append(b / (a + b))
        want.append((r[M.LABEL], int(np.mean(shares) > 0.5), round(float(np.mean(shares)), 12)))
    got = [(r["label"], r["pred"], round(r["score"], 12)) for r in M.scored(model, train).collect()]
    assert sorted(got) == sorted(want)


def test_leaves_that_predict_the_same_are_one(train):
    for t in M.forest(train, trees=TREES, depth=DEPTH).trees:
        todo, second = [0], t.counts[:, 1] * WEIGHTS[1] > t.counts[:, 0] * WEIGHTS[0]
        while todo:
            a, b = t.after[todo.pop()]
            if a != b:
                assert not (t.is_leaf()[a] and t.is_leaf()[b] and second[a] == second[b])
                todo += [a, b]


def test_the_same_rows_give_the_same_forest(train):
    one, other = (M.forest(x, trees=TREES, depth=DEPTH) for x in (train, train.drop("place").repartition(7).orderBy("weight")))
    for a, b in zip(one.trees, other.trees):
        assert all(np.array_equal(getattr(a, k), getattr(b, k)) for k in ("feature", "bin", "after", "counts", "gain"))


def test_no_bags_are_kept(spark, train):
    """Before, a row was kept with its 150 counts and all its features: several hundred bytes."""
    from aloft.session import scratch_path

    before = set(glob.glob(scratch_path(spark, "*").removeprefix("file:")))
    many = train.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(20)))).withColumn("place", F.xxhash64("place", "i")).drop("i")
    M.forest(many, trees=12, depth=3)
    new = set(glob.glob(scratch_path(spark, "*").removeprefix("file:"))) - before
    files = [f for d in new for f in glob.glob(f"{d}/*.parquet")]
    rows = many.count()
    kept = spark.read.parquet(*files)
    assert kept.columns == ["key", "label", "numbers"] and kept.count() == rows
    assert kept.agg(F.max(F.length("numbers"))).first()[0] <= 2 * WIDTH


def test_poisson_bags():
    keys = np.random.default_rng(3).integers(0, 1 << 62, 200_000).astype(np.uint64)
    n = [B.copies(B.words(keys, t, 42), t) for t in (0, 1, 4)]
    for x in n:
        assert np.mean(x) == pytest.approx(1, abs=0.01) and np.mean(x == 0) == pytest.approx(np.exp(-1), abs=0.005) and np.var(x) == pytest.approx(1, abs=0.02)
    assert abs(np.corrcoef(n)[np.triu_indices(3, 1)]).max() < 0.01


def test_subsets_are_even():
    got = B.subsets(2, np.arange(4000), 30, 42)
    assert got.shape == (4000, 6) and (np.diff(got, axis=1) > 0).all()
    assert abs(np.bincount(got.ravel(), minlength=30) / 4000 - 0.2).max() < 0.04


def test_what_is_no_training_table(spark, train):
    for bad in (train.where("false"), train.withColumn(M.LABEL, F.col(M.LABEL) + 1), train.withColumn("weight", F.rand(1))):
        with pytest.raises(ValueError, match="a forest needs"):
            M.forest(bad, trees=1)
    alone = M.forest(train.where(F.col(M.LABEL) == 0), trees=2, depth=2)
    assert M.scored(alone, train).where("score <> 0 or pred <> 0").count() == 0 and not alone.featureImportances.toArray().any()
