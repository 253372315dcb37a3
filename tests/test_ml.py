"""Numeric behaviour of the ML operators off the fixture's range, and invariants of trained models."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import Observation
from pyspark.sql import functions as F

from aloft.operators import clean as C
from aloft.operators import ml as M
from aloft.operators import newton
from aloft.operators import summaries as S
from aloft.plans import queries as Q

SF = "/root/testdata/sf0.001"


def test_auc_of_billions_of_rows(spark):
    n = 4_000_000_000
    counts = spark.createDataFrame([(1, 1, 0.9, n), (0, 0, 0.1, n), (1, 0, 0.5, n), (0, 0, 0.5, n)],
                                   "label int, pred int, score double, n bigint")
    r = M.binary_metrics(counts).first()
    assert r["roc_auc"] == 0.875 and r["accuracy"] == 0.75


@pytest.mark.parametrize("values, sd", [([0.1] * 7, 1.0), ([1e8, 1e8 + 1, 1e8 + 2], float(np.std([0, 1, 2]))),
                                        ([None, None], 1.0), ([0.5, 2.25, 3.0], float(np.std([0.5, 2.25, 3.0])))])
def test_scaling_is_the_population_std(spark, values, sd):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert M.scale_stats(df, ["x"]).first()["__sd_x"] == pytest.approx(sd, rel=1e-12)


def test_null_keys_form_no_group(spark):
    rows = [("A", "A-B", "C1", y, 1, d, 5.0, 1.0, 10.0, 0, 0, 1) for y, d in ((2000, 1), (None, 2), (2000, None))]
    df = spark.createDataFrame(rows, "ORIGIN string, route string, OP_UNIQUE_CARRIER string, YEAR int, MONTH int, "
                               "DAY_OF_WEEK int, DEP_DELAY double, ARR_DELAY double, DISTANCE double, CANCELLED int, "
                               "DIVERTED int, disrupted int")
    allg = S.all_summaries_grouping_sets(df)
    assert allg.count() == 6
    for one, other in ((S.monthly_summary_of(allg), S.monthly_summary(df)),
                       (S.airport_summary_of(allg), S.airport_summary(df)),
                       (S.route_summary_of(allg), S.route_summary(df)),
                       (S.carrier_summary_of(allg), S.carrier_summary(df))):
        assert sorted(map(tuple, one.select(*other.columns).collect())) == sorted(map(tuple, other.collect()))


def test_medians(spark):
    df = spark.createDataFrame([(1.0, None, 0.1), (2.0, None, 0.1), (10.0, None, 7.75), (20.0, None, None), (None, None, None)],
                               "a double, b double, c double")
    assert tuple(C.column_medians(df, ["a", "b", "c"]).first()) == (6.0, None, 0.1)
    filled = C.median_fill(df, ["a", "b", "c"]).collect()
    assert [r["a"] for r in filled].count(6.0) == 1 and all(r["b"] is None for r in filled)
    many = spark.range(1, 10_002).select((F.col("id") / 8).alias("a"))
    assert C.column_medians(many, ["a"]).first()["a"] == 5001 / 8


@pytest.fixture(scope="module")
def prepared(spark):
    return Q._prepared(spark, SF)


def test_logistic_regression_converges(prepared):
    model = M.logistic(prepared.train)
    rows = prepared.train.collect()
    x = np.array([r["features"].toArray() for r in rows])
    y = np.array([r[M.LABEL] for r in rows], dtype=float)
    w = np.array([r["weight"] for r in rows])
    coef, b = model.coefficients, model.intercept
    p = 1 / (1 + np.exp(-(x @ coef + b)))
    # gradient of mean weighted log loss + L2 / 2
    g = np.append(x.T @ (w * (p - y)) / w.sum() + coef / w.sum(), (w * (p - y)).sum() / w.sum())
    assert np.linalg.norm(g) <= 1e-9 and model.gradient_norm == pytest.approx(np.linalg.norm(g), abs=1e-10)
    assert model.passes < 20


def test_gradient_of_the_fit_in_duckdb(spark, prepared):
    """The emitted coefficients, put into a statement that knows nothing of the fit."""
    model = M.logistic(prepared.train)
    rows = prepared.train.collect()
    con = duckdb.connect()
    x = pa.table({"r": range(len(rows)), "x": [[*r["features"].toArray().tolist(), 1.0] for r in rows],
                  "y": [float(r[M.LABEL]) for r in rows], "w": [r["weight"] for r in rows]})
    c = pa.table({"i": range(len(model.coefficients) + 1), "c": [*model.coefficients, model.intercept],
                  "ridge": [1.0] * len(model.coefficients) + [0.0]})
    con.register("x", x)
    con.register("c", c)
    worst, total = con.execute("""
        WITH e AS (SELECT r, y, w, unnest(x) AS v, unnest(range(len(x))) AS i FROM x),
        p AS (SELECT r, 1 / (1 + exp(-sum(v * c.c))) AS p FROM e JOIN c USING (i) GROUP BY r),
        g AS (SELECT i, sum(w * (p - y) * v) + any_value(c.c * c.ridge) AS g FROM e JOIN p USING (r) JOIN c USING (i) GROUP BY i)
        SELECT max(abs(g)) / (SELECT sum(w) FROM x), count(*) FROM g""").fetchone()
    assert total == len(model.coefficients) + 1 and worst < 1e-6
    found = M.logistic_gradient(prepared, model).collect()
    assert len(found) == total and all(r["gradient"] == 0 for r in found)


@pytest.mark.parametrize("dense", [False, True])
def test_newton_on_hard_rows(spark, dense):
    make = (lambda v: Vectors.dense(v)) if dense else (lambda v: Vectors.sparse(len(v), [(i, x) for i, x in enumerate(v) if x]))
    r = np.random.default_rng(1)
    rows = [(make([float(a), float(b), 0.0]), int(a > 0), 1.0 + abs(float(b))) for a, b in r.normal(size=(200, 2)) * [40, 1]]
    train = spark.createDataFrame(rows, ["features", M.LABEL, "weight"])  # separable, with a column of zeros
    model = newton.fit(train, M.LABEL, "weight")
    assert model.gradient_norm < 1e-9 and model.coefficients[2] == 0 and model.coefficients[0] > 0
    got = M.scored(model, train)
    assert got.where("label <> pred").count() <= 1 and got.where("score < 0 or score > 1 or score is null").count() == 0
    assert newton.fit(train.where("false"), M.LABEL, "weight").passes == 0


def test_forest_does_not_follow_the_partitions(spark, prepared):
    one = M.forest(prepared.train, trees=5)
    other = M.forest(prepared.train.repartition(5), trees=5)
    assert np.allclose(one.featureImportances.toArray(), other.featureImportances.toArray(), atol=1e-12)
    imp = [tuple(r) for r in M.importances(spark, one, prepared.names, top=len(prepared.names)).collect()]
    assert sum(x for _, x in imp) == pytest.approx(1.0) and imp == sorted(imp, key=lambda t: (-t[1], t[0]))
    assert imp[:20] == [tuple(r) for r in M.importances(spark, one, prepared.names).collect()]


def test_forest_scores_in_a_session_that_has_observed(spark, prepared):
    """The model goes to the tasks: nothing of the session may hang on it."""
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    model = M.forest(prepared.train, trees=2, depth=2)
    assert not model.hasSummary and M.scored(model, prepared.test).agg(F.count("score").alias("n")).first()["n"] == prepared.test.count()


def test_models_give_probabilities_and_importances(spark, prepared):
    n = prepared.test.count()
    for model in (M.logistic(prepared.train), M.forest(prepared.train, trees=5)):
        scored = M.scored(model, prepared.test)
        r = scored.agg(F.min("score"), F.max("score"), F.count("score")).first()
        assert 0 <= r[0] <= r[1] <= 1 and r[2] == n
        m = M.binary_metrics(scored, "m").first()
        assert m["model"] == "m" and 0.5 < m["roc_auc"] <= 1 and 0 <= m["precision"] <= 1
        report = {x["label"]: x for x in M.classification_report(scored).collect()}
        assert report["accuracy"]["support"] == n and round(report["accuracy"]["f1_score"], 4) == m["accuracy"]
    imp = M.importances(spark, model, prepared.names, top=len(prepared.names)).collect()
    assert sum(r["importance"] for r in imp) == pytest.approx(1.0)
