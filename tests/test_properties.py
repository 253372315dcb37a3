"""Invariants of the summaries and the ML data work on the smallest fixture."""

import pytest
from pyspark.sql import functions as F

from aloft.operators import ml as M
from aloft.operators import summaries as S
from aloft.plans import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def enriched(spark):
    return Q.enriched(spark, SF).persist()


def test_totals_agree_across_grains(enriched):
    n = enriched.count()
    for build in (S.airport_summary, S.route_summary, S.carrier_summary, S.monthly_summary):
        df = build(enriched)
        assert df.agg(F.sum("total_flights")).first()[0] == n
        assert df.where(F.col("disrupted_flights") > F.col("total_flights")).count() == 0


def test_scores_in_range(enriched):
    afi = S.airport_fragility(enriched)
    assert afi.where((F.col("AFI") < 0) | (F.col("AFI") > 1)).count() == 0
    for c in ("norm_disruption", "norm_delay", "norm_cancel", "norm_divert"):
        mn, mx = afi.agg(F.min(c), F.max(c)).first()
        assert (mn, mx) in ((0.0, 1.0), (0.0, 0.0))
    rrs = S.route_reliability(enriched)
    assert rrs.where((F.col("RRS") < 0) | (F.col("RRS") > 100)).count() == 0


def test_cause_shares_sum_to_100(enriched):
    total = S.delay_cause_summary(enriched).agg(F.sum("pct_of_total")).first()[0]
    assert abs(total - 100.0) <= 0.05


def test_split_is_exact_and_disjoint(enriched):
    frame = M.ml_frame(enriched, M.KEYS)
    split = M.stratified_split(frame)
    assert split.count() == frame.count()
    per = {(r[M.LABEL], r.split): r["count"] for r in split.groupBy(M.LABEL, "split").count().collect()}
    for label in (0, 1):
        n_c = per.get((label, "train"), 0) + per.get((label, "test"), 0)
        assert abs(per.get((label, "test"), 0) - 0.2 * n_c) <= 1
    assert split.select(*M.KEYS, M.LABEL).distinct().count() == frame.select(*M.KEYS, M.LABEL).distinct().count()


def test_one_hot_at_most_one_active_per_column(enriched):
    split = M.stratified_split(M.ml_frame(enriched, M.KEYS))
    idx = M.fit_indexers(split.where(F.col("split") == "train"))
    long = M.one_hot_long(split, idx, list(M.KEYS))
    per = long.withColumn("col", F.regexp_extract("feature", r"^(OP_UNIQUE_CARRIER|ORIGIN|DEST|time_block)_", 1))
    assert per.groupBy(*M.KEYS, "col").count().where("count > 1").count() <= \
        split.groupBy(*M.KEYS).count().where("count > 1").count() * 4


def test_auc_invariant_under_monotone_transform(spark):
    rows = [(i % 2, float(i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "label int, score double")
    a = M.exact_auc(df).first()[0]
    b = M.exact_auc(df.withColumn("score", F.col("score") * 3 + 1)).first()[0]
    assert a == b
