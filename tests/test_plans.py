"""Physical-plan checks: pruning, pushdown, broadcast discipline."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from aloft.operators import ml as M
from aloft.operators import summaries as S
from aloft.plans import pipeline as P
from aloft.plans import queries as Q
from aloft.sources import warehouse as W

SF = "/root/testdata/sf0.001"


def _plan(df, mode="formatted"):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(S.delay_cause_summary(Q.coerced(spark, SF)))
    line = [ln for ln in plan.splitlines() if "ReadSchema" in ln and "l_orderkey" in ln][0]
    assert "l_extendedprice" not in line and "l_returnflag" not in line


def test_fact_table_never_broadcast(spark):
    plan = _plan(Q.raw(spark, SF))
    # lineitem is joined by a shuffle; only the dimension sides and one-row aggregates are broadcast
    assert "SortMergeJoin" in plan
    for block in plan.split("BroadcastExchange")[1:]:
        assert "lineitem" not in block.split("\n\n")[0]


def test_partition_pruning_on_served_flights(spark):
    path = P.new_scratch(spark, "prune-test")
    W.save_table(W.load_flights(Q.enriched(spark, SF)), path, partition_by=P.FLIGHT_PARTITIONS,
                 sort_by=P.FLIGHT_CLUSTER, tiebreak=("flight_id",))
    df = W.read_table(spark, path, W.FLIGHTS).where((F.col("year") == 1998) & (F.col("month") == 7)
                                                    & (F.col("origin") == "A07"))
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(year" in plan and "(month" in plan
    assert "PushedFilters" in plan and "origin" in plan
    total = W.read_table(spark, path, W.FLIGHTS)
    assert df.count() == total.where("year = 1998 and month = 7 and origin = 'A07'").count()


def test_single_partition_exchanges_only_over_partition_counts(spark):
    plan = _plan(Q.QUERIES["surrogate_key"](spark, SF), "simple").splitlines()
    for i, line in enumerate(plan):
        if "Exchange SinglePartition" in line:
            below = "\n".join(plan[i + 1:i + 4])
            assert "HashAggregate(keys=[__pid" in below, below


def test_staged_queries_read_the_input_once(spark):
    """Behind the staging step no query goes back to the source tables."""
    for name in ("engineer_features", "airport_fragility", "monthly_summary", "pk_violations", "one_hot"):
        assert "lineitem.parquet" not in _plan(Q.QUERIES[name](spark, SF), "simple")


def test_split_sorts_only_the_edge(spark):
    plan = _plan(M.stratified_split(M.ml_frame(Q.enriched(spark, SF), M.KEYS)), "simple")
    assert "rangepartitioning" not in plan
