"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is rebuilt from scratch for every run (so no shuffle output of a
previous run is reused) and written to the ``noop`` sink, which executes the
whole plan without moving rows to Python.  One warm-up, then the median of
three runs.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import StorageLevel  # noqa: E402

from aloft.operators import summaries as S  # noqa: E402
from aloft.plans import queries as Q  # noqa: E402
from aloft.plans.queries import QUERIES  # noqa: E402
from aloft.session import get_session  # noqa: E402

HEADLINE = [
    "clean_flights",
    "engineer_features",
    "airport_fragility",
    "route_reliability",
    "carrier_summary",
    "monthly_summary",
    "delay_cause_summary",
    "five_summaries_persisted",
    "five_summaries_grouping_sets",
    "view_top_disrupted_airports",
    "load_flights_cleaned",
    "binary_metrics",
    "train_logistic",
    "train_forest",
]
# long single-shot jobs: one run, no warm-up
SINGLE_RUN = {"train_logistic", "train_forest"}


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def five_summaries_persisted(spark, sf: str) -> None:
    """Airport/route/carrier/month/weekday aggregates over one persisted enriched frame."""
    enriched = Q.all_grains(spark, sf).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for build in (S.airport_summary, S.route_summary, S.carrier_summary, S.monthly_summary,
                      S.dow_trend):
            _noop(build(enriched))
    finally:
        enriched.unpersist()


def five_summaries_grouping_sets(spark, sf: str) -> None:
    """The same five aggregates from one scan with GROUPING SETS."""
    _noop(S.all_summaries_grouping_sets(Q.all_grains(spark, sf)))


JOBS = {"five_summaries_persisted": five_summaries_persisted,
        "five_summaries_grouping_sets": five_summaries_grouping_sets}


def run_once(spark, name: str, sf: str) -> float:
    t = time.perf_counter()
    if name in JOBS:
        JOBS[name](spark, sf)
    else:
        _noop(QUERIES[name](spark, sf))
    return time.perf_counter() - t


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [a for a in sys.argv[1:] if a in QUERIES or a in JOBS]
    names = only or [n for n in HEADLINE if n in QUERIES or n in JOBS]
    extra = {"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")}
    extra.update(json.loads(os.environ.get("BENCH_EXTRA_CONF", "{}")))
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2, extra=extra)
    out = {}
    for name in names:
        if name in SINGLE_RUN:
            times = [run_once(spark, name, sf)]
        else:
            run_once(spark, name, sf)  # warm-up
            times = [run_once(spark, name, sf) for _ in range(runs)]
        out[name] = round(statistics.median(times), 3)
        print(f"# {name}: {out[name]}s {[round(x, 2) for x in times]}", file=sys.stderr)
    total = round(sum(out.values()), 3)
    sf_label = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_median_sec", "value": total, "unit": "sec",
                      "queries": out, "sf": sf_label, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
