"""End-to-end batch job from a folder of CSV files (the production entry point)."""

import pytest
from pyspark.sql import functions as F

from aloft.plans import pipeline as P
from aloft.plans import queries as Q
from aloft.session import delete_path
from aloft.sources import csv_folder as CF
from aloft.sources import tables
from aloft.sources import warehouse as W

SF = "/root/testdata/sf0.001"
SUMMARIES = {"airport_summary", "route_summary", "carrier_summary", "monthly_summary", "delay_cause_summary"}


@pytest.fixture(scope="module")
def job(spark):
    raw = Q.raw(spark, SF)
    src = P.new_scratch(spark, "pipeline-src")
    y = F.col("YEAR").cast("int")
    CF.write_csv_folder(raw.where(y <= 1998), f"{src}/a")
    CF.write_csv_folder(raw.where(y > 1998).select(*reversed(raw.columns)), f"{src}/b")
    out = P.new_scratch(spark, "pipeline-out")
    status = {r.table_name: r for r in P.run(spark, [f"{src}/a", f"{src}/b"], out, trees=5).collect()}
    return out, status


def test_run_from_csv_folder(spark, job):
    out, status = job
    assert set(status) == {"flights_cleaned"} | SUMMARIES
    assert all(r.status == "loaded" and r.error == "" for r in status.values())
    assert status["flights_cleaned"].rows == Q.cleaned(spark, SF).count()


@pytest.mark.parametrize("name", [n for n, _, _ in P.VIEWS])
def test_saved_views_equal_the_queries(spark, job, name):
    assert sorted(map(tuple, spark.table(name).collect()), key=repr) == \
        sorted(map(tuple, Q.QUERIES[f"view_{name}"](spark, SF).collect()), key=repr)


def test_eight_exports(spark, job):
    out, _ = job
    comparison = spark.read.option("header", True).csv(f"{out}/csv/model_comparison")
    assert comparison.columns == ["model", "accuracy", "precision", "recall", "f1", "roc_auc"]
    assert sorted(r.model for r in comparison.collect()) == ["Logistic Regression", "Random Forest"]
    assert spark.read.option("header", True).csv(f"{out}/csv/rf_feature_importance").count() == 20
    for name in {"flights_cleaned"} | SUMMARIES:
        assert CF.list_csv_files(spark, f"{out}/csv/{name}")


def test_load_skips_missing_reports_failing_and_needs_flights(spark, job):
    out, _ = job
    csv, new = P.new_scratch(spark, "csv"), P.new_scratch(spark, "tables")
    with pytest.raises(CF.NoCsvFilesError):
        P.load_csv(spark, csv, new)
    for name in ("flights_cleaned", "airport_summary", "monthly_summary", "delay_cause_summary"):
        df = spark.read.option("header", True).csv(f"{out}/csv/{name}")
        if name == "monthly_summary":
            df = df.drop("cancellations")
        if name == "delay_cause_summary":
            df = df.withColumn("cause", F.rpad("cause", 40, "x"))
        W.write_csv(df, f"{csv}/{name}")
    got = {r.table: r for r in P.load_csv(spark, csv, new)}
    assert got["flights_cleaned"].status == got["airport_summary"].status == "loaded"
    assert (got["monthly_summary"].status, got["monthly_summary"].error) == ("loaded", "missing columns: cancellations")
    assert (got["route_summary"].status, got["carrier_summary"].status) == ("skipped", "skipped")
    assert got["delay_cause_summary"].status == "failed" and got["delay_cause_summary"].error
    assert W.read_table(spark, f"{new}/monthly_summary", W.MONTHLY).where("cancellations is not null").count() == 0


def test_one_failing_summary_leaves_the_others(spark, monkeypatch):
    def broken(summary, contract):
        if contract is W.ROUTE:
            raise RuntimeError
        return build(summary, contract)

    build = W.load_summary
    monkeypatch.setattr(W, "load_summary", broken)
    got = {r.table: r for r in P.load_tables(spark, Q.enriched(spark, SF), P.new_scratch(spark, "tables"))}
    assert (got["route_summary"].status, got["route_summary"].error) == ("failed", "RuntimeError")
    assert all(got[t].status == "loaded" for t in ({"flights_cleaned"} | SUMMARIES) - {"route_summary"})


def test_failed_write_leaves_the_old_table(spark):
    path = P.new_scratch(spark, "safe")
    W.save_table(spark.range(5), path)
    bad = spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("id"))
    with pytest.raises(Exception, match="no"):
        W.save_table(bad, path)
    assert tables.read(spark, path).count() == 5
    W.save_table(spark.range(7), path)
    assert tables.read(spark, path).count() == 7
    delete_path(spark, path)
