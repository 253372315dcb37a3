"""End-to-end batch job: CSV folder -> cleaned/enriched flights -> summaries and models ->
eight CSV exports -> six typed tables -> seven views.

Text parsing is the expensive part at scale, and the cleaning stage needs two
passes (exact medians must be known before any value is filled).  So the
coerced frame is staged once as Parquet in the shared checkpoint folder:
the CSV text is parsed exactly once, the median pass reads six columns of the
staged copy, and the flights table, the combined aggregate behind the summaries
and the models are computed from it.  The staged table also cuts the lineage: a
lost executor only costs the recomputation of its own tasks from Parquet.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aloft.functions import fixed
from aloft.operators import clean as C
from aloft.operators import features as FE
from aloft.operators import ml as M
from aloft.operators import summaries as S
from aloft.operators.ordered import written
from aloft.plans import views as V
from aloft.session import scratch_path
from aloft.sources import csv_folder as CF
from aloft.sources import warehouse as W

FLIGHT_PARTITIONS = ("year", "month")
FLIGHT_CLUSTER = ("origin", "dest", "op_unique_carrier", "fl_date")
#: the seven access paths of the served flights: year and month are folders; the label leads inside them, and the
#: curve confines the other columns; the zone map also knows the routes
FLIGHT_ZONES = ("origin", "dest", "route", "op_unique_carrier", "year", "month", "disrupted", "fl_date")
FLIGHT_LAYOUT = {"partition_by": FLIGHT_PARTITIONS, "sort_by": ("disrupted",), "cluster_by": FLIGHT_CLUSTER,
                 "tiebreak": ("flight_id",), "zones": FLIGHT_ZONES, "bloom": ("route", "op_unique_carrier")}
#: reporting views: name, view, the table it reads
VIEWS = (
    ("top_disrupted_airports", V.top_disrupted_airports, W.AIRPORT),
    ("unstable_routes", V.unstable_routes, W.ROUTE),
    ("carrier_disruption", V.carrier_disruption, W.CARRIER),
    ("monthly_trend", V.monthly_trend, W.MONTHLY),
    ("root_causes", V.root_causes, W.CAUSE),
    ("top_cancel_airports", V.top_cancel_airports, W.AIRPORT),
    ("top_arrival_delay", V.top_arrival_delay, W.AIRPORT),
)


@dataclass
class LoadResult:
    table: str
    rows: int
    status: str
    error: str


def new_scratch(spark: SparkSession, prefix: str) -> str:
    return scratch_path(spark, f"{prefix}-{uuid.uuid4().hex[:12]}")


def enrich_staged(raw: DataFrame) -> DataFrame:
    """Cleaning + features with the coerced frame staged once (one parse of the input)."""
    coerced = written(C.coerce_raw(raw), "coerced")
    # medians: one job over six staged columns, then literals (no repeat per table)
    return FE.engineer_features(C.finish_cleaning(coerced))


def summaries(enriched: DataFrame) -> dict[str, DataFrame]:
    """The five exported summaries by table name, from one scan for the four grouped ones."""
    grouped = written(S.all_summaries_grouping_sets(enriched), "summaries")  # one row a key
    return {
        W.AIRPORT.name: S.fragility_of(S.airport_summary_of(grouped)),
        W.ROUTE.name: S.reliability_of(S.route_summary_of(grouped)),
        W.CARRIER.name: S.carrier_summary_of(grouped),
        W.MONTHLY.name: S.monthly_summary_of(grouped),
        W.CAUSE.name: S.delay_cause_summary(enriched),
    }


def _message(exc: Exception) -> str:
    return ((str(exc) or type(exc).__name__).splitlines() or [""])[0][:500]


def _load_flights(spark: SparkSession, exported: DataFrame, out_dir: str, staged: bool = False) -> LoadResult:
    path = f"{out_dir}/{W.FLIGHTS.name}"
    # the layout reads the flights more than once
    flights = written(W.load_flights(exported, staged=staged), "flights")
    rows = W.save_table(flights, path, contract=W.FLIGHTS, **FLIGHT_LAYOUT)
    return LoadResult(W.FLIGHTS.name, rows, "loaded",
                      _missing(W.missing_columns(exported, W.FLIGHTS)))


def _load_summary(spark: SparkSession, exported: DataFrame, contract: W.Contract, out_dir: str) -> LoadResult:
    path = f"{out_dir}/{contract.name}"
    rows = W.save_table(W.load_summary(exported, contract), path, contract=contract)
    return LoadResult(contract.name, rows, "loaded",
                      _missing(W.missing_columns(exported, contract)))


def _missing(columns: list[str]) -> str:
    return f"missing columns: {', '.join(columns)}" if columns else ""


def load_tables(spark: SparkSession, enriched: DataFrame, out_dir: str) -> list[LoadResult]:
    """Write the six served tables under ``out_dir`` straight from the enriched frame.

    The flights table is written first; a failure there is fatal (raised).  Each summary is
    loaded on its own: one failing summary is reported and the others still load.
    """
    results = [_load_flights(spark, enriched, out_dir, staged=True)]
    frames = summaries(enriched)
    for contract in W.SUMMARY_CONTRACTS:
        try:
            results.append(_load_summary(spark, frames[contract.name], contract, out_dir))
        except Exception as exc:  # per-table isolation, as a per-table transaction would give
            results.append(LoadResult(contract.name, 0, "failed", _message(exc)))
    return results


def export_csv(enriched: DataFrame, csv_dir: str, models: bool = True, trees: int = fixed.RF_TREES) -> dict[str, DataFrame]:
    """Write the eight exports (six without ``models``) as CSV folders; returns the model reports."""
    W.write_csv(W.export_rename(enriched), f"{csv_dir}/{W.FLIGHTS.name}")
    for name, frame in summaries(enriched).items():
        W.write_csv(W.export_rename(frame), f"{csv_dir}/{name}")
    if not models:
        return {}
    comparison, importance, reports = train_models(enriched, trees)
    W.write_csv(comparison, f"{csv_dir}/model_comparison")
    W.write_csv(importance, f"{csv_dir}/rf_feature_importance")
    return reports


def train_models(enriched: DataFrame, trees: int = fixed.RF_TREES) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """(model comparison, forest importances, classification report of each model)."""
    spark = enriched.sparkSession
    prep = M.prepare(M.stratified_split(M.ml_frame(enriched, M.KEYS)))
    train = written(prep.train, "train")
    out, reports, importance = [], {}, None
    for name, fit in (("Logistic Regression", M.logistic), ("Random Forest", lambda t: M.forest(t, trees=trees))):
        model = fit(train)
        counted = M.score_counts(M.scored(model, prep.test))
        out.append(M.binary_metrics(counted, name))
        reports[name] = M.classification_report(counted)
        if name == "Random Forest":
            importance = M.importances(spark, model, prep.names)
    return out[0].unionByName(out[1]), importance, reports


def load_csv(spark: SparkSession, csv_dir: str, out_dir: str) -> list[LoadResult]:
    """Load the exported CSV folders into the typed tables.

    Missing flights are an error; a missing summary is skipped and reported, a failing one is
    reported, and the others still load.  Columns an export does not have are reported.
    """
    try:
        flights = CF.read_csv_folder(spark, f"{csv_dir}/{W.FLIGHTS.name}")
    except CF.NoCsvFilesError as exc:
        raise CF.NoCsvFilesError(f"no exported flights in {csv_dir}") from exc
    results = [_load_flights(spark, flights, out_dir)]
    for contract in W.SUMMARY_CONTRACTS:
        try:
            exported = CF.read_csv_folder(spark, f"{csv_dir}/{contract.name}")
            results.append(_load_summary(spark, exported, contract, out_dir))
        except CF.NoCsvFilesError:
            results.append(LoadResult(contract.name, 0, "skipped", "no exported file"))
        except Exception as exc:  # per-table isolation, as a per-table transaction would give
            results.append(LoadResult(contract.name, 0, "failed", _message(exc)))
    return results


def register_views(spark: SparkSession, out_dir: str, loaded: Collection[str] | None = None) -> list[str]:
    """Temporary views of the saved tables (all, or those in ``loaded``) and of the reporting views whose own
    table is among them; returns the names of the reporting views."""
    contracts = [c for c in (W.FLIGHTS, *W.SUMMARY_CONTRACTS) if loaded is None or c.name in loaded]
    for contract in contracts:
        W.read_table(spark, f"{out_dir}/{contract.name}", contract).createOrReplaceTempView(contract.name)
    names = []
    for name, view, contract in VIEWS:
        if contract in contracts:
            view(spark.table(contract.name)).createOrReplaceTempView(name)
            names.append(name)
    return names


def status_frame(spark: SparkSession, results: list[LoadResult]) -> DataFrame:
    return spark.createDataFrame([(r.table, r.rows, r.status, r.error) for r in results],
                                 "table_name string, rows bigint, status string, error string")


def run(spark: SparkSession, csv_folders, out_dir: str, models: bool = True, trees: int = fixed.RF_TREES) -> DataFrame:
    """The whole batch job from a folder of monthly CSV files: exports under ``out_dir``/csv, tables
    under ``out_dir``, views in the session's catalog."""
    enriched = enrich_staged(CF.read_csv_folder(spark, csv_folders))
    export_csv(enriched, f"{out_dir}/csv", models, trees)
    results = load_csv(spark, f"{out_dir}/csv", out_dir)
    register_views(spark, out_dir, {r.table for r in results if r.status == "loaded"})
    return status_frame(spark, results)


def stage_counts(raw: DataFrame) -> DataFrame:
    """Rows at each stage, as one small union of counts (the input is parsed once)."""
    coerced = written(C.coerce_raw(raw), "coerced")
    cleaned = C.drop_missing_keys(coerced)
    enriched = FE.engineer_features(C.finish_cleaning(coerced))
    grouped = written(S.all_summaries_grouping_sets(enriched).groupBy("grain").agg(
        F.count(F.lit(1)).alias("row_count")), "grain-counts")

    def count(df: DataFrame, stage: str, order: int) -> DataFrame:
        return df.agg(F.lit(order).alias("step"), F.lit(stage).alias("stage"), F.count(F.lit(1)).alias("row_count"))

    def groups(stage: str, order: int, *keys: str) -> DataFrame:
        own = grouped.where(F.col("grain") == S.grain_id(keys))
        return own.agg(F.lit(order).alias("step"), F.lit(stage).alias("stage"),
                       F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"))

    out = count(coerced, "raw", 1)
    for part in (count(cleaned, "cleaned", 2), groups("airports", 3, "ORIGIN"), groups("routes", 4, "route"),
                 groups("carriers", 5, "OP_UNIQUE_CARRIER"), groups("months", 6, "YEAR", "MONTH")):
        out = out.unionByName(part)
    return out
