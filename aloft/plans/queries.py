"""Registry of runnable queries: name -> (spark, sf_dir) -> DataFrame.

Every query starts from the driver's tables in ``sf_dir`` (through the
flight-shaped view) and runs over all of their rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aloft.functions import fixed
from aloft.operators import clean as C
from aloft.operators import features as FE
from aloft.operators import ml as M
from aloft.operators import summaries as S
from aloft.operators.ordered import written
from aloft.plans import pipeline as P
from aloft.plans import views as V
from aloft.sources import csv_folder as CF
from aloft.sources import layout, tables
from aloft.sources import warehouse as W
from aloft.sources.flightview import closed_form_score, flight_view

Query = Callable[[SparkSession, str], DataFrame]

ID = "OP_CARRIER_FL_NUM"


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return flight_view(spark, sf)


def tokened(spark: SparkSession, sf: str) -> DataFrame:
    return C.replace_null_tokens(raw(spark, sf))


def coerced(spark: SparkSession, sf: str) -> DataFrame:
    return C.coerce_raw(raw(spark, sf))


def staged(spark: SparkSession, sf: str, columns: Sequence[str] = fixed.RAW_COLUMNS) -> DataFrame:
    """The coerced frame (the columns asked for), parsed and joined once."""
    return written(coerced(spark, sf).select(*columns), "coerced")


def cleaned(spark: SparkSession, sf: str, columns: Sequence[str] = fixed.RAW_COLUMNS) -> DataFrame:
    return C.finish_cleaning(staged(spark, sf, columns))


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    return FE.engineer_features(cleaned(spark, sf))


#: what the disruption label and the key filter need
LABEL_COLUMNS = (*fixed.KEY_COLUMNS, "DEP_DELAY", "ARR_DELAY", "CANCELLED", "DIVERTED")


def labelled(spark: SparkSession, sf: str, *columns: str, features: Sequence[str] = ()) -> DataFrame:
    """The label with the raw columns and features that a query reads, and nothing else."""
    frame = cleaned(spark, sf, (*LABEL_COLUMNS, *columns))
    return FE.engineer_features(frame, ("disrupted", *features))


#: the raw columns behind the whole-number columns of the flights table, and the features among these
SMALLINT_RAW = tuple(c for c in fixed.RAW_COLUMNS
                     if c.lower() in W.FLIGHT_SMALLINT or c in (ID, "FL_DATE", *LABEL_COLUMNS))
SMALLINT_FEATURES = ("disrupted", "is_weekend", "dep_hour", "arr_hour")


def whole_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """The whole-number columns of the flights, re-typed; nothing else is staged or filled."""
    frame = FE.engineer_features(cleaned(spark, sf, SMALLINT_RAW), SMALLINT_FEATURES)
    return W.prepare_flights(frame).select("flight_num", *W.FLIGHT_SMALLINT)


def causes(spark: SparkSession, sf: str) -> DataFrame:
    """Delay causes of the kept flights: no column of it needs a median, so nothing is staged."""
    frame = coerced(spark, sf).select(*fixed.KEY_COLUMNS, *fixed.CAUSE_COLUMNS)
    return C.drop_missing_keys(C.fill_causes_zero(frame))


def routes(spark: SparkSession, sf: str) -> DataFrame:
    return labelled(spark, sf, "DISTANCE", features=("route",))


def months(spark: SparkSession, sf: str) -> DataFrame:
    return labelled(spark, sf, "YEAR", "MONTH")


def all_grains(spark: SparkSession, sf: str) -> DataFrame:
    return labelled(spark, sf, "DISTANCE", "YEAR", "MONTH", "DAY_OF_WEEK", features=("route",))


def ml_input(spark: SparkSession, sf: str, keys: Sequence[str] = ()) -> DataFrame:
    raw_features = [c for c in fixed.ML_FEATURES if c in fixed.RAW_COLUMNS and c not in LABEL_COLUMNS]
    frame = labelled(spark, sf, *raw_features, *keys, features=("is_weekend", "dep_hour", "time_block"))
    return M.ml_frame(frame, keys)


def _registry() -> dict[str, Query]:
    q: dict[str, Query] = {}

    # --- cleaning -----------------------------------------------------------------
    q["null_tokens"] = tokened
    q["coerce_numeric"] = coerced
    q["fill_causes_zero"] = lambda s, sf: C.fill_causes_zero(coerced(s, sf)).select(ID, *fixed.CAUSE_COLUMNS)
    q["column_medians"] = lambda s, sf: C.column_medians(staged(s, sf))
    q["median_fill"] = lambda s, sf: C.median_fill(staged(s, sf)).select(ID, *fixed.MEDIAN_COLUMNS)
    q["fill_flags"] = lambda s, sf: C.fill_flags(coerced(s, sf)).select(ID, *fixed.FLAG_COLUMNS)
    q["drop_missing_keys"] = lambda s, sf: C.drop_missing_keys(tokened(s, sf)).select(ID, *fixed.KEY_COLUMNS)
    q["clean_flights"] = cleaned

    # --- features -----------------------------------------------------------------
    q["disrupted_flag"] = lambda s, sf: enriched(s, sf).select(
        ID, "DEP_DELAY", "ARR_DELAY", "CANCELLED", "DIVERTED", "disrupted")
    q["route_key"] = lambda s, sf: enriched(s, sf).select(ID, "ORIGIN", "DEST", "route")
    q["weekend_flag"] = lambda s, sf: enriched(s, sf).select(ID, "DAY_OF_WEEK", "is_weekend")
    q["hour_of_day"] = lambda s, sf: enriched(s, sf).select(
        ID, "CRS_DEP_TIME", "CRS_ARR_TIME", "dep_hour", "arr_hour")
    q["time_block"] = lambda s, sf: enriched(s, sf).select(ID, "dep_hour", "time_block")
    q["engineer_features"] = enriched

    # --- summaries ----------------------------------------------------------------
    q["airport_summary"] = lambda s, sf: S.airport_summary(labelled(s, sf))
    q["minmax_norm"] = lambda s, sf: S.minmax_norm(
        S.airport_summary(labelled(s, sf)), {"avg_arr_delay": "norm_arr_delay"}).select(
        "ORIGIN", "avg_arr_delay", "norm_arr_delay")
    q["airport_fragility"] = lambda s, sf: S.airport_fragility(labelled(s, sf))
    q["route_summary"] = lambda s, sf: S.route_summary(routes(s, sf))
    q["route_reliability"] = lambda s, sf: S.route_reliability(routes(s, sf))
    q["carrier_summary"] = lambda s, sf: S.carrier_summary(labelled(s, sf))
    q["monthly_summary"] = lambda s, sf: S.monthly_summary(months(s, sf))
    q["delay_cause_summary"] = lambda s, sf: S.delay_cause_summary(causes(s, sf))
    q["overall_rate"] = lambda s, sf: S.overall_rate(labelled(s, sf))
    q["month_trend"] = lambda s, sf: S.month_trend(S.monthly_summary(months(s, sf)))
    q["dow_trend"] = lambda s, sf: S.dow_trend(labelled(s, sf, "DAY_OF_WEEK"))

    # --- warehouse: export naming, contracts, typed loads -------------------------
    q["export_rename"] = lambda s, sf: W.export_rename(enriched(s, sf))
    q["contract_projection"] = lambda s, sf: W.contract_projection(
        W.export_rename(S.route_reliability(routes(s, sf))), W.ROUTE)[0]
    for name, build, contract in _SUMMARY_LOADS:
        q[f"load_{name}"] = (lambda b, c: lambda s, sf: W.load_summary(b(s, sf), c))(build, contract)
    q["typed_cast_flights"] = lambda s, sf: W.conform(
        W.prepare_flights(enriched(s, sf)), W.FLIGHTS, strict=False).drop("flight_id")
    q["coerce_smallint"] = whole_numbers
    q["parse_fl_date"] = lambda s, sf: W.prepare_flights(enriched(s, sf)).select("flight_num", "fl_date")
    q["iso_day_of_week"] = lambda s, sf: W.prepare_flights(enriched(s, sf)).select(
        "flight_num", "fl_date", "day_of_week")
    q["load_flights_cleaned"] = lambda s, sf: W.load_flights(enriched(s, sf), staged=True)
    q["surrogate_key"] = lambda s, sf: W.load_flights(enriched(s, sf), staged=True).select(
        "flight_id", "fl_date", "flight_num", "tail_num", "origin", "dest")
    q["pk_violations"] = _pk_violations

    # --- reporting views over the typed tables --------------------------------------
    q["view_top_disrupted_airports"] = lambda s, sf: V.top_disrupted_airports(_airport_table(s, sf))
    q["view_unstable_routes"] = lambda s, sf: V.unstable_routes(
        W.load_summary(S.route_reliability(routes(s, sf)), W.ROUTE))
    q["view_carrier_disruption"] = lambda s, sf: V.carrier_disruption(
        W.load_summary(S.carrier_summary(labelled(s, sf)), W.CARRIER))
    q["view_monthly_trend"] = lambda s, sf: V.monthly_trend(
        W.load_summary(S.monthly_summary(months(s, sf)), W.MONTHLY))
    q["view_root_causes"] = lambda s, sf: V.root_causes(
        W.load_summary(S.delay_cause_summary(causes(s, sf)), W.CAUSE))
    q["view_top_cancel_airports"] = lambda s, sf: V.top_cancel_airports(_airport_table(s, sf))
    q["view_top_arrival_delay"] = lambda s, sf: V.top_arrival_delay(_airport_table(s, sf))

    # --- chart tables ---------------------------------------------------------------
    q["chart_top_airports"] = lambda s, sf: (
        S.airport_fragility(labelled(s, sf)).select("ORIGIN", "disruption_rate", "AFI")
        .orderBy(F.col("AFI").desc_nulls_last(), F.col("ORIGIN")).limit(fixed.TOP_AIRPORTS_CHART))

    # --- sources and sinks: CSV folder with header drift, CSV round trip, layout -----
    q["scan_csv_folder"] = lambda s, sf: CF.read_csv_folder(s, _csv_drift_folders(s, sf))
    q["union_by_name"] = _union_by_name
    q["standardize_columns"] = lambda s, sf: C.standardize_columns(
        raw(s, sf).toDF(*[f"  {c.lower()} " for c in fixed.RAW_COLUMNS]))
    q["csv_roundtrip"] = _csv_roundtrip
    q["partitioned_scan"] = _partitioned_scan
    q["access_paths"] = _access_paths
    q["load_status"] = lambda s, sf: P.status_frame(
        s, P.load_tables(s, enriched(s, sf), P.new_scratch(s, "tables")))
    q["stage_counts"] = lambda s, sf: P.stage_counts(raw(s, sf))
    q["all_summaries_grouping_sets"] = lambda s, sf: S.all_summaries_grouping_sets(all_grains(s, sf))

    # --- machine learning -------------------------------------------------------------
    q["ml_frame"] = lambda s, sf: ml_input(s, sf)
    q["stratified_split"] = lambda s, sf: _split(s, sf).select(*M.KEYS, M.LABEL, "split")
    q["class_weights"] = lambda s, sf: M.class_weights(_split(s, sf).where(F.col("split") == "train"))
    q["standard_scale"] = _standard_scale
    q["one_hot"] = _one_hot
    q["feature_vectors"] = _feature_vectors
    q["binary_metrics"] = lambda s, sf: M.binary_metrics(closed_form_score(ml_input(s, sf)))
    q["classification_report"] = lambda s, sf: M.classification_report(
        closed_form_score(ml_input(s, sf)))
    q["train_logistic"] = lambda s, sf: _train(s, sf, "lr")
    q["logistic_gradient"] = _logistic_gradient
    q["train_forest"] = lambda s, sf: _train(s, sf, "rf")
    q["model_comparison"] = lambda s, sf: _train(s, sf, "both")
    q["rf_importance"] = _rf_importance
    return q


def _split(spark: SparkSession, sf: str) -> DataFrame:
    return M.stratified_split(ml_input(spark, sf, M.KEYS))


def _standard_scale(spark: SparkSession, sf: str) -> DataFrame:
    """Scaled features; rounded here, as a standard deviation's last digits depend on the order of rows."""
    split = written(_split(spark, sf), "split")
    scaled = M.standard_scale(split, M.scale_stats(split.where(F.col("split") == "train")))
    return scaled.select(*M.KEYS, "split", *[F.round(c, 6).alias(c) for c in M.NUMERIC])


def _one_hot(spark: SparkSession, sf: str) -> DataFrame:
    split = written(_split(spark, sf), "split")
    indexers = M.fit_indexers(split.where(F.col("split") == "train"))
    return M.one_hot_long(split, indexers, [*M.KEYS, "split"])


def _feature_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """What the models see: the assembled vector of every row, entry by entry."""
    split = written(_split(spark, sf), "split")
    prep = M.prepare(split)
    return M.vectors_long(prep.assemble(split), prep.names, [*M.KEYS, "split"])


def _prepared(spark: SparkSession, sf: str) -> M.Prepared:
    """Split + fitted preprocessing; the training vectors are staged, as solvers read them many times."""
    prep = M.prepare(written(_split(spark, sf), "split"))
    prep.train = written(prep.train, "train")
    return prep


def _train(spark: SparkSession, sf: str, which: str) -> DataFrame:
    prep = _prepared(spark, sf)
    models = []
    if which in ("lr", "both"):
        models.append(("Logistic Regression", M.logistic(prep.train)))
    if which in ("rf", "both"):
        models.append(("Random Forest", M.forest(prep.train)))
    out = [M.binary_metrics(M.scored(m, prep.test), name) for name, m in models]
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])


def _logistic_gradient(spark: SparkSession, sf: str) -> DataFrame:
    """The gradient of the objective at the fitted coefficients: the certificate that they are the minimum."""
    prep = _prepared(spark, sf)
    return M.logistic_gradient(prep, M.logistic(prep.train))


def _rf_importance(spark: SparkSession, sf: str) -> DataFrame:
    prep = _prepared(spark, sf)
    model = M.forest(prep.train)
    return M.importances(spark, model, prep.names)


def _year(df: DataFrame):
    return F.coalesce(F.col("YEAR").cast("int"), F.lit(0))


def _csv_drift_folders(spark: SparkSession, sf: str) -> list[str]:
    """Write the flight rows as CSV files whose headers drift, return their folders.

    files of years <= 1997: the source layout; 1998-1999: columns in reverse order,
    lower-case, padded names; >= 2000: no TAXI_IN column and a trailing blank-header
    column.
    """
    df = raw(spark, sf)
    base = P.new_scratch(spark, "csv-drift")
    y = _year(df)
    cols = list(fixed.RAW_COLUMNS)
    g1 = df.where(y <= 1997)
    g2 = df.where((y >= 1998) & (y <= 1999)).select(
        *[F.col(c).alias(f" {c.lower()} ") for c in reversed(cols)])
    g3 = df.where(y >= 2000).drop("TAXI_IN").withColumn(" ", F.lit(None).cast("string"))
    folders = []
    for i, g in enumerate((g1, g2, g3), start=1):
        path = f"{base}/g{i}"
        CF.write_csv_folder(g, path)
        folders.append(path)
    return folders


def _union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    df = tokened(spark, sf)
    y = _year(df)
    early = df.where(y <= 1997).select(*reversed(df.columns))
    late = df.where(y >= 1998).drop(*fixed.CAUSE_COLUMNS)
    return CF.union_by_name([early, late])


def _csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    exported = W.export_rename(S.airport_fragility(labelled(spark, sf)))
    path = P.new_scratch(spark, "csv-airports")
    W.write_csv(exported, path)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in exported.schema.fields)
    return W.read_csv(spark, path, schema=schema)


def _partitioned_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = P.new_scratch(spark, "flights-layout")
    flights = written(W.load_flights(enriched(spark, sf), staged=True), "flights")
    W.save_table(flights, path, contract=W.FLIGHTS, **P.FLIGHT_LAYOUT)
    return W.read_table(spark, path, W.FLIGHTS)


#: about so many files are written to show the access paths, whatever the table's size
ACCESS_FILES = 256


def _access_paths(spark: SparkSession, sf: str) -> DataFrame:
    """For each of the seven access paths of the served flights, looked up by the path's smallest value: the rows
    found, and whether files were skipped.  One curve serves all paths here (no folders)."""
    path = P.new_scratch(spark, "flights-access")
    flights = written(W.load_flights(enriched(spark, sf), staged=True), "flights")
    W.save_table(flights, path, contract=W.FLIGHTS, rows_per_file=max(1, flights.count() // ACCESS_FILES),
                 **{**P.FLIGHT_LAYOUT, "partition_by": (), "cluster_by": (*P.FLIGHT_CLUSTER, "year", "month")})
    least = flights.agg(*[F.min(c).alias(c) for c in ("origin", "dest", "route", "op_unique_carrier", "fl_date")],
                        F.min(F.struct("year", "month")).alias("ym")).first()
    probes = {c: {c: least[c]} for c in ("origin", "dest", "route", "op_unique_carrier", "fl_date")}
    probes |= {"year, month": {"year": least["ym"]["year"], "month": least["ym"]["month"]}, "disrupted": {"disrupted": 1}}
    report = layout.access_report(spark, tables.current(spark, path).folder, W.table_schema(W.FLIGHTS), probes)
    return report.select("path", "probe", "rows", "rows_found", (F.col("files_kept") < F.col("files")).alias("skips"))


_SUMMARY_LOADS = (
    ("airport_summary", lambda s, sf: S.airport_fragility(labelled(s, sf)), W.AIRPORT),
    ("route_summary", lambda s, sf: S.route_reliability(routes(s, sf)), W.ROUTE),
    ("carrier_summary", lambda s, sf: S.carrier_summary(labelled(s, sf)), W.CARRIER),
    ("monthly_summary", lambda s, sf: S.monthly_summary(months(s, sf)), W.MONTHLY),
    ("delay_cause_summary", lambda s, sf: S.delay_cause_summary(causes(s, sf)), W.CAUSE),
)


def _airport_table(spark: SparkSession, sf: str) -> DataFrame:
    return W.load_summary(S.airport_fragility(labelled(spark, sf)), W.AIRPORT)


def _pk_violations(spark: SparkSession, sf: str) -> DataFrame:
    frames = P.summaries(enriched(spark, sf))
    out = None
    for contract in W.SUMMARY_CONTRACTS:
        part = W.pk_violations(W.load_summary(frames[contract.name], contract), contract)
        out = part if out is None else out.unionByName(part)
    return out


QUERIES: dict[str, Query] = _registry()
