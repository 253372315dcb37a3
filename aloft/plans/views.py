"""Reporting views over the typed (decimal) tables.

Views read the *stored* decimals, so values are rounded once on load and once
in the view, as a database view over a typed table would.  Descending sorts
put NULLs first (database default for DESC); the table key breaks ties so a
LIMIT cut is deterministic.  Each ``ORDER BY .. LIMIT`` plans as a single
``TakeOrderedAndProject`` (per-partition top-k, then a merge of k rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aloft.functions.columns import month_abbrev


def _pct(c: str, places: int, typ: str) -> Column:
    return F.round(F.col(c) * F.lit(100), places).cast(typ)


def _r(c: str, places: int, typ: str) -> Column:
    return F.round(F.col(c), places).cast(typ)


def top_disrupted_airports(airports: DataFrame, n: int = 10) -> DataFrame:
    out = airports.select(
        F.col("origin").alias("airport"), "total_flights", "disrupted_flights",
        _pct("disruption_rate", 1, "decimal(5,1)").alias("disruption_pct"),
        _r("avg_dep_delay", 1, "decimal(5,1)").alias("avg_dep_delay_min"),
        _pct("cancellation_rate", 2, "decimal(5,2)").alias("cancel_pct"),
        _r("afi", 4, "decimal(5,4)").alias("fragility_index"))
    return out.orderBy(F.col("disruption_pct").desc_nulls_first(), F.col("airport")).limit(n)


def unstable_routes(routes: DataFrame, n: int = 10, min_flights: int = 50) -> DataFrame:
    out = routes.where(F.col("total_flights") >= min_flights).select(
        "route", "total_flights", "disrupted_flights",
        _pct("disruption_rate", 1, "decimal(5,1)").alias("disruption_pct"),
        _r("avg_dep_delay", 1, "decimal(5,1)").alias("avg_dep_delay_min"),
        _r("rrs", 1, "decimal(4,1)").alias("reliability_score"))
    return out.orderBy(F.col("disruption_pct").desc_nulls_first(), F.col("route")).limit(n)


def carrier_disruption(carriers: DataFrame) -> DataFrame:
    out = carriers.select(
        "op_unique_carrier", "total_flights", "disrupted_flights",
        _pct("disruption_rate", 1, "decimal(5,1)").alias("disruption_pct"),
        _r("avg_dep_delay", 1, "decimal(5,1)").alias("avg_dep_delay_min"),
        _r("avg_arr_delay", 1, "decimal(5,1)").alias("avg_arr_delay_min"),
        "cancellations",
        _pct("cancellation_rate", 2, "decimal(5,2)").alias("cancel_pct"),
        "diversions")
    return out.orderBy(F.col("disruption_pct").desc_nulls_first(), F.col("op_unique_carrier"))


def monthly_trend(monthly: DataFrame) -> DataFrame:
    out = monthly.select(
        "year", "month", month_abbrev("month").alias("month_name"),
        "total_flights", "disrupted_flights",
        _pct("disruption_rate", 2, "decimal(5,2)").alias("disruption_pct"),
        _r("avg_dep_delay", 1, "decimal(5,1)").alias("avg_dep_delay_min"),
        "cancellations")
    return out.orderBy("year", "month")


def root_causes(causes: DataFrame) -> DataFrame:
    hours = F.round(F.col("total_minutes") / F.lit(60.0).cast("decimal(3,1)"), 0)
    out = causes.select(
        "cause", hours.cast("decimal(12,0)").alias("total_hours"), "total_minutes", "avg_minutes",
        "flight_count", _r("pct_of_total", 1, "decimal(4,1)").alias("pct_of_total_delay"))
    return out.orderBy(F.col("total_minutes").desc_nulls_first(), F.col("cause"))


def top_cancel_airports(airports: DataFrame, n: int = 15, min_flights: int = 100) -> DataFrame:
    out = airports.where(F.col("total_flights") >= min_flights).select(
        F.col("origin").alias("airport"), "total_flights",
        _pct("cancellation_rate", 2, "decimal(5,2)").alias("cancel_pct"),
        _pct("disruption_rate", 1, "decimal(5,1)").alias("disruption_pct"),
        _r("afi", 4, "decimal(5,4)").alias("fragility_index"))
    return out.orderBy(F.col("cancel_pct").desc_nulls_first(), F.col("airport")).limit(n)


def top_arrival_delay(airports: DataFrame, n: int = 15, min_flights: int = 100) -> DataFrame:
    """Sorted by the stored ``avg_arr_delay`` (not by the rounded output column)."""
    out = airports.where(F.col("total_flights") >= min_flights).select(
        F.col("origin").alias("airport"), "total_flights", "avg_arr_delay",
        _r("avg_arr_delay", 1, "decimal(5,1)").alias("avg_arr_delay_min"),
        _pct("disruption_rate", 1, "decimal(5,1)").alias("disruption_pct"),
        _r("afi", 4, "decimal(5,4)").alias("fragility_index"))
    return (out.orderBy(F.col("avg_arr_delay").desc_nulls_first(), F.col("airport")).limit(n)
               .drop("avg_arr_delay"))
