"""Summaries at five grains plus the two composite scores.

Each group-by is a partial (map-side) hash aggregate followed by one shuffle
of the partial rows, so hub airports or busy carriers never concentrate raw
rows in one task: the shuffle carries one row per (task, key).  Scalars that
must be seen by every summary row (min/max for normalisation, grand totals)
are one-row aggregates joined back with a broadcast of that single row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aloft.functions import fixed
from aloft.functions.columns import label_lookup, np_round, safe_ratio
from aloft.session import ensure_checkpoint_dir


def _total() -> Column:
    return F.count(F.lit(1)).alias("total_flights")


def _disrupted() -> Column:
    return F.sum("disrupted").cast("bigint").alias("disrupted_flights")


def _rate(num: str, den: str = "total_flights") -> Column:
    return safe_ratio(F.col(num), F.col(den))


def minmax_norm(df: DataFrame, columns: dict[str, str], materialize: bool = False) -> DataFrame:
    """Add ``out = (x - min) / (max - min)`` over the whole frame; 0 when the range is 0.

    ``columns`` maps source column -> output column.  Min and max come from one
    global aggregate (a single row) broadcast back to the rows.

    With ``materialize`` the frame is first checkpointed (eagerly, to the shared
    checkpoint folder).  Use it for a per-key summary: the statistics branch and
    the row branch then read that small table instead of each re-aggregating
    the whole input (column pruning makes the two upstream aggregates differ,
    so their shuffles would not be shared).
    """
    if materialize:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    stats = df.agg(*[a for src in columns for a in
                     (F.min(src).alias(f"__mn_{src}"), F.max(src).alias(f"__mx_{src}"))])
    joined = df.crossJoin(F.broadcast(stats))
    outs = {}
    for src, out in columns.items():
        mn, mx = F.col(f"__mn_{src}"), F.col(f"__mx_{src}")
        rng = mx - mn
        outs[out] = F.when(rng == 0, F.lit(0.0)).otherwise((F.col(src) - mn) / rng)
    return joined.withColumns(outs).select(*df.columns, *columns.values())


def airport_summary(df: DataFrame) -> DataFrame:
    g = (df.where(F.col("ORIGIN").isNotNull()).groupBy("ORIGIN")
         .agg(_total(), _disrupted(),
              F.avg("DEP_DELAY").alias("avg_dep_delay"),
              F.avg("ARR_DELAY").alias("avg_arr_delay"),
              F.avg("CANCELLED").alias("cancellation_rate"),
              F.avg("DIVERTED").alias("diversion_rate")))
    return g.withColumn("disruption_rate", _rate("disrupted_flights"))


def airport_fragility(df: DataFrame) -> DataFrame:
    """Airport summary + four normalised components + the fragility index (AFI)."""
    return fragility_of(airport_summary(df), materialize=True)


def fragility_of(airports: DataFrame, materialize: bool = False) -> DataFrame:
    s = minmax_norm(airports, {
        "disruption_rate": "norm_disruption", "avg_dep_delay": "norm_delay",
        "cancellation_rate": "norm_cancel", "diversion_rate": "norm_divert"}, materialize=materialize)
    score = None
    for name, weight in fixed.AFI_WEIGHTS:
        term = F.col(name) * F.lit(weight)
        score = term if score is None else score + term
    return (s.withColumn("AFI", np_round(score, 4))
             .orderBy(F.col("AFI").desc_nulls_last(), F.col("ORIGIN")))


def route_summary(df: DataFrame) -> DataFrame:
    g = (df.where(F.col("route").isNotNull()).groupBy("route")
         .agg(_total(), _disrupted(),
              F.avg("DEP_DELAY").alias("avg_dep_delay"),
              F.avg("ARR_DELAY").alias("avg_arr_delay"),
              F.avg("DISTANCE").alias("avg_distance")))
    return g.withColumn("disruption_rate", _rate("disrupted_flights"))


def route_reliability(df: DataFrame) -> DataFrame:
    """Route summary + delay penalty + route reliability score (RRS, 0..100)."""
    return reliability_of(route_summary(df), materialize=True)


def reliability_of(routes: DataFrame, materialize: bool = False) -> DataFrame:
    s = minmax_norm(routes, {"avg_dep_delay": "__norm_delay"}, materialize=materialize)
    s = s.withColumn("delay_penalty", F.col("__norm_delay") * F.lit(fixed.RRS_DELAY_WEIGHT))
    raw = (F.lit(1.0) - F.col("disruption_rate") - F.col("delay_penalty")) * F.lit(100.0)
    clipped = F.when(raw.isNotNull(), F.greatest(F.least(raw, F.lit(100.0)), F.lit(0.0)))
    return (s.drop("__norm_delay").withColumn("RRS", np_round(clipped, 2))
             .orderBy(F.col("RRS").desc_nulls_last(), F.col("route")))


def carrier_summary(df: DataFrame) -> DataFrame:
    g = (df.where(F.col("OP_UNIQUE_CARRIER").isNotNull()).groupBy("OP_UNIQUE_CARRIER")
         .agg(_total(), _disrupted(),
              F.avg("DEP_DELAY").alias("avg_dep_delay"),
              F.avg("ARR_DELAY").alias("avg_arr_delay"),
              F.sum("CANCELLED").cast("bigint").alias("cancellations"),
              F.sum("DIVERTED").cast("bigint").alias("diversions")))
    return (g.withColumns({"disruption_rate": _rate("disrupted_flights"),
                           "cancellation_rate": _rate("cancellations")})
             .withColumnRenamed("OP_UNIQUE_CARRIER", "carrier")
             .orderBy(F.col("disruption_rate").desc_nulls_last(), F.col("carrier")))


def monthly_summary(df: DataFrame) -> DataFrame:
    g = (df.where(F.col("YEAR").isNotNull() & F.col("MONTH").isNotNull())
         .groupBy("YEAR", "MONTH")
         .agg(_total(), _disrupted(),
              F.avg("DEP_DELAY").alias("avg_dep_delay"),
              F.sum("CANCELLED").cast("bigint").alias("cancellations")))
    return (g.withColumn("disruption_rate", _rate("disrupted_flights"))
             .orderBy("YEAR", "MONTH"))


def delay_cause_summary(df: DataFrame, causes: Sequence[str] = fixed.CAUSE_COLUMNS) -> DataFrame:
    """Per cause: total minutes, mean (2 dp), flights with minutes > 0, share of all minutes.

    One scan computes all 3 x 5 aggregates in a single row; ``stack`` turns the
    row into five, and the grand total is a sum of the five totals in that row.
    """
    aggs = []
    for c in causes:
        aggs += [F.sum(c).alias(f"t_{c}"), F.avg(c).alias(f"a_{c}"),
                 F.count_if(F.col(c) > 0).alias(f"n_{c}")]
    row = df.agg(*aggs)
    grand = None
    for c in causes:
        grand = F.col(f"t_{c}") if grand is None else grand + F.col(f"t_{c}")
    row = row.withColumn("__grand", grand)
    parts = ", ".join(f"'{c}', t_{c}, a_{c}, n_{c}" for c in causes)
    long = row.selectExpr(f"stack({len(causes)}, {parts}) as (cause, total_minutes, a, n)",
                          "__grand")
    pct = safe_ratio(F.col("total_minutes"), F.col("__grand")) * F.lit(100.0)
    return (long.select("cause", "total_minutes",
                        np_round(F.col("a"), 2).alias("avg_minutes"),
                        F.col("n").cast("bigint").alias("flight_count"),
                        np_round(pct, 2).alias("pct_of_total"))
                .orderBy(F.col("total_minutes").desc_nulls_last(), F.col("cause")))


def overall_rate(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("flights"), F.avg("disrupted").alias("disruption_rate"))


def month_trend(monthly: DataFrame) -> DataFrame:
    """Unweighted mean over years of the monthly disruption rate (chart table)."""
    g = monthly.groupBy("MONTH").agg(F.avg("disruption_rate").alias("disruption_rate"))
    return (g.select("MONTH", "disruption_rate",
                     (F.col("disruption_rate") * F.lit(100.0)).alias("disruption_pct"),
                     label_lookup("MONTH", list(enumerate(fixed.MONTH_LABELS, start=1)))
                     .alias("month_label"))
             .orderBy("MONTH"))


def dow_trend(df: DataFrame) -> DataFrame:
    g = (df.where(F.col("DAY_OF_WEEK").isNotNull()).groupBy("DAY_OF_WEEK")
         .agg(F.count(F.lit(1)).alias("total"), F.sum("disrupted").cast("bigint").alias("disrupted")))
    rate = safe_ratio(F.col("disrupted"), F.col("total"))
    return (g.select("DAY_OF_WEEK", "total", "disrupted", rate.alias("rate"),
                     (rate * F.lit(100.0)).alias("rate_pct"),
                     label_lookup("DAY_OF_WEEK", fixed.DAY_LABELS).alias("day"))
             .orderBy("DAY_OF_WEEK"))


#: grouping keys and the sets (grains) of the combined aggregate
GRAIN_KEYS = ("ORIGIN", "route", "OP_UNIQUE_CARRIER", "YEAR", "MONTH", "DAY_OF_WEEK")
GRAINS = (("ORIGIN",), ("route",), ("OP_UNIQUE_CARRIER",), ("YEAR", "MONTH"), ("DAY_OF_WEEK",))


def grain_id(keys: Sequence[str]) -> int:
    """``grouping_id()`` of a grain: a bit for every grouping key that it leaves out."""
    return sum(1 << (len(GRAIN_KEYS) - 1 - i) for i, k in enumerate(GRAIN_KEYS) if k not in keys)


def all_summaries_grouping_sets(df: DataFrame) -> DataFrame:
    """Airport, route, carrier, year-month and weekday aggregates in ONE scan.

    ``Expand`` feeds five grouping sets into one partial aggregate and ``grain``
    (the grouping id) tells the rows apart.  Rows whose own key is NULL form no group.
    """
    out = df.groupingSets([list(g) for g in GRAINS], *GRAIN_KEYS).agg(
        F.grouping_id().alias("grain"),
        _total(), _disrupted(),
        F.avg("DEP_DELAY").alias("avg_dep_delay"),
        F.avg("ARR_DELAY").alias("avg_arr_delay"),
        F.avg("DISTANCE").alias("avg_distance"),
        F.sum("CANCELLED").cast("bigint").alias("cancellations"),
        F.sum("DIVERTED").cast("bigint").alias("diversions"))
    known = None
    for g in GRAINS:
        p = F.col("grain") == grain_id(g)
        for k in g:
            p = p & F.col(k).isNotNull()
        known = p if known is None else known | p
    return out.where(known)


def grain(summaries: DataFrame, *keys: str) -> DataFrame:
    """The rows of one grain of ``all_summaries_grouping_sets``."""
    return summaries.where(F.col("grain") == grain_id(keys)).drop(
        "grain", *[k for k in GRAIN_KEYS if k not in keys])


def airport_summary_of(summaries: DataFrame) -> DataFrame:
    n = F.col("total_flights")
    return grain(summaries, "ORIGIN").select(
        "ORIGIN", "total_flights", "disrupted_flights", "avg_dep_delay", "avg_arr_delay",
        safe_ratio(F.col("cancellations"), n).alias("cancellation_rate"),
        safe_ratio(F.col("diversions"), n).alias("diversion_rate"), _rate("disrupted_flights").alias("disruption_rate"))


def route_summary_of(summaries: DataFrame) -> DataFrame:
    return grain(summaries, "route").select(
        "route", "total_flights", "disrupted_flights", "avg_dep_delay", "avg_arr_delay", "avg_distance",
        _rate("disrupted_flights").alias("disruption_rate"))


def carrier_summary_of(summaries: DataFrame) -> DataFrame:
    g = grain(summaries, "OP_UNIQUE_CARRIER").select(
        F.col("OP_UNIQUE_CARRIER").alias("carrier"), "total_flights", "disrupted_flights", "avg_dep_delay",
        "avg_arr_delay", "cancellations", "diversions")
    return (g.withColumns({"disruption_rate": _rate("disrupted_flights"), "cancellation_rate": _rate("cancellations")})
             .orderBy(F.col("disruption_rate").desc_nulls_last(), F.col("carrier")))


def monthly_summary_of(summaries: DataFrame) -> DataFrame:
    return grain(summaries, "YEAR", "MONTH").select(
        "YEAR", "MONTH", "total_flights", "disrupted_flights", "avg_dep_delay", "cancellations",
        _rate("disrupted_flights").alias("disruption_rate")).orderBy("YEAR", "MONTH")
