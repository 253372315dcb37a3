"""Feature stage: disruption label, route key, weekend flag, hours, time block.

All six columns are computed in one projection from the cleaned frame; no
Python function runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aloft.functions import fixed
from aloft.functions.columns import hour_of, strip_all, time_block
from aloft.operators.clean import require_columns

FEATURE_INPUTS = ("DEP_DELAY", "ARR_DELAY", "CANCELLED", "DIVERTED", "ORIGIN", "DEST",
                  "DAY_OF_WEEK", "CRS_DEP_TIME", "CRS_ARR_TIME")


def disrupted_flag() -> Column:
    """1 when departure or arrival is >= 15 min late, or the flight was cancelled or
    diverted.  A comparison with NULL counts as false (``null or false`` is NULL in SQL,
    hence the outer ``coalesce``)."""
    t = fixed.DELAY_THRESHOLD_MIN
    hit = ((F.col("DEP_DELAY") >= t) | (F.col("ARR_DELAY") >= t)
           | (F.col("CANCELLED") == 1) | (F.col("DIVERTED") == 1))
    return F.when(F.coalesce(hit, F.lit(False)), F.lit(1)).otherwise(F.lit(0))


def route_key() -> Column:
    return F.concat(strip_all("ORIGIN"), F.lit("-"), strip_all("DEST"))


def weekend_flag() -> Column:
    return F.coalesce(F.col("DAY_OF_WEEK").isin(*fixed.WEEKEND_DAYS), F.lit(False)).cast("int")


def engineer_features(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """All features, or only the named ones (then only their own inputs need to be there)."""
    if features is None:
        require_columns(df, FEATURE_INPUTS, "engineer_features")
    build = {"disrupted": disrupted_flag, "route": route_key, "is_weekend": weekend_flag,
             "dep_hour": lambda: hour_of("CRS_DEP_TIME"), "arr_hour": lambda: hour_of("CRS_ARR_TIME")}
    wanted = [*build, "time_block"] if features is None else features
    out = df.withColumns({f: build[f]() for f in build if f in wanted})
    return out.withColumn("time_block", time_block("dep_hour")) if "time_block" in wanted else out
