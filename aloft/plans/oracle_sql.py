"""Independent ANSI-SQL statements of every value-checked query (DuckDB dialect).

Used by the correctness check: the same parquet tables are registered as
views in DuckDB and each statement below must return the same multiset of
rows, with the same column names, as the Spark query of the same key.

The SQL is written from the specification, not generated from the Spark
plans: a shared CTE prefix builds the flight-shaped rows, the coerced frame,
the medians, the cleaned and the enriched frame; each query appends its own
final SELECT.  Rounding rules: frame-side rounds are half-to-even on doubles
(``round_even(x * 10^n, 0) / 10^n``); rounds of stored decimals use ``round``.
"""

from __future__ import annotations

import re

from aloft.functions import fixed

NUM_RE = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"


def q(c: str) -> str:
    return f'"{c}"'


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def tok(c: str) -> str:
    return f"CASE WHEN {q(c)} IN ({_sql_list(fixed.NULL_TOKENS)}) THEN NULL ELSE {q(c)} END"


def finite(x: str) -> str:
    return f"(CASE WHEN isnan({x}) OR isinf({x}) THEN NULL ELSE {x} END)"


def num(x: str) -> str:
    return finite(f"(CASE WHEN regexp_matches({x}, '{NUM_RE}') THEN TRY_CAST(trim({x}) AS DOUBLE) END)")


def rnd(x: str, places: int) -> str:
    s = f"{10 ** places}.0::DOUBLE"
    return f"(round_even(({x}) * {s}, 0) / {s})"


FLIGHT_VIEW = """
fv_src AS (
  SELECT l.l_orderkey AS ok, l.l_partkey AS pk, l.l_suppkey AS sk, l.l_linenumber AS ln,
         l.l_quantity AS qty, l.l_discount AS disc, l.l_tax AS tax,
         CAST(l.l_shipdate AS DATE) AS sd, s.s_nationkey AS sn, c.c_nationkey AS cn
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
fv_a AS (
  SELECT *, (disc = 0.1) AS canc, (disc <> 0.1 AND tax = 0.08 AND ln = 7) AS dvt,
         (ok * 7 + pk * 3 + ln * 11) % 60 - 40 + sn % 12 AS dd
  FROM fv_src
),
fv_b AS (SELECT *, dd + CAST(trunc(qty) AS INTEGER) % 21 - 12 AS ad FROM fv_a),
fv_c AS (SELECT *, (NOT canc AND NOT dvt AND ad >= 15) AS late, (canc OR dvt) AS gone FROM fv_b),
flights_raw AS (
  SELECT
    CAST(year(sd) AS VARCHAR) AS "YEAR",
    CAST(month(sd) AS VARCHAR) AS "MONTH",
    CAST(isodow(sd) AS VARCHAR) AS "DAY_OF_WEEK",
    CASE WHEN pk % 17 = 0 THEN month(sd) || '/' || day(sd) || '/' || year(sd) || ' 12:00:00 AM'
         WHEN pk % 23 = 0 THEN NULL WHEN pk % 29 = 0 THEN 'unknown' ELSE strftime(sd, '%Y-%m-%d') END AS "FL_DATE",
    'C' || CAST(sk % 12 AS VARCHAR) AS "OP_UNIQUE_CARRIER",
    'N' || CAST(pk % 100000 AS VARCHAR) || 'S' || CAST(sk % 1000 AS VARCHAR) AS "TAIL_NUM",
    CAST(ok * 10 + ln AS VARCHAR) AS "OP_CARRIER_FL_NUM",
    CASE WHEN pk % 211 <> 0 THEN 'A' || lpad(CAST(sn AS VARCHAR), 2, '0') END AS "ORIGIN",
    'A' || lpad(CAST(cn AS VARCHAR), 2, '0') || ' ' AS "DEST",
    CAST(pk % 25 * 100 + sk % 60 AS VARCHAR) AS "CRS_DEP_TIME",
    CAST(CASE WHEN NOT canc THEN pk % 25 * 100 + (sk + 7) % 60 END AS VARCHAR) AS "DEP_TIME",
    CASE WHEN NOT canc THEN CASE WHEN pk % 97 = 0 THEN 'N/A' ELSE CAST(dd AS VARCHAR) END END AS "DEP_DELAY",
    CAST(CASE WHEN NOT canc THEN CASE WHEN dd >= 15 THEN 1 ELSE 0 END END AS VARCHAR) AS "DEP_DEL15",
    CASE WHEN NOT canc THEN (10 + ok % 20) || CASE WHEN ln % 2 = 0 THEN '.5' ELSE '' END END AS "TAXI_OUT",
    CAST(CASE WHEN NOT gone THEN 4 + pk % 9 END AS VARCHAR) AS "TAXI_IN",
    CAST((pk + 3 + ln) % 25 * 100 + ok % 60 AS VARCHAR) AS "CRS_ARR_TIME",
    CAST(CASE WHEN NOT gone THEN (pk + 3 + ln) % 25 * 100 + (ok + 5) % 60 END AS VARCHAR) AS "ARR_TIME",
    CAST(CASE WHEN NOT gone THEN ad END AS VARCHAR) AS "ARR_DELAY",
    CAST(CASE WHEN NOT gone THEN CASE WHEN ad >= 15 THEN 1 ELSE 0 END END AS VARCHAR) AS "ARR_DEL15",
    CAST(CASE WHEN canc THEN 1 ELSE 0 END AS VARCHAR) AS "CANCELLED",
    CAST(CASE WHEN dvt THEN 1 ELSE 0 END AS VARCHAR) AS "DIVERTED",
    CAST(CASE WHEN NOT gone THEN 30 + pk % 300 END AS VARCHAR) AS "AIR_TIME",
    (200 + pk % 2300) || CASE WHEN sk % 3 = 0 THEN '.5' ELSE '' END AS "DISTANCE",
    CAST(CASE WHEN late THEN CASE WHEN ln IN (1, 2) THEN ad ELSE 0 END END AS VARCHAR) AS "CARRIER_DELAY",
    CAST(CASE WHEN late THEN CASE WHEN ln = 3 THEN ad ELSE 0 END END AS VARCHAR) AS "WEATHER_DELAY",
    CAST(CASE WHEN late THEN CASE WHEN ln = 4 THEN ad ELSE 0 END END AS VARCHAR) AS "NAS_DELAY",
    CAST(CASE WHEN late THEN CASE WHEN ln = 5 THEN ad ELSE 0 END END AS VARCHAR) AS "SECURITY_DELAY",
    CAST(CASE WHEN late THEN CASE WHEN ln IN (6, 7) THEN ad ELSE 0 END END AS VARCHAR) AS "LATE_AIRCRAFT_DELAY"
  FROM fv_c
)"""


def _tokens_cte() -> str:
    cols = ", ".join(f"{tok(c)} AS {q(c)}" for c in fixed.RAW_COLUMNS)
    return f"tokened AS (SELECT {cols} FROM flights_raw)"


def _coerced_cte() -> str:
    out = []
    for c in fixed.RAW_COLUMNS:
        if c in fixed.NUMERIC_COLUMNS:
            out.append(f"{num(q(c))} AS {q(c)}")
        elif c in fixed.CALENDAR_COLUMNS:
            out.append(f"CAST(round_even({num(q(c))}, 0) AS INTEGER) AS {q(c)}")
        else:
            out.append(q(c))
    return f"coerced AS (SELECT {', '.join(out)} FROM tokened)"


def _medians_cte() -> str:
    cols = ", ".join(f"median({q(c)}) AS {q(c)}" for c in fixed.MEDIAN_COLUMNS)
    return f"medians AS (SELECT {cols} FROM coerced)"


def _filled_cte() -> str:
    out = []
    for c in fixed.RAW_COLUMNS:
        if c in fixed.CAUSE_COLUMNS:
            out.append(f"COALESCE(k.{q(c)}, 0.0) AS {q(c)}")
        elif c in fixed.MEDIAN_COLUMNS:
            out.append(f"COALESCE(k.{q(c)}, m.{q(c)}) AS {q(c)}")
        elif c in fixed.FLAG_COLUMNS:
            out.append(f"CAST(trunc(COALESCE(k.{q(c)}, 0.0)) AS INTEGER) AS {q(c)}")
        else:
            out.append(f"k.{q(c)}")
    return f"filled AS (SELECT {', '.join(out)} FROM coerced k CROSS JOIN medians m)"


def _clean_cte() -> str:
    keys = " AND ".join(f"{q(c)} IS NOT NULL" for c in fixed.KEY_COLUMNS)
    return f"clean AS (SELECT * FROM filled WHERE {keys})"


STRIP = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _hour(c: str) -> str:
    return (f"CASE WHEN {q(c)} IS NOT NULL THEN "
            f"CAST(greatest(least(floor({q(c)} / 100), 23), 0) AS INTEGER) END")


def _block(h: str) -> str:
    return (f"CASE WHEN {h} IS NULL THEN NULL WHEN {h} < 6 THEN 'Night' WHEN {h} < 12 THEN 'Morning' "
            f"WHEN {h} < 18 THEN 'Afternoon' ELSE 'Evening' END")


def _feat_cte() -> str:
    disrupted = ("CASE WHEN COALESCE(\"DEP_DELAY\" >= 15 OR \"ARR_DELAY\" >= 15 OR \"CANCELLED\" = 1 "
                 "OR \"DIVERTED\" = 1, false) THEN 1 ELSE 0 END")
    route = (STRIP.format(x=q("ORIGIN")) + " || '-' || " + STRIP.format(x=q("DEST")))
    return (f"feat AS (SELECT *, {disrupted} AS disrupted, {route} AS route, "
            f"CASE WHEN \"DAY_OF_WEEK\" IN (6, 7) THEN 1 ELSE 0 END AS is_weekend, "
            f"{_hour('CRS_DEP_TIME')} AS dep_hour, {_hour('CRS_ARR_TIME')} AS arr_hour, "
            f"{_block(_hour('CRS_DEP_TIME'))} AS time_block FROM clean)")


def _summary_ctes() -> str:
    airport = """airport_base AS (
  SELECT "ORIGIN", CAST(count(*) AS BIGINT) AS total_flights, CAST(sum(disrupted) AS BIGINT) AS disrupted_flights,
         avg("DEP_DELAY") AS avg_dep_delay, avg("ARR_DELAY") AS avg_arr_delay,
         avg("CANCELLED") AS cancellation_rate, avg("DIVERTED") AS diversion_rate,
         CAST(sum(disrupted) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS disruption_rate
  FROM feat WHERE "ORIGIN" IS NOT NULL GROUP BY "ORIGIN"
),
airport_mm AS (
  SELECT min(disruption_rate) a0, max(disruption_rate) a1, min(avg_dep_delay) b0, max(avg_dep_delay) b1,
         min(cancellation_rate) c0, max(cancellation_rate) c1, min(diversion_rate) d0, max(diversion_rate) d1
  FROM airport_base
),
airport_norm AS (
  SELECT s.*,
    CASE WHEN a1 - a0 = 0 THEN 0.0 ELSE (disruption_rate - a0) / (a1 - a0) END AS norm_disruption,
    CASE WHEN b1 - b0 = 0 THEN 0.0 ELSE (avg_dep_delay - b0) / (b1 - b0) END AS norm_delay,
    CASE WHEN c1 - c0 = 0 THEN 0.0 ELSE (cancellation_rate - c0) / (c1 - c0) END AS norm_cancel,
    CASE WHEN d1 - d0 = 0 THEN 0.0 ELSE (diversion_rate - d0) / (d1 - d0) END AS norm_divert
  FROM airport_base s CROSS JOIN airport_mm
),
airport_afi AS (
  SELECT "ORIGIN", total_flights, disrupted_flights, avg_dep_delay, avg_arr_delay, cancellation_rate,
         diversion_rate, disruption_rate, norm_disruption, norm_delay, norm_cancel, norm_divert,
         """ + rnd("norm_disruption * 0.4::DOUBLE + norm_delay * 0.3::DOUBLE + norm_cancel * 0.2::DOUBLE "
                   "+ norm_divert * 0.1::DOUBLE", 4) + """ AS "AFI"
  FROM airport_norm
),
route_base AS (
  SELECT route, CAST(count(*) AS BIGINT) AS total_flights, CAST(sum(disrupted) AS BIGINT) AS disrupted_flights,
         avg("DEP_DELAY") AS avg_dep_delay, avg("ARR_DELAY") AS avg_arr_delay, avg("DISTANCE") AS avg_distance,
         CAST(sum(disrupted) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS disruption_rate
  FROM feat WHERE route IS NOT NULL GROUP BY route
),
route_mm AS (SELECT min(avg_dep_delay) b0, max(avg_dep_delay) b1 FROM route_base),
route_pen AS (
  SELECT s.*, (CASE WHEN b1 - b0 = 0 THEN 0.0 ELSE (avg_dep_delay - b0) / (b1 - b0) END) * 0.1::DOUBLE
         AS delay_penalty
  FROM route_base s CROSS JOIN route_mm
),
route_rrs AS (
  SELECT *, """ + rnd("CASE WHEN (1.0::DOUBLE - disruption_rate - delay_penalty) IS NULL THEN NULL ELSE "
                      "greatest(least((1.0::DOUBLE - disruption_rate - delay_penalty) * 100.0::DOUBLE, "
                      "100.0::DOUBLE), 0.0::DOUBLE) END", 2) + """ AS "RRS"
  FROM route_pen
),
carrier_s AS (
  SELECT "OP_UNIQUE_CARRIER" AS carrier, CAST(count(*) AS BIGINT) AS total_flights,
         CAST(sum(disrupted) AS BIGINT) AS disrupted_flights,
         avg("DEP_DELAY") AS avg_dep_delay, avg("ARR_DELAY") AS avg_arr_delay,
         CAST(sum("CANCELLED") AS BIGINT) AS cancellations, CAST(sum("DIVERTED") AS BIGINT) AS diversions,
         CAST(sum(disrupted) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS disruption_rate,
         CAST(sum("CANCELLED") AS DOUBLE) / CAST(count(*) AS DOUBLE) AS cancellation_rate
  FROM feat WHERE "OP_UNIQUE_CARRIER" IS NOT NULL GROUP BY "OP_UNIQUE_CARRIER"
),
monthly_s AS (
  SELECT "YEAR", "MONTH", CAST(count(*) AS BIGINT) AS total_flights,
         CAST(sum(disrupted) AS BIGINT) AS disrupted_flights, avg("DEP_DELAY") AS avg_dep_delay,
         CAST(sum("CANCELLED") AS BIGINT) AS cancellations,
         CAST(sum(disrupted) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS disruption_rate
  FROM feat WHERE "YEAR" IS NOT NULL AND "MONTH" IS NOT NULL GROUP BY "YEAR", "MONTH"
),"""
    causes = " UNION ALL ".join(
        f"SELECT '{c}' AS cause, sum({q(c)}) AS total_minutes, avg({q(c)}) AS a, "
        f"CAST(count(*) FILTER (WHERE {q(c)} > 0) AS BIGINT) AS flight_count FROM feat"
        for c in fixed.CAUSE_COLUMNS)
    cause = f"""
cause_long AS ({causes}),
cause_s AS (
  SELECT cause, total_minutes, {rnd('a', 2)} AS avg_minutes, flight_count,
         {rnd('(total_minutes / (SELECT sum(total_minutes) FROM cause_long)) * 100.0::DOUBLE', 2)} AS pct_of_total
  FROM cause_long
)"""
    return airport + cause


def prefix() -> str:
    parts = [FLIGHT_VIEW, _tokens_cte(), _coerced_cte(), _medians_cte(), _filled_cte(), _clean_cte(),
             _feat_cte(), _summary_ctes()]
    return "WITH " + ",\n".join(p.strip().rstrip(",") for p in parts) + TYPED_CTES + "," + ML_CTES + "\n"


def sql(body: str) -> str:
    return prefix() + body


# ---------------------------------------------------------------------------------------------
# Per-query final SELECTs
# ---------------------------------------------------------------------------------------------

ID = q("OP_CARRIER_FL_NUM")


def _cols(*cs: str) -> str:
    return ", ".join(q(c) for c in cs)


def _registry() -> dict[str, str]:
    o: dict[str, str] = {}
    o["null_tokens"] = "SELECT * FROM tokened"
    o["coerce_numeric"] = "SELECT * FROM coerced"
    o["fill_causes_zero"] = ("SELECT " + ID + ", " + ", ".join(
        f"COALESCE({q(c)}, 0.0) AS {q(c)}" for c in fixed.CAUSE_COLUMNS) + " FROM coerced")
    o["column_medians"] = "SELECT * FROM medians"
    o["median_fill"] = ("SELECT k." + ID + ", " + ", ".join(
        f"COALESCE(k.{q(c)}, m.{q(c)}) AS {q(c)}" for c in fixed.MEDIAN_COLUMNS)
        + " FROM coerced k CROSS JOIN medians m")
    o["fill_flags"] = ("SELECT " + ID + ", " + ", ".join(
        f"CAST(trunc(COALESCE({q(c)}, 0.0)) AS INTEGER) AS {q(c)}" for c in fixed.FLAG_COLUMNS)
        + " FROM coerced")
    o["drop_missing_keys"] = ("SELECT " + _cols("OP_CARRIER_FL_NUM", *fixed.KEY_COLUMNS)
                              + " FROM tokened WHERE " + " AND ".join(
                                  f"{q(c)} IS NOT NULL" for c in fixed.KEY_COLUMNS))
    o["clean_flights"] = "SELECT * FROM clean"
    o["disrupted_flag"] = ("SELECT " + _cols("OP_CARRIER_FL_NUM", "DEP_DELAY", "ARR_DELAY", "CANCELLED",
                                             "DIVERTED") + ", disrupted FROM feat")
    o["route_key"] = "SELECT " + _cols("OP_CARRIER_FL_NUM", "ORIGIN", "DEST") + ", route FROM feat"
    o["weekend_flag"] = "SELECT " + _cols("OP_CARRIER_FL_NUM", "DAY_OF_WEEK") + ", is_weekend FROM feat"
    o["hour_of_day"] = ("SELECT " + _cols("OP_CARRIER_FL_NUM", "CRS_DEP_TIME", "CRS_ARR_TIME")
                        + ", dep_hour, arr_hour FROM feat")
    o["time_block"] = "SELECT " + ID + ", dep_hour, time_block FROM feat"
    o["engineer_features"] = "SELECT * FROM feat"
    o["airport_summary"] = "SELECT * FROM airport_base"
    o["minmax_norm"] = ("SELECT \"ORIGIN\", avg_arr_delay, CASE WHEN max(avg_arr_delay) OVER () - "
                        "min(avg_arr_delay) OVER () = 0 THEN 0.0 ELSE (avg_arr_delay - min(avg_arr_delay) "
                        "OVER ()) / (max(avg_arr_delay) OVER () - min(avg_arr_delay) OVER ()) END "
                        "AS norm_arr_delay FROM airport_base")
    o["airport_fragility"] = "SELECT * FROM airport_afi"
    o["route_summary"] = "SELECT * FROM route_base"
    o["route_reliability"] = "SELECT * FROM route_rrs"
    o["carrier_summary"] = "SELECT * FROM carrier_s"
    o["monthly_summary"] = "SELECT * FROM monthly_s"
    o["delay_cause_summary"] = "SELECT * FROM cause_s"
    o["overall_rate"] = "SELECT CAST(count(*) AS BIGINT) AS flights, avg(disrupted) AS disruption_rate FROM feat"
    months = ", ".join(f"({i}, '{m}')" for i, m in enumerate(fixed.MONTH_LABELS, start=1))
    o["month_trend"] = ("SELECT t.\"MONTH\", t.disruption_rate, t.disruption_rate * 100.0::DOUBLE AS disruption_pct, "
                        "l.label AS month_label FROM (SELECT \"MONTH\", avg(disruption_rate) AS disruption_rate "
                        "FROM monthly_s GROUP BY \"MONTH\") t LEFT JOIN (VALUES " + months
                        + ") l(m, label) ON t.\"MONTH\" = l.m")
    days = ", ".join(f"({i}, '{d}')" for i, d in fixed.DAY_LABELS)
    o["dow_trend"] = ("SELECT t.\"DAY_OF_WEEK\", t.total, t.disrupted, t.disrupted::DOUBLE / t.total::DOUBLE AS rate, "
                      "(t.disrupted::DOUBLE / t.total::DOUBLE) * 100.0::DOUBLE AS rate_pct, l.label AS day FROM "
                      "(SELECT \"DAY_OF_WEEK\", CAST(count(*) AS BIGINT) AS total, CAST(sum(disrupted) AS BIGINT) "
                      "AS disrupted FROM feat WHERE \"DAY_OF_WEEK\" IS NOT NULL GROUP BY \"DAY_OF_WEEK\") t "
                      "LEFT JOIN (VALUES " + days + ") l(d, label) ON t.\"DAY_OF_WEEK\" = l.d")
    o.update(_warehouse_sql())
    return {k: sql(v) for k, v in o.items()}


def _dec(x: str, p: int, s: int) -> str:
    return f"CAST({x} AS DECIMAL({p},{s}))"


def _char(x: str, n: int) -> str:
    return f"rpad(rtrim({x}), {n}, ' ')"


TYPED_CTES = """,
airport_t AS (
  SELECT rpad(rtrim("ORIGIN"), 3, ' ') AS origin, CAST(total_flights AS INTEGER) AS total_flights,
         CAST(disrupted_flights AS INTEGER) AS disrupted_flights,
         CAST(avg_dep_delay AS DECIMAL(6,2)) AS avg_dep_delay, CAST(avg_arr_delay AS DECIMAL(6,2)) AS avg_arr_delay,
         CAST(cancellation_rate AS DECIMAL(5,4)) AS cancellation_rate,
         CAST(diversion_rate AS DECIMAL(5,4)) AS diversion_rate,
         CAST(disruption_rate AS DECIMAL(5,4)) AS disruption_rate, CAST("AFI" AS DECIMAL(5,4)) AS afi
  FROM airport_afi
),
route_t AS (
  SELECT route, CAST(total_flights AS INTEGER) AS total_flights, CAST(disrupted_flights AS INTEGER) AS disrupted_flights,
         CAST(avg_dep_delay AS DECIMAL(6,2)) AS avg_dep_delay, CAST(avg_arr_delay AS DECIMAL(6,2)) AS avg_arr_delay,
         CAST(avg_distance AS DECIMAL(7,2)) AS avg_distance, CAST(disruption_rate AS DECIMAL(5,4)) AS disruption_rate,
         CAST("RRS" AS DECIMAL(5,2)) AS rrs
  FROM route_rrs
),
carrier_t AS (
  SELECT carrier AS op_unique_carrier, CAST(total_flights AS INTEGER) AS total_flights,
         CAST(disrupted_flights AS INTEGER) AS disrupted_flights,
         CAST(avg_dep_delay AS DECIMAL(6,2)) AS avg_dep_delay, CAST(avg_arr_delay AS DECIMAL(6,2)) AS avg_arr_delay,
         CAST(cancellations AS INTEGER) AS cancellations, CAST(diversions AS INTEGER) AS diversions,
         CAST(disruption_rate AS DECIMAL(5,4)) AS disruption_rate,
         CAST(cancellation_rate AS DECIMAL(5,4)) AS cancellation_rate
  FROM carrier_s
),
monthly_t AS (
  SELECT CAST("YEAR" AS SMALLINT) AS year, CAST("MONTH" AS SMALLINT) AS month,
         CAST(total_flights AS INTEGER) AS total_flights, CAST(disrupted_flights AS INTEGER) AS disrupted_flights,
         CAST(avg_dep_delay AS DECIMAL(6,2)) AS avg_dep_delay, CAST(cancellations AS INTEGER) AS cancellations,
         CAST(disruption_rate AS DECIMAL(5,4)) AS disruption_rate
  FROM monthly_s
),
cause_t AS (
  SELECT cause, CAST(total_minutes AS DECIMAL(12,1)) AS total_minutes, CAST(avg_minutes AS DECIMAL(6,2)) AS avg_minutes,
         CAST(flight_count AS INTEGER) AS flight_count, CAST(pct_of_total AS DECIMAL(5,2)) AS pct_of_total
  FROM cause_s
),
flights_prep AS (
  SELECT
    CAST(round_even(CAST("YEAR" AS DOUBLE), 0) AS SMALLINT) AS year,
    CAST(round_even(CAST("MONTH" AS DOUBLE), 0) AS SMALLINT) AS month,
    CAST(isodow(coalesce(TRY_CAST(try_strptime("FL_DATE", '%Y-%m-%d') AS DATE), TRY_CAST(try_strptime("FL_DATE", '%m/%d/%Y %I:%M:%S %p') AS DATE))) AS SMALLINT) AS day_of_week,
    coalesce(TRY_CAST(try_strptime("FL_DATE", '%Y-%m-%d') AS DATE), TRY_CAST(try_strptime("FL_DATE", '%m/%d/%Y %I:%M:%S %p') AS DATE)) AS fl_date,
    "OP_UNIQUE_CARRIER" AS op_unique_carrier, "TAIL_NUM" AS tail_num, "OP_CARRIER_FL_NUM" AS flight_num,
    "ORIGIN" AS origin, "DEST" AS dest, route,
    CAST(round_even("CRS_DEP_TIME", 0) AS SMALLINT) AS crs_dep_time,
    CAST(round_even(""" + num('"DEP_TIME"') + """, 0) AS SMALLINT) AS dep_time,
    "DEP_DELAY" AS dep_delay, CAST("DEP_DEL15" AS SMALLINT) AS dep_del15,
    "TAXI_OUT" AS taxi_out, "TAXI_IN" AS taxi_in,
    CAST(round_even("CRS_ARR_TIME", 0) AS SMALLINT) AS crs_arr_time,
    CAST(round_even(""" + num('"ARR_TIME"') + """, 0) AS SMALLINT) AS arr_time,
    "ARR_DELAY" AS arr_delay, CAST("ARR_DEL15" AS SMALLINT) AS arr_del15,
    CAST("CANCELLED" AS SMALLINT) AS cancelled, CAST("DIVERTED" AS SMALLINT) AS diverted,
    "AIR_TIME" AS air_time, "DISTANCE" AS distance,
    "CARRIER_DELAY" AS carrier_delay, "WEATHER_DELAY" AS weather_delay, "NAS_DELAY" AS nas_delay,
    "SECURITY_DELAY" AS security_delay, "LATE_AIRCRAFT_DELAY" AS late_aircraft_delay,
    CAST(disrupted AS SMALLINT) AS disrupted, CAST(is_weekend AS SMALLINT) AS is_weekend,
    CAST(dep_hour AS SMALLINT) AS dep_hour, CAST(arr_hour AS SMALLINT) AS arr_hour, time_block
  FROM feat
),
flights_typed AS (
  SELECT year, month, day_of_week, fl_date, op_unique_carrier, tail_num, flight_num,
         rpad(rtrim(origin), 3, ' ') AS origin, rpad(rtrim(dest), 3, ' ') AS dest, route,
         crs_dep_time, dep_time, CAST(dep_delay AS DECIMAL(6,1)) AS dep_delay, dep_del15,
         CAST(taxi_out AS DECIMAL(5,1)) AS taxi_out, CAST(taxi_in AS DECIMAL(5,1)) AS taxi_in,
         crs_arr_time, arr_time, CAST(arr_delay AS DECIMAL(6,1)) AS arr_delay, arr_del15, cancelled, diverted,
         CAST(air_time AS DECIMAL(6,1)) AS air_time, CAST(distance AS DECIMAL(7,1)) AS distance,
         CAST(carrier_delay AS DECIMAL(6,1)) AS carrier_delay, CAST(weather_delay AS DECIMAL(6,1)) AS weather_delay,
         CAST(nas_delay AS DECIMAL(6,1)) AS nas_delay, CAST(security_delay AS DECIMAL(6,1)) AS security_delay,
         CAST(late_aircraft_delay AS DECIMAL(6,1)) AS late_aircraft_delay,
         disrupted, is_weekend, dep_hour, arr_hour, time_block,
         row_number() OVER (ORDER BY fl_date NULLS FIRST, flight_num, tail_num, origin, dest, crs_dep_time, crs_arr_time,
                                     op_unique_carrier, year, month, day_of_week, route, dep_time, dep_delay,
                                     dep_del15, taxi_out, taxi_in, arr_time, arr_delay, arr_del15, cancelled,
                                     diverted, air_time, distance, carrier_delay, weather_delay, nas_delay,
                                     security_delay, late_aircraft_delay, disrupted, is_weekend, dep_hour,
                                     arr_hour, time_block) AS flight_id
  FROM flights_prep
)"""

# Double -> DECIMAL goes through the shortest decimal text of the double, as a load of
# exported text does (and as Spark's double -> decimal cast does).
TYPED_CTES = re.sub(r'CAST\(("?[A-Za-z_]+"?) AS DECIMAL\((\d+),(\d+)\)\)',
                    r'CAST(CAST(\1 AS VARCHAR) AS DECIMAL(\2,\3))', TYPED_CTES)

FLIGHT_COLS = ("flight_id, year, month, day_of_week, fl_date, op_unique_carrier, tail_num, flight_num, origin, "
               "dest, route, crs_dep_time, dep_time, dep_delay, dep_del15, taxi_out, taxi_in, crs_arr_time, "
               "arr_time, arr_delay, arr_del15, cancelled, diverted, air_time, distance, carrier_delay, "
               "weather_delay, nas_delay, security_delay, late_aircraft_delay, disrupted, is_weekend, dep_hour, "
               "arr_hour, time_block")


def _export_cols(cols) -> str:
    renames = dict(fixed.EXPORT_RENAMES)
    return ", ".join(f"{q(c)} AS {q(renames.get(c, c).lower())}" for c in cols)


def _warehouse_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    feat_cols = list(fixed.RAW_COLUMNS) + ["disrupted", "route", "is_weekend", "dep_hour", "arr_hour",
                                           "time_block"]
    o["export_rename"] = f"SELECT {_export_cols(feat_cols)} FROM feat"
    o["contract_projection"] = ('SELECT route, total_flights, disrupted_flights, avg_dep_delay, avg_arr_delay, '
                                'avg_distance, disruption_rate, "RRS" AS rrs FROM route_rrs')
    o["load_airport_summary"] = "SELECT * FROM airport_t"
    o["load_route_summary"] = "SELECT * FROM route_t"
    o["load_carrier_summary"] = "SELECT * FROM carrier_t"
    o["load_monthly_summary"] = "SELECT * FROM monthly_t"
    o["load_delay_cause_summary"] = "SELECT * FROM cause_t"
    o["typed_cast_flights"] = "SELECT * EXCLUDE (flight_id) FROM flights_typed"
    o["coerce_smallint"] = ("SELECT flight_num, year, month, day_of_week, crs_dep_time, dep_time, crs_arr_time, "
                            "arr_time, dep_del15, arr_del15, cancelled, diverted, disrupted, is_weekend, dep_hour, "
                            "arr_hour FROM flights_prep")
    o["parse_fl_date"] = "SELECT flight_num, fl_date FROM flights_prep"
    o["iso_day_of_week"] = "SELECT flight_num, fl_date, day_of_week FROM flights_prep"
    o["load_flights_cleaned"] = f"SELECT {FLIGHT_COLS} FROM flights_typed"
    o["surrogate_key"] = "SELECT flight_id, fl_date, flight_num, tail_num, origin, dest FROM flights_typed"
    counts = ["SELECT 'flights_cleaned' AS table_name, count(*) AS n FROM flights_typed"]
    counts += [f"SELECT '{t}', count(*) FROM {src}" for t, src in (
        ("airport_summary", "airport_t"), ("route_summary", "route_t"), ("carrier_summary", "carrier_t"),
        ("monthly_summary", "monthly_t"), ("delay_cause_summary", "cause_t"))]
    o["load_status"] = ("SELECT table_name, CAST(n AS BIGINT) AS rows, 'loaded' AS status, '' AS error FROM ("
                        + " UNION ALL ".join(counts) + ")")
    pk = []
    for t, key in (("airport_summary", "origin"), ("route_summary", "route"),
                   ("carrier_summary", "op_unique_carrier"), ("monthly_summary", "year, month"),
                   ("delay_cause_summary", "cause")):
        src = {"airport_summary": "airport_t", "route_summary": "route_t", "carrier_summary": "carrier_t",
               "monthly_summary": "monthly_t", "delay_cause_summary": "cause_t"}[t]
        nulls = " OR ".join(f"{k.strip()} IS NULL" for k in key.split(","))
        pk.append(f"SELECT '{t}' AS table_name, CAST(COALESCE(sum(CASE WHEN nn THEN n ELSE 0 END), 0) AS BIGINT) "
                  f"AS key_nulls, CAST(COALESCE(sum(CASE WHEN n > 1 THEN n - 1 END), 0) AS BIGINT) AS duplicate_keys "
                  f"FROM (SELECT count(*) AS n, bool_or({nulls}) AS nn FROM {src} GROUP BY {key})")
    o["pk_violations"] = " UNION ALL ".join(pk)
    o["view_top_disrupted_airports"] = (
        "SELECT origin AS airport, total_flights, disrupted_flights, "
        "CAST(round(disruption_rate * 100, 1) AS DECIMAL(5,1)) AS disruption_pct, "
        "CAST(round(avg_dep_delay, 1) AS DECIMAL(5,1)) AS avg_dep_delay_min, "
        "CAST(round(cancellation_rate * 100, 2) AS DECIMAL(5,2)) AS cancel_pct, "
        "CAST(round(afi, 4) AS DECIMAL(5,4)) AS fragility_index FROM airport_t "
        "ORDER BY disruption_pct DESC NULLS FIRST, airport LIMIT 10")
    o["view_unstable_routes"] = (
        "SELECT route, total_flights, disrupted_flights, "
        "CAST(round(disruption_rate * 100, 1) AS DECIMAL(5,1)) AS disruption_pct, "
        "CAST(round(avg_dep_delay, 1) AS DECIMAL(5,1)) AS avg_dep_delay_min, "
        "CAST(round(rrs, 1) AS DECIMAL(4,1)) AS reliability_score FROM route_t WHERE total_flights >= 50 "
        "ORDER BY disruption_pct DESC NULLS FIRST, route LIMIT 10")
    o["view_carrier_disruption"] = (
        "SELECT op_unique_carrier, total_flights, disrupted_flights, "
        "CAST(round(disruption_rate * 100, 1) AS DECIMAL(5,1)) AS disruption_pct, "
        "CAST(round(avg_dep_delay, 1) AS DECIMAL(5,1)) AS avg_dep_delay_min, "
        "CAST(round(avg_arr_delay, 1) AS DECIMAL(5,1)) AS avg_arr_delay_min, cancellations, "
        "CAST(round(cancellation_rate * 100, 2) AS DECIMAL(5,2)) AS cancel_pct, diversions FROM carrier_t")
    o["view_monthly_trend"] = (
        "SELECT year, month, CASE WHEN month BETWEEN 1 AND 12 THEN strftime(make_date(2000, month, 1), '%b') END "
        "AS month_name, total_flights, disrupted_flights, "
        "CAST(round(disruption_rate * 100, 2) AS DECIMAL(5,2)) AS disruption_pct, "
        "CAST(round(avg_dep_delay, 1) AS DECIMAL(5,1)) AS avg_dep_delay_min, cancellations FROM monthly_t")
    o["view_root_causes"] = (
        "SELECT cause, CAST(round(total_minutes / 60.0, 0) AS DECIMAL(12,0)) AS total_hours, total_minutes, "
        "avg_minutes, flight_count, CAST(round(pct_of_total, 1) AS DECIMAL(4,1)) AS pct_of_total_delay "
        "FROM cause_t")
    o["view_top_cancel_airports"] = (
        "SELECT origin AS airport, total_flights, "
        "CAST(round(cancellation_rate * 100, 2) AS DECIMAL(5,2)) AS cancel_pct, "
        "CAST(round(disruption_rate * 100, 1) AS DECIMAL(5,1)) AS disruption_pct, "
        "CAST(round(afi, 4) AS DECIMAL(5,4)) AS fragility_index FROM airport_t WHERE total_flights >= 100 "
        "ORDER BY cancel_pct DESC NULLS FIRST, airport LIMIT 15")
    o["view_top_arrival_delay"] = (
        "SELECT airport, total_flights, avg_arr_delay_min, disruption_pct, fragility_index FROM ("
        "SELECT origin AS airport, total_flights, avg_arr_delay, "
        "CAST(round(avg_arr_delay, 1) AS DECIMAL(5,1)) AS avg_arr_delay_min, "
        "CAST(round(disruption_rate * 100, 1) AS DECIMAL(5,1)) AS disruption_pct, "
        "CAST(round(afi, 4) AS DECIMAL(5,4)) AS fragility_index FROM airport_t WHERE total_flights >= 100 "
        "ORDER BY avg_arr_delay DESC NULLS FIRST, airport LIMIT 15)")
    raw_cols = list(fixed.RAW_COLUMNS)
    o["scan_csv_folder"] = ("SELECT " + ", ".join(
        f"CASE WHEN CAST(\"YEAR\" AS INTEGER) >= 2000 THEN NULL ELSE {q(c)} END AS {q(c)}" if c == "TAXI_IN"
        else q(c) for c in raw_cols) + " FROM tokened")
    o["union_by_name"] = ("SELECT " + ", ".join(
        f"CASE WHEN CAST(\"YEAR\" AS INTEGER) >= 1998 THEN NULL ELSE {q(c)} END AS {q(c)}"
        if c in fixed.CAUSE_COLUMNS else q(c) for c in raw_cols) + " FROM tokened")
    o["standardize_columns"] = "SELECT * FROM flights_raw"
    o["csv_roundtrip"] = ('SELECT "ORIGIN" AS origin, total_flights, disrupted_flights, avg_dep_delay, avg_arr_delay, '
                          'cancellation_rate, diversion_rate, disruption_rate, norm_disruption, norm_delay, '
                          'norm_cancel, norm_divert, "AFI" AS afi FROM airport_afi')
    o["partitioned_scan"] = f"SELECT {FLIGHT_COLS} FROM flights_typed"
    paths = [(c, f"CAST(min({c}) AS VARCHAR)", f"{c} = (SELECT min({c}) FROM flights_typed)")
             for c in ("origin", "dest", "route", "op_unique_carrier", "fl_date")]
    paths += [("year, month", "CAST(min((year, month))[1] AS VARCHAR) || ', ' || CAST(min((year, month))[2] AS VARCHAR)",
               "(year, month) = (SELECT min((year, month)) FROM flights_typed)"), ("disrupted", "'1'", "disrupted = 1")]
    o["access_paths"] = " UNION ALL ".join(
        f"SELECT '{name}' AS path, {probe} AS probe, count(*) AS rows, count(*) FILTER ({found}) AS rows_found, "
        f"true AS skips FROM flights_typed" for name, probe, found in paths)
    o["stage_counts"] = (
        "SELECT 1 AS step, 'raw' AS stage, CAST(count(*) AS BIGINT) AS row_count FROM flights_raw UNION ALL "
        "SELECT 2, 'cleaned', CAST(count(*) AS BIGINT) FROM clean UNION ALL "
        "SELECT 3, 'airports', CAST(count(*) AS BIGINT) FROM airport_base UNION ALL "
        "SELECT 4, 'routes', CAST(count(*) AS BIGINT) FROM route_base UNION ALL "
        "SELECT 5, 'carriers', CAST(count(*) AS BIGINT) FROM carrier_s UNION ALL "
        "SELECT 6, 'months', CAST(count(*) AS BIGINT) FROM monthly_s")
    o["all_summaries_grouping_sets"] = (
        'SELECT CAST(grouping_id("ORIGIN", route, "OP_UNIQUE_CARRIER", "YEAR", "MONTH", "DAY_OF_WEEK") AS BIGINT) '
        'AS grain, "ORIGIN", route, "OP_UNIQUE_CARRIER", "YEAR", "MONTH", "DAY_OF_WEEK", '
        'CAST(count(*) AS BIGINT) AS total_flights, CAST(sum(disrupted) AS BIGINT) AS disrupted_flights, '
        'avg("DEP_DELAY") AS avg_dep_delay, avg("ARR_DELAY") AS avg_arr_delay, avg("DISTANCE") AS avg_distance, '
        'CAST(sum("CANCELLED") AS BIGINT) AS cancellations, CAST(sum("DIVERTED") AS BIGINT) AS diversions '
        'FROM feat GROUP BY GROUPING SETS (("ORIGIN"), (route), ("OP_UNIQUE_CARRIER"), ("YEAR", "MONTH"), '
        '("DAY_OF_WEEK")) HAVING CASE grouping_id("ORIGIN", route, "OP_UNIQUE_CARRIER", "YEAR", "MONTH", "DAY_OF_WEEK") '
        'WHEN 31 THEN "ORIGIN" IS NOT NULL WHEN 47 THEN route IS NOT NULL WHEN 55 THEN "OP_UNIQUE_CARRIER" IS NOT NULL '
        'WHEN 57 THEN "YEAR" IS NOT NULL AND "MONTH" IS NOT NULL ELSE "DAY_OF_WEEK" IS NOT NULL END')
    o.update(_ml_sql())
    o["chart_top_airports"] = ('SELECT "ORIGIN", disruption_rate, "AFI" FROM airport_afi '
                               'ORDER BY "AFI" DESC NULLS LAST, "ORIGIN" LIMIT 15')
    return o



ML_FEATS = ('"MONTH", "DAY_OF_WEEK", "OP_UNIQUE_CARRIER", "ORIGIN", "DEST", "CRS_DEP_TIME", "DISTANCE", '
            'dep_hour, is_weekend, time_block')
ML_KEYS = '"OP_CARRIER_FL_NUM", "TAIL_NUM", "FL_DATE"'
ML_NUM = ("MONTH", "DAY_OF_WEEK", "CRS_DEP_TIME", "DISTANCE", "dep_hour", "is_weekend")
ML_CAT = ("OP_UNIQUE_CARRIER", "ORIGIN", "DEST", "time_block")

ML_CTES = """
ml AS (
  SELECT """ + ML_KEYS + ", " + ML_FEATS + """, disrupted FROM feat
  WHERE "MONTH" IS NOT NULL AND "DAY_OF_WEEK" IS NOT NULL AND "OP_UNIQUE_CARRIER" IS NOT NULL
    AND "ORIGIN" IS NOT NULL AND "DEST" IS NOT NULL AND "CRS_DEP_TIME" IS NOT NULL AND "DISTANCE" IS NOT NULL
    AND dep_hour IS NOT NULL AND is_weekend IS NOT NULL AND time_block IS NOT NULL AND disrupted IS NOT NULL
),
ml_counts AS (SELECT disrupted, CAST(count(*) AS BIGINT) AS n_c FROM ml GROUP BY disrupted),
ml_a1 AS (
  SELECT disrupted, n_c, CAST(sum(n_c) OVER () AS DOUBLE) AS n,
         CAST(sum(n_c) OVER () AS DOUBLE) - ceil(0.2::DOUBLE * CAST(sum(n_c) OVER () AS DOUBLE)) AS ntrain
  FROM ml_counts
),
ml_a2 AS (SELECT *, (CAST(n_c AS DOUBLE) / n) * ntrain AS cont FROM ml_a1),
ml_a3 AS (SELECT *, floor(cont) AS fl, cont - floor(cont) AS rem FROM ml_a2),
ml_a4 AS (SELECT *, ntrain - sum(fl) OVER () AS need,
                 row_number() OVER (ORDER BY rem DESC, disrupted) AS rk FROM ml_a3),
ml_alloc AS (SELECT disrupted, n_c, CAST(n_c - (fl + CASE WHEN rk <= need THEN 1 ELSE 0 END) AS BIGINT) AS test_c
             FROM ml_a4),
ml_split AS (
  SELECT m.*, CASE WHEN row_number() OVER (PARTITION BY m.disrupted ORDER BY
             md5(concat_ws('|', '42', "OP_CARRIER_FL_NUM", "TAIL_NUM", "FL_DATE")), """ + ML_KEYS + ", " + ML_FEATS + """)
             <= a.test_c THEN 'test' ELSE 'train' END AS split
  FROM ml m JOIN ml_alloc a ON m.disrupted = a.disrupted
),
ml_train AS (SELECT * FROM ml_split WHERE split = 'train'),
ml_sd AS (
  SELECT """ + ", ".join(
    f"CASE WHEN max({q(c)}) <> min({q(c)}) THEN stddev_pop(CAST({q(c)} AS DOUBLE)) ELSE 1.0 END AS {q('sd_' + c)}"
    for c in ML_NUM) + """ FROM ml_train
),
closed AS (
  SELECT disrupted AS label,
         ((CAST(substr("ORIGIN", 2, 2) AS INTEGER) % 12) * 8 + CAST(trunc("DISTANCE") AS INTEGER) % 10) / 100.0::DOUBLE
         AS score
  FROM ml
),
closed_p AS (SELECT label, score, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS pred FROM closed),
conf AS (
  SELECT CAST(count(*) FILTER (WHERE label = 1 AND pred = 1) AS BIGINT) AS tp,
         CAST(count(*) FILTER (WHERE label = 0 AND pred = 1) AS BIGINT) AS fp,
         CAST(count(*) FILTER (WHERE label = 1 AND pred = 0) AS BIGINT) AS fn,
         CAST(count(*) FILTER (WHERE label = 0 AND pred = 0) AS BIGINT) AS tn
  FROM closed_p
),
auc_s AS (
  SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM closed_p
  GROUP BY score
),
auc_r AS (SELECT pos, neg, COALESCE(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 AS below FROM auc_s),
auc AS (SELECT CASE WHEN sum(pos) * sum(neg) = 0 THEN 0.0 ELSE
               sum(CAST(pos AS DOUBLE) * (CAST(below AS DOUBLE) + CAST(neg AS DOUBLE) * 0.5::DOUBLE))
               / CAST(sum(pos) * sum(neg) AS DOUBLE) END AS roc_auc FROM auc_r)"""


def _d0(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)"


def _ml_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    o["ml_frame"] = f"SELECT {ML_FEATS}, disrupted FROM ml"
    o["stratified_split"] = f"SELECT {ML_KEYS}, disrupted, split FROM ml_split"
    o["class_weights"] = ("SELECT disrupted, n_c, CAST(sum(n_c) OVER () AS DOUBLE) / "
                          "CAST(count(*) OVER () * n_c AS DOUBLE) AS weight "
                          "FROM (SELECT disrupted, CAST(count(*) AS BIGINT) AS n_c FROM ml_train GROUP BY disrupted)")
    o["standard_scale"] = (f"SELECT {ML_KEYS}, split, " + ", ".join(
        f"round(CAST({q(c)} AS DOUBLE) / {q('sd_' + c)}, 6) AS {q(c)}" for c in ML_NUM) + " FROM ml_split CROSS JOIN ml_sd")
    parts = []
    for c in ML_CAT:
        parts.append(f"SELECT {ML_KEYS}, split, '{c}_' || {q(c)} AS feature, 1.0::DOUBLE AS value FROM ml_split "
                     f"WHERE {q(c)} IN (SELECT {q(c)} FROM ml_train)")
    o["one_hot"] = " UNION ALL ".join(parts)
    scaled = [f"SELECT {ML_KEYS}, split, '{c}' AS feature, round(CAST({q(c)} AS DOUBLE) / {q('sd_' + c)}, 6) AS value "
              f"FROM ml_split CROSS JOIN ml_sd WHERE {q(c)} <> 0" for c in ML_NUM]
    o["feature_vectors"] = " UNION ALL ".join(scaled + parts)
    # at the minimum the gradient is 0 for every feature that the training rows have
    o["logistic_gradient"] = " UNION ALL ".join(
        [f"SELECT '{c}' AS feature, 0.0::DOUBLE AS gradient" for c in (*ML_NUM, "(intercept)")]
        + [f"SELECT DISTINCT '{c}_' || {q(c)}, 0.0::DOUBLE FROM ml_train" for c in ML_CAT])
    o["binary_metrics"] = (
        "SELECT " + rnd(_d0("tp + tn", "tp + fp + fn + tn"), 4) + " AS accuracy, "
        + rnd(_d0("tp", "tp + fp"), 4) + " AS precision, " + rnd(_d0("tp", "tp + fn"), 4) + " AS recall, "
        + rnd(_d0("2 * tp", "2 * tp + fp + fn"), 4) + " AS f1, " + rnd("roc_auc", 4) + " AS roc_auc "
        "FROM conf CROSS JOIN auc")
    r = ("(SELECT " + _d0("tn", "tn + fn") + " AS p0, " + _d0("tn", "tn + fp") + " AS r0, "
         + _d0("2 * tn", "2 * tn + fn + fp") + " AS f0, tn + fp AS s0, "
         + _d0("tp", "tp + fp") + " AS p1, " + _d0("tp", "tp + fn") + " AS r1, "
         + _d0("2 * tp", "2 * tp + fp + fn") + " AS f1, tp + fn AS s1, "
         + _d0("tp + tn", "tp + fp + fn + tn") + " AS acc FROM conf) r")
    o["classification_report"] = (
        f"SELECT 'Not Disrupted' AS label, p0 AS precision, r0 AS recall, f0 AS f1_score, "
        f"CAST(s0 AS BIGINT) AS support FROM {r} "
        f"UNION ALL SELECT 'Disrupted', p1, r1, f1, CAST(s1 AS BIGINT) FROM {r} "
        f"UNION ALL SELECT 'accuracy', NULL, NULL, acc, CAST(s0 + s1 AS BIGINT) FROM {r} "
        f"UNION ALL SELECT 'macro avg', (p0 + p1) / 2.0::DOUBLE, (r0 + r1) / 2.0::DOUBLE, (f0 + f1) / 2.0::DOUBLE, "
        f"CAST(s0 + s1 AS BIGINT) FROM {r} "
        f"UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / CAST(s0 + s1 AS DOUBLE), "
        f"(r0 * s0 + r1 * s1) / CAST(s0 + s1 AS DOUBLE), (f0 * s0 + f1 * s1) / CAST(s0 + s1 AS DOUBLE), "
        f"CAST(s0 + s1 AS BIGINT) FROM {r}")
    return o


ORACLE: dict[str, str] = _registry()
