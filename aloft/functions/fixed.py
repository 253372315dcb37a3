"""Fixed values the pipeline must reproduce exactly.

Everything here is data, not logic: column lists of the 28-column
on-time-performance layout, the missing-value spellings, label lookups,
score weights and the thresholds of the time-of-day buckets.  Keep them
together so a reviewer can check them against the specification at a
glance.
"""

# --- fixed values: raw flight layout (28 source columns, natural order) ---
RAW_COLUMNS = (
    "YEAR", "MONTH", "DAY_OF_WEEK", "FL_DATE", "OP_UNIQUE_CARRIER", "TAIL_NUM",
    "OP_CARRIER_FL_NUM", "ORIGIN", "DEST", "CRS_DEP_TIME", "DEP_TIME", "DEP_DELAY",
    "DEP_DEL15", "TAXI_OUT", "TAXI_IN", "CRS_ARR_TIME", "ARR_TIME", "ARR_DELAY",
    "ARR_DEL15", "CANCELLED", "DIVERTED", "AIR_TIME", "DISTANCE", "CARRIER_DELAY",
    "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
)

# --- fixed values: missing-value spellings recognised when a CSV is scanned ---
# (the default NA spellings of the pandas CSV reader, as documented publicly)
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# --- fixed values: cleaning column groups ---
NUMERIC_COLUMNS = (
    "DEP_DELAY", "ARR_DELAY", "DEP_DEL15", "ARR_DEL15", "CANCELLED", "DIVERTED",
    "AIR_TIME", "DISTANCE", "TAXI_OUT", "TAXI_IN", "CRS_DEP_TIME", "CRS_ARR_TIME",
    "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
)
CAUSE_COLUMNS = (
    "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
)
MEDIAN_COLUMNS = ("DEP_DELAY", "ARR_DELAY", "TAXI_OUT", "TAXI_IN", "AIR_TIME", "DISTANCE")
FLAG_COLUMNS = ("CANCELLED", "DIVERTED", "DEP_DEL15", "ARR_DEL15")
KEY_COLUMNS = ("ORIGIN", "DEST", "OP_UNIQUE_CARRIER")
# calendar columns are typed as integers (group keys and the weekend test)
CALENDAR_COLUMNS = ("YEAR", "MONTH", "DAY_OF_WEEK")

# --- fixed values: disruption label and time-of-day buckets ---
DELAY_THRESHOLD_MIN = 15
WEEKEND_DAYS = (6, 7)
TIME_BLOCKS = ((6, "Night"), (12, "Morning"), (18, "Afternoon"))  # upper bound (exclusive), label
TIME_BLOCK_LAST = "Evening"

# --- fixed values: composite scores ---
AFI_WEIGHTS = (("norm_disruption", 0.40), ("norm_delay", 0.30), ("norm_cancel", 0.20),
               ("norm_divert", 0.10))
RRS_DELAY_WEIGHT = 0.10

# --- fixed values: labels for charts ---
MONTH_LABELS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun",
                "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
DAY_LABELS = ((1, "Mon"), (2, "Tue"), (3, "Wed"), (4, "Thu"), (5, "Fri"), (6, "Sat"), (7, "Sun"))

# --- fixed values: export naming ---
# Export lower-cases every column name; these two are renamed instead.
EXPORT_RENAMES = (("OP_UNIQUE_CARRIER", "carrier"), ("OP_CARRIER_FL_NUM", "flight_num"))

# --- fixed values: machine-learning setup ---
ML_FEATURES = ("MONTH", "DAY_OF_WEEK", "OP_UNIQUE_CARRIER", "ORIGIN", "DEST",
               "CRS_DEP_TIME", "DISTANCE", "dep_hour", "is_weekend", "time_block")
ML_TARGET = "disrupted"
ML_CATEGORICAL = ("OP_UNIQUE_CARRIER", "ORIGIN", "DEST", "time_block")
ML_TEST_FRACTION = 0.20
ML_SEED = 42
LR_MAX_ITER = 500
RF_TREES = 150
RF_MAX_DEPTH = 12
TOP_FEATURES = 20
TOP_AIRPORTS_CHART = 15
