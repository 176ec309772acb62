"""Schemas and fixed values of the request-log model.

Everything here is a constant of the data model. The lookup tables are small
by construction (12 endpoints at most), so the DataFrames made from them may
be broadcast at any log size.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RAW_LOG = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("service", T.StringType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("response_time_ms", T.LongType()),
        T.StructField("status_code", T.LongType()),
        T.StructField("error", T.BooleanType()),
    ]
)

CALENDAR = T.StructType(
    [
        T.StructField("hour", T.IntegerType()),
        T.StructField("day_of_week", T.StringType()),
        T.StructField("day_of_week_num", T.IntegerType()),
        T.StructField("date", T.DateType()),
        T.StructField("is_weekend", T.BooleanType()),
        T.StructField("is_peak_hour", T.BooleanType()),
    ]
)

CLEAN_LOG = T.StructType(RAW_LOG.fields + CALENDAR.fields)

# The text of a line that does not have the fields of a log; NULL for a line that has. Only
# raw logs from text have this column.
MALFORMED = "malformed_line"

# An optional natural key. Sampling needs it, the reports do not.
EVENT_ID = T.StructField("event_id", T.LongType())


def with_event_id(schema: T.StructType) -> T.StructType:
    return T.StructType([EVENT_ID] + schema.fields)


# ---- Fixed values: they must equal the published model -----------------------

SERVICES = ["auth", "events", "payments"]

DAY_NAMES = [
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
]

# Both ends inclusive: 18:00 up to 22:59.
PEAK_FIRST_HOUR = 18
PEAK_LAST_HOUR = 22

PEAK_LABEL = "Peak"
PEAK_LABEL_LONG = "Peak (6-10 PM)"
OFF_PEAK_LABEL = "Off-Peak"

VALID_STATUS_CODES = [200, 201, 400, 401, 403, 404, 500, 502, 503]

# The status chart shows these only; 201 is valid but has no bar.
REPORT_STATUS_CODES = [200, 400, 401, 403, 404, 500, 502, 503]

# service, slot, endpoint, base latency in ms, base error rate, weight in the service
ENDPOINTS = [
    ("auth", 0, "/login", 80, 0.03, 0.60),
    ("auth", 1, "/register", 150, 0.05, 0.15),
    ("auth", 2, "/logout", 30, 0.01, 0.20),
    ("auth", 3, "/reset-password", 200, 0.08, 0.05),
    ("events", 0, "/list", 100, 0.02, 0.50),
    ("events", 1, "/create", 120, 0.04, 0.25),
    ("events", 2, "/update", 90, 0.03, 0.15),
    ("events", 3, "/delete", 70, 0.02, 0.10),
    ("payments", 0, "/checkout", 300, 0.06, 0.40),
    ("payments", 1, "/refund", 250, 0.07, 0.10),
    ("payments", 2, "/history", 150, 0.02, 0.35),
    ("payments", 3, "/verify", 180, 0.04, 0.15),
]

# service, requests per hour at multiplier 1
SERVICE_BASE_REQUESTS = [("auth", 150), ("events", 100), ("payments", 50)]

# name, first hour, last hour, multiplier; the first match wins
TRAFFIC_BANDS = [
    ("evening", 18, 22, 2.5),
    ("lunch", 12, 14, 1.5),
    ("business", 9, 17, 1.2),
    ("night", 2, 6, 0.3),
]
OTHER_BAND = ("other", 0.8)

# first weekday, last weekday (0 = Monday), multiplier
DAY_MULTIPLIERS = [(5, 6, 0.7), (0, 0, 1.1), (4, 4, 1.2)]
OTHER_DAY_MULTIPLIER = 1.0

LATENCY_LOAD_FACTOR = 0.4
ERROR_LOAD_FACTOR = 0.5
MAX_ERROR_RATE = 0.25
# latency over this multiple of the base -> factor on the error rate
SLOW_ERROR_FACTORS = [(3, 1.5), (2, 1.2)]

# status code, share among errors
ERROR_CODE_WEIGHTS = [
    (400, 0.25), (401, 0.15), (403, 0.10), (404, 0.15),
    (500, 0.20), (502, 0.05), (503, 0.10),
]

INCIDENT_DAY = 5
INCIDENT_FIRST_HOUR = 14
INCIDENT_LAST_HOUR = 14
BAD_LATENCY = -1
BAD_STATUS = 999

HISTOGRAM_BINS = 50

# ------------------------------------------------------------------------------


def _inline(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """Constants as an inline table, whose exact size the optimizer knows."""

    def literal(value: object) -> str:
        return f"{value!r}D" if isinstance(value, float) else repr(value)

    values = ", ".join(f"({', '.join(map(literal, row))})" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


def endpoint_dim(spark: SparkSession) -> DataFrame:
    """The 12 known endpoints with their load-model constants."""
    return _inline(
        spark, ENDPOINTS, "service, slot, endpoint, base_ms, base_error_rate, weight"
    )


def service_dim(spark: SparkSession) -> DataFrame:
    """The 3 known services with their base traffic."""
    return _inline(spark, SERVICE_BASE_REQUESTS, "service, base_requests")


def error_code_dim(spark: SparkSession) -> DataFrame:
    """The 7 error codes with their configured share among errors."""
    return _inline(spark, ERROR_CODE_WEIGHTS, "status_code, weight")
