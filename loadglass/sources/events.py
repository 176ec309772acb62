"""Request logs derived from a generic ``events`` table.

``events`` has an id, a time, a user, a type, a value and a JSON text with the
integer ``k``. The mapping is arithmetic on those, so any engine can repeat it.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadglass import schema

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

ERROR_CODES = [code for code, _ in schema.ERROR_CODE_WEIGHTS]


def _constants(values: Sequence) -> str:
    return f"array({', '.join(repr(value) for value in values)})"


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{folder.rstrip('/')}/events.parquet")


def to_raw_log(events: DataFrame) -> DataFrame:
    """One raw request per event, with its id and the known defects.

    Service and endpoint are looked up in constant arrays, which needs no join.
    """
    endpoints = _constants([row[2] for row in schema.ENDPOINTS])
    return events.selectExpr(
        "event_id",
        "ts",
        "event_type",
        "value",
        "CAST(pmod(user_id, 3) AS INT) AS service_no",
        "try_cast(get_json_object(props, '$.k') AS INT) AS k",
    ).selectExpr(
        "event_id",
        "ts AS timestamp",
        f"element_at({_constants(schema.SERVICES)}, service_no + 1) AS service",
        f"element_at({endpoints}, service_no * 4 + pmod(k, 4) + 1) AS endpoint",
        f"""CASE WHEN event_id % 1000 = 7 THEN {schema.BAD_LATENCY}L
            ELSE greatest(10L, CAST(floor(value * 3) AS BIGINT)) END AS response_time_ms""",
        f"""CAST(CASE WHEN event_id % 2000 = 11 THEN {schema.BAD_STATUS}
            WHEN event_type = 'error' AND k % 5 = 0
              THEN element_at({_constants(ERROR_CODES)}, CAST(pmod(k DIV 5, 7) AS INT) + 1)
            WHEN event_type = 'signup' THEN 201
            ELSE 200 END AS BIGINT) AS status_code""",
        "event_type = 'error' AND k % 5 = 0 AS error",
    )


def raw_log(spark: SparkSession, folder: str) -> DataFrame:
    return to_raw_log(read_events(spark, folder))


def with_large_latencies(raw: DataFrame) -> DataFrame:
    """The log with latencies that need up to 64 bits, in three of a thousand rows."""
    case = F.col("event_id") % 1000
    large = {1: 4_000_000_000, 2: 200_000_000_000_000_000, 3: 9_000_000_000_000_000_000}
    latency = F.col("response_time_ms")
    for number, value in large.items():
        latency = F.when(case == number, F.lit(value)).otherwise(latency)
    return raw.withColumn("response_time_ms", latency)


def lines_with_defects(raw: DataFrame) -> DataFrame:
    """The log as lines of text, in which some of every hundred lack fields, have more, or
    have a quote that is not closed; others quote a value, which is allowed."""
    text = as_text(raw)
    names = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in text.columns]
    line = F.concat_ws(",", *names)
    short = F.concat_ws(",", *names[:-1])
    start = F.concat_ws(",", *names[:2])
    rest = F.concat_ws(",", *names[3:])
    case = F.col("event_id") % 100
    return text.select(
        F.when(case == 21, F.concat(line, F.lit(',x,"y,z"')))
        .when(case == 22, short)
        .when(case == 23, F.concat(start, F.lit(',"'), names[2], F.lit(","), rest))
        .when(case == 24, names[0])
        .when(case == 25, F.concat(line, F.lit(",")))
        .when(case == 26, F.concat(start, F.lit(',"'), names[2], F.lit('",'), rest))
        .when(case == 27, F.lit(""))
        .otherwise(line)
        .alias("value")
    )


def as_text(raw: DataFrame) -> DataFrame:
    """A typed log as the text columns of a CSV file."""
    return raw.select(
        *[
            F.col(field.name).cast("string").alias(field.name)
            if field.name != "event_id"
            else F.col("event_id")
            for field in raw.schema.fields
        ]
    )
