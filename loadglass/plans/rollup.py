"""One grouping of the log that all reports can be computed from.

A rollup has one row per day, hour, service, endpoint, status, outcome and
latency, with the number of requests. Counts add up, so a day is rolled up on its
own and replaced on its own, and the reports read the rollup instead of the log:
one scan of the log instead of one per report.
"""

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadglass import schema
from loadglass.functions.calendar import day_name, is_peak
from loadglass.operators.aggregate import request_count
from loadglass.sources.ledger import live_folders
from loadglass.sources.logs import empty_days

KEYS = [
    "date", "hour", "service", "endpoint", "status_code", "error", "response_time_ms",
]

ROLLUP = T.StructType(
    [field for name in KEYS for field in schema.CLEAN_LOG.fields if field.name == name]
    + [T.StructField("requests", T.LongType())]
)


def roll_up(log: DataFrame) -> DataFrame:
    """A clean log, or several rollups put together, to one rollup."""
    return log.groupBy(*KEYS).agg(request_count(log).alias("requests"))


def with_calendar(rollup: DataFrame) -> DataFrame:
    """Add the calendar columns that follow from the date and the hour."""
    weekday = F.weekday("date")
    return rollup.withColumns(
        {
            "day_of_week": day_name("weekday(date)"),
            "day_of_week_num": weekday,
            "is_weekend": weekday >= 5,
            "is_peak_hour": is_peak(F.col("hour")),
        }
    )


def write_rollup(
    log: DataFrame, path: str, days: Sequence[datetime.date] = ()
) -> None:
    """Write the rollup by date, replacing only the days the log covers and those in
    ``days``, which become empty if the log has no rows for them.

    Writing a day again therefore gives the same table.
    """
    rolled = roll_up(log)
    (
        rolled.hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )
    empty_days(rolled, path, days)


def read_folders(spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame:
    """Those of the ``folders`` of a rollup, by date below each of them."""
    reader = spark.read.schema(ROLLUP).option("basePath", path)
    return reader.parquet(*folders).select(ROLLUP.names)


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """A written rollup as input for the reports, by days or, from a stream, by batches."""
    folders = live_folders(spark, path)
    if folders == []:
        raise ValueError(f"the ledger of {path} has no batch")
    return with_calendar(read_folders(spark, path, folders or [path]))
