"""Request logs in CSV or Parquet, always read with a fixed schema."""

import datetime
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadglass import schema
from loadglass.operators.cleaning import parse_log

# Fractions of a second are kept; Spark's own default writes milliseconds only.
CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def text_schema(columns: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns.names])


def read_raw_text(
    spark: SparkSession,
    path: str,
    event_id: bool = False,
    header: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """A raw CSV log as text columns, nothing parsed and nothing dropped.

    A header must name the columns in order. A line with too many or too few fields, or with
    a quote that is not closed, is in ``schema.MALFORMED`` as it stands; the clean stage
    rejects it. With ``multi_line`` a quoted value may hold line breaks, but a file is then
    read by one task, so by default each line is a request.
    """
    columns = schema.with_event_id(schema.RAW_LOG) if event_id else schema.RAW_LOG
    return (
        spark.read.schema(text_schema(columns).add(schema.MALFORMED, T.StringType()))
        .option("header", header)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schema.MALFORMED)
        .option("multiLine", multi_line)
        # With fewer columns read, fields would not be counted.
        .option("columnPruning", False)
        .csv(path)
    )


def read_raw_log(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    event_id: bool = False,
    header: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """A raw log. From CSV, latency and status are doubles, and malformed lines and values
    that do not parse are rejected, with the reason, by the clean stage. Integer columns of
    Parquet files of any width are read as BIGINT.
    """
    if fmt == "csv":
        typed = parse_log(read_raw_text(spark, path, event_id, header, multi_line))
        if event_id:
            typed = typed.withColumn("event_id", F.col("event_id").try_cast("bigint"))
        return typed
    columns = schema.with_event_id(schema.RAW_LOG) if event_id else schema.RAW_LOG
    return spark.read.schema(columns).format(fmt).load(path)


def read_strict_raw_log(spark: SparkSession, path: str) -> DataFrame:
    """A raw CSV log that ends the job at the first value that does not parse."""
    return (
        spark.read.schema(schema.RAW_LOG)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_clean_log(
    spark: SparkSession, path: str, fmt: str = "parquet", event_id: bool = False
) -> DataFrame:
    """A clean log as the writers of this module leave it.

    For Parquet, a filter on ``date`` prunes whole directories.
    """
    columns = schema.with_event_id(schema.CLEAN_LOG) if event_id else schema.CLEAN_LOG
    reader = spark.read.schema(columns)
    if fmt == "csv":
        reader = (
            reader.option("header", True)
            .option("enforceSchema", False)
            .option("timestampNTZFormat", CSV_TIMESTAMP)
            .option("mode", "FAILFAST")
        )
    return reader.format(fmt).load(path).select(columns.names)


def write_csv_log(log: DataFrame, path: str) -> None:
    """Any log as CSV with a header, in several files and in no order."""
    log.write.mode("overwrite").option("header", True).option(
        "timestampNTZFormat", CSV_TIMESTAMP
    ).csv(path)


def write_sorted_csv_log(log: DataFrame, path: str) -> None:
    """A clean log as CSV, sorted by time across its files (range partitioned)."""
    write_csv_log(log.orderBy("timestamp"), path)


def empty_days(log: DataFrame, path: str, days: Sequence[datetime.date]) -> None:
    """Empty those of the named days at ``path`` that the log has no rows for.

    Writing by date replaces only days with rows, so a day that lost its last row would
    keep its old ones. The driver sees no more days than it was given.
    """
    if not days:
        return
    present = log.filter(F.col("date").isin(list(days))).select("date").distinct().collect()
    for day in sorted(set(days) - {row["date"] for row in present}):
        log.limit(0).drop("date").write.mode("overwrite").parquet(
            f"{path.rstrip('/')}/date={day.isoformat()}"
        )


def write_clean_log(
    log: DataFrame,
    path: str,
    keep_other_days: bool = False,
    days: Sequence[datetime.date] = (),
    watch: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """A clean log as Parquet by date, sorted by time within each file.

    ``keep_other_days`` replaces only the days in ``log``, for daily runs, and those in
    ``days``, which become empty if the log has no rows for them.
    ``rebalance`` lets adaptive execution cut a day that holds much of the log
    into several tasks of even size, and merge small days.
    ``watch`` sees the rows in the last stage of the write, see ``plans.gathered``.
    """
    (
        watch(log.hint("rebalance", "date"))
        .sortWithinPartitions("date", "timestamp")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if keep_other_days else "static")
        .partitionBy("date")
        .parquet(path)
    )
    empty_days(log, path, days if keep_other_days else ())


def write_table(report: DataFrame, path: str) -> None:
    """A finished report as one CSV file in its own order.

    For reports whose size is bounded by the clock, the calendar or the endpoints.
    """
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_table(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """A report as ``write_table`` leaves it."""
    return (
        spark.read.schema(columns).option("header", True).option("mode", "FAILFAST").csv(path)
    )
