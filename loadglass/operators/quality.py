"""Data-quality reports over the raw and the clean log."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadglass.functions.numeric import percent
from loadglass.operators.aggregate import LATENCY
from loadglass.operators.cleaning import (
    INVALID_STATUS,
    reject_reason,
)


def reject_report(raw: DataFrame) -> DataFrame:
    """Rejected rows per rule, in one pass."""
    return (
        raw.select(reject_reason(raw).alias("reject_reason"))
        .filter(F.col("reject_reason").isNotNull())
        .groupBy("reject_reason")
        .agg(F.count(F.lit(1)).alias("rejected"))
        .orderBy("reject_reason")
    )


def invalid_codes(raw: DataFrame) -> DataFrame:
    """Distinct status codes of the rows that ``reject_report`` counts as such. A missing
    code is invalid too."""
    return (
        raw.filter(reject_reason(raw) == INVALID_STATUS)
        .select("status_code")
        .distinct()
        .orderBy("status_code")
    )


def removal_summary(raw: DataFrame) -> DataFrame:
    """Rows in, rows removed and the percentage, in one pass."""
    removed = F.count_if(F.col("reject_reason").isNotNull())
    rows = F.count(F.lit(1))
    return raw.select(reject_reason(raw).alias("reject_reason")).agg(
        rows.alias("rows_in"),
        (rows - removed).alias("rows_kept"),
        removed.alias("rows_removed"),
        percent(removed, rows).alias("removed_percent"),
    )


def null_counts(log: DataFrame) -> DataFrame:
    """Missing values per column, in one pass."""
    counted = log.agg(
        *[F.count_if(F.col(name).isNull()).alias(name) for name in log.columns]
    )
    return counted.unpivot([], log.columns, "column_name", "null_count").orderBy(
        "column_name"
    )


def validation_ranges(log: DataFrame) -> DataFrame:
    """Latency and time range, status codes and services present, in one row.

    The inner grouping leaves one row per service and status for the sets.
    """
    per_group = log.groupBy("service", "status_code").agg(
        F.min(LATENCY).alias("min_ms"),
        F.max(LATENCY).alias("max_ms"),
        F.min("timestamp").alias("first_request"),
        F.max("timestamp").alias("last_request"),
    )
    return per_group.agg(
        F.min("min_ms").alias("min_ms"),
        F.max("max_ms").alias("max_ms"),
        F.array_join(
            F.array_sort(F.collect_set("status_code")).cast("array<string>"), ","
        ).alias("status_codes"),
        F.min("first_request").alias("first_request"),
        F.max("last_request").alias("last_request"),
        F.array_join(F.array_sort(F.collect_set("service")), ",").alias("services"),
    )
