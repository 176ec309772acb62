"""How fast are requests, and how does that change over the day?"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadglass.functions.numeric import coarse_percent, round_half_even
from loadglass.operators.aggregate import (
    LATENCY,
    MEDIAN,
    P90,
    P95,
    P99,
    centre,
    frequency,
    mean_latency,
    narrowed,
    profile,
    profile_columns,
    quantile,
    sample_deviation,
    spread_columns,
)
from loadglass.operators.order import in_order


def response_time_stats(log: DataFrame) -> DataFrame:
    """Mean, median, sample deviation, percentiles and maximum of all requests."""
    quantiles = [MEDIAN, P90, P95, P99]
    frequencies = frequency(log)
    return (
        narrowed(frequencies, quantiles=quantiles)
        .withColumn("centre", centre(frequencies))
        .agg(
            *profile_columns(quantiles),
            *spread_columns("centre"),
            F.max(LATENCY).alias("max_ms"),
        )
        .select(
            mean_latency().alias("mean_ms"),
            quantile(0).alias("median_ms"),
            sample_deviation().alias("std_ms"),
            quantile(0).alias("p50_ms"),
            quantile(1).alias("p90_ms"),
            quantile(2).alias("p95_ms"),
            quantile(3).alias("p99_ms"),
            "max_ms",
        )
    )


def response_by_hour(log: DataFrame) -> DataFrame:
    return (
        profile(log, "hour")
        .select(
            "hour",
            round_half_even(mean_latency()).alias("mean_ms"),
            round_half_even(quantile(0)).alias("median_ms"),
            round_half_even(quantile(1)).alias("p95_ms"),
        )
        .transform(in_order, "hour")
    )


def daily_response(log: DataFrame) -> DataFrame:
    """Mean and 95th percentile per day, not rounded."""
    return (
        profile(log, "date", quantiles=[P95])
        .select(
            "date",
            mean_latency().alias("mean_ms"),
            quantile(0).alias("p95_ms"),
        )
        .transform(in_order, "date")
    )


def response_trend(log: DataFrame) -> DataFrame:
    return (
        profile(log, "date")
        .select(
            "date",
            round_half_even(mean_latency()).alias("mean_ms"),
            round_half_even(quantile(0)).alias("median_ms"),
            round_half_even(quantile(1)).alias("p95_ms"),
        )
        .transform(in_order, "date")
    )


def daily_metrics(log: DataFrame) -> DataFrame:
    """The published daily table."""
    return (
        profile(log, "date")
        .select(
            "date",
            round_half_even(mean_latency()).alias("mean_rt_ms"),
            round_half_even(quantile(0)).alias("median_rt_ms"),
            round_half_even(quantile(1)).alias("p95_rt_ms"),
            coarse_percent(F.col("errors"), F.col("requests")).alias("error_rate"),
            F.col("errors").alias("error_count"),
            F.col("requests").alias("total_requests"),
        )
        .transform(in_order, "date")
    )


def hourly_metrics(log: DataFrame) -> DataFrame:
    """The published hourly table."""
    return (
        profile(log, "hour", quantiles=[P95])
        .select(
            "hour",
            round_half_even(mean_latency()).alias("mean_rt_ms"),
            round_half_even(quantile(0)).alias("p95_rt_ms"),
            coarse_percent(F.col("errors"), F.col("requests")).alias("error_rate"),
            F.col("requests").alias("total_requests"),
        )
        .transform(in_order, "hour")
    )
