"""Which endpoints and services are slow or failing?"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadglass.functions import labels
from loadglass.functions.numeric import coarse_percent, round_half_even
from loadglass.operators.aggregate import P95, mean_latency, profile, quantile, totals


def endpoint_performance(log: DataFrame) -> DataFrame:
    """The published endpoint table, slowest 95th percentile first."""
    return (
        profile(log, "service", "endpoint")
        .select(
            "service",
            "endpoint",
            round_half_even(mean_latency()).alias("mean_ms"),
            round_half_even(quantile(0)).alias("median_ms"),
            round_half_even(quantile(1)).alias("p95_ms"),
            F.col("timed_requests").alias("request_count"),
            coarse_percent(F.col("errors"), F.col("requests")).alias("error_rate"),
        )
        .orderBy(F.desc("p95_ms"), "service", "endpoint")
    )


def slowest_endpoint(log: DataFrame) -> DataFrame:
    return endpoint_performance(log).limit(1)


def service_summary(log: DataFrame) -> DataFrame:
    return (
        profile(log, "service", quantiles=[P95])
        .select(
            "service",
            round_half_even(mean_latency()).alias("mean_ms"),
            round_half_even(quantile(0)).alias("p95_ms"),
            coarse_percent(F.col("errors"), F.col("requests")).alias("error_rate"),
            F.col("requests").alias("total_requests"),
        )
        .orderBy("service")
    )


def endpoint_dashboard(log: DataFrame) -> DataFrame:
    """Endpoints for the dashboard chart, fastest mean first."""
    return (
        profile(log, "service", "endpoint", quantiles=[P95])
        .select(
            "service",
            "endpoint",
            round_half_even(mean_latency()).alias("mean_ms"),
            round_half_even(quantile(0)).alias("p95_ms"),
            coarse_percent(F.col("errors"), F.col("requests")).alias("error_rate"),
            "requests",
            F.concat("service", "endpoint").alias("full_endpoint"),
        )
        .orderBy("mean_ms", "service", "endpoint")
    )


def endpoint_severity(log: DataFrame) -> DataFrame:
    """Endpoints by error rate, lowest first, with a severity band."""
    return (
        totals(log, "service", "endpoint")
        .select(
            F.concat("service", "endpoint").alias("full_endpoint"),
            coarse_percent(F.col("errors"), F.col("requests")).alias("error_rate"),
        )
        .withColumn("severity", labels.severity(F.col("error_rate")))
        .orderBy("error_rate", "full_endpoint")
    )
