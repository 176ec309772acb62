"""How do the evening peak hours differ from the rest?"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadglass import schema
from loadglass.functions import labels
from loadglass.functions.numeric import (
    coarse_percent,
    percent_change,
    round_half_even,
)
from loadglass.operators.aggregate import mean_latency, profile, quantile, totals
from loadglass.operators.order import in_order
from loadglass.plans.errors import error_percent


def peak_vs_offpeak(log: DataFrame) -> DataFrame:
    return (
        profile(log, "is_peak_hour")
        .select(
            labels.period(F.col("is_peak_hour"), schema.PEAK_LABEL).alias("period"),
            round_half_even(mean_latency()).alias("mean_ms"),
            round_half_even(quantile(0)).alias("median_ms"),
            round_half_even(quantile(1)).alias("p95_ms"),
            coarse_percent(F.col("errors"), F.col("requests")).alias("error_rate"),
            F.col("requests").alias("request_count"),
        )
        .transform(in_order, "period")
    )


def peak_degradation(log: DataFrame) -> DataFrame:
    """Change from off-peak to peak in percent, from the rounded figures.

    NULL when the log has only one of the two periods.
    """

    def change(measure: str) -> Column:
        def during(label: str) -> Column:
            return F.max(F.when(F.col("period") == label, F.col(measure)))

        return percent_change(
            during(schema.PEAK_LABEL), during(schema.OFF_PEAK_LABEL)
        )

    # The 95th percentile and the median are not compared, so only totals are needed.
    compared = totals(log, "is_peak_hour").select(
        labels.period(F.col("is_peak_hour"), schema.PEAK_LABEL).alias("period"),
        round_half_even(mean_latency()).alias("mean_ms"),
        coarse_percent(F.col("errors"), F.col("requests")).alias("error_rate"),
        F.col("requests").alias("request_count"),
    )
    return compared.agg(
        change("mean_ms").alias("response_time_increase"),
        change("error_rate").alias("error_rate_increase"),
        change("request_count").alias("traffic_increase"),
    )


def peak_comparison(log: DataFrame) -> DataFrame:
    """Mean latency and error rate of both periods, not rounded."""
    return (
        totals(log, "is_peak_hour")
        .select(
            "is_peak_hour",
            mean_latency().alias("response_time_ms"),
            error_percent().alias("error"),
            labels.period(F.col("is_peak_hour")).alias("period"),
        )
        .transform(in_order, "is_peak_hour")
    )


def metric_labels(log: DataFrame) -> DataFrame:
    """The texts printed on the peak charts."""
    return (
        totals(log, "is_peak_hour")
        .select(
            labels.period(F.col("is_peak_hour")).alias("period"),
            labels.millis_label(mean_latency()).alias("latency_label"),
            labels.percent_label(error_percent()).alias("error_label"),
            labels.count_label(F.col("requests")).alias("requests_label"),
        )
        .transform(in_order, "period")
    )
