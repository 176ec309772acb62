"""The report sets a run delivers, by name.

All of them take a clean log or, better, its rollup: with a rollup the log itself
is read once however many reports are made. Without one, ``shared`` reads it once for
all reports of the static report and the dashboard.
"""

from pyspark.sql import DataFrame

from loadglass.operators import histogram, quality
from loadglass.plans import (
    endpoints,
    errors,
    expectations,
    latency,
    peak,
    summary,
    traffic,
)


def published_tables(log: DataFrame) -> dict[str, DataFrame]:
    """The three tables that are kept as CSV files."""
    return {
        "endpoint_performance": endpoints.endpoint_performance(log),
        "daily_metrics": latency.daily_metrics(log),
        "hourly_metrics": latency.hourly_metrics(log),
    }


def static_report(log: DataFrame) -> dict[str, DataFrame]:
    """The data behind every chart and printed figure of the static report."""
    return published_tables(log) | {
        "requests_by_hour": traffic.requests_by_hour(log),
        "requests_by_day": traffic.requests_by_day(log),
        "hourly_vs_average": traffic.hourly_vs_average(log),
        "peak_ratio": traffic.peak_ratio(log),
        "response_time_stats": latency.response_time_stats(log),
        "response_by_hour": latency.response_by_hour(log),
        "daily_response": latency.daily_response(log),
        "latency_histogram": histogram.latency_histogram(log),
        "overall_error_rate": errors.overall_error_rate(log),
        "error_spike_hours": errors.error_spike_hours(log),
        "error_rate_by_hour": errors.error_rate_by_hour(log),
        "daily_errors": errors.daily_errors(log),
        "error_status_share": errors.error_status_share(log),
        "status_counts": traffic.status_counts(log),
        "service_share": traffic.service_share(log),
        "service_summary": endpoints.service_summary(log),
        "endpoint_severity": endpoints.endpoint_severity(log),
        "peak_vs_offpeak": peak.peak_vs_offpeak(log),
        "peak_degradation": peak.peak_degradation(log),
        "summary_dashboard": summary.summary_dashboard(log),
    }


def dashboard(log: DataFrame) -> dict[str, DataFrame]:
    """The data behind the interactive dashboard."""
    return {
        "kpis": summary.kpis(log),
        "traffic_by_hour": traffic.traffic_by_hour(log),
        "response_trend": latency.response_trend(log),
        "error_heatmap": errors.error_heatmap_wide(log),
        "endpoint_dashboard": endpoints.endpoint_dashboard(log),
        "service_distribution": traffic.service_distribution(log),
        "flat_distribution_check": traffic.flat_distribution_check(log),
        "error_by_service": errors.error_by_service(log),
        "status_distribution": errors.status_distribution(log),
        "peak_comparison": peak.peak_comparison(log),
        "metric_labels": peak.metric_labels(log),
    }


def load_model(log: DataFrame) -> dict[str, DataFrame]:
    """Observed against expected load."""
    return {
        "traffic_band": expectations.traffic_band(log),
        "day_multiplier": expectations.day_multiplier(log),
        "expected_vs_observed": expectations.expected_vs_observed(log),
        "expected_error_rate": expectations.expected_error_rate(log),
        "expected_traffic": expectations.expected_traffic(log),
        "endpoint_mix": expectations.endpoint_mix(log),
        "error_code_mix": expectations.error_code_mix(log),
    }


def clean_report(raw: DataFrame, clean: DataFrame) -> dict[str, DataFrame]:
    """What the clean stage says about its input and its result."""
    return {
        "raw_summary": summary.raw_summary(raw),
        "removal_summary": quality.removal_summary(raw),
        "reject_report": quality.reject_report(raw),
        "invalid_codes": quality.invalid_codes(raw),
        "null_counts": quality.null_counts(clean),
        "validation_ranges": quality.validation_ranges(clean),
        "clean_summary": summary.clean_summary(clean),
        "service_counts": traffic.service_counts(clean),
    }
