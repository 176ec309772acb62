"""The named queries over a folder of test tables.

Each takes a session and a folder. Figures the reports leave unrounded are rounded
to six digits here, because two engines may differ in the last bits of a percentile.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadglass import schema
from loadglass.functions.numeric import round_half_even
from loadglass.operators import (
    cleaning,
    heavy,
    histogram,
    incidents,
    quality,
    sampling,
    windows,
)
from loadglass.operators.aggregate import mean_latency, profile, quantile, totals
from loadglass.plans import (
    bundles,
    endpoints,
    errors,
    expectations,
    gathered,
    latency,
    peak,
    rollup,
    shared,
    sketches,
    summary,
    traffic,
)
from loadglass.session import scratch_folder
from loadglass.sources import events, logs
from loadglass.streaming import rollup_stream

Query = Callable[[SparkSession, str], DataFrame]


def six_digits(result: DataFrame) -> DataFrame:
    return result.withColumns(
        {
            field.name: round_half_even(F.col(field.name), 6)
            for field in result.schema.fields
            if field.dataType == T.DoubleType()
        }
    )


def over_raw(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(events.raw_log(spark, folder))


def over_clean(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(
        cleaning.clean_log(events.raw_log(spark, folder))
    )


def over_clean_unrounded(report: Callable[[DataFrame], DataFrame]) -> Query:
    return over_clean(lambda log: six_digits(report(log)))


def src_raw_log(spark: SparkSession, folder: str) -> DataFrame:
    """The raw log through a CSV file and back."""
    path = scratch_folder(spark, "raw-csv")
    logs.write_csv_log(events.raw_log(spark, folder), path)
    raw = logs.read_raw_log(spark, path, event_id=True)
    return cleaning.whole_numbers(cleaning.well_formed(raw))


def defective_text(spark: SparkSession, folder: str) -> DataFrame:
    """The raw log from lines of text with defects."""
    path = scratch_folder(spark, "lines")
    events.lines_with_defects(events.raw_log(spark, folder)).write.text(path)
    return logs.read_raw_log(spark, path, event_id=True, header=False)


def malformed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The lines that are no requests, as they stand, and why."""
    return (
        cleaning.rejected_log(defective_text(spark, folder))
        .filter(F.col(schema.MALFORMED).isNotNull())
        .select(F.col(schema.MALFORMED).alias("line"), "reject_reason")
    )


def malformed_report(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected rows per rule, malformed lines among them."""
    return quality.reject_report(defective_text(spark, folder))


def clean_from_lines(spark: SparkSession, folder: str) -> DataFrame:
    """What the clean stage keeps of the same lines."""
    return cleaning.clean_log(defective_text(spark, folder)).select(
        "event_id", "service", "response_time_ms", "status_code", "error"
    )


def eleven_digits(result: DataFrame, *names: str) -> DataFrame:
    """Figures as text in eleven significant digits, for those beyond six decimals."""
    return result.withColumns({name: F.format_string("%.10e", name) for name in names})


def large_latency_stats(raw: DataFrame) -> DataFrame:
    """Totals and spread of a log with latencies of up to 64 bits."""
    log = cleaning.clean_log(events.with_large_latencies(raw))
    total = totals(log).select(F.struct("requests", "total_ms")).scalar()
    figures = latency.response_time_stats(log).withColumn("total", total)
    return eleven_digits(
        figures.select(
            "*",
            F.col("total.requests").alias("requests"),
            F.col("total.total_ms").cast("string").alias("total_ms"),
        ).drop("total"),
        "mean_ms", "median_ms", "std_ms", "p50_ms", "p90_ms", "p95_ms", "p99_ms",
    )


def large_latency_endpoints(raw: DataFrame) -> DataFrame:
    log = cleaning.clean_log(events.with_large_latencies(raw))
    figures = profile(log, "service", "endpoint").select(
        "service",
        "endpoint",
        F.col("total_ms").cast("string").alias("total_ms"),
        mean_latency().alias("mean_ms"),
        quantile(0).alias("median_ms"),
        quantile(1).alias("p95_ms"),
        "requests",
    )
    return eleven_digits(figures, "mean_ms", "median_ms", "p95_ms")


def large_latency_histogram(raw: DataFrame) -> DataFrame:
    log = cleaning.clean_log(events.with_large_latencies(raw))
    return eleven_digits(histogram.latency_histogram(log), "bucket_start", "bucket_end")


def shared_scan(name: str) -> Query:
    """A report from the counts that one scan of the clean log makes for all reports."""
    return over_clean(
        lambda log: shared.SharedScan(log, [*shared.REPORTS, *shared.WHOLE_LOG]).table(name)
    )


def shared_scan_unrounded(name: str) -> Query:
    return lambda spark, folder: six_digits(shared_scan(name)(spark, folder))


def incidents_by_window(log: DataFrame) -> DataFrame:
    """Windows of each day of the log: an hour, one that overlaps with those of other days,
    seven minutes, and one long after the log."""
    spans = {
        "hour": ("14 hours", "15 hours"),
        "days": ("12 hours", "70 hours"),
        "minutes": ("9 hours", "9 hours 7 minutes"),
        "later": ("9000 days", "9001 days"),
    }
    days = log.select("date").distinct()
    tables = [
        days.selectExpr(
            f"concat('{label} ', date) AS label",
            f"CAST(date AS TIMESTAMP_NTZ) + INTERVAL {start} AS start",
            f"CAST(date AS TIMESTAMP_NTZ) + INTERVAL {end} AS end",
        )
        for label, (start, end) in spans.items()
    ]
    return windows.incidents_by_window(log, reduce(DataFrame.unionByName, tables))


def daily_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The clean log as written cells."""
    path = scratch_folder(spark, "cells")
    sketches.write_cells(cleaning.clean_log(events.raw_log(spark, folder)), path)
    return sketches.read_cells(spark, path)


def daily_percentiles_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return sketches.daily_percentiles_sketch(daily_cells(spark, folder))


def endpoint_percentiles_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and exact figures only: of this many requests percentiles are estimates."""
    return sketches.endpoint_percentiles_sketch(daily_cells(spark, folder)).drop(
        "p50_ms", "p95_ms", "p99_ms"
    )


def kept(frame: DataFrame, purpose: str) -> DataFrame:
    """A summary as a table that is kept."""
    path = scratch_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def distinct_days_by_endpoint(log: DataFrame) -> DataFrame:
    days = kept(sketches.active_days(log, "service", "endpoint"), "days")
    return sketches.distinct_days(days, "service", "endpoint")


def distinct_keys_by_month(log: DataFrame) -> DataFrame:
    """From sketches per day."""
    seen = kept(sketches.seen_keys(log, "date"), "seen")
    return sketches.distinct_keys(
        seen.withColumn("month", F.trunc("date", "month")), "month"
    )


def top_endpoints(log: DataFrame) -> DataFrame:
    return heavy.top_keys(log, "service", "endpoint", k=5)


def top_users(spark: SparkSession, folder: str) -> DataFrame:
    """An open key set: the users with most events."""
    return heavy.top_keys(events.read_events(spark, folder), "user_id", k=20)


def src_clean_log(spark: SparkSession, folder: str) -> DataFrame:
    """The clean log through a CSV file and back."""
    path = scratch_folder(spark, "clean-csv")
    logs.write_csv_log(cleaning.clean_log(events.raw_log(spark, folder)), path)
    return logs.read_clean_log(spark, path, fmt="csv", event_id=True)


def sink_clean_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The clean log through Parquet by date and back."""
    path = scratch_folder(spark, "clean-parquet")
    logs.write_clean_log(cleaning.clean_log(events.raw_log(spark, folder)), path)
    return logs.read_clean_log(spark, path, event_id=True)


def daily_metrics_via_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """The daily table from a written rollup instead of the log."""
    path = scratch_folder(spark, "rollup")
    rollup.write_rollup(cleaning.clean_log(events.raw_log(spark, folder)), path)
    return latency.daily_metrics(rollup.read_rollup(spark, path))


def parse_timestamps(raw: DataFrame) -> DataFrame:
    """Timestamps from text, where every 500th text is broken."""
    text = events.as_text(raw).withColumn(
        "timestamp",
        F.when(F.col("event_id") % 500 == 3, F.concat(F.lit("x"), "timestamp")).otherwise(
            F.col("timestamp")
        ),
    )
    return cleaning.parse_timestamps(text).select("event_id", "timestamp")


def ensure_dtypes(raw: DataFrame) -> DataFrame:
    """Types from text, with Python-style flags and decimal latencies."""
    text = events.as_text(raw).withColumns(
        {
            "response_time_ms": F.concat("response_time_ms", F.lit(".0")),
            "error": F.initcap("error"),
        }
    )
    return cleaning.ensure_dtypes(text).select(
        "event_id", "response_time_ms", "status_code", "error"
    )


def clean_from_text(raw: DataFrame) -> DataFrame:
    """The clean stage from text in which every hundred rows have each kind of trouble:
    what is kept, and of the rest the reason."""
    case = F.col("event_id") % 100

    def changed(name: str, texts: dict[int, str]):
        column = F.col(name)
        for number, text in texts.items():
            column = F.when(case == number, F.lit(text)).otherwise(column)
        return column

    text = events.as_text(raw).withColumns(
        {
            "timestamp": F.when(case == 5, F.concat("timestamp", F.lit("-05:00"))).otherwise(
                F.col("timestamp")
            ),
            "response_time_ms": changed(
                "response_time_ms",
                {1: "3000000000", 2: "-0.5", 3: "abc", 4: "12.7", 6: "1e30", 9: "NaN"},
            ),
            "status_code": changed("status_code", {8: "200.7", 12: "200.0", 13: "x"}),
            "error": F.when(case == 15, F.lit("")).otherwise(F.initcap("error")),
        }
    )
    parsed = cleaning.parse_log(text)
    names = ["event_id", "response_time_ms", "status_code", "error"]
    kept = cleaning.clean_log(parsed).select(*names, F.lit(None).cast("string").alias("reason"))
    rest = cleaning.rejected_log(parsed).select(
        "event_id",
        *(F.lit(None).cast(kept.schema[name].dataType).alias(name) for name in names[1:]),
        F.col("reject_reason").alias("reason"),
    )
    return kept.unionByName(rest)


def derived_columns(raw: DataFrame) -> DataFrame:
    return cleaning.add_derived_columns(raw).select(
        "event_id", "timestamp", *schema.CALENDAR.names
    )


def sample_n(raw: DataFrame) -> DataFrame:
    """Two independent samples of a fixed size."""
    draws = {
        "latency": sampling.Draw(sampling.fixed_size(0.001), "latency:"),
        "status": sampling.Draw(sampling.fixed_size(0.0005), "status:"),
    }
    return sampling.samples(raw, "event_id", draws).select("sample", "event_id")


def sample_fraction(raw: DataFrame) -> DataFrame:
    """A share of the requests of the incident window."""
    inside = incidents.incident_window(raw)
    return sampling.sample(inside, "event_id", sampling.rounded_fraction(0.3), "incident:")


def sorted_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The clean log through CSV files in order of time and back."""
    path = scratch_folder(spark, "sorted-csv")
    logs.write_sorted_csv_log(cleaning.clean_log(events.raw_log(spark, folder)), path)
    return logs.read_clean_log(spark, path, fmt="csv", event_id=True)


def published_roundtrip(name: str) -> Query:
    """A published table through the file it is kept in and back."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        clean = cleaning.clean_log(events.raw_log(spark, folder))
        table = bundles.published_tables(clean)[name]
        path = scratch_folder(spark, name)
        logs.write_table(table, path)
        return logs.read_table(spark, path, table.schema)

    return query


def gathered_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """What the writes of the clean log and of its rejects gather."""
    raw = events.raw_log(spark, folder)
    clean = cleaning.clean_log(raw)
    kept, removed = gathered.clean_metrics(clean.columns), gathered.reject_metrics()
    logs.write_clean_log(clean, scratch_folder(spark, "clean"), watch=kept.on)
    removed.on(cleaning.rejected_log(raw)).write.parquet(scratch_folder(spark, "rejects"))
    return gathered.tables(spark, kept, removed)


def gathered_table(name: str) -> Query:
    return lambda spark, folder: six_digits(gathered_tables(spark, folder)[name])


def streamed(spark: SparkSession, folder: str) -> tuple[str, str]:
    """The raw log delivered as files, streamed into a rollup and rejects: their folders."""
    files, path, rejects, checkpoint = (
        scratch_folder(spark, f"stream-{name}")
        for name in ["raw", "rollup", "rejects", "checkpoint"]
    )
    logs.write_csv_log(events.raw_log(spark, folder).drop("event_id").repartition(4), files)
    stream = rollup_stream.read_raw_stream(spark, files, files_per_batch=2)
    query = rollup_stream.start_rollup(stream, path, checkpoint, rejects=rejects, fan_in=2)
    query.awaitTermination()
    return path, rejects


def daily_metrics_streamed(spark: SparkSession, folder: str) -> DataFrame:
    path, _ = streamed(spark, folder)
    return latency.daily_metrics(rollup.read_rollup(spark, path))


def reject_report_streamed(spark: SparkSession, folder: str) -> DataFrame:
    path, rejects = streamed(spark, folder)
    rows = rollup_stream.read_rejects(spark, path, rejects)
    return rows.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rejected"))


QUERIES: dict[str, Query] = {
    # sources and sinks
    "daily_metrics_streamed": daily_metrics_streamed,
    "reject_report_streamed": reject_report_streamed,
    "null_counts_gathered": gathered_table("null_counts"),
    "removal_summary_gathered": gathered_table("removal_summary"),
    "reject_report_gathered": gathered_table("reject_report"),
    "src_raw_log": src_raw_log,
    "src_clean_log": src_clean_log,
    "sink_clean_roundtrip": sink_clean_roundtrip,
    "sorted_csv_roundtrip": sorted_csv_roundtrip,
    "endpoint_performance_roundtrip": published_roundtrip("endpoint_performance"),
    "daily_metrics_roundtrip": published_roundtrip("daily_metrics"),
    "hourly_metrics_roundtrip": published_roundtrip("hourly_metrics"),
    # parsing, cleaning and quality
    "malformed_lines": malformed_lines,
    "malformed_report": malformed_report,
    "clean_from_lines": clean_from_lines,
    "parse_timestamps": over_raw(parse_timestamps),
    "ensure_dtypes": over_raw(ensure_dtypes),
    "clean_from_text": over_raw(clean_from_text),
    "derived_columns": over_raw(derived_columns),
    "filter_response_time": over_raw(cleaning.drop_invalid_response_times),
    "filter_status": over_raw(cleaning.drop_invalid_status_codes),
    "clean_log": over_raw(cleaning.clean_log),
    "rejected_log": over_raw(cleaning.rejected_log),
    "reject_report": over_raw(quality.reject_report),
    "invalid_codes": over_raw(quality.invalid_codes),
    "removal_summary": over_raw(lambda raw: six_digits(quality.removal_summary(raw))),
    "null_counts": over_clean(quality.null_counts),
    "validation_ranges": over_clean(quality.validation_ranges),
    "raw_summary": over_raw(lambda raw: six_digits(summary.raw_summary(raw))),
    "clean_summary": over_clean_unrounded(summary.clean_summary),
    # traffic
    "requests_by_hour": over_clean(traffic.requests_by_hour),
    "requests_by_day": over_clean(traffic.requests_by_day),
    "service_counts": over_clean(traffic.service_counts),
    "status_counts": over_clean(traffic.status_counts),
    "service_share": over_clean_unrounded(traffic.service_share),
    "traffic_by_hour": over_clean(traffic.traffic_by_hour),
    "service_distribution": over_clean(traffic.service_distribution),
    "flat_distribution_check": over_clean(traffic.flat_distribution_check),
    "hourly_vs_average": over_clean_unrounded(traffic.hourly_vs_average),
    "hour_labels": over_clean(traffic.hour_labels),
    "peak_ratio": over_clean_unrounded(traffic.peak_ratio),
    "busiest_quietest_hour": over_clean(traffic.busiest_quietest_hour),
    # latency
    "response_time_stats": over_clean_unrounded(latency.response_time_stats),
    "response_by_hour": over_clean(latency.response_by_hour),
    "daily_response": over_clean_unrounded(latency.daily_response),
    "response_trend": over_clean(latency.response_trend),
    "daily_metrics": over_clean(latency.daily_metrics),
    "daily_metrics_via_rollup": daily_metrics_via_rollup,
    "hourly_metrics": over_clean(latency.hourly_metrics),
    "latency_histogram": over_clean_unrounded(histogram.latency_histogram),
    "large_latency_stats": over_raw(large_latency_stats),
    "large_latency_endpoints": over_raw(large_latency_endpoints),
    "large_latency_histogram": over_raw(large_latency_histogram),
    # errors
    "overall_error_rate": over_clean_unrounded(errors.overall_error_rate),
    "error_rate_by_hour": over_clean_unrounded(errors.error_rate_by_hour),
    "daily_errors": over_clean_unrounded(errors.daily_errors),
    "error_status_share": over_clean_unrounded(errors.error_status_share),
    "error_spike_hours": over_clean_unrounded(errors.error_spike_hours),
    "error_heatmap": over_clean_unrounded(errors.error_heatmap),
    "error_heatmap_wide": over_clean_unrounded(errors.error_heatmap_wide),
    "error_by_service": over_clean_unrounded(errors.error_by_service),
    "status_distribution": over_clean(errors.status_distribution),
    # endpoints and services
    "endpoint_performance": over_clean(endpoints.endpoint_performance),
    "slowest_endpoint": over_clean(endpoints.slowest_endpoint),
    "service_summary": over_clean(endpoints.service_summary),
    "endpoint_dashboard": over_clean(endpoints.endpoint_dashboard),
    "endpoint_severity": over_clean(endpoints.endpoint_severity),
    # peak hours
    "peak_vs_offpeak": over_clean(peak.peak_vs_offpeak),
    "peak_degradation": over_clean_unrounded(peak.peak_degradation),
    "peak_comparison": over_clean_unrounded(peak.peak_comparison),
    "metric_labels": over_clean(peak.metric_labels),
    # dashboards
    "kpis": over_clean_unrounded(summary.kpis),
    "summary_dashboard": over_clean_unrounded(summary.summary_dashboard),
    # one scan for all reports
    "kpis_shared_scan": shared_scan_unrounded("kpis"),
    "endpoint_performance_shared_scan": shared_scan("endpoint_performance"),
    "error_heatmap_shared_scan": shared_scan_unrounded("error_heatmap"),
    # summaries that merge
    "daily_percentiles_sketch": daily_percentiles_sketch,
    "endpoint_percentiles_sketch": endpoint_percentiles_sketch,
    "distinct_days_by_endpoint": over_clean(distinct_days_by_endpoint),
    "distinct_keys_by_month": over_clean(distinct_keys_by_month),
    "top_endpoints": over_clean(top_endpoints),
    "top_users": top_users,
    # load model
    "traffic_band": over_clean(expectations.traffic_band),
    "day_multiplier": over_clean(expectations.day_multiplier),
    "expected_vs_observed": over_clean_unrounded(expectations.expected_vs_observed),
    "expected_error_rate": over_clean_unrounded(expectations.expected_error_rate),
    "expected_traffic": over_clean_unrounded(expectations.expected_traffic),
    "endpoint_mix": over_clean_unrounded(expectations.endpoint_mix),
    "error_code_mix": over_clean_unrounded(expectations.error_code_mix),
    # incidents and samples
    "incident_window": over_raw(incidents.incident_window),
    "incidents_by_window": over_clean(incidents_by_window),
    "sample_n": over_raw(sample_n),
    "sample_fraction": over_raw(sample_fraction),
}
