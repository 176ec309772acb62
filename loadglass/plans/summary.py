"""One-row summaries of a whole log, each from a single pass."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadglass.functions.calendar import is_peak
from loadglass.functions.numeric import ratio
from loadglass.operators.aggregate import (
    LATENCY,
    MEDIAN,
    P95,
    P99,
    error_count,
    frequency,
    mean_latency,
    narrowed,
    profile_columns,
    quantile,
    request_count,
    totals,
)
from loadglass.operators.cleaning import well_formed, whole_numbers
from loadglass.plans.errors import error_percent


def _hour_totals() -> Column:
    """Requests of each hour 0 to 23 in an array; NULL for an hour without any."""
    return F.array(
        *[
            F.sum(F.when(F.col("hour") == hour, F.col("time_requests")))
            for hour in range(24)
        ]
    )


def _present_hours() -> Column:
    """The hours that had requests, as structs of hour and requests."""
    numbered = F.transform(
        "hour_totals",
        lambda requests, hour: F.struct(hour.alias("hour"), requests.alias("requests")),
    )
    return F.filter(numbered, lambda cell: cell["requests"].isNotNull())


def _mean_per_hour(hours: Column, during_peak: bool) -> Column:
    """Mean requests over those of the present hours that lie in the period."""
    cells = F.filter(
        hours,
        lambda cell: is_peak(cell["hour"]) if during_peak else ~is_peak(cell["hour"]),
    )
    total = F.aggregate(
        cells, F.lit(0).cast("long"), lambda acc, cell: acc + cell["requests"]
    )
    return ratio(total, F.size(cells))


def _first_hour(hours: Column, most: bool) -> Column:
    """The hour with most (or fewest) requests; of equals the earlier one."""
    sign = -1 if most else 1
    ranked = F.transform(
        hours,
        lambda cell: F.struct(
            (cell["requests"] * sign).alias("order"), cell["hour"].alias("hour")
        ),
    )
    return F.array_min(ranked)["hour"]


def _latency_and_time(log: DataFrame, *time_keys: str) -> DataFrame:
    """Counts per latency and, apart from them, counts per time key.

    One pass with two grouping sets. A task of unordered rows then sends the sum of
    both key counts through the shuffle, where grouping by all keys together would
    send their product. Columns of the other set are NULL, so sums skip them.
    """
    grouped = log.groupingSets([[LATENCY], list(time_keys)], LATENCY, *time_keys).agg(
        request_count(log).alias("all_requests"),
        error_count(log).alias("all_errors"),
        F.grouping(LATENCY).alias("is_time_row"),
    )

    def on(is_time_row: int, column: str) -> Column:
        return F.when(F.col("is_time_row") == is_time_row, F.col(column))

    return grouped.select(
        LATENCY,
        *time_keys,
        on(0, "all_requests").alias("requests"),
        on(0, "all_errors").alias("errors"),
        on(1, "all_requests").alias("time_requests"),
    )


def latency_and_time(by_latency: DataFrame, by_time: DataFrame, *time_keys: str) -> DataFrame:
    """The rows of ``_latency_and_time`` from two logs of the same requests: one that has
    their latencies, one that has the time keys."""
    frequencies = frequency(by_latency)
    times = totals(by_time, *time_keys).select(
        *time_keys, F.col("requests").alias("time_requests")
    )
    return frequencies.unionByName(times, allowMissingColumns=True)


def _days() -> Column:
    """The number of days; the set is bounded by the calendar."""
    return F.size(F.collect_set("date")).cast("long")


def _whole_log(counts: DataFrame) -> DataFrame:
    """Everything the two dashboards' figures need, in one row."""
    return (
        narrowed(counts, quantiles=[P95])
        .agg(
            *profile_columns([P95]),
            _days().alias("total_days"),
            _hour_totals().alias("hour_totals"),
        )
        .withColumn("hours", _present_hours())
    )


def kpis(log: DataFrame) -> DataFrame:
    return kpis_from(_latency_and_time(log, "date", "hour"))


def kpis_from(counts: DataFrame) -> DataFrame:
    """From counts per latency and, apart from them, per date and hour."""
    return _whole_log(counts).select(
        F.col("requests").alias("total_requests"),
        "total_days",
        ratio(F.col("requests"), F.col("total_days")).alias("avg_daily"),
        mean_latency().alias("mean_rt"),
        quantile(0).alias("p95_rt"),
        error_percent().alias("error_rate"),
        F.col("errors").alias("total_errors"),
        F.try_divide(
            _mean_per_hour(F.col("hours"), True), _mean_per_hour(F.col("hours"), False)
        ).alias("peak_ratio"),
    )


def summary_dashboard(log: DataFrame) -> DataFrame:
    return summary_dashboard_from(_latency_and_time(log, "date", "hour"))


def summary_dashboard_from(counts: DataFrame) -> DataFrame:
    """From counts per latency and, apart from them, per date and hour."""
    return _whole_log(counts).select(
        F.col("requests").alias("total_requests"),
        "total_days",
        ratio(F.col("requests"), F.col("total_days")).alias("avg_daily_requests"),
        mean_latency().alias("mean_rt"),
        quantile(0).alias("p95_rt"),
        error_percent().alias("error_rate"),
        F.col("errors").alias("total_errors"),
        _first_hour(F.col("hours"), True).alias("busiest_hour"),
        _first_hour(F.col("hours"), False).alias("quietest_hour"),
    )


def clean_summary(log: DataFrame) -> DataFrame:
    """What the clean stage prints about its result."""
    return (
        narrowed(_latency_and_time(log, "date"), quantiles=[MEDIAN, P95, P99])
        .agg(
            *profile_columns([MEDIAN, P95, P99]),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
            _days().alias("unique_days"),
        )
        .select(
            F.col("requests").alias("total_records"),
            "first_date",
            "last_date",
            "unique_days",
            error_percent().alias("error_rate"),
            mean_latency().alias("mean_ms"),
            quantile(0).alias("median_ms"),
            quantile(1).alias("p95_ms"),
            quantile(2).alias("p99_ms"),
        )
    )


def raw_summary(raw: DataFrame) -> DataFrame:
    """The same quick look before cleaning, so invalid latencies count; malformed lines do
    not, as they are no requests."""
    raw = whole_numbers(well_formed(raw))
    per_group = raw.groupBy("service", LATENCY).agg(
        request_count(raw).alias("requests"),
        error_count(raw).alias("errors"),
        F.min("timestamp").alias("first_request"),
        F.max("timestamp").alias("last_request"),
    )
    return narrowed(per_group, quantiles=[P95]).agg(
        *profile_columns([P95]),
        F.min("first_request").alias("first_request"),
        F.max("last_request").alias("last_request"),
        F.array_join(F.array_sort(F.collect_set("service")), ",").alias("services"),
    ).select(
        "first_request",
        "last_request",
        "services",
        F.col("requests").alias("total_requests"),
        error_percent().alias("error_rate"),
        mean_latency().alias("mean_ms"),
        quantile(0).alias("p95_ms"),
    )
