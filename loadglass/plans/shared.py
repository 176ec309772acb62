"""Report sets straight from the log, which is read once.

Each report needs some columns of the log. The needs of all reports wanted are put together
into one aggregation with grouping sets: those columns of a report that no other report's
columns include are one set, and the log is counted by each. A report then reads the smallest
set that has its columns, as if that were a rollup.

Sets are not multiplied with each other, so what the shuffle carries is the sum of their key
counts, and less than a rollup by all keys: that one serves reports of later runs as well, and
the load model, whose cells need most keys at once.
"""

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadglass.operators import histogram
from loadglass.operators.aggregate import LATENCY, WEIGHT, request_count
from loadglass.plans import endpoints, errors, latency, peak, summary, traffic
from loadglass.session import scratch_folder

Report = Callable[[DataFrame], DataFrame]

SET = "grouping_set"

HOUR, DATE, SERVICE, STATUS, PEAK = "hour", "date", "service", "status_code", "is_peak_hour"
ENDPOINT = (SERVICE, "endpoint")

# Columns that follow from another one; to group by both gives no more groups.
FOLLOWS = {PEAK: HOUR}

# What each report reads of a log besides ``error`` and the number of requests.
REPORTS: dict[str, tuple[Report, tuple[str, ...]]] = {
    "endpoint_performance": (endpoints.endpoint_performance, (*ENDPOINT, LATENCY)),
    "daily_metrics": (latency.daily_metrics, (DATE, LATENCY)),
    "hourly_metrics": (latency.hourly_metrics, (HOUR, LATENCY)),
    "requests_by_hour": (traffic.requests_by_hour, (HOUR,)),
    "requests_by_day": (traffic.requests_by_day, (DATE,)),
    "hourly_vs_average": (traffic.hourly_vs_average, (HOUR,)),
    "peak_ratio": (traffic.peak_ratio, (HOUR,)),
    "response_time_stats": (latency.response_time_stats, (LATENCY,)),
    "response_by_hour": (latency.response_by_hour, (HOUR, LATENCY)),
    "daily_response": (latency.daily_response, (DATE, LATENCY)),
    "latency_histogram": (histogram.latency_histogram, (LATENCY,)),
    "overall_error_rate": (errors.overall_error_rate, ()),
    "error_spike_hours": (errors.error_spike_hours, (HOUR,)),
    "error_rate_by_hour": (errors.error_rate_by_hour, (HOUR,)),
    "daily_errors": (errors.daily_errors, (DATE,)),
    "error_status_share": (errors.error_status_share, (STATUS,)),
    "status_counts": (traffic.status_counts, (STATUS,)),
    "service_share": (traffic.service_share, (SERVICE,)),
    "service_summary": (endpoints.service_summary, (SERVICE, LATENCY)),
    "endpoint_severity": (endpoints.endpoint_severity, ENDPOINT),
    "peak_vs_offpeak": (peak.peak_vs_offpeak, (PEAK, LATENCY)),
    "peak_degradation": (peak.peak_degradation, (PEAK, LATENCY)),
    "traffic_by_hour": (traffic.traffic_by_hour, (HOUR,)),
    "response_trend": (latency.response_trend, (DATE, LATENCY)),
    "error_heatmap": (errors.error_heatmap_wide, ("day_of_week_num", HOUR)),
    "endpoint_dashboard": (endpoints.endpoint_dashboard, (*ENDPOINT, LATENCY)),
    "service_distribution": (traffic.service_distribution, (SERVICE,)),
    "flat_distribution_check": (traffic.flat_distribution_check, (SERVICE,)),
    "error_by_service": (errors.error_by_service, (SERVICE,)),
    "status_distribution": (errors.status_distribution, (STATUS,)),
    "peak_comparison": (peak.peak_comparison, (PEAK, LATENCY)),
    "metric_labels": (peak.metric_labels, (PEAK, LATENCY)),
}

# The sets of ``bundles`` by name.
PUBLISHED = ["endpoint_performance", "daily_metrics", "hourly_metrics"]
STATIC = [*list(REPORTS)[: list(REPORTS).index("traffic_by_hour")], "summary_dashboard"]
DASHBOARD = [*list(REPORTS)[list(REPORTS).index("traffic_by_hour") :], "kpis"]

# These need latencies and times, but not together.
WHOLE_LOG = {
    "kpis": summary.kpis_from,
    "summary_dashboard": summary.summary_dashboard_from,
}
BY_LATENCY, BY_TIME = (LATENCY,), (DATE, HOUR)


def _columns(need: Iterable[str]) -> frozenset[str]:
    columns = {"error", *need}
    return frozenset(columns | {FOLLOWS[name] for name in columns & set(FOLLOWS)})


def needs(names: Iterable[str]) -> set[frozenset[str]]:
    """The columns that each of the reports reads."""
    found = set()
    for name in names:
        wanted = (BY_LATENCY, BY_TIME) if name in WHOLE_LOG else (REPORTS[name][1],)
        found |= set(map(_columns, wanted))
    return found


def grouping_sets(needed: Iterable[frozenset[str]]) -> list[tuple[str, ...]]:
    """The needs that no other one includes, each in alphabetical order."""
    needed = set(needed)
    return sorted(
        tuple(sorted(need)) for need in needed if not any(need < other for other in needed)
    )


def grouped(log: DataFrame, sets: list[tuple[str, ...]]) -> DataFrame:
    """The log counted by each of the sets; ``SET`` is the place of a row's set among them."""
    columns = sorted({name for one in sets for name in one})
    counted = log.groupingSets([list(one) for one in sets], *columns).agg(
        request_count(log).alias(WEIGHT), F.grouping_id().alias("missing")
    )

    def missing(one: tuple[str, ...]) -> int:
        """``grouping_id`` of a set: a bit for each column that it lacks, the last is 1."""
        return sum(1 << at for at, name in enumerate(reversed(columns)) if name not in one)

    place = F.when(F.lit(False), F.lit(0))
    for number, one in enumerate(sets):
        place = place.when(F.col("missing") == missing(one), F.lit(number))
    return counted.select(*columns, WEIGHT, place.alias(SET))


class SharedScan:
    """The counts that some reports need of a log, written to the scratch folder."""

    def __init__(self, log: DataFrame, names: Iterable[str]):
        self.names = list(names)
        self.sets = grouping_sets(needs(self.names))
        counted = grouped(log, self.sets)
        self.path = scratch_folder(log.sparkSession, "shared")
        counted.hint("rebalance", SET).write.partitionBy(SET).parquet(self.path)
        self.counted = log.sparkSession.read.schema(counted.schema).parquet(self.path)

    def counts(self, need: Iterable[str]) -> DataFrame:
        """The smallest set with these columns, as a rollup; without a latency if none of its
        reports needs it."""
        need = _columns(need)
        of = min(
            (number for number, one in enumerate(self.sets) if need <= set(one)),
            key=lambda number: (len(self.sets[number]), number),
        )
        counts = self.counted.filter(F.col(SET) == of).select(*self.sets[of], WEIGHT)
        if LATENCY not in self.sets[of]:
            counts = counts.withColumn(LATENCY, F.lit(None).cast("long"))
        return counts

    def _whole_log(self) -> DataFrame:
        return summary.latency_and_time(
            self.counts(BY_LATENCY), self.counts(BY_TIME), *BY_TIME
        )

    def table(self, name: str) -> DataFrame:
        if name in WHOLE_LOG:
            return WHOLE_LOG[name](self._whole_log())
        report, need = REPORTS[name]
        return report(self.counts(need))

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in self.names}


def shared_tables(log: DataFrame, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """Reports by name, by default all but those of the load model; the log is read once,
    now, and the tables read its counts."""
    return SharedScan(log, [*REPORTS, *WHOLE_LOG] if names is None else names).tables()
