"""When is traffic highest?"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadglass.functions import labels
from loadglass.functions.calendar import is_peak
from loadglass.functions.numeric import percent
from loadglass.operators import spines
from loadglass.operators.aggregate import totals
from loadglass.operators.order import in_order


def requests_per(log: DataFrame, *keys: str) -> DataFrame:
    return totals(log, *keys).select(*keys, "requests")


def requests_by_hour(log: DataFrame) -> DataFrame:
    return requests_per(log, "hour").transform(in_order, "hour")


def requests_by_day(log: DataFrame) -> DataFrame:
    return requests_per(log, "date").transform(in_order, "date")


def service_counts(log: DataFrame) -> DataFrame:
    return requests_per(log, "service").orderBy(F.desc("requests"), "service")


def status_counts(log: DataFrame) -> DataFrame:
    """Requests per status code; here only a 200 is a success."""
    return (
        requests_per(log, "status_code")
        .withColumn("outcome", labels.outcome_by_200(F.col("status_code")))
        .transform(in_order, F.desc("requests"), "status_code")
    )


def service_share(log: DataFrame) -> DataFrame:
    """Requests per service and the percentage of all of them.

    Services are an open set, so the total is a sum over their counts, no window.
    """
    counts = requests_per(log, "service")
    whole = counts.agg(F.sum("requests")).scalar()
    return (
        counts
        .withColumn("share_percent", percent(F.col("requests"), whole))
        .orderBy(F.desc("requests"), "service")
    )


def traffic_by_hour(log: DataFrame) -> DataFrame:
    """All 24 hours, zero where there was no request."""
    return (
        spines.fit_to(
            spines.hours(log.sparkSession), requests_per(log, "hour"), ["hour"]
        )
        .withColumn("period", labels.period(is_peak(F.col("hour"))))
        .orderBy("hour")
    )


def service_distribution(log: DataFrame) -> DataFrame:
    """The known services, zero where there was no request."""
    counts = requests_per(spines.on_services(log), "service")
    return spines.fit_to(
        spines.services(log.sparkSession), counts, ["service"]
    ).orderBy("service")


def flat_distribution_check(log: DataFrame) -> DataFrame:
    """Whether all known services have the same number of requests."""
    return service_distribution(log).agg(
        F.count(F.lit(1)).alias("services"),
        F.count_distinct("requests").alias("distinct_counts"),
        (F.count_distinct("requests") == 1).alias("is_flat"),
    )


def hourly_vs_average(log: DataFrame) -> DataFrame:
    """Requests per hour against the mean over the hours that had any."""
    average = F.avg("requests").over(Window.partitionBy())
    return (
        requests_per(log, "hour")
        .withColumn("average_requests", average)
        .withColumn("above_average", F.col("requests") > F.col("average_requests"))
        .transform(in_order, "hour")
    )


def hour_labels(log: DataFrame) -> DataFrame:
    return traffic_by_hour(log).select(
        "hour", labels.hour_label(F.col("hour")).alias("label"), "requests"
    )


def peak_ratio(log: DataFrame) -> DataFrame:
    """Mean requests per peak hour and per off-peak hour, and how many times more."""
    by_hour = requests_per(log, "hour")
    peak = F.avg(F.when(is_peak(F.col("hour")), F.col("requests")))
    off_peak = F.avg(F.when(~is_peak(F.col("hour")), F.col("requests")))
    return by_hour.agg(
        peak.alias("peak_average"),
        off_peak.alias("off_peak_average"),
        F.try_divide(peak, off_peak).alias("peak_ratio"),
    )


def busiest_quietest_hour(log: DataFrame) -> DataFrame:
    """The hours with most and fewest requests; of equals the earlier one."""
    return requests_per(log, "hour").agg(
        F.max_by("hour", F.struct("requests", -F.col("hour"))).alias("busiest_hour"),
        F.max("requests").alias("busiest_requests"),
        F.min_by("hour", F.struct("requests", "hour")).alias("quietest_hour"),
        F.min("requests").alias("quietest_requests"),
    )
