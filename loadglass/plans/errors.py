"""When and where do requests fail?"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadglass.functions import labels
from loadglass.functions.numeric import percent
from loadglass.operators import spines
from loadglass.operators.aggregate import totals
from loadglass.operators.order import in_order
from loadglass.plans.traffic import requests_per


def error_percent() -> Column:
    """Errors per 100 requests from the columns of ``totals``, not rounded."""
    return percent(F.col("errors"), F.col("requests"))


def overall_error_rate(log: DataFrame) -> DataFrame:
    return totals(log).select("requests", "errors", error_percent().alias("error_rate"))


def error_rate_by_hour(log: DataFrame) -> DataFrame:
    """The rate as a fraction (``error``) and as a percentage."""
    rate = F.try_divide(F.col("errors").cast("double"), F.col("requests"))
    return (
        totals(log, "hour")
        .select("hour", rate.alias("error"), (rate * 100.0).alias("error_rate"))
        .transform(in_order, "hour")
    )


def daily_errors(log: DataFrame) -> DataFrame:
    return (
        totals(log, "date")
        .select(
            "date",
            error_percent().alias("error_rate"),
            F.col("requests").alias("total_requests"),
        )
        .transform(in_order, "date")
    )


def error_status_share(log: DataFrame) -> DataFrame:
    """Failed requests per status code and the percentage of all failed ones."""
    whole = F.sum("requests").over(Window.partitionBy())
    return (
        requests_per(log.filter("error"), "status_code")
        .withColumn("share_percent", percent(F.col("requests"), whole))
        .transform(in_order, F.desc("requests"), "status_code")
    )


def error_spike_hours(log: DataFrame) -> DataFrame:
    """Hours whose error rate is above the rate of the whole log (strictly).

    The overall rate is summed over the hourly rows, so the log is read once.
    """
    everything = Window.partitionBy()
    overall = percent(
        F.sum("errors").over(everything), F.sum("requests").over(everything)
    )
    return (
        totals(log, "hour")
        .select(
            "hour",
            error_percent().alias("error_rate"),
            overall.alias("overall_error_rate"),
        )
        .withColumn(
            "above_average", F.col("error_rate") > F.col("overall_error_rate")
        )
        .transform(in_order, "hour")
    )


def error_heatmap(log: DataFrame) -> DataFrame:
    """Error rate of all 168 day and hour cells, Monday first.

    A cell without traffic shows 0 %; ``requests`` tells it from a clean hour.
    """
    cells = totals(log, "day_of_week_num", "hour").select(
        "day_of_week_num", "hour", error_percent().alias("error_rate"), "requests"
    )
    return spines.fit_to(
        spines.days_and_hours(log.sparkSession), cells, ["day_of_week_num", "hour"]
    ).orderBy("day_of_week_num", "hour")


def error_heatmap_wide(log: DataFrame) -> DataFrame:
    """The same grid with one row per day and one column per hour."""
    hours = list(range(24))
    wide = (
        error_heatmap(log)
        .groupBy("day_of_week_num", "day_of_week")
        .pivot("hour", hours)
        .agg(F.first("error_rate"))
        .transform(in_order, "day_of_week_num")
    )
    return wide.select(
        "day_of_week", *[F.col(str(hour)).alias(f"h{hour:02d}") for hour in hours]
    )


def error_by_service(log: DataFrame) -> DataFrame:
    """The known services, zeros where there was no request."""
    measured = totals(spines.on_services(log), "service").select(
        "service",
        error_percent().alias("error_rate"),
        F.col("requests").alias("total_requests"),
    )
    return spines.fit_to(
        spines.services(log.sparkSession), measured, ["service"]
    ).orderBy("service")


def status_distribution(log: DataFrame) -> DataFrame:
    """The eight charted status codes as text, zero where there was none.

    Here every 2xx code is a success.
    """
    counts = requests_per(spines.on_status_codes(log), "status_code")
    filled = spines.fit_to(
        spines.status_codes(log.sparkSession), counts, ["status_code"]
    )
    return filled.select(
        F.col("status_code").cast("string").alias("status_code"),
        F.col("requests").alias("count"),
        labels.outcome_by_prefix(F.col("status_code")).alias("type"),
    ).orderBy("status_code")
