"""Observed load against what the load model expects of it.

The log is joined with the model's 12 endpoints while it is read (a broadcast of
constants), reduced to counts per model cell, and weighted from there. Requests of
services, endpoints or codes that the model does not know stay, without expectation.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadglass import schema
from loadglass.functions import load_model
from loadglass.functions.numeric import percent, ratio
from loadglass.operators.aggregate import LATENCY, totals
from loadglass.operators.order import in_order
from loadglass.plans.traffic import requests_per


def traffic_band(log: DataFrame) -> DataFrame:
    """Requests per hour with the band and the multiplier the model gives it."""
    hour = F.col("hour")
    return (
        requests_per(log, "hour")
        .select(
            "hour",
            load_model.traffic_band(hour).alias("band"),
            load_model.traffic_multiplier(hour).alias("multiplier"),
            "requests",
        )
        .transform(in_order, "hour")
    )


def day_multiplier(log: DataFrame) -> DataFrame:
    day = F.col("day_of_week_num")
    return (
        requests_per(log, "day_of_week_num", "day_of_week")
        .select(
            "day_of_week_num",
            "day_of_week",
            load_model.day_multiplier(day).alias("multiplier"),
            "requests",
        )
        .transform(in_order, "day_of_week_num")
    )


def _multiplier():
    return load_model.combined_multiplier(F.col("hour"), F.col("day_of_week_num"))


def expected_vs_observed(log: DataFrame) -> DataFrame:
    """Expected and observed mean latency per endpoint and hour."""
    endpoints = schema.endpoint_dim(log.sparkSession)
    expected = load_model.expected_latency(F.col("base_ms"), _multiplier())
    return (
        totals(log, "service", "endpoint", "hour", "day_of_week_num")
        .join(F.broadcast(endpoints), ["service", "endpoint"], "left")
        .groupBy("service", "endpoint", "hour")
        .agg(
            F.sum("requests").alias("requests"),
            (F.sum(expected * F.col("requests")) / F.sum("requests")).alias(
                "expected_ms"
            ),
            ratio(F.sum("total_ms"), F.sum("timed_requests")).alias("observed_ms"),
        )
        .withColumn("observed_ratio", ratio(F.col("observed_ms"), F.col("expected_ms")))
        .orderBy("service", "endpoint", "hour")
    )


def expected_error_rate(log: DataFrame) -> DataFrame:
    """Expected and observed error rate in percent per endpoint.

    How slow a request was only matters as one of three factors, so the first
    grouping has one row per endpoint, hour, weekday and factor.
    """
    endpoints = schema.endpoint_dim(log.sparkSession)
    slowness = load_model.slow_factor(F.col(LATENCY), F.col("base_ms"))
    cells = totals(
        log.join(F.broadcast(endpoints), ["service", "endpoint"], "left").withColumn(
            "slowness", F.coalesce(slowness, F.lit(1.0))
        ),
        "service", "endpoint", "hour", "day_of_week_num", "slowness",
    ).join(F.broadcast(endpoints), ["service", "endpoint"], "left")
    # The model caps rates with ``least``, which would take NULL for the cap.
    expected = F.when(
        F.col("base_error_rate").isNotNull(),
        load_model.expected_error_rate(
            F.col("base_error_rate"), _multiplier(), F.col("slowness")
        ),
    )
    return (
        cells.groupBy("service", "endpoint")
        .agg(
            F.sum("requests").alias("requests"),
            (F.sum(expected * F.col("requests")) / F.sum("requests") * 100.0).alias(
                "expected_error_rate"
            ),
            percent(F.sum("errors"), F.sum("requests")).alias("observed_error_rate"),
        )
        .orderBy("service", "endpoint")
    )


def expected_traffic(log: DataFrame) -> DataFrame:
    """Expected and observed mean requests per service and clock hour.

    The means run over the days on which the service had requests in that hour.
    """
    services = schema.service_dim(log.sparkSession)
    expected = load_model.expected_requests(F.col("base_requests"), _multiplier())
    return (
        requests_per(log, "service", "date", "hour", "day_of_week_num")
        .join(F.broadcast(services), "service", "left")
        .groupBy("service", "hour")
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.avg(expected).alias("expected_requests"),
            F.avg("requests").alias("observed_requests"),
        )
        .orderBy("service", "hour")
    )


def endpoint_mix(log: DataFrame) -> DataFrame:
    """Share of each endpoint within its service against the configured weight.

    Endpoints are an open set, so services are summed from their counts, no window.
    """
    counts = requests_per(log, "service", "endpoint")
    services = counts.groupBy("service").agg(F.sum("requests").alias("whole"))
    return (
        counts.join(services, "service")
        .withColumn("observed_share", ratio(F.col("requests"), F.col("whole")))
        .join(
            F.broadcast(schema.endpoint_dim(log.sparkSession)),
            ["service", "endpoint"],
            "left",
        )
        .select(
            "service",
            "endpoint",
            "requests",
            "observed_share",
            F.col("weight").alias("configured_share"),
        )
        .orderBy("service", "endpoint")
    )


def error_code_mix(log: DataFrame) -> DataFrame:
    """Share of each error code among failed requests against its weight."""
    whole = F.sum("requests").over(Window.partitionBy())
    return (
        requests_per(log.filter("error"), "status_code")
        .withColumn("observed_share", ratio(F.col("requests"), whole))
        .join(
            F.broadcast(schema.error_code_dim(log.sparkSession)), "status_code", "left"
        )
        .select(
            "status_code",
            "requests",
            "observed_share",
            F.col("weight").alias("configured_share"),
        )
        .transform(in_order, "status_code")
    )
