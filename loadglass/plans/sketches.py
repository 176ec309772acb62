"""Summaries that merge: percentiles and distinct counts over any set of days, without the log.

A cell stands for all requests of a day, hour, service and endpoint. It holds counts and totals,
a quantile sketch of the latencies (KLL), and nothing that grows with the distinct latencies, as
the rows of the exact rollup do. A sketch keeps about ``3 * SKETCH_SIZE`` latencies at most, and
up to ``SKETCH_SIZE`` of them it is exact. Beyond that a percentile is that of a rank within
``RANK_ERROR`` of the one asked for, with 99 % confidence. Cells of any days, hours or services
merge, so a report over a year reads a year of cells.

Activity holds, per month, service and endpoint, the days with requests as a bitmap, and per
month the services and endpoints as a HyperLogLog sketch. Bitmaps merge to exact counts of days.
Sketches merge to counts of open sets: exact up to some hundred values, then within
``DISTINCT_ERROR`` (relative standard error).

Exact percentiles from the log or the rollup stay the default of all other reports.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadglass import schema
from loadglass.operators.aggregate import (
    LATENCY,
    MEDIAN,
    P95,
    P99,
    error_count,
    mean_latency,
    request_count,
    request_count_if,
    total_latency,
)
from loadglass.operators.order import in_order

# Latencies that a quantile sketch keeps of each of its levels, and the rank error that gives.
SKETCH_SIZE = 1024
RANK_ERROR = 0.004

# Registers of a distinct sketch are 2 to this; the error is 1.04 over the root of that.
DISTINCT_BITS = 12
DISTINCT_ERROR = 0.02

CELL_KEYS = ["date", "hour", "service", "endpoint"]

CELLS = T.StructType(
    [field for name in CELL_KEYS for field in schema.CLEAN_LOG.fields if field.name == name]
    + [T.StructField(name, T.LongType()) for name in ("requests", "errors", "timed_requests")]
    + [
        T.StructField("total_ms", T.DecimalType(38, 0)),
        T.StructField("min_ms", T.LongType()),
        T.StructField("max_ms", T.LongType()),
        T.StructField("latencies", T.BinaryType()),
    ]
)


def cells(log: DataFrame) -> DataFrame:
    """A clean log as cells; one shuffle, whose rows are cells. The log is one of requests,
    not a rollup."""
    return (
        log.groupBy(*CELL_KEYS)
        .agg(
            request_count(log).alias("requests"),
            error_count(log).alias("errors"),
            request_count_if(log, F.col(LATENCY).isNotNull()).alias("timed_requests"),
            total_latency(log).alias("total_ms"),
            F.min(LATENCY).alias("min_ms"),
            F.max(LATENCY).alias("max_ms"),
            F.kll_sketch_agg_bigint(LATENCY, SKETCH_SIZE).alias("latencies"),
        )
        .select(CELLS.names)
    )


def merged_cells(rows: DataFrame, *keys: str) -> DataFrame:
    """Cells, of one log or of several, as one row per key."""
    return rows.groupBy(*keys).agg(
        F.sum("requests").alias("requests"),
        F.sum("errors").alias("errors"),
        F.sum("timed_requests").alias("timed_requests"),
        F.sum("total_ms").cast("decimal(38,0)").alias("total_ms"),
        F.min("min_ms").alias("min_ms"),
        F.max("max_ms").alias("max_ms"),
        F.kll_merge_agg_bigint("latencies", SKETCH_SIZE).alias("latencies"),
    )


def sketch_quantile(fraction: float) -> Column:
    """The latency of this rank, a value of the log and not interpolated; NULL without any."""
    return F.when(
        F.col("timed_requests") > 0,
        F.kll_sketch_get_quantile_bigint("latencies", F.lit(float(fraction))),
    )


def write_cells(log: DataFrame, path: str) -> None:
    """Write the cells by date, replacing only the days the log covers."""
    (
        cells(log)
        .hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CELLS).parquet(path).select(CELLS.names)


def percentiles_sketch(
    rows: DataFrame, *keys: str, quantiles: Sequence[float] = (MEDIAN, P95, P99)
) -> DataFrame:
    """Requests, mean, range and approximate percentiles per key, from cells."""
    return (
        merged_cells(rows.filter(F.col(keys[0]).isNotNull()), *keys)
        .select(
            *keys,
            "requests",
            mean_latency().alias("mean_ms"),
            "min_ms",
            *(
                sketch_quantile(fraction).alias(f"p{round(fraction * 100)}_ms")
                for fraction in quantiles
            ),
            "max_ms",
        )
        .transform(in_order, *keys)
    )


def daily_percentiles_sketch(rows: DataFrame) -> DataFrame:
    return percentiles_sketch(rows, "date")


def endpoint_percentiles_sketch(rows: DataFrame) -> DataFrame:
    return percentiles_sketch(rows, "service", "endpoint")


# ---- distinct counts ----------------------------------------------------------------

def _day() -> Column:
    """Days since 1970 as positions of a bitmap, which begin with 1."""
    return F.unix_date("date").cast("long") + 1


def active_days(log: DataFrame, *keys: str) -> DataFrame:
    """Per month and key the days with requests, as bitmaps of 4 KB."""
    return (
        log.filter(F.col("date").isNotNull())
        .groupBy(
            F.trunc("date", "month").alias("month"),
            *keys,
            F.bitmap_bucket_number(_day()).alias("bucket"),
        )
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(_day())).alias("days"))
    )


def distinct_days(activity: DataFrame, *keys: str) -> DataFrame:
    """Days with requests per key, exactly, from the bitmaps of any months."""
    merged = activity.groupBy(*keys, "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("days")).alias("days")
    )
    present = merged
    for key in keys:
        present = present.filter(F.col(key).isNotNull())
    return present.groupBy(*keys).agg(F.sum("days").alias("distinct_days")).transform(
        in_order, *keys
    )


def seen_keys(log: DataFrame, *periods: str) -> DataFrame:
    """Per period the services, and the endpoints of services, as sketches."""
    return log.groupBy(*periods).agg(
        F.hll_sketch_agg("service", DISTINCT_BITS).alias("services"),
        F.hll_sketch_agg(
            F.when(
                F.col("service").isNotNull() & F.col("endpoint").isNotNull(),
                F.to_json(F.struct("service", "endpoint")),
            ),
            DISTINCT_BITS,
        ).alias("endpoints"),
    )


def distinct_keys(seen: DataFrame, *periods: str) -> DataFrame:
    """Services and endpoints seen per period, estimated from the sketches of any others."""
    def count(name: str) -> Column:
        return F.hll_sketch_estimate(F.hll_union_agg(name)).alias(f"distinct_{name}")

    return (
        seen.groupBy(*periods)
        .agg(count("services"), count("endpoints"))
        .transform(in_order, *periods)
    )
