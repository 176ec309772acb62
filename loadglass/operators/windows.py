"""Requests within windows of time that come as a table.

A window is ``start`` to ``end``, the end not included. Windows may overlap, hold each other, be
empty, or last from a second to years. Comparing each request with each window would be a
product, so both sides get a bucket to meet in. A window belongs to the level whose buckets are
as long as itself or up to twice as long, so it lies in two buckets of that level at most. A
request looks into one bucket of each level that any window has, of which there are some 40 at
most. A bucket with many requests is shared out: requests are dealt to ``SHARES`` parts, and
each window is in all parts.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadglass.functions.numeric import round_half_even
from loadglass.operators.aggregate import mean_latency, totals
from loadglass.plans.errors import error_percent

# Microseconds of the shortest buckets.
BASE = 60_000_000
# Parts of each bucket.
SHARES = 8

START, END = "start", "end"


def _micros(time: str) -> Column:
    """Local time as a number; no zone is involved."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{time}`)")


def _bucket(micros: Column, level: Column) -> Column:
    width = F.lit(BASE).cast("long") * F.call_function("shiftleft", F.lit(1).cast("long"), level)
    return F.floor((micros - F.pmod(micros, width)) / width)


def _level() -> Column:
    """The least level whose buckets are no shorter than the window."""
    longer = F.floor((_micros(END) - _micros(START) - 1) / BASE)
    return F.when(longer <= 0, 0).otherwise(F.length(F.bin(longer)))


def in_windows(log: DataFrame, windows: DataFrame, time: str = "timestamp") -> DataFrame:
    """A row for each request and window around it, with the columns of both.

    Windows without a start or an end, or that end before they start, have no requests.
    """
    names = {name: f"__{name}" for name in ("level", "bucket", "part")}
    level, bucket, part = names.values()
    placed = windows.filter(F.col(START) < F.col(END)).withColumn(level, _level())
    levels = [row[0] for row in placed.select(level).distinct().collect()]
    ends = [_bucket(micros, F.col(level)) for micros in (_micros(START), _micros(END) - 1)]
    placed = placed.withColumn(bucket, F.explode(F.sequence(*ends))).withColumn(
        part, F.explode(F.lit(list(range(SHARES))))
    )
    looking = (
        log.withColumn(part, (F.monotonically_increasing_id() % SHARES).cast("int"))
        .withColumn(level, F.explode(F.lit(levels or [0])))
        .withColumn(bucket, _bucket(_micros(time), F.col(level)))
    )
    return (
        looking.join(placed, list(names.values()))
        .filter((F.col(time) >= F.col(START)) & (F.col(time) < F.col(END)))
        .drop(*names.values())
    )


def incidents_by_window(log: DataFrame, windows: DataFrame) -> DataFrame:
    """Requests, errors and latency of each (label, start, end), also of windows without any.
    Rows that repeat are one window."""
    windows = windows.select("label", START, END).distinct()
    keys = ["label", START, END]
    found = totals(in_windows(log, windows.filter("label IS NOT NULL")), *keys)
    return (
        windows.join(found, keys, "left")
        .select(
            *keys,
            F.coalesce("requests", F.lit(0).cast("long")).alias("requests"),
            F.coalesce("errors", F.lit(0).cast("long")).alias("errors"),
            round_half_even(error_percent(), 6).alias("error_rate"),
            round_half_even(mean_latency(), 6).alias("mean_ms"),
        )
        .orderBy(START, END, "label")
    )
