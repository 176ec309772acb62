"""Additive totals and exact percentiles over a request log.

Every function takes either a log (one row per request) or a rollup, whose rows
stand for ``requests`` requests each. All sums are sums of integers, so results
do not depend on the order in which partitions are merged, and none can overflow: a
latency is any BIGINT, so its bits are added up in slices (see ``wide_sum``).

Percentiles run in three steps. The first groups by the keys and the latency, with
map-side combining, so each task sends at most one row per key and distinct
latency, and a key that holds a third of all rows is spread over the shuffle by
its latencies. The second counts, per key, latencies cut to their first 11 binary
digits, of which there are 110,000 or so over the whole 64-bit domain, and finds
those that hold the ranks asked for. The third merges the counts per key, with
every latency outside of these cut to its first digits. That moves no rank and
changes no percentile, and what meets in one task is bounded, never the distinct
latencies of a key. Latencies up to 2,047 are never cut.
"""

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LATENCY = "response_time_ms"
WEIGHT = "requests"

# Sums of latencies. They hold any latency of up to 2^41 requests.
WIDE = "decimal(38,0)"

# First bit and width of the slices that a latency is added up in. The sum of each fits into
# 64 bits for up to 2^41 requests; the last one has the sign.
SLICES = [(0, 20), (20, 22), (42, 22)]

# Binary digits of a latency that the first narrowing keeps.
DIGITS = 11

MEDIAN = 0.5
P90 = 0.9
P95 = 0.95
P99 = 0.99


def weight(log: DataFrame) -> Column:
    """How many requests a row stands for."""
    return F.col(WEIGHT) if WEIGHT in log.columns else F.lit(1).cast("long")


def request_count(log: DataFrame) -> Column:
    if WEIGHT in log.columns:
        return F.coalesce(F.sum(WEIGHT), F.lit(0).cast("long"))
    return F.count(F.lit(1))


def error_count(log: DataFrame) -> Column:
    return request_count_if(log, F.col("error"))


def request_count_if(log: DataFrame, condition: Column) -> Column:
    if WEIGHT in log.columns:
        return F.coalesce(
            F.sum(F.when(condition, F.col(WEIGHT))), F.lit(0).cast("long")
        )
    return F.count_if(condition)


def wide_sum(value: Column, count: Column) -> Column:
    """The sum of ``value`` times ``count``, exact for any BIGINT values.

    Three sums of BIGINT cost less than one of decimals, whose buffers are objects.
    """

    value = value.cast("long")

    def part(low: int, width: int) -> Column:
        bits = F.shiftright(value, low)
        if low + width < 64:
            bits = bits.bitwiseAND(F.lit((1 << width) - 1))
        return F.sum(bits * count).cast(WIDE) * F.lit(Decimal(1 << low))

    return reduce(add, (part(*bits) for bits in SLICES)).cast(WIDE)


def total_latency(log: DataFrame) -> Column:
    return wide_sum(F.col(LATENCY), weight(log))


def with_keys(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows with a missing group key: a NULL group is not reported."""
    if not keys:
        return log
    return log.filter(" AND ".join(f"`{key}` IS NOT NULL" for key in keys))


def totals(log: DataFrame, *keys: str) -> DataFrame:
    """``requests, errors, timed_requests, total_ms`` per key; one shuffle.

    ``timed_requests`` leaves out rows without a latency and divides the mean.
    Unused sums are pruned by the optimizer.
    """
    return (
        with_keys(log, keys)
        .groupBy(*keys)
        .agg(
            request_count(log).alias("requests"),
            error_count(log).alias("errors"),
            request_count_if(log, F.col(LATENCY).isNotNull()).alias("timed_requests"),
            total_latency(log).alias("total_ms"),
        )
    )


def mean_latency() -> Column:
    """Mean latency from the columns of ``totals``."""
    return F.try_divide(F.col("total_ms").cast("double"), F.col("timed_requests"))


def frequency(log: DataFrame, *keys: str) -> DataFrame:
    """``requests, errors`` per key and distinct latency."""
    return (
        with_keys(log, keys)
        .groupBy(*keys, LATENCY)
        .agg(
            request_count(log).alias("requests"),
            error_count(log).alias("errors"),
        )
    )


def _cut(latency: Column) -> Column:
    """A latency without the binary digits after its first ``DIGITS``. It keeps order,
    also of negative values."""
    # The complement of a negative one: the least BIGINT has no absolute value.
    size = F.when(latency < 0, F.bitwise_not(latency)).otherwise(latency)
    drop = F.greatest(F.length(F.bin(size)) - DIGITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", latency, drop), drop)


def narrowed(
    frequencies: DataFrame, *keys: str, quantiles: Sequence[float] = (MEDIAN, P95)
) -> DataFrame:
    """``frequency`` rows with ``narrow``: the latency, cut unless a quantile of its key
    needs it whole.

    Rows without a latency keep none. The window runs over the cut latencies of a key.
    """
    cut = frequencies.filter(F.col(LATENCY).isNotNull()).groupBy(
        *keys, _cut(F.col(LATENCY)).alias("cut")
    ).agg(F.sum("requests").alias("n"))
    per_key = Window.partitionBy(*keys)
    ranked = cut.withColumns(
        {
            "to": F.sum("n").over(per_key.orderBy("cut")),
            "all": F.sum("n").over(per_key),
        }
    )

    def holds(fraction: float) -> Column:
        position = (F.col("all") - 1) * F.lit(float(fraction))
        return (F.floor(position) < F.col("to")) & (
            F.ceil(position) >= F.col("to") - F.col("n")
        )

    wanted = (
        ranked.filter(reduce(or_, map(holds, quantiles)))
        .groupBy(*[F.col(key).alias(f"{key}__wanted") for key in keys])
        .agg(F.collect_set("cut").alias("whole"))
    )
    if keys:
        condition = reduce(
            and_, (F.col(key).eqNullSafe(F.col(f"{key}__wanted")) for key in keys)
        )
        joined = frequencies.join(wanted, condition, "left")
    else:
        joined = frequencies.withColumn("whole", wanted.select("whole").scalar())
    latency = F.col(LATENCY)
    return joined.withColumn(
        "narrow",
        F.when(F.array_contains("whole", _cut(latency)), latency).otherwise(_cut(latency)),
    ).drop("whole", *[f"{key}__wanted" for key in keys])


def profile_columns(quantiles: Sequence[float] = (MEDIAN, P95)) -> list[Column]:
    """Aggregates over ``narrowed`` rows: totals plus ``quantiles``, an array.

    One percentile call for all fractions keeps one count map instead of several.
    """
    timed = F.col(LATENCY).isNotNull()
    return [
        F.coalesce(F.sum("requests"), F.lit(0).cast("long")).alias("requests"),
        F.coalesce(F.sum("errors"), F.lit(0).cast("long")).alias("errors"),
        F.sum(F.when(timed, F.col("requests"))).alias("timed_requests"),
        wide_sum(F.col(LATENCY), F.col("requests")).alias("total_ms"),
        F.percentile("narrow", list(quantiles), F.col("requests")).alias("quantiles"),
    ]


def profile(
    log: DataFrame, *keys: str, quantiles: Sequence[float] = (MEDIAN, P95)
) -> DataFrame:
    """``totals`` plus exact, linearly interpolated percentiles per key."""
    rows = narrowed(frequency(log, *keys), *keys, quantiles=quantiles)
    return rows.groupBy(*keys).agg(*profile_columns(quantiles))


def centre(frequencies: DataFrame) -> Column:
    """The mean latency of ``frequency`` rows, rounded down to a whole number, as a scalar."""
    return (
        frequencies.filter(F.col(LATENCY).isNotNull())
        .agg(
            wide_sum(F.col(LATENCY), F.col("requests")).alias("total"),
            F.sum("requests").alias("n"),
        )
        .select(F.expr("total DIV nullif(n, 0)"))
        .scalar()
    )


def spread_columns(middle: str) -> list[Column]:
    """Sums for ``sample_deviation`` over ``frequency`` rows with the column ``middle``, their
    ``centre``.

    Squares are of distances from the centre, each cut into multiples of 2^32 and a rest of the
    same sign. So all sums are exact for any latencies, and none cancels another one.
    """
    count = F.col("requests").cast("decimal(18,0)")
    apart = F.col(LATENCY).cast("long") - F.col(middle)
    high = F.signum(apart).cast("bigint") * F.shiftright(F.abs(apart), 32)
    low = apart - high * F.lit(1 << 32)

    def total(*factors: Column) -> Column:
        return F.sum(reduce(lambda a, b: a * b, (x.cast("decimal(10,0)") for x in factors)) * count)

    return [
        total(high, high).alias("high_squares"),
        total(high, low).alias("mixed_products"),
        total(low, low).alias("low_squares"),
        F.sum(apart.cast("decimal(19,0)") * count).alias("apart"),
    ]


def sample_deviation() -> Column:
    """Sample standard deviation from ``profile_columns`` and ``spread_columns``."""
    n = F.col("timed_requests").cast("double")
    squares = (
        F.col("high_squares").cast("double") * F.lit(2.0**64)
        + F.col("mixed_products").cast("double") * F.lit(2.0**33)
        + F.col("low_squares").cast("double")
    )
    apart = F.col("apart").cast("double")
    spread = F.greatest(squares - F.try_divide(apart * apart, n), F.lit(0.0))
    return F.sqrt(F.try_divide(spread, n - 1))


def quantile(position: int) -> Column:
    """The percentile at a position of the list given to ``profile``."""
    return F.col("quantiles")[position]
