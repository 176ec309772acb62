"""The load model's rules as column expressions.

The multipliers say how much traffic an hour should see, and how far latency
and error rate should move with it. The reports compare them with the log.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadglass import schema


def _first_match(rules: list[tuple[Column, object]], default: object) -> Column:
    condition, value = rules[0]
    chain = F.when(condition, F.lit(value))
    for condition, value in rules[1:]:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(F.lit(default))


def traffic_band(hour: Column) -> Column:
    return _first_match(
        [(hour.between(lo, hi), name) for name, lo, hi, _ in schema.TRAFFIC_BANDS],
        schema.OTHER_BAND[0],
    )


def traffic_multiplier(hour: Column) -> Column:
    return _first_match(
        [(hour.between(lo, hi), mult) for _, lo, hi, mult in schema.TRAFFIC_BANDS],
        schema.OTHER_BAND[1],
    )


def day_multiplier(day_of_week_num: Column) -> Column:
    return _first_match(
        [
            (day_of_week_num.between(lo, hi), mult)
            for lo, hi, mult in schema.DAY_MULTIPLIERS
        ],
        schema.OTHER_DAY_MULTIPLIER,
    )


def combined_multiplier(hour: Column, day_of_week_num: Column) -> Column:
    return traffic_multiplier(hour) * day_multiplier(day_of_week_num)


def load_impact(multiplier: Column, factor: float) -> Column:
    return F.lit(1.0) + (multiplier - 1.0) * factor


def expected_latency(base_ms: Column, multiplier: Column) -> Column:
    return base_ms * load_impact(multiplier, schema.LATENCY_LOAD_FACTOR)


def slow_factor(response_time_ms: Column, base_ms: Column) -> Column:
    return _first_match(
        [
            (response_time_ms > base_ms * times, factor)
            for times, factor in schema.SLOW_ERROR_FACTORS
        ],
        1.0,
    )


def expected_error_rate(
    base_error_rate: Column, multiplier: Column, slowness: Column
) -> Column:
    rate = (
        base_error_rate
        * load_impact(multiplier, schema.ERROR_LOAD_FACTOR)
        * slowness
    )
    return F.least(rate, F.lit(schema.MAX_ERROR_RATE))


def expected_requests(base_requests: Column, multiplier: Column) -> Column:
    """Whole requests per hour; the fraction is cut, not rounded."""
    return (base_requests * multiplier).cast("long")
