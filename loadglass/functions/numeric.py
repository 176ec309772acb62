"""Rounding and ratio expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(value: Column, digits: int = 2) -> Column:
    """Round the scaled double to the nearest integer, ties to even.

    This is how pandas rounds. ``F.round`` rounds the decimal text half up,
    which gives other last digits on ties such as 155.575.
    """
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, NULL where there is nothing to divide by."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * 100.0


def coarse_percent(part: Column, whole: Column) -> Column:
    """A percentage whose rate is rounded to 2 digits before the times 100.

    The published tables have whole-percent precision because of this, and
    print values such as 7.000000000000001.
    """
    return round_half_even(ratio(part, whole)) * 100.0


def percent_change(new: Column, old: Column) -> Column:
    return (ratio(new, old) - 1.0) * 100.0
