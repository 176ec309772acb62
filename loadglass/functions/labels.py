"""Text labels of the reports."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadglass import schema
from loadglass.functions.numeric import round_half_even


def period(is_peak_hour: Column, peak_label: str = schema.PEAK_LABEL_LONG) -> Column:
    """Peak or off-peak, named from the key and never from the row position."""
    return F.when(is_peak_hour, peak_label).otherwise(schema.OFF_PEAK_LABEL)


def outcome_by_prefix(status_code: Column) -> Column:
    """The status chart's rule: every 2xx is a success."""
    return F.when(status_code.cast("string").startswith("2"), "Success").otherwise(
        "Error"
    )


def outcome_by_200(status_code: Column) -> Column:
    """The static report's rule: 200 alone is a success, so 201 is not."""
    return F.when(status_code == 200, "Success").otherwise("Error")


def severity(error_percent: Column) -> Column:
    """Band of an error rate in percent; both limits are strict."""
    return (
        F.when(error_percent > 5, "high")
        .when(error_percent > 3, "elevated")
        .otherwise("normal")
    )


def hour_label(hour: Column) -> Column:
    return F.format_string("%02d:00", hour)


def percent_label(value: Column) -> Column:
    return F.format_string("%.2f%%", round_half_even(value))


def millis_label(value: Column) -> Column:
    return F.format_string("%dms", F.rint(value).cast("long"))


def count_label(value: Column) -> Column:
    return F.format_number(value, 0)
