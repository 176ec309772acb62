"""Calendar columns of a request."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadglass import schema


def day_name(day_of_week_num: str) -> Column:
    """English day name of a weekday number, 0 = Monday, given as SQL."""
    names = ", ".join(f"'{name}'" for name in schema.DAY_NAMES)
    return F.expr(f"element_at(array({names}), {day_of_week_num} + 1)")


def is_peak(hour: Column) -> Column:
    return hour.between(schema.PEAK_FIRST_HOUR, schema.PEAK_LAST_HOUR)


def calendar_columns() -> dict[str, Column]:
    """The six derived columns of the clean log, by name, from ``timestamp``."""
    hour = F.hour("timestamp")
    weekday = F.weekday("timestamp")
    return {
        "hour": hour,
        "day_of_week": day_name("weekday(timestamp)"),
        "day_of_week_num": weekday,
        "date": F.to_date("timestamp"),
        "is_weekend": weekday >= 5,
        "is_peak_hour": is_peak(hour),
    }


def in_incident_window(
    timestamp: Column,
    day: int = schema.INCIDENT_DAY,
    first_hour: int = schema.INCIDENT_FIRST_HOUR,
    last_hour: int = schema.INCIDENT_LAST_HOUR,
) -> Column:
    """Requests of some clock hours on one day of the month, in any month."""
    return (F.dayofmonth(timestamp) == day) & F.hour(timestamp).between(
        first_hour, last_hour
    )
