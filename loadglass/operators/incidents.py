"""Requests of a known incident."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadglass.functions.calendar import in_incident_window


def incident_window(raw: DataFrame) -> DataFrame:
    return raw.filter(in_incident_window(F.col("timestamp")))
