"""Report grids: fixed key sets that results are fitted to.

A grid both adds missing keys, with zeros, and drops keys outside it, so results
are joined *from* the grid. The joined side is first restricted to the grid's own
keys, so it has at most as many rows as the grid (168) and is safe to broadcast.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadglass import schema
from loadglass.functions.calendar import day_name


def hours(spark: SparkSession) -> DataFrame:
    return spark.range(24, numPartitions=1).select(F.col("id").cast("int").alias("hour"))


def days_and_hours(spark: SparkSession) -> DataFrame:
    """All 7 x 24 cells, Monday first."""
    return spark.range(7 * 24, numPartitions=1).select(
        F.expr("CAST(id DIV 24 AS INT) AS day_of_week_num"),
        day_name("CAST(id DIV 24 AS INT)").alias("day_of_week"),
        F.expr("CAST(id % 24 AS INT) AS hour"),
    )


def _listed(spark: SparkSession, values: Sequence, name: str) -> DataFrame:
    items = ", ".join(repr(value) for value in values)
    return spark.range(len(values), numPartitions=1).select(
        F.expr(f"element_at(array({items}), CAST(id AS INT) + 1) AS {name}")
    )


def services(spark: SparkSession) -> DataFrame:
    return _listed(spark, schema.SERVICES, "service")


def status_codes(spark: SparkSession) -> DataFrame:
    return _listed(spark, schema.REPORT_STATUS_CODES, "status_code")


def on_services(log: DataFrame) -> DataFrame:
    return log.filter(F.col("service").isin(schema.SERVICES))


def on_status_codes(log: DataFrame) -> DataFrame:
    return log.filter(F.col("status_code").isin(schema.REPORT_STATUS_CODES))


def fit_to(spine: DataFrame, result: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join from the grid; missing measures become 0."""
    measures = [name for name in result.columns if name not in keys]
    return spine.join(F.broadcast(result), list(keys), "left").fillna(0, measures)
