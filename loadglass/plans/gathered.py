"""Quality reports from metrics that are gathered while the clean stage writes its tables.

The write of the clean log counts its rows and nulls, the write of the rejects counts them by
reason, so ``null_counts``, ``removal_summary`` and ``reject_report`` need no scan of their own.

The metrics belong to the last stage of a write, after all its shuffles. Spark adds up what a
task of the last stage has gathered once for each partition, so an attempt that failed, was
lost with its executor or ran beside another counts nothing. A write that fails as a whole has
no metrics, and reading them raises its error.
"""

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadglass.operators.cleaning import REASONS

ROWS = "rows"


class Gathered:
    """Metrics of the rows that pass through one write."""

    def __init__(self, **metrics: Column) -> None:
        self._metrics = {ROWS: F.count(F.lit(1)), **metrics}
        self._observation = Observation()

    def on(self, rows: DataFrame) -> DataFrame:
        """The same rows, which count themselves when they are written; call this once."""
        return rows.observe(
            self._observation, *[metric.alias(name) for name, metric in self._metrics.items()]
        )

    def counts(self) -> dict[str, int]:
        """The metrics, once the write has ended."""
        return self._observation.get


def clean_metrics(columns: list[str]) -> Gathered:
    """Rows, and missing values per column."""
    return Gathered(**{name: F.count_if(F.col(name).isNull()) for name in columns})


def reject_metrics() -> Gathered:
    """Rows, and rows per reason."""
    return Gathered(
        **{name: F.count_if(F.col("reject_reason") == F.lit(name)) for name in REASONS}
    )


def _literals(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """The few rows as literals in the plan, in their order."""
    kind = T.StructType.fromDDL(columns)
    values = F.array(*[F.struct(*map(F.lit, row)).cast(kind) for row in rows])
    return spark.range(0, 1, 1, 1).select(F.inline(values.cast(T.ArrayType(kind))))


def null_counts(spark: SparkSession, clean: dict[str, int]) -> DataFrame:
    rows = sorted((name, count) for name, count in clean.items() if name != ROWS)
    return _literals(spark, rows, "column_name string, null_count long")


def reject_report(spark: SparkSession, rejects: dict[str, int]) -> DataFrame:
    rows = sorted((name, rejects[name]) for name in REASONS if rejects[name])
    return _literals(spark, rows, "reject_reason string, rejected long")


def removal_summary(
    spark: SparkSession, clean: dict[str, int], rejects: dict[str, int]
) -> DataFrame:
    kept, removed = clean[ROWS], rejects[ROWS]
    rows = kept + removed
    return _literals(
        spark,
        [(rows, kept, removed, removed / rows * 100.0 if rows else None)],
        "rows_in long, rows_kept long, rows_removed long, removed_percent double",
    )


def tables(spark: SparkSession, clean: Gathered, rejects: Gathered) -> dict[str, DataFrame]:
    """Those tables of the clean report that the two writes have gathered."""
    kept, removed = clean.counts(), rejects.counts()
    return {
        "removal_summary": removal_summary(spark, kept, removed),
        "reject_report": reject_report(spark, removed),
        "null_counts": null_counts(spark, kept),
    }
