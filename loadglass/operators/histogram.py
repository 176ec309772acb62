"""Equal-width histogram."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadglass import schema
from loadglass.operators.aggregate import LATENCY, frequency
from loadglass.operators.spines import fit_to


def latency_histogram(log: DataFrame, bins: int = schema.HISTOGRAM_BINS) -> DataFrame:
    """Requests per latency bin between the minimum and the maximum.

    The last bin is closed. Bin numbers come from whole-number division, which
    puts values on a bin edge exactly, in decimals, which hold any BIGINT. With a single latency the range is widened
    by half a millisecond on each side, so all requests fall in the middle.

    The log is read once: limits and bins both come from its latency frequencies.
    """
    spark = log.sparkSession
    frequencies = frequency(log)
    low, high = (limit(LATENCY).cast("decimal(20,0)") for limit in (F.min, F.max))
    # Twice the latency keeps the half milliseconds of the widened range whole.
    limits = frequencies.agg(
        F.struct(
            F.when(low == high, low * 2 - 1).otherwise(low * 2).alias("start"),
            F.when(low == high, high * 2 + 1).otherwise(high * 2).alias("end"),
        ).alias("limits")
    ).scalar()

    bin_number = F.expr(
        f"(2 * CAST({LATENCY} AS DECIMAL(20,0)) - limits.start) * {bins}"
        " DIV (limits.end - limits.start)"
    )
    counts = (
        frequencies.filter(F.col(LATENCY).isNotNull())
        .withColumn("limits", limits)
        .withColumn("bucket", F.least(bin_number + 1, F.lit(bins)).cast("int"))
        .groupBy("bucket")
        .agg(F.sum("requests").alias("requests"))
    )
    spine = spark.range(1, bins + 1, numPartitions=1).select(
        F.col("id").cast("int").alias("bucket")
    )
    start, end = (F.col(f"limits.{name}").cast("double") / 2.0 for name in ("start", "end"))
    width = (end - start) / bins
    return (
        fit_to(spine, counts, ["bucket"])
        .withColumn("limits", limits)
        .select(
            "bucket",
            (start + (F.col("bucket") - 1) * width).alias("bucket_start"),
            (start + F.col("bucket") * width).alias("bucket_end"),
            "requests",
        )
        .orderBy("bucket")
    )
