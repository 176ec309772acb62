"""The most frequent keys of an open key set, exactly.

Counting every key costs a shuffle as large as the keys, and raw URLs can be as many as the
requests. So keys are first hashed into a fixed number of buckets, and the buckets are
counted: a summary of bounded size that adds up over tasks, days and logs. A bucket has no
fewer requests than any of its keys. The keys of the fullest buckets are then counted exactly,
and the k-th of those counts is a lower limit: keys that belong to the answer are only in
buckets with at least that many requests. Keys of those buckets, a superset of the answer, are
counted exactly in a last pass. If the limit rules out what the first pass left, there is none.

The shuffle is the summary plus the keys of full buckets. On a flat log no bucket stands out
and all keys are counted, which is then the only exact way.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadglass.operators.aggregate import request_count, with_keys
from loadglass.session import scratch_folder

# Buckets of the summary: 16 bytes each for a task, and as many rows at most are broadcast.
BUCKETS = 1 << 16
# Buckets whose keys are counted first, for each key asked for.
FIRST_BUCKETS = 4

BUCKET = "__bucket"


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))


def bucket_summary(log: DataFrame, *keys: str) -> DataFrame:
    """Requests per bucket of the keys, ``BUCKETS`` rows at most. Summaries of several logs
    add up to the summary of all."""
    return (
        with_keys(log, keys)
        .groupBy(_bucket(keys).alias(BUCKET))
        .agg(request_count(log).alias("requests"))
    )


def _counted(log: DataFrame, keys: Sequence[str], buckets: DataFrame) -> DataFrame:
    """Exact requests of the keys in some buckets."""
    inside = with_keys(log, keys).join(
        F.broadcast(buckets.select(BUCKET)), _bucket(keys) == F.col(BUCKET), "left_semi"
    )
    return inside.groupBy(*keys).agg(request_count(log).alias("requests"))


def _first(counted: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    return counted.orderBy(F.desc("requests"), *keys).limit(k)


def top_keys(
    log: DataFrame, *keys: str, k: int, summary: DataFrame | None = None
) -> DataFrame:
    """The ``k`` keys with most requests and their ``requests``, most first; of equals those
    that sort first. A missing key is no key.

    ``summary``, a ``bucket_summary`` of the same log that was kept, saves one pass.
    """
    if k < 1:
        raise ValueError("k is at least 1")
    spark = log.sparkSession
    path = scratch_folder(spark, "buckets")
    (bucket_summary(log, *keys) if summary is None else summary).write.parquet(path)
    buckets = spark.read.parquet(path)

    fullest = buckets.orderBy(F.desc("requests"), BUCKET)
    tried = fullest.limit(FIRST_BUCKETS * k)
    first = _first(_counted(log, keys, tried), keys, k)
    path = scratch_folder(spark, "first-keys")
    first.write.parquet(path)
    first = spark.read.parquet(path)
    # Fewer than k keys give no limit: then every bucket counts.
    least = first.agg(F.when(F.count("*") == k, F.min("requests")).otherwise(0)).first()[0]
    needed = buckets.where(F.col("requests") >= least)
    untried = needed.join(tried, BUCKET, "left_anti")
    if untried.isEmpty():
        return first.orderBy(F.desc("requests"), *keys)
    return _first(_counted(log, keys, needed), keys, k)
