"""Summaries that merge, against exact figures."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from loadglass.operators import heavy
from loadglass.operators.cleaning import add_derived_columns
from loadglass.plans import sketches

DAYS = 40


@pytest.fixture(scope="module")
def log(spark):
    """400,000 requests of 40 days, latencies with a long tail, one endpoint with a third."""
    ids = spark.range(400_000, numPartitions=8)
    noise = F.abs(F.xxhash64("id", F.lit("ms")) % 1_000_000) / 1_000_000.0
    place = F.pmod(F.xxhash64("id", F.lit("endpoint")), F.lit(90))
    made = ids.select(
        F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.xxhash64("id"), F.lit(DAYS * 86400)))
        .cast("timestamp_ntz").alias("timestamp"),
        F.lit("auth").alias("service"),
        F.concat(F.lit("/e"), F.when(place < 30, 0).otherwise(place).cast("string")).alias("endpoint"),
        F.floor(10 / (1.0001 - noise)).alias("response_time_ms"),
        F.lit(200).cast("long").alias("status_code"),
        (place == 3).alias("error"),
    )
    return add_derived_columns(made).cache()


@pytest.fixture(scope="module")
def cells(spark, log, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cells") / "cells")
    sketches.write_cells(log, path)
    return sketches.read_cells(spark, path)


def rank_errors(log, rows, key):
    """How far the ranks of the estimates are from those asked for."""
    latencies = {}
    for row in log.select(key, "response_time_ms").collect():
        latencies.setdefault(row[0], []).append(row[1])
    worst = 0
    for row in rows:
        values = sorted(latencies[row[key]])
        for name, fraction in (("p50_ms", 0.5), ("p95_ms", 0.95), ("p99_ms", 0.99)):
            below = sum(v < row[name] for v in values) / len(values)
            upto = sum(v <= row[name] for v in values) / len(values)
            worst = max(worst, below - fraction, fraction - upto)
    return worst


def test_rank_error_is_as_stated(log, cells):
    rows = sketches.percentiles_sketch(cells, "date").collect()
    assert len(rows) == DAYS and sum(row["requests"] for row in rows) == 400_000
    assert rank_errors(log, rows, "date") <= sketches.RANK_ERROR
    rows = sketches.percentiles_sketch(cells, "service").collect()
    assert rank_errors(log, rows, "service") <= sketches.RANK_ERROR


def test_cells_do_not_grow_with_distinct_latencies(spark, log, cells):
    groups = log.groupBy(*sketches.CELL_KEYS).count().count()
    assert cells.count() == groups
    one = sketches.merged_cells(cells.withColumn("all", F.lit(1)), "all")
    size = one.select(F.length("latencies")).first()[0]
    assert size < 8 * 4 * sketches.SKETCH_SIZE


def test_few_latencies_are_exact(make_clean):
    random.seed(1)
    values = [random.randrange(10_000) for _ in range(501)]
    log = make_clean([("2024-03-05 10:00:00", "auth", "/login", ms, 200, False) for ms in values])
    row = sketches.daily_percentiles_sketch(sketches.cells(log)).first()
    assert row["p50_ms"] == sorted(values)[250] and row["max_ms"] == max(values)


def test_days_are_replaced(spark, make_clean, tmp_path):
    path = str(tmp_path / "cells")
    rows = [("2024-03-05 10:00:00", "auth", "/login", 5, 200, False)]
    sketches.write_cells(make_clean(rows), path)
    sketches.write_cells(make_clean([("2024-03-06 10:00:00", "auth", "/login", 7, 200, True)] * 2), path)
    sketches.write_cells(make_clean(rows * 3), path)
    found = sketches.daily_percentiles_sketch(sketches.read_cells(spark, path)).collect()
    assert [(r["date"], r["requests"]) for r in found] == [
        (datetime.date(2024, 3, 5), 3), (datetime.date(2024, 3, 6), 2),
    ]


def test_missing_latencies_and_keys(spark, make_clean):
    log = make_clean([("2024-03-05 10:00:00", None, None, 5, 200, False)])
    log = log.withColumn("response_time_ms", F.lit(None).cast("long"))
    row = sketches.daily_percentiles_sketch(sketches.cells(log)).first()
    assert (row["requests"], row["mean_ms"], row["p95_ms"]) == (1, None, None)
    assert sketches.distinct_days(sketches.active_days(log, "service"), "service").collect() == []
    assert sketches.daily_percentiles_sketch(sketches.cells(log.limit(0))).collect() == []


def test_distinct_days_are_exact_over_any_months(spark):
    random.seed(4)
    days = [datetime.date(1950, 1, 1), datetime.date(1970, 1, 1), datetime.date(2199, 12, 31)]
    days += [datetime.date(2024, 1, 1) + datetime.timedelta(random.randrange(900)) for _ in range(500)]
    rows = [(day, f"s{random.randrange(3)}") for day in days] * 2
    log = spark.createDataFrame(rows, "date date, service string")
    found = sketches.distinct_days(sketches.active_days(log, "service"), "service").collect()
    expected = {}
    for day, service in rows:
        expected.setdefault(service, set()).add(day)
    assert {r["service"]: r["distinct_days"] for r in found} == {k: len(v) for k, v in expected.items()}


def test_distinct_error_is_as_stated(spark):
    errors = []
    for size in (100, 5_000, 200_000):
        log = spark.range(size * 3, numPartitions=4).select(
            F.lit("s").alias("service"),
            (F.col("id") % size).cast("string").alias("endpoint"),
            (F.col("id") % 7).alias("date"),
        )
        row = sketches.distinct_keys(sketches.seen_keys(log, "date").withColumn("x", F.lit(1)), "x").first()
        assert row["distinct_services"] == 1
        errors.append(abs(row["distinct_endpoints"] / size - 1))
    assert errors[0] == 0 and max(errors) <= 3 * sketches.DISTINCT_ERROR


def exact(rows, k):
    counts = {}
    for row in rows:
        if None not in row:
            counts[row] = counts.get(row, 0) + 1
    return [(*key, n) for key, n in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]]


@pytest.mark.parametrize("buckets", [1, 7, 1 << 16])
@pytest.mark.parametrize("shape", ["skewed", "flat", "few", "none"])
def test_top_keys(spark, monkeypatch, buckets, shape):
    monkeypatch.setattr(heavy, "BUCKETS", buckets)
    random.seed(len(shape))
    sizes = {"skewed": 3000, "flat": 400, "few": 6, "none": 0}
    if shape == "skewed":
        rows = [("s", f"/u{int(random.paretovariate(0.7)) % 900}") for _ in range(sizes[shape])]
    else:
        rows = [("s", f"/u{n % 100}") for n in range(sizes[shape])]
    rows += [(None, "/u1"), ("s", None)] * 50
    log = spark.createDataFrame(rows, "service string, endpoint string")
    found = heavy.top_keys(log, "service", "endpoint", k=10)
    assert [tuple(r) for r in found.collect()] == exact(rows, 10)


def test_top_keys_of_a_rollup_and_a_kept_summary(spark):
    rows = [("a", 5), ("b", 7), ("a", 4), ("c", 8)]
    log = spark.createDataFrame(rows, "endpoint string, requests long")
    summary = heavy.bucket_summary(log, "endpoint")
    found = heavy.top_keys(log, "endpoint", k=2, summary=summary).collect()
    assert [tuple(r) for r in found] == [("a", 9), ("c", 8)]
    with pytest.raises(ValueError):
        heavy.top_keys(log, "endpoint", k=0)


def test_few_keys_are_counted_on_a_skewed_log(spark):
    """What the second count shuffles are the keys of full buckets, not all keys."""
    ids = spark.range(200_000, numPartitions=4)
    log = ids.select(
        F.when(F.col("id") % 10 < 6, F.concat(F.lit("/hot"), (F.col("id") % 3).cast("string")))
        .otherwise(F.concat(F.lit("/id/"), F.col("id").cast("string")))
        .alias("endpoint")
    )
    summary = heavy.bucket_summary(log, "endpoint")
    assert summary.count() <= heavy.BUCKETS
    tried = summary.orderBy(F.desc("requests")).limit(3 * heavy.FIRST_BUCKETS)
    assert heavy._counted(log, ["endpoint"], tried).count() < 500
    found = heavy.top_keys(log, "endpoint", k=3).collect()
    assert {r["endpoint"] for r in found} == {"/hot0", "/hot1", "/hot2"}
