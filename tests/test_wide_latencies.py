"""Any BIGINT is a latency: no report ends, and totals stay exact."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from loadglass.operators import aggregate, histogram
from loadglass.plans import bundles, latency, rollup, summary

DAY = "2024-03-05 10:00:00"
LARGE = [4_000_000_000, 4_000_000_001, 2 * 10**17, 9 * 10**18, 2**63 - 1, 2**63 - 1, 0, 1, 57]


def log_of(make_clean, latencies):
    return make_clean([(DAY, "auth", "/login", ms, 200, False) for ms in latencies])


@pytest.mark.parametrize("latencies", [LARGE, [2**63 - 1] * 40, [2**62 + n for n in range(30)], [5], []])
def test_totals_are_exact(make_clean, latencies):
    log = log_of(make_clean, latencies)
    for frame in (log, rollup.with_calendar(rollup.roll_up(log))):
        row = aggregate.totals(frame).first()
        assert (row["total_ms"] or 0) == sum(latencies)
        assert row["timed_requests"] == len(latencies)


def test_negative_latencies_too(spark):
    values = [-(2**63), -(2**63), -1, -(2**42), 2**63 - 1, 3]
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    assert frame.agg(aggregate.wide_sum(F.col("v"), F.lit(1).cast("long"))).first()[0] == sum(values)
    cut = frame.select("v", aggregate._cut(F.col("v")).alias("cut")).orderBy("v").collect()
    assert [row["cut"] for row in cut] == sorted(row["cut"] for row in cut)


@pytest.mark.parametrize(
    "latencies", [LARGE, [2**63 - 1 - n for n in range(20)], [3, 3, 3], [1, 2, 4, 8], [10**18, 0] * 9]
)
def test_deviation(make_clean, latencies):
    row = latency.response_time_stats(log_of(make_clean, latencies)).first()
    assert row["std_ms"] == pytest.approx(statistics.stdev(latencies), rel=1e-12)
    assert row["mean_ms"] == pytest.approx(statistics.fmean(latencies), rel=1e-15)
    assert row["max_ms"] == max(latencies)


@pytest.mark.parametrize("kind", ["smallint", "int", "bigint"])
def test_narrower_columns_give_the_same(spark, kind):
    values = [5, 7, 30_000, 12]
    log = spark.createDataFrame([(v, False) for v in values], f"response_time_ms {kind}, error boolean")
    assert aggregate.totals(log).first()["total_ms"] == sum(values)
    row = latency.response_time_stats(log).first()
    assert row["std_ms"] == pytest.approx(statistics.stdev(values), rel=1e-12)


def test_one_request_has_no_deviation(make_clean):
    assert latency.response_time_stats(log_of(make_clean, [7])).first()["std_ms"] is None
    assert latency.response_time_stats(log_of(make_clean, [])).first()["std_ms"] is None


@pytest.mark.parametrize("latencies", [LARGE, [2**63 - 1], [2**63 - 1, 2**63 - 2]])
def test_histogram(make_clean, latencies):
    rows = histogram.latency_histogram(log_of(make_clean, latencies)).collect()
    assert len(rows) == 50 and sum(row["requests"] for row in rows) == len(latencies)
    assert rows[-1]["bucket_end"] == pytest.approx(max(latencies), rel=1e-15)


def test_every_report_works(make_clean, make_raw):
    log = log_of(make_clean, LARGE)
    for tables in (bundles.static_report(log), bundles.dashboard(log)):
        for table in tables.values():
            table.collect()
    raw = make_raw([(DAY, "auth", "/login", ms, 200, False) for ms in LARGE + [-(2**63)]])
    row = summary.raw_summary(raw).first()
    assert math.isclose(row["mean_ms"], (sum(LARGE) - 2**63) / (len(LARGE) + 1), rel_tol=1e-12)
