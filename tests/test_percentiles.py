import numpy as np
import pytest
from pyspark.sql import functions as F

from loadglass.functions.numeric import round_half_even
from loadglass.operators.aggregate import frequency, narrowed, profile, totals
from loadglass.plans import latency

FRACTIONS = [0.0, 0.5, 0.9, 0.95, 0.99, 1.0]


@pytest.fixture(scope="module")
def skewed(spark):
    """Three quarters of the rows have one service, half of those one latency."""
    random = np.random.default_rng(7)
    rows = []
    for service, size in [("auth", 3000), ("events", 900), ("payments", 7)]:
        values = random.lognormal(5, 1, size).astype(int)
        values[: size // 2] = 100
        rows += [(service, int(value), bool(value % 9 == 0)) for value in values]
    rows += [("wide", value, False) for value in [0, 65535, 65536, 2**31 - 1, 70000]]
    rows += [(None, 5, True)]
    return spark.createDataFrame(
        rows, "service string, response_time_ms int, error boolean"
    ), rows


def expected(rows):
    return {
        service: [row[1] for row in rows if row[0] == service]
        for service in {row[0] for row in rows} - {None}
    }


def test_exact_percentiles(skewed):
    log, rows = skewed
    found = {
        row.service: row
        for row in profile(log, "service", quantiles=FRACTIONS).collect()
    }
    groups = expected(rows)
    assert set(found) == set(groups)
    for service, values in groups.items():
        assert found[service].requests == len(values)
        assert found[service].quantiles == pytest.approx(
            np.quantile(values, FRACTIONS).tolist(), rel=1e-12
        )


def test_percentiles_of_the_whole_log(skewed):
    log, rows = skewed
    found = profile(log, quantiles=FRACTIONS).first()
    assert found.quantiles == pytest.approx(
        np.quantile([row[1] for row in rows], FRACTIONS).tolist(), rel=1e-12
    )


def test_percentiles_of_negative_and_huge_latencies(spark):
    values = [-(2**40) - 3, -5000, -4097, -4096, -4095, -1, 0, 2047, 2048, 2**52 + 1, 2**52 + 3]
    log = spark.createDataFrame(
        [(v, False) for v in values], "response_time_ms long, error boolean"
    )
    found = profile(log, quantiles=FRACTIONS).first()
    assert found.quantiles == pytest.approx(np.quantile(values, FRACTIONS).tolist(), rel=1e-12)


def test_millions_of_latencies_in_one_key(spark):
    """The final percentile holds cut latencies only, not the distinct ones."""
    rows = 3_000_000
    log = spark.range(rows).select(
        F.lit("auth").alias("service"),
        (F.col("id") * 2_654_435_761 % 2_000_000_011).alias("response_time_ms"),
        F.lit(False).alias("error"),
    )
    found = profile(log, "service", quantiles=[0.5, 0.95]).first()
    values = np.arange(rows, dtype=np.int64) * 2_654_435_761 % 2_000_000_011
    assert found.quantiles == pytest.approx(np.quantile(values, [0.5, 0.95]).tolist(), rel=1e-12)
    counted = narrowed(frequency(log, "service"), "service", quantiles=[0.5, 0.95])
    assert counted.select("narrow").distinct().count() < 60_000


def test_totals_are_exact_and_leave_out_missing_keys(skewed):
    log, rows = skewed
    for row in totals(log, "service").collect():
        values = [r for r in rows if r[0] == row.service]
        assert row.requests == row.timed_requests == len(values)
        assert row.total_ms == sum(r[1] for r in values)
        assert row.errors == sum(r[2] for r in values)


def test_deviation_matches_numpy(skewed):
    log, rows = skewed
    stats = latency.response_time_stats(log).first()
    values = np.array([row[1] for row in rows], dtype=float)
    assert stats.std_ms == pytest.approx(values.std(ddof=1), rel=1e-9)
    assert stats.mean_ms == pytest.approx(values.mean(), rel=1e-12)
    assert stats.max_ms == values.max()


def test_deviation_of_one_request_is_missing(spark):
    one = spark.createDataFrame(
        [(5, False)], "response_time_ms int, error boolean"
    )
    stats = latency.response_time_stats(one).first()
    assert stats.std_ms is None and stats.p99_ms == 5


def test_a_rollup_gives_the_same_profile(skewed):
    log, _ = skewed
    weighted = log.groupBy("service", "response_time_ms", "error").agg(
        F.count("*").alias("requests")
    )
    assert sorted(profile(weighted, "service").collect()) == sorted(
        profile(log, "service").collect()
    )


def test_rounding_is_half_even(spark):
    values = [155.575, 0.125, 0.375, 2.675, -1.005, 1.115]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    rounded = [row[0] for row in rows.select(round_half_even(F.col("v"))).collect()]
    assert rounded == np.round(values, 2).tolist()
