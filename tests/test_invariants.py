"""Properties that hold between reports over the same log, and of all plans."""

import re

import pytest

from loadglass.catalog import QUERIES



@pytest.fixture(scope="module")
def result(spark, folder):
    found = {}

    def get(name):
        if name not in found:
            found[name] = QUERIES[name](spark, folder).collect()
        return found[name]

    return get


def test_request_totals_agree(result):
    totals = {
        name: sum(row[column] for row in result(name))
        for name, column in [
            ("requests_by_hour", "requests"),
            ("requests_by_day", "requests"),
            ("endpoint_performance", "request_count"),
            ("service_summary", "total_requests"),
            ("peak_vs_offpeak", "request_count"),
            ("daily_metrics", "total_requests"),
            ("hourly_metrics", "total_requests"),
            ("error_heatmap", "requests"),
            ("latency_histogram", "requests"),
            ("status_counts", "requests"),
            ("kpis", "total_requests"),
        ]
    }
    assert set(totals.values()) == {998}


def test_shares_add_up(result):
    assert sum(r.share_percent for r in result("service_share")) == pytest.approx(100)
    assert sum(r.share_percent for r in result("error_status_share")) == pytest.approx(100)
    assert sum(r.observed_share for r in result("endpoint_mix")) == pytest.approx(3)


def test_grid_sizes(result):
    sizes = [
        ("traffic_by_hour", 24), ("error_heatmap", 168), ("error_heatmap_wide", 7),
        ("error_by_service", 3), ("service_distribution", 3), ("status_distribution", 8),
        ("latency_histogram", 50),
    ]
    assert [len(result(name)) for name, _ in sizes] == [size for _, size in sizes]


def test_percentiles_are_ordered(result):
    stats = result("response_time_stats")[0]
    ordered = [stats.median_ms, stats.p50_ms, stats.p90_ms, stats.p95_ms, stats.p99_ms, stats.max_ms]
    assert ordered == sorted(ordered) and stats.median_ms == stats.p50_ms


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_python_and_no_products(spark, folder, name):
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert "localCheckpoint" not in plan and "ExistingRDD" not in plan
