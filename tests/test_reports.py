import datetime

import numpy as np
import pytest
from plan_text import executed_scans

from loadglass.operators.histogram import latency_histogram
from loadglass.plans import bundles, endpoints, errors, expectations, peak, summary, traffic


@pytest.fixture
def small(make_clean):
    """Hours 3, 9, 19 and 21 only, no events service, one unknown service."""
    return make_clean(
        [
            ("2026-01-05 03:00:00", "auth", "/login", 100, 200, False),
            ("2026-01-05 09:00:00", "auth", "/login", 110, 201, False),
            ("2026-01-05 09:30:00", "auth", "/logout", 30, 200, False),
            ("2026-01-05 19:00:00", "payments", "/refund", 400, 500, True),
            ("2026-01-05 19:10:00", "payments", "/refund", 300, 200, False),
            ("2026-01-06 19:20:00", "billing", "/x", 50, 200, False),
            ("2026-01-06 21:00:00", None, "/login", 60, 404, True),
        ]
    )


def rows(report):
    return [tuple(row) for row in report.collect()]


def test_hours_without_traffic_are_zero(small):
    found = rows(traffic.traffic_by_hour(small))
    assert [row[0] for row in found] == list(range(24))
    assert {row[0]: row[1] for row in found if row[1]} == {3: 1, 9: 2, 19: 3, 21: 1}
    assert [row[0] for row in found if row[2] == "Peak (6-10 PM)"] == [18, 19, 20, 21, 22]


def test_grids_drop_what_is_outside(small):
    assert rows(traffic.service_distribution(small)) == [
        ("auth", 3), ("events", 0), ("payments", 2),
    ]
    assert rows(errors.error_by_service(small)) == [
        ("auth", 0.0, 3), ("events", 0.0, 0), ("payments", 50.0, 2),
    ]
    found = {row[0]: row[1:] for row in rows(errors.status_distribution(small))}
    assert len(found) == 8 and "201" not in found
    assert found["200"] == (4, "Success") and found["500"] == (1, "Error")


def test_missing_keys_are_not_a_group(small):
    assert rows(traffic.service_counts(small)) == [
        ("auth", 3), ("payments", 2), ("billing", 1),
    ]


def test_two_rules_for_a_success(small):
    outcome = {row.status_code: row.outcome for row in traffic.status_counts(small).collect()}
    assert outcome == {200: "Success", 201: "Error", 404: "Error", 500: "Error"}


def test_heat_map(small):
    cells = errors.error_heatmap(small).collect()
    assert len(cells) == 168
    assert [(c.day_of_week_num, c.hour) for c in cells] == [
        (day, hour) for day in range(7) for hour in range(24)
    ]
    busy = {(c.day_of_week, c.hour): (c.error_rate, c.requests) for c in cells if c.requests}
    assert busy[("Monday", 19)] == (50.0, 2) and busy[("Tuesday", 21)] == (100.0, 1)
    wide = errors.error_heatmap_wide(small).collect()
    assert [row.day_of_week for row in wide][::6] == ["Monday", "Sunday"]
    assert wide[0].h19 == 50.0 and wide[0].h20 == 0.0 and len(wide[0]) == 25


def test_peak_ratio_counts_hours_that_had_traffic(small):
    # off-peak (1 + 2) / 2 hours, peak (3 + 1) / 2 hours
    assert rows(traffic.peak_ratio(small)) == [(2.0, 1.5, pytest.approx(4 / 3))]
    assert summary.kpis(small).first().peak_ratio == pytest.approx(4 / 3)


def test_of_equal_hours_the_first_wins(small):
    assert rows(traffic.busiest_quietest_hour(small)) == [(19, 3, 3, 1)]
    found = summary.summary_dashboard(small).first()
    assert (found.busiest_hour, found.quietest_hour) == (19, 3)
    tied = small.filter("hour = 3 OR hour = 21")
    assert rows(traffic.busiest_quietest_hour(tied)) == [(3, 1, 3, 1)]
    found = summary.summary_dashboard(tied).first()
    assert (found.busiest_hour, found.quietest_hour) == (3, 3)


def test_one_period_only(small):
    calm = small.filter("NOT is_peak_hour")
    assert [row[0] for row in rows(peak.peak_vs_offpeak(calm))] == ["Off-Peak"]
    assert rows(peak.peak_degradation(calm)) == [(None, None, None)]
    assert summary.kpis(calm).first().peak_ratio is None
    assert traffic.peak_ratio(calm).first().peak_average is None


def test_no_errors_off_peak_gives_no_error_change(small):
    found = peak.peak_degradation(small).first()
    assert found.error_rate_increase is None
    assert found.traffic_increase == pytest.approx((4 / 3 - 1) * 100)


def test_empty_log(small):
    nothing = small.filter("false")
    found = summary.kpis(nothing).first()
    assert (found.total_requests, found.total_days, found.error_rate) == (0, 0, None)
    assert len(rows(traffic.traffic_by_hour(nothing))) == 24
    assert rows(endpoints.endpoint_performance(nothing)) == []
    assert [row[3] for row in rows(latency_histogram(nothing))] == [0] * 50


def test_flat_distribution(make_clean):
    flat = make_clean(
        [
            (f"2026-01-05 0{hour}:00:00", service, "/a", 10, 200, False)
            for hour in range(4)
            for service in ["auth", "events", "payments"]
        ]
    )
    assert rows(traffic.flat_distribution_check(flat)) == [(3, 1, True)]
    assert rows(traffic.flat_distribution_check(flat.filter("service != 'auth' OR hour > 0"))) == [
        (3, 2, False)
    ]


def test_rates_are_rounded_before_they_become_percent(make_clean):
    log = make_clean(
        [("2026-01-05 14:00:00", "auth", "/login", 10, 200, number < 7) for number in range(101)]
    )
    assert endpoints.endpoint_performance(log).first().error_rate == 7.000000000000001
    assert errors.overall_error_rate(log).first().error_rate == pytest.approx(700 / 101)


def test_severity_limits_are_strict(make_clean):
    log = make_clean(
        [
            ("2026-01-05 14:00:00", "auth", f"/{bad}", 10, 200, number < bad)
            for bad in [2, 3, 4, 5, 6]
            for number in range(100)
        ]
    )
    assert [(row.full_endpoint, row.severity) for row in endpoints.endpoint_severity(log).collect()] == [
        ("auth/2", "normal"), ("auth/3", "normal"), ("auth/4", "elevated"),
        ("auth/5", "elevated"), ("auth/6", "high"),
    ]


def test_spike_hours_are_strictly_above(make_clean):
    log = make_clean(
        [
            (f"2026-01-05 {hour}:00:00", "auth", "/login", 10, 200, number < bad)
            for hour, bad in [(10, 1), (11, 2), (12, 3)]
            for number in range(10)
        ]
    )
    assert rows(errors.error_spike_hours(log)) == [
        (10, 10.0, 20.0, False), (11, 20.0, 20.0, False), (12, 30.0, 20.0, True),
    ]


@pytest.mark.parametrize("values", [[5, 5, 5], [0, 1, 2, 49, 50], [10, 11, 12], [3, 900, 77]])
def test_histogram_matches_numpy(make_clean, values):
    log = make_clean(
        [("2026-01-05 14:00:00", "auth", "/login", value, 200, False) for value in values]
    )
    found = latency_histogram(log).collect()
    counts, edges = np.histogram(values, bins=50)
    assert [row.requests for row in found] == counts.tolist()
    assert [row.bucket_start for row in found] == pytest.approx(edges[:-1].tolist())
    assert found[-1].bucket_end == pytest.approx(edges[-1])


def test_expectations(make_clean):
    # Monday 19:00: 2.5 * 1.1; the base of /login is 80 ms and 3 %.
    log = make_clean(
        [
            ("2026-01-05 19:00:00", "auth", "/login", 100, 200, False),
            ("2026-01-05 19:01:00", "auth", "/login", 200, 200, False),
            ("2026-01-05 19:02:00", "auth", "/login", 300, 500, True),
            ("2026-01-05 19:03:00", "other", "/login", 300, 500, True),
        ]
    )
    load = 2.5 * 1.1
    found = expectations.expected_vs_observed(log).collect()
    assert [row.service for row in found] == ["auth", "other"]
    assert (found[1].expected_ms, found[1].observed_ms) == (None, 300.0)
    assert found[0].expected_ms == pytest.approx(80 * (1 + (load - 1) * 0.4))
    assert found[0].observed_ms == 200.0
    rate = 0.03 * (1 + (load - 1) * 0.5)
    found, unknown = expectations.expected_error_rate(log).collect()
    assert (unknown.expected_error_rate, unknown.observed_error_rate) == (None, 100.0)
    assert found.expected_error_rate == pytest.approx(rate * (1 + 1.2 + 1.5) / 3 * 100)
    assert found.observed_error_rate == pytest.approx(100 / 3)
    found, unknown = expectations.expected_traffic(log).collect()
    assert (unknown.expected_requests, unknown.observed_requests) == (None, 1.0)
    assert (found.days, found.expected_requests, found.observed_requests) == (1, 412.0, 3.0)


def test_shares_add_up_with_unknown_endpoints_and_codes(make_clean):
    log = make_clean(
        [
            ("2026-01-05 19:00:00", "auth", "/login", 100, 201, True),
            ("2026-01-05 19:01:00", "auth", "/other", 200, 500, True),
            ("2026-01-05 19:02:00", "new", "/new", 300, 404, True),
        ]
    )
    mix = {(r.service, r.endpoint): r for r in expectations.endpoint_mix(log).collect()}
    assert mix["auth", "/login"].observed_share + mix["auth", "/other"].observed_share == 1
    assert mix["new", "/new"].configured_share is None
    codes = expectations.error_code_mix(log).collect()
    assert sum(row.observed_share for row in codes) == pytest.approx(1)
    assert [row.configured_share is None for row in codes] == [True, False, False]


def test_histogram_reads_the_log_once(spark, make_clean, tmp_path):
    path = str(tmp_path / "log")
    make_clean(
        [("2026-01-05 19:00:00", "auth", "/a", ms, 200, False) for ms in range(1, 90)]
    ).write.parquet(path)
    log = spark.read.parquet(path)
    assert executed_scans(latency_histogram(log)) == 1


def test_daily_rows_are_in_calendar_order(make_clean):
    log = make_clean(
        [(f"2026-01-{day:02d} 10:00:00", "auth", "/a", day, 200, False) for day in [9, 3, 7, 1]]
    )
    report = bundles.published_tables(log)["daily_metrics"]
    assert [row.date for row in report.collect()] == [
        datetime.date(2026, 1, day) for day in [1, 3, 7, 9]
    ]
