"""Requests within windows, against plain comparison of all pairs."""

import datetime
import random

import pytest

from loadglass.operators import windows

BEGIN = datetime.datetime(1969, 12, 30)
COLUMNS = "label string, start timestamp_ntz, end timestamp_ntz"


def moment(seconds):
    return BEGIN + datetime.timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def requests():
    random.seed(2)
    times = [random.randrange(10 * 86400) for _ in range(900)] + [3 * 86400] * 600
    return [(n, moment(t)) for n, t in enumerate(times)]


@pytest.fixture(scope="module")
def spans():
    random.seed(3)
    made = []
    for n in range(60):
        start = random.randrange(-86400, 10 * 86400)
        length = random.choice([1, 59, 60, 61, 119, 120, 121, 3600, 86400, 86401, 5 * 86400, 400 * 86400])
        made.append((f"w{n}", moment(start), moment(start + length)))
    made += [("same", moment(0), moment(86400 * 4))] * 2 + [("same2", moment(0), moment(86400 * 4))]
    made += [("none", moment(50), moment(50)), ("back", moment(60), moment(50))]
    made += [("open", moment(5), None), ("late", moment(10**9), moment(10**9 + 5))]
    made += [("edge", moment(3 * 86400), moment(3 * 86400 + 1)), ("before", moment(3 * 86400 - 1), moment(3 * 86400))]
    return made


def test_all_pairs(spark, requests, spans):
    log = spark.createDataFrame(requests, "event_id long, timestamp timestamp_ntz")
    found = windows.in_windows(log, spark.createDataFrame(spans, COLUMNS))
    assert found.columns == ["event_id", "timestamp", "label", "start", "end"]
    expected = [
        (id, label) for id, time in requests for label, start, end in spans
        if end is not None and start <= time < end
    ]
    assert sorted((r["event_id"], r["label"]) for r in found.collect()) == sorted(expected)


def test_each_window_has_a_row(spark, make_clean, spans):
    log = make_clean([(str(moment(3 * 86400)), "auth", "/login", 10 * n, 200, n == 1) for n in range(4)])
    rows = windows.incidents_by_window(log, spark.createDataFrame(spans, COLUMNS)).collect()
    assert len(rows) == len(set(spans))
    by_label = {row["label"]: row for row in rows}
    assert by_label["edge"].asDict() == {
        "label": "edge", "start": moment(3 * 86400), "end": moment(3 * 86400 + 1),
        "requests": 4, "errors": 1, "error_rate": 25.0, "mean_ms": 15.0,
    }
    for name in ("none", "back", "open", "late", "before"):
        assert (by_label[name]["requests"], by_label[name]["mean_ms"]) == (0, None)


def test_no_windows_and_no_requests(spark, make_clean, spans):
    log = make_clean([("2024-03-05 10:00:00", "auth", "/login", 5, 200, False)])
    assert windows.incidents_by_window(log, spark.createDataFrame([], COLUMNS)).collect() == []
    empty = windows.incidents_by_window(log.limit(0), spark.createDataFrame(spans, COLUMNS))
    assert {row["requests"] for row in empty.collect()} == {0}


def test_no_product_in_the_plan(spark, make_clean, spans):
    log = make_clean([("2024-03-05 10:00:00", "auth", "/login", 5, 200, False)])
    plan = windows.in_windows(log, spark.createDataFrame(spans, COLUMNS))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
