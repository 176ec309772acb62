import hashlib

import pytest
from plan_text import executed_scans
from loadglass.operators import incidents, sampling


def smallest(ids, size, salt=""):
    ranked = sorted(ids, key=lambda i: hashlib.md5(f"{salt}{i}".encode()).hexdigest())
    return set(ranked[:size])


@pytest.mark.parametrize(
    "rows, size, wanted",
    [
        (5000, sampling.fixed_size(0.001), 5),
        (999, sampling.fixed_size(0.001), 1),
        (1, sampling.fixed_size(0.0005), 1),
        (5000, sampling.rounded_fraction(0.3), 1500),
        (5, sampling.rounded_fraction(0.3), 2),
        (15, sampling.rounded_fraction(0.3), 4),
        (7, sampling.rounded_fraction(1.0), 7),
        (1, sampling.rounded_fraction(0.3), 0),
    ],
)
def test_exact_size_and_members(spark, rows, size, wanted):
    ids = spark.range(rows).withColumnRenamed("id", "event_id")
    found = [row.event_id for row in sampling.sample(ids, "event_id", size, "s:").collect()]
    assert len(found) == wanted
    assert set(found) == smallest(range(rows), wanted, "s:")


def test_edge_of_a_crowded_prefix(spark, monkeypatch):
    monkeypatch.setattr(sampling, "PREFIX", 2)
    monkeypatch.setattr(sampling, "FIRST_STEP", 1)
    ids = spark.range(1000).withColumnRenamed("id", "event_id")
    found = sampling.sample(ids, "event_id", sampling.rounded_fraction(0.3)).collect()
    assert {row.event_id for row in found} == smallest(range(1000), 300)


def test_repeated_and_missing_ids_keep_the_exact_size(spark):
    ids = spark.createDataFrame([(7,)] * 1000 + [(None,)] * 50, "event_id int")
    found = sampling.sample(ids, "event_id", sampling.rounded_fraction(0.1)).collect()
    assert [row.event_id for row in found] == [7] * 100


def test_samples_read_the_table_twice_however_many_they_are(spark, tmp_path):
    path = str(tmp_path / "ids")
    spark.range(5000).withColumnRenamed("id", "event_id").write.parquet(path)
    draws = {
        name: sampling.Draw(sampling.fixed_size(0.01), name) for name in ["a", "b", "c"]
    }
    found = sampling.samples(spark.read.parquet(path), "event_id", draws)
    rows = found.collect()
    for name in draws:
        members = {row.event_id for row in rows if row["sample"] == name}
        assert members == smallest(range(5000), 50, name)
    assert executed_scans(found) == 2


def test_empty_table_gives_an_empty_sample(spark):
    ids = spark.range(0).withColumnRenamed("id", "event_id")
    assert sampling.sample(ids, "event_id", sampling.fixed_size(0.1)).collect() == []


@pytest.fixture
def raw(make_raw):
    """Ten requests inside the window, in two months, and five around it."""
    inside = [
        (f"2026-0{month}-05 14:{minute}0:00", "auth", "/login", 10 + minute, 200, False)
        for month in [1, 2]
        for minute in range(5)
    ]
    outside = [
        ("2026-01-05 13:59:59", "auth", "/login", 20, 200, False),
        ("2026-01-05 15:00:00", "auth", "/login", 20, 404, True),
        ("2026-01-04 14:30:00", "auth", "/login", 20, 200, False),
        ("2026-01-15 14:30:00", "auth", "/login", 20, 200, False),
        (None, "auth", "/login", 20, 200, False),
    ]
    return make_raw(inside + outside)


def test_incident_window(raw):
    assert {row.event_id for row in incidents.incident_window(raw).collect()} == set(range(10))
