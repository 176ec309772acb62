import csv
import datetime
import glob
import os

import pytest
from pyspark.sql import functions as F

from loadglass import schema
import loadglass.__main__ as command_line
from loadglass.__main__ import main
from loadglass.operators.cleaning import clean_log
from loadglass.plans import bundles, latency, rollup
from loadglass.session import scratch_folder
from loadglass.sources import events, logs

# The columns of the published tables, in their order.
PUBLISHED = {
    "endpoint_performance": [
        "service", "endpoint", "mean_ms", "median_ms", "p95_ms", "request_count",
        "error_rate",
    ],
    "daily_metrics": [
        "date", "mean_rt_ms", "median_rt_ms", "p95_rt_ms", "error_rate", "error_count",
        "total_requests",
    ],
    "hourly_metrics": ["hour", "mean_rt_ms", "p95_rt_ms", "error_rate", "total_requests"],
}


@pytest.fixture(scope="module")
def clean(spark, folder):
    return clean_log(events.raw_log(spark, folder))


def read_csv(folder):
    parts = sorted(glob.glob(f"{folder}/part-*.csv"))
    lines = []
    for part in parts:
        with open(part, newline="") as file:
            header, *rest = list(csv.reader(file)) or [None]
            lines += rest
    return parts, header, lines


def test_published_tables(clean, tmp_path):
    for name, table in bundles.published_tables(clean).items():
        logs.write_table(table, str(tmp_path / name))
        parts, header, lines = read_csv(tmp_path / name)
        assert len(parts) == 1 and header == PUBLISHED[name]
        assert lines == [
            [str(value) for value in row] for row in table.collect()
        ]
        if name == "endpoint_performance":
            p95 = [float(line[4]) for line in lines]
            assert p95 == sorted(p95, reverse=True)


def test_sorted_csv_log(clean, tmp_path):
    logs.write_sorted_csv_log(clean, str(tmp_path / "log"))
    _, header, lines = read_csv(tmp_path / "log")
    assert header == clean.columns
    times = [line[header.index("timestamp")] for line in lines]
    assert len(times) == clean.count() and times == sorted(times)


def test_parquet_log_is_split_by_date_and_prunes(spark, clean, tmp_path):
    path = str(tmp_path / "log")
    logs.write_clean_log(clean, path)
    assert os.path.isdir(f"{path}/date=2024-01-01")
    back = logs.read_clean_log(spark, path, event_id=True)
    assert back.schema == schema.with_event_id(schema.CLEAN_LOG)
    assert back.exceptAll(clean).isEmpty() and back.count() == clean.count()
    day = back.filter(F.col("date") == datetime.date(2024, 1, 3)).groupBy("hour").count()
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "ReadSchema: struct<hour:int>" in plan


def test_rows_within_a_file_are_sorted(spark, clean, tmp_path):
    path = str(tmp_path / "log")
    logs.write_clean_log(clean, path)
    for file in glob.glob(f"{path}/date=*/part-*.parquet"):
        times = [row[0] for row in spark.read.parquet(file).select("timestamp").collect()]
        assert times == sorted(times)


def test_one_day_can_be_replaced(spark, clean, tmp_path):
    path = str(tmp_path / "log")
    logs.write_clean_log(clean, path)
    day = datetime.date(2024, 1, 3)
    part = clean.filter(F.col("date") == day).limit(5)
    logs.write_clean_log(part, path, keep_other_days=True)
    back = logs.read_clean_log(spark, path)
    assert back.filter(F.col("date") == day).count() == 5
    assert back.count() == clean.filter(F.col("date") != day).count() + 5


def test_rollup_is_repeatable_and_adds_up_by_day(spark, clean, tmp_path):
    path = str(tmp_path / "rollup")
    early = clean.filter(F.col("date") < datetime.date(2024, 1, 11))
    late = clean.filter(F.col("date") >= datetime.date(2024, 1, 11))
    for part in [early, late, late]:
        rollup.write_rollup(part, path)
    assert latency.daily_metrics(rollup.read_rollup(spark, path)).collect() == (
        latency.daily_metrics(clean).collect()
    )


def rounded(report):
    """Rows without the last bits, in which sums of fractions may differ."""
    return [
        [round(value, 9) if isinstance(value, float) else value for value in row]
        for row in report.collect()
    ]


@pytest.mark.parametrize(
    "bundle",
    [bundles.static_report, bundles.dashboard, bundles.load_model],
    ids=lambda bundle: bundle.__name__,
)
def test_every_report_is_the_same_from_a_rollup(spark, clean, tmp_path, bundle):
    path = str(tmp_path / "rollup")
    rollup.write_rollup(clean, path)
    from_rollup = bundle(rollup.read_rollup(spark, path))
    for name, report in bundle(clean).items():
        assert from_rollup[name].schema.simpleString() == report.schema.simpleString(), name
        assert rounded(from_rollup[name]) == rounded(report), name


def test_command_line(spark, folder, tmp_path):
    raw = str(tmp_path / "raw")
    logs.write_csv_log(events.raw_log(spark, folder).drop("event_id"), raw)
    at = {name: str(tmp_path / name) for name in ["clean", "rejects", "rollup", "tables"]}
    main(["clean", "--raw", raw, "--clean", at["clean"], "--rejects", at["rejects"],
          "--tables", at["tables"]])
    assert spark.read.parquet(at["rejects"]).count() == 2
    main(["rollup", "--clean", at["clean"], "--rollup", at["rollup"]])
    main(["report", "--rollup", at["rollup"], "--tables", at["tables"],
          "--set", "published", "dashboard"])
    for name, columns in PUBLISHED.items():
        _, header, lines = read_csv(f"{at['tables']}/{name}")
        assert header == columns and lines
    assert sum(int(line[-1]) for line in lines) == 998
    _, header, lines = read_csv(f"{at['tables']}/error_heatmap")
    assert len(lines) == 7 and len(header) == 25
    _, header, lines = read_csv(f"{at['tables']}/removal_summary")
    assert lines[0][:3] == ["1000", "998", "2"]


def test_scratch_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first.startswith(shared) and first != second


def test_clean_reads_the_text_once(spark, folder, tmp_path, monkeypatch):
    """After the rows are staged the raw text may be gone."""
    raw = str(tmp_path / "raw")
    logs.write_csv_log(events.raw_log(spark, folder).drop("event_id"), raw)
    stage = command_line.staged

    def stage_and_remove(*args):
        found = stage(*args)
        for path in glob.glob(f"{raw}/part-*"):
            os.remove(path)
        return found

    monkeypatch.setattr(command_line, "staged", stage_and_remove)
    at = {name: str(tmp_path / name) for name in ["clean", "rejects", "tables", "csv"]}
    main(["clean", "--raw", raw, "--clean", at["clean"], "--rejects", at["rejects"],
          "--tables", at["tables"], "--csv", at["csv"]])
    expected = events.raw_log(spark, folder)
    assert spark.read.parquet(at["clean"]).count() == clean_log(expected).count()
    assert len(read_csv(at["csv"])[2]) == clean_log(expected).count()
    assert {line[0]: int(line[1]) for line in read_csv(f"{at['tables']}/reject_report")[2]} == {
        "invalid_status_code": 1, "negative_response_time": 1,
    }


def test_a_day_that_becomes_empty_is_emptied(spark, make_clean, tmp_path):
    rows = [
        (f"2026-01-0{day} 10:00:00", "auth", "/a", 10 * day, 200, False) for day in [1, 2, 3]
    ]
    log, again = make_clean(rows), make_clean(rows[:1])
    days = [datetime.date(2026, 1, 1), datetime.date(2026, 1, 2)]
    at, rolled = str(tmp_path / "log"), str(tmp_path / "rollup")
    logs.write_clean_log(log.drop("event_id"), at)
    logs.write_clean_log(again.drop("event_id"), at, keep_other_days=True, days=days)
    rollup.write_rollup(log, rolled)
    rollup.write_rollup(again, rolled, days)
    for found in (logs.read_clean_log(spark, at), rollup.read_rollup(spark, rolled)):
        assert sorted(row.date.day for row in found.select("date").collect()) == [1, 3]
