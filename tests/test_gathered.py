"""Metrics that a write gathers against reports that scan for them."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadglass import schema
from loadglass.operators import quality
from loadglass.operators.cleaning import REASONS, clean_log, rejected_log
from loadglass.plans import gathered
from loadglass.sources import logs

HEADER = ",".join(schema.RAW_LOG.names)
LINES = [
    *[f"2024-01-0{1 + n % 5} 0{n % 9}:00:00,auth,/a,{n},200,false" for n in range(200)],
    "2024-01-01 00:00:00,,,5,200,false",
    "2024-01-01 00:00:00,auth,/a,-5,200,false",
    "2024-01-01 00:00:00,auth,/a,5,999,false",
    "2024-01-01 00:00:00,auth,/a,,200,false",
    "2024-01-01 00:00:00,auth,/a,fast,200,false",
    "yesterday,auth,/a,5,200,false",
    "2024-01-01 00:00:00,auth,/a,5,200,false,more",
    "2024-01-01 00:00:00,auth",
    '2024-01-01 00:00:00,"auth,/a,5,200,false',
]


def written(raw, tmp_path, change=lambda rows: rows):
    log = clean_log(raw)
    kept, removed = gathered.clean_metrics(log.columns), gathered.reject_metrics()
    logs.write_clean_log(
        log, str(tmp_path / "clean"), watch=lambda rows: change(kept.on(rows))
    )
    change(removed.on(rejected_log(raw))).write.parquet(str(tmp_path / "rejects"))
    return gathered.tables(raw.sparkSession, kept, removed)


def assert_as_scanned(tables, raw):
    for name, expected in {
        "removal_summary": quality.removal_summary(raw),
        "reject_report": quality.reject_report(raw),
        "null_counts": quality.null_counts(clean_log(raw)),
    }.items():
        assert tables[name].dtypes == expected.dtypes
        assert tables[name].collect() == expected.collect(), name


@pytest.fixture
def raw(spark, tmp_path):
    for part in range(4):
        (tmp_path / f"{part}.csv").write_text("\n".join([HEADER, *LINES]) + "\n")
    return logs.read_raw_log(spark, str(tmp_path / "*.csv"))


def test_gathered_tables_are_those_of_a_scan(raw, tmp_path):
    tables = written(raw, tmp_path)
    assert_as_scanned(tables, raw)
    assert {row["reject_reason"] for row in tables["reject_report"].collect()} == set(REASONS)


def test_without_rows(spark, tmp_path):
    raw = spark.createDataFrame([], schema.RAW_LOG)
    assert_as_scanned(written(raw, tmp_path), raw)


def test_only_rejects(raw, tmp_path):
    raw = raw.where(F.col("status_code") == 999)
    assert_as_scanned(written(raw, tmp_path), raw)


def test_tables_of_counts_of_any_size(spark):
    counts = {gathered.ROWS: 5 << 40, "b": 3 << 31, "a": 0}
    assert [tuple(row) for row in gathered.null_counts(spark, counts).collect()] == [("a", 0), ("b", 3 << 31)]
    summary = gathered.removal_summary(spark, counts, {gathered.ROWS: 5 << 40})
    assert [tuple(row) for row in summary.collect()] == [(10 << 40, 5 << 40, 5 << 40, 50.0)]
    assert gathered.reject_report(spark, dict.fromkeys(REASONS, 0)).collect() == []
    for table in (gathered.null_counts(spark, counts), summary):
        assert "ExistingRDD" not in table._jdf.queryExecution().executedPlan().toString()


def test_attempts_that_fail_are_not_counted(tmp_path):
    """Each task of the writes fails after its rows were counted, and is tried again.

    This needs a session that retries, so it runs in a process of its own.
    """
    import subprocess
    import sys

    (tmp_path / "0.csv").write_text("\n".join([HEADER, *LINES]) + "\n")
    done = subprocess.run(
        [sys.executable, os.path.join(os.path.dirname(__file__), "retried_write.py"), str(tmp_path)],
        capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stdout + done.stderr
    assert "failed attempts: 2\n" in done.stdout


def test_command_reads_the_counts_of_its_writes(spark, raw, tmp_path, monkeypatch):
    from loadglass import __main__ as command

    monkeypatch.setattr(command, "session", lambda master: spark)
    monkeypatch.setattr(quality, "null_counts", lambda log: log)
    monkeypatch.setattr(quality, "removal_summary", lambda log: log)
    monkeypatch.setattr(quality, "reject_report", lambda log: log)
    command.main(
        ["clean", "--raw", str(tmp_path / "*.csv"), "--clean", str(tmp_path / "clean"),
         "--rejects", str(tmp_path / "rejects"), "--tables", str(tmp_path / "tables")]
    )
    columns = T.StructType(
        [T.StructField("column_name", T.StringType()), T.StructField("null_count", T.LongType())]
    )
    counts = logs.read_table(spark, str(tmp_path / "tables" / "null_counts"), columns)
    assert dict(counts.collect()) == {
        name: 4 if name in ("service", "endpoint") else 0 for name in schema.CLEAN_LOG.names
    }
