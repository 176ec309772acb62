import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from loadglass.operators.cleaning import clean_log
from loadglass.plans import bundles, rollup
from loadglass.sources import events, ledger, logs
from loadglass.streaming import rollup_stream
from loadglass.streaming.rollup_stream import read_raw_stream, start_rollup


def run(spark, source, target, checkpoint):
    stream = read_raw_stream(spark, source, files_per_batch=1)
    query = start_rollup(stream, target, checkpoint)
    query.awaitTermination(300)
    assert query.exception() is None and not query.isActive


def test_arriving_files_give_the_batch_reports(spark, folder, tmp_path):
    source, target = str(tmp_path / "raw"), str(tmp_path / "rollup")
    checkpoint = str(tmp_path / "checkpoint")
    raw = events.raw_log(spark, folder)
    clean = clean_log(raw)

    def deliver(part):
        raw.filter(F.col("event_id") % 3 == part).drop("event_id").coalesce(1).write.mode(
            "append"
        ).option("header", True).option("timestampNTZFormat", logs.CSV_TIMESTAMP).csv(source)

    # The parts overlap in time, so later files bring late rows for every day.
    deliver(0)
    deliver(1)
    run(spark, source, target, checkpoint)
    deliver(2)
    run(spark, source, target, checkpoint)

    read = rollup.read_rollup(spark, target)
    assert read.agg(F.sum("requests")).first()[0] == clean.count()
    for name, report in bundles.published_tables(read).items():
        assert report.collect() == bundles.published_tables(clean)[name].collect()
    # Rolling the batches up once more gives the rollup of the whole log.
    assert rollup.roll_up(read).exceptAll(rollup.roll_up(clean)).isEmpty()


HEADER = "timestamp,service,endpoint,response_time_ms,status_code,error"


def deliver(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.csv").write_text("\n".join([HEADER, *lines]) + "\n")


def line(day, ms, status=200):
    return f"2024-01-0{day} 10:00:00,auth,/a,{ms},{status},false"


def stream(spark, tmp_path, checkpoint="checkpoint", files=1, fan_in=8):
    query = start_rollup(
        read_raw_stream(spark, str(tmp_path / "raw"), files_per_batch=files),
        str(tmp_path / "rollup"), str(tmp_path / checkpoint),
        rejects=str(tmp_path / "rejects"), fan_in=fan_in,
    )
    query.awaitTermination(300)
    assert not query.isActive


def state(spark, tmp_path):
    """Requests per day and latency, and rejects per reason."""
    path = str(tmp_path / "rollup")
    rows = rollup.read_rollup(spark, path).groupBy("date", "response_time_ms")
    rejects = rollup_stream.read_rejects(spark, path, str(tmp_path / "rejects"))
    return (
        {(row[0].day, row[1]): row[2] for row in rows.agg(F.sum("requests")).collect()},
        dict(rejects.groupBy("reject_reason").count().collect()),
    )


def test_rejects_are_kept(spark, tmp_path):
    deliver(tmp_path / "raw", "a", line(1, 5), line(1, -5), line(1, 5, 999), "broken")
    deliver(tmp_path / "raw", "b", line(2, 5), line(2, 7) + ",more")
    stream(spark, tmp_path)
    assert state(spark, tmp_path) == (
        {(1, 5): 1, (2, 5): 1},
        {"negative_response_time": 1, "invalid_status_code": 1, "too_few_fields": 1,
         "too_many_fields": 1},
    )
    rejects = rollup_stream.read_rejects(
        spark, str(tmp_path / "rollup"), str(tmp_path / "rejects")
    )
    assert {row["malformed_line"]: row["source_file"][-5:] for row in rejects.collect()} == {
        None: "a.csv", "broken": "a.csv", line(2, 7) + ",more": "b.csv",
    }


@pytest.mark.parametrize("recorded", [False, True])
def test_a_batch_that_is_cut_off_counts_once(spark, tmp_path, monkeypatch, recorded):
    """The writer dies before its record is written, or after it."""
    deliver(tmp_path / "raw", "a", line(1, 5), line(1, -5))
    stream(spark, tmp_path)
    deliver(tmp_path / "raw", "b", line(1, 5), line(2, 6), "broken")
    record = ledger.record

    def dies(*args, **kwargs):
        if recorded:
            record(*args, **kwargs)
        raise RuntimeError("killed")

    monkeypatch.setattr(ledger, "record", dies)
    with pytest.raises(StreamingQueryException):
        stream(spark, tmp_path)
    if not recorded:
        before = ({(1, 5): 1}, {"negative_response_time": 1})
        assert state(spark, tmp_path) == before
    monkeypatch.setattr(ledger, "record", record)
    stream(spark, tmp_path)
    after = ({(1, 5): 2, (2, 6): 1}, {"negative_response_time": 1, "too_few_fields": 1})
    assert state(spark, tmp_path) == after


def test_a_lost_checkpoint_repeats_nothing(spark, tmp_path):
    deliver(tmp_path / "raw", "a", line(1, 5))
    deliver(tmp_path / "raw", "b", line(1, 5), line(1, 5, 999))
    stream(spark, tmp_path)
    deliver(tmp_path / "raw", "c", line(1, 6))
    # Batches of other files than at first, one of them with old and new files.
    stream(spark, tmp_path, "another", files=2)
    assert state(spark, tmp_path) == ({(1, 5): 2, (1, 6): 1}, {"invalid_status_code": 1})
    stream(spark, tmp_path, "third", files=9)
    assert state(spark, tmp_path) == ({(1, 5): 2, (1, 6): 1}, {"invalid_status_code": 1})


def test_batches_merge_and_stay_few(spark, tmp_path):
    for number in range(9):
        deliver(tmp_path / "raw", str(number), line(1, number % 2), line(2, 7), "broken")
    stream(spark, tmp_path, fan_in=2)
    path = str(tmp_path / "rollup")
    levels = ledger.live(ledger.read_ledger(spark, path))
    # Nine is 1001 in binary.
    assert {level: len(batches) for level, batches in levels.items()} == {0: 1, 3: 1}
    days = [
        len(list((tmp_path / "rollup" / f"batch={batch}").glob("date=2024-01-02/*.parquet")))
        for batches in levels.values() for batch in batches
    ]
    assert days == [1, 1]
    expected = {(1, 0): 5, (1, 1): 4, (2, 7): 9}
    assert state(spark, tmp_path) == (expected, {"too_few_fields": 9})


def test_a_merge_that_is_cut_off_changes_nothing(spark, tmp_path, monkeypatch):
    for number in range(3):
        deliver(tmp_path / "raw", str(number), line(1, 5))
    stream(spark, tmp_path)
    path = str(tmp_path / "rollup")
    record = ledger.record
    monkeypatch.setattr(ledger, "record", lambda *args, **kwargs: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        rollup_stream.merge_batches(spark, path, 3)
    assert state(spark, tmp_path)[0] == {(1, 5): 3}
    monkeypatch.setattr(ledger, "record", record)
    rollup_stream.merge_batches(spark, path, 3)
    assert len(ledger.live_folders(spark, path)) == 1
    assert state(spark, tmp_path)[0] == {(1, 5): 3}


def test_files_with_rejects_only_or_nothing(spark, tmp_path):
    deliver(tmp_path / "raw", "a")
    deliver(tmp_path / "raw", "b", "broken")
    stream(spark, tmp_path)
    assert state(spark, tmp_path) == ({}, {"too_few_fields": 1})
