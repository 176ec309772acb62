import datetime

import pytest
from pyspark.sql import functions as F

from loadglass import schema
from loadglass.operators import cleaning, quality
from loadglass.sources import logs

GOOD = ("2026-01-05 14:00:00", "auth", "/login", 20, 200, False)


@pytest.fixture
def raw(make_raw):
    return make_raw(
        [
            GOOD,
            ("2026-01-05 14:00:01", "auth", "/login", -1, 200, False),
            ("2026-01-05 14:00:02", "auth", "/login", -1, 999, False),
            ("2026-01-05 14:00:03", "auth", "/login", 20, 999, True),
            ("2026-01-05 14:00:04", "auth", "/login", 20, None, True),
            ("2026-01-05 14:00:05", "auth", "/login", None, 200, False),
            ("2026-01-05 14:00:06", "auth", "/login", None, 998, False),
            (None, "auth", "/login", 20, 200, False),
            ("2026-01-05 14:00:08", "auth", "/login", 0, 201, False),
        ]
    )


def test_each_reject_has_its_first_reason(raw):
    reasons = {
        row.event_id: row.reject_reason for row in cleaning.rejected_log(raw).collect()
    }
    assert reasons == {
        1: "negative_response_time",
        2: "negative_response_time",
        3: "invalid_status_code",
        4: "invalid_status_code",
        5: "null_response_time",
        6: "invalid_status_code",
        7: "invalid_timestamp",
    }


def test_rejects_and_clean_rows_make_the_raw_log(raw):
    kept = {row.event_id for row in cleaning.clean_log(raw).collect()}
    rejected = {row.event_id for row in cleaning.rejected_log(raw).collect()}
    assert kept == {0, 8}
    assert kept | rejected == set(range(9)) and not kept & rejected


def test_quality_reports(raw):
    assert quality.removal_summary(raw).first().asDict() == {
        "rows_in": 9, "rows_kept": 2, "rows_removed": 7,
        "removed_percent": pytest.approx(7 / 9 * 100),
    }
    assert [tuple(row) for row in quality.reject_report(raw).collect()] == [
        ("invalid_status_code", 3), ("invalid_timestamp", 1),
        ("negative_response_time", 2), ("null_response_time", 1),
    ]
    # 999 of event 2 was already removed for its latency; a missing code counts.
    assert [row.status_code for row in quality.invalid_codes(raw).collect()] == [
        None, 998, 999,
    ]
    nulls = {row.column_name: row.null_count for row in quality.null_counts(raw).collect()}
    assert nulls["response_time_ms"] == 2 and nulls["status_code"] == 1


def test_empty_log(make_raw):
    empty = make_raw([GOOD]).filter("false")
    summary = quality.removal_summary(empty).first()
    assert (summary.rows_in, summary.removed_percent) == (0, None)
    assert cleaning.clean_log(empty).collect() == []


def test_derived_columns(make_clean):
    rows = make_clean(
        [
            ("2026-01-04 17:59:59", "auth", "/login", 20, 200, False),
            ("2026-01-05 18:00:00", "auth", "/login", 20, 200, False),
            ("2026-01-10 22:59:59", "auth", "/login", 20, 200, False),
            ("2026-01-09 23:00:00", "auth", "/login", 20, 200, False),
        ]
    )
    assert [tuple(row) for row in rows.orderBy("event_id").select(schema.CALENDAR.names).collect()] == [
        (17, "Sunday", 6, datetime.date(2026, 1, 4), True, False),
        (18, "Monday", 0, datetime.date(2026, 1, 5), False, True),
        (22, "Saturday", 5, datetime.date(2026, 1, 10), True, True),
        (23, "Friday", 4, datetime.date(2026, 1, 9), False, False),
    ]
    types = {field.name: field.dataType for field in rows.schema}
    assert all(types[field.name] == field.dataType for field in schema.CLEAN_LOG)


def test_text_values_become_typed(spark):
    text = spark.createDataFrame(
        [
            ("2026-01-01 00:00:03", "12", "200", "False"),
            ("2026-01-01T00:00:03", "12.0", "200.0", "True"),
            ("soon", "12.7", "abc", ""),
            ("2026-01-01", "NaN", None, None),
            ("2026-01-01 00:00:03.5", "inf", "1e2", " false "),
        ],
        "timestamp string, response_time_ms string, status_code string, error string",
    )
    second = datetime.datetime(2026, 1, 1, 0, 0, 3)
    typed = cleaning.ensure_dtypes(cleaning.parse_timestamps(text))
    assert [tuple(row) for row in typed.collect()] == [
        (second, 12, 200, False),
        (second, 12, 200, True),
        (None, 12, None, True),
        (datetime.datetime(2026, 1, 1), None, None, True),
        (second.replace(microsecond=500000), None, 100, False),
    ]


def test_broken_csv_lines_are_rejected_and_not_lost(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        "timestamp,service,endpoint,response_time_ms,status_code,error\n"
        "2026-01-01 00:00:03,auth,/login,87,200,False\n"
        "2026-01-01 00:00:04,auth,/login,90,500,True\n"
        "yesterday,auth,/login,90,500,True\n"
        "2026-01-01 00:00:05,auth\n"
    )
    raw = logs.read_raw_log(spark, str(path))
    clean = cleaning.clean_log(raw)
    assert [f.dataType for f in clean.schema] == [f.dataType for f in schema.CLEAN_LOG]
    assert cleaning.clean_log(raw).select("response_time_ms", "error").collect() == [
        (87, False), (90, True),
    ]
    assert sorted(
        row.reject_reason for row in cleaning.rejected_log(raw).collect()
    ) == ["invalid_timestamp", "too_few_fields"]


def test_clean_filters_reach_the_scan(spark, make_raw, tmp_path):
    path = str(tmp_path / "raw")
    make_raw([GOOD]).write.parquet(path)
    raw = logs.read_raw_log(spark, path, "parquet", event_id=True)
    kept = cleaning.clean_log(raw).groupBy("hour").agg(F.count("*").alias("n"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(response_time_ms,0)" in plan
    assert ", In(st" in plan  # the plan text is cut here
    assert "ReadSchema: struct<timestamp:timestamp_ntz,response_time_ms:bigint,status_code:bigint" in plan


def write_lines(path, *lines):
    path.write_text(
        "\n".join(["timestamp,service,endpoint,response_time_ms,status_code,error", *lines])
    )
    return str(path)


def test_rules_see_values_before_they_are_cut(spark, tmp_path):
    raw = logs.read_raw_log(
        spark,
        write_lines(
            tmp_path / "raw.csv",
            "2026-01-01 00:00:01,auth,/login,3000000000,200,False",
            "2026-01-01 00:00:02,auth,/login,-0.5,200,False",
            "2026-01-01 00:00:03,auth,/login,20,200.7,False",
            "2026-01-01 00:00:04,auth,/login,abc,200,False",
            "2026-01-01 00:00:05,auth,/login,,200,False",
            "2026-01-01 00:00:06-05:00,auth,/login,20,200,False",
            "2026-01-01T00:00:07Z,auth,/login,20,200,False",
            "2026-01-01 00:00:08,auth,/login,12.7,200.0,",
            "2026-01-01 00:00:09,auth,/login,1e19,200,False",
        ),
    )
    clean = cleaning.clean_log(raw).orderBy("timestamp")
    assert clean.select("response_time_ms", "status_code", "error").collect() == [
        (3_000_000_000, 200, False), (12, 200, True),
    ]
    reasons = [row.reject_reason for row in cleaning.rejected_log(raw).collect()]
    assert sorted(reasons) == sorted(
        [
            "negative_response_time", "invalid_status_code", "unparsable_response_time",
            "null_response_time", "invalid_timestamp", "invalid_timestamp",
            "unparsable_response_time",
        ]
    )


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_integers_of_either_width_are_read(spark, make_raw, tmp_path, kind):
    path = str(tmp_path / "raw")
    make_raw([GOOD, (*GOOD[:5], None)]).withColumns(
        {
            "response_time_ms": F.col("response_time_ms").cast(kind),
            "status_code": F.col("status_code").cast(kind),
        }
    ).write.parquet(path)
    raw = logs.read_raw_log(spark, path, "parquet")
    clean = cleaning.clean_log(raw).select("response_time_ms", "status_code", "error")
    # A missing flag counts as an error, from any format.
    assert sorted(clean.collect()) == [(20, 200, False), (20, 200, True)]


def test_strict_reading_stops_at_the_first_bad_value(spark, tmp_path):
    path = write_lines(tmp_path / "raw.csv", "soon,auth,/login,87,200,False")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        logs.read_strict_raw_log(spark, path).collect()


def test_invalid_codes_are_those_that_the_report_counts(make_raw):
    raw = make_raw([(None, "auth", "/login", 20, 999, True), (*GOOD[:4], 998, True)])
    assert [row.status_code for row in quality.invalid_codes(raw).collect()] == [998]
    reasons = {row.reject_reason: row.rejected for row in quality.reject_report(raw).collect()}
    assert reasons == {"invalid_timestamp": 1, "invalid_status_code": 1}
