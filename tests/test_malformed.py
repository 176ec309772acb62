"""Lines of text that do not have the fields of a log."""

import pytest

from loadglass import schema
from loadglass.operators import cleaning, quality
from loadglass.plans import summary
from loadglass.sources import logs

HEADER = "timestamp,service,endpoint,response_time_ms,status_code,error"
GOOD = "2024-01-01 00:00:00,auth,/login,5,200,false"
BAD = {
    GOOD + ",x": "too_many_fields",
    GOOD + ',"a,b"': "too_many_fields",
    GOOD + ",": "too_many_fields",
    "2024-01-01 00:00:00,auth,/login,5,200": "too_few_fields",
    "hello": "too_few_fields",
    '2024-01-01 00:00:00,"auth,/login",5,200,false': "too_few_fields",
    '2024-01-01 00:00:00,"auth,/login,5,200,false': "open_quote",
}


@pytest.fixture
def text(tmp_path):
    def write(*lines):
        (tmp_path / "log.csv").write_text("\n".join([HEADER, *lines]) + "\n")
        return str(tmp_path / "log.csv")

    return write


def test_malformed_lines_are_rejects_with_their_text(spark, text):
    raw = logs.read_raw_log(spark, text(GOOD, *BAD, "", GOOD))
    rejects = cleaning.rejected_log(raw).collect()
    assert {row[schema.MALFORMED]: row["reject_reason"] for row in rejects} == BAD
    clean = cleaning.clean_log(raw)
    assert clean.columns == schema.CLEAN_LOG.names and clean.count() == 2


def test_each_line_is_clean_or_a_reject(spark, text):
    broken = GOOD.replace(",200,", ",999,")
    raw = logs.read_raw_log(spark, text(GOOD, *BAD, broken))
    row = quality.removal_summary(raw).first()
    assert (row["rows_in"], row["rows_kept"], row["rows_removed"]) == (9, 1, 8)
    report = {r["reject_reason"]: r["rejected"] for r in quality.reject_report(raw).collect()}
    assert report == {"too_many_fields": 3, "too_few_fields": 3, "open_quote": 1, "invalid_status_code": 1}
    assert [r[0] for r in quality.invalid_codes(raw).collect()] == [999]
    assert summary.raw_summary(raw).first()["total_requests"] == 2


def test_few_columns_read_change_nothing(spark, text):
    raw = logs.read_raw_log(spark, text(GOOD, *BAD))
    assert [row["service"] for row in cleaning.well_formed(raw.select("service", schema.MALFORMED)).collect()] == ["auth"]


def test_line_breaks_in_quotes(spark, text):
    path = text('2024-01-01 00:00:00,"au\nth",/login,5,200,false', GOOD)
    assert cleaning.clean_log(logs.read_raw_log(spark, path)).count() == 1
    whole = logs.read_raw_log(spark, path, multi_line=True)
    assert {r["service"] for r in cleaning.clean_log(whole).collect()} == {"au\nth", "auth"}
    assert cleaning.rejected_log(whole).count() == 0


def test_a_strict_reader_ends_at_a_malformed_line(spark, text):
    with pytest.raises(Exception, match="MALFORMED"):
        logs.read_strict_raw_log(spark, text(GOOD, GOOD + ",x")).collect()


def test_parquet_has_no_lines(spark, text, tmp_path):
    raw = logs.read_raw_log(spark, text(GOOD, *BAD))
    cleaning.whole_numbers(cleaning.well_formed(raw)).write.parquet(str(tmp_path / "raw"))
    again = logs.read_raw_log(spark, str(tmp_path / "raw"), "parquet")
    assert schema.MALFORMED not in again.columns and cleaning.clean_log(again).count() == 1
