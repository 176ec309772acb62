"""Parsing, typing, filtering and deriving: raw request log to clean log."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadglass import schema
from loadglass.functions.calendar import calendar_columns

INVALID_TIMESTAMP = "invalid_timestamp"
NEGATIVE_LATENCY = "negative_response_time"
INVALID_STATUS = "invalid_status_code"
NULL_LATENCY = "null_response_time"
TOO_MANY_FIELDS = "too_many_fields"
TOO_FEW_FIELDS = "too_few_fields"
OPEN_QUOTE = "open_quote"
UNPARSABLE_LATENCY = "unparsable_response_time"

REASONS = [
    TOO_MANY_FIELDS, TOO_FEW_FIELDS, OPEN_QUOTE, INVALID_TIMESTAMP, NEGATIVE_LATENCY,
    INVALID_STATUS, NULL_LATENCY, UNPARSABLE_LATENCY,
]

# From here on a latency is no BIGINT. A double can hold this bound exactly.
LATENCY_LIMIT = float(2**63)


def parse_timestamps(text_log: DataFrame) -> DataFrame:
    """Text timestamps to ``TIMESTAMP_NTZ``; what cannot be parsed becomes NULL.

    The clean stage then rejects those rows, so one bad line does not end a job. Times
    are local: with a zone or an offset after the time they cannot be compared with the
    others, so such a text counts as one that does not parse.
    """
    has_zone = F.rlike("timestamp", F.lit(r":[0-9.]+\s*[^0-9.:\s]"))
    return text_log.withColumn(
        "timestamp",
        F.when(~has_zone, F.col("timestamp").try_cast("timestamp_ntz")),
    )


def _number(text: Column) -> Column:
    """Text to double; NULL stays NULL, and text that is no number becomes NaN."""
    return F.when(
        text.isNotNull(), F.coalesce(text.try_cast("double"), F.lit(float("nan")))
    )


def parse_numbers(text_log: DataFrame) -> DataFrame:
    """Text latency and status to double, so that rules see fractions and large values,
    and the error flag to boolean; a missing flag stays missing.

    The words for false give false, any other word counts as an error.
    """
    flag = F.trim("error")
    return text_log.withColumns(
        {
            "response_time_ms": _number(F.col("response_time_ms")),
            "status_code": _number(F.col("status_code")),
            "error": F.when(
                flag != "", F.coalesce(flag.try_cast("boolean"), F.lit(True))
            ),
        }
    )


def whole_numbers(log: DataFrame) -> DataFrame:
    """Latency and status to BIGINT, cutting fractions; no number gives NULL. A missing
    error flag counts as an error: a request is only fine when the log says so."""

    def whole(name: str) -> Column:
        value = F.col(name)
        if log.schema[name].dataType == T.DoubleType():
            value = F.when(~F.isnan(name), value)
        return value.try_cast("bigint")

    return log.withColumns(
        {
            "response_time_ms": whole("response_time_ms"),
            "status_code": whole("status_code"),
            "error": F.coalesce("error", F.lit(True)),
        }
    )


def ensure_dtypes(text_log: DataFrame) -> DataFrame:
    """Text latency, status and error flag to their final types."""
    return whole_numbers(parse_numbers(text_log))


def parse_log(text_log: DataFrame) -> DataFrame:
    """All-text rows, as a CSV file holds them, with values that the rules can judge."""
    return parse_numbers(parse_timestamps(text_log))


def has_valid_latency() -> Column:
    return F.col("response_time_ms") >= 0


def _has_whole_latency(raw: DataFrame) -> Column:
    """Parsed latencies may be NaN, which Spark sorts above all numbers."""
    if raw.schema["response_time_ms"].dataType == T.DoubleType():
        return F.col("response_time_ms") < LATENCY_LIMIT
    return F.lit(True)


def has_valid_status() -> Column:
    return F.expr(f"status_code IN {tuple(schema.VALID_STATUS_CODES)}")


def drop_invalid_response_times(raw: DataFrame) -> DataFrame:
    return raw.filter(has_valid_latency())


def drop_invalid_status_codes(raw: DataFrame) -> DataFrame:
    return raw.filter(has_valid_status())


def well_formed(raw: DataFrame) -> DataFrame:
    """The rows that are requests: lines of text with the fields of a log."""
    if schema.MALFORMED not in raw.columns:
        return raw
    return raw.filter(F.col(schema.MALFORMED).isNull()).drop(schema.MALFORMED)


def _malformed_reason(raw: DataFrame) -> Column:
    """What is wrong with a line that does not have the fields of the log; NULL without one.

    Fields are counted in the text without its quoted pieces.
    """
    line = F.col(schema.MALFORMED)
    fields = sum(name in schema.with_event_id(schema.RAW_LOG).names for name in raw.columns)
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    found = F.size(F.split(F.regexp_replace(line, '"[^"]*"', ""), ","))
    return (
        F.when(line.isNull(), F.lit(None))
        .when(quotes % 2 == 1, OPEN_QUOTE)
        .when(found > fields, TOO_MANY_FIELDS)
        .otherwise(TOO_FEW_FIELDS)
    )


def reject_reason(raw: DataFrame) -> Column:
    """The first rule a raw row breaks, NULL for a good row.

    The rules run in this order, so a row breaking two of them counts once. They see
    values as parsed: -0.5 is negative, 200.7 is no status. What a malformed line seems to
    hold is not looked at.
    """
    rules = _value_reason()
    if schema.MALFORMED not in raw.columns:
        return rules
    return F.coalesce(_malformed_reason(raw), rules)


def _value_reason() -> Column:
    return (
        F.when(F.col("timestamp").isNull(), INVALID_TIMESTAMP)
        .when(F.col("response_time_ms") < 0, NEGATIVE_LATENCY)
        .when(~F.coalesce(has_valid_status(), F.lit(False)), INVALID_STATUS)
        .when(F.col("response_time_ms").isNull(), NULL_LATENCY)
        .when(
            F.col("response_time_ms").cast("double") >= LATENCY_LIMIT, UNPARSABLE_LATENCY
        )
    )


def add_derived_columns(log: DataFrame) -> DataFrame:
    return log.withColumns(calendar_columns())


def keep_valid(raw: DataFrame) -> DataFrame:
    """Rows that break no rule, as plain predicates the scan can push down."""
    return well_formed(raw).filter(
        F.col("timestamp").isNotNull()
        & has_valid_latency()
        & has_valid_status()
        & _has_whole_latency(raw)
    )


def clean_log(raw: DataFrame) -> DataFrame:
    """The clean stage: valid rows, then their final types and calendar columns.

    It does not sort. Order is a property of the files, see ``sources``.
    """
    return add_derived_columns(whole_numbers(keep_valid(raw)))


def rejected_log(raw: DataFrame) -> DataFrame:
    """The rows the clean stage drops, with the reason, and malformed lines with their text."""
    return raw.withColumn("reject_reason", reject_reason(raw)).filter(
        F.col("reject_reason").isNotNull()
    )
