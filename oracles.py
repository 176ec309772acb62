"""SQL for every query in the catalog, written apart from the Spark code.

Each statement starts from the ``events`` view, repeats the mapping to a request
log and the cleaning, and ends in the report, so a match covers the whole chain.
"""

BASE = """
WITH dim(service_no, slot, service, endpoint, base_ms, base_error_rate, weight) AS (VALUES
  (0, 0, 'auth', '/login', 80, 0.03::DOUBLE, 0.60::DOUBLE),
  (0, 1, 'auth', '/register', 150, 0.05::DOUBLE, 0.15::DOUBLE),
  (0, 2, 'auth', '/logout', 30, 0.01::DOUBLE, 0.20::DOUBLE),
  (0, 3, 'auth', '/reset-password', 200, 0.08::DOUBLE, 0.05::DOUBLE),
  (1, 0, 'events', '/list', 100, 0.02::DOUBLE, 0.50::DOUBLE),
  (1, 1, 'events', '/create', 120, 0.04::DOUBLE, 0.25::DOUBLE),
  (1, 2, 'events', '/update', 90, 0.03::DOUBLE, 0.15::DOUBLE),
  (1, 3, 'events', '/delete', 70, 0.02::DOUBLE, 0.10::DOUBLE),
  (2, 0, 'payments', '/checkout', 300, 0.06::DOUBLE, 0.40::DOUBLE),
  (2, 1, 'payments', '/refund', 250, 0.07::DOUBLE, 0.10::DOUBLE),
  (2, 2, 'payments', '/history', 150, 0.02::DOUBLE, 0.35::DOUBLE),
  (2, 3, 'payments', '/verify', 180, 0.04::DOUBLE, 0.15::DOUBLE)),
keyed AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
raw AS (
  SELECT e.event_id, e.ts AS "timestamp", d.service, d.endpoint,
    CAST(CASE WHEN e.event_id % 1000 = 7 THEN -1
              ELSE greatest(10, CAST(floor(e."value" * 3) AS BIGINT)) END AS BIGINT)
      AS response_time_ms,
    CAST(CASE WHEN e.event_id % 2000 = 11 THEN 999
              WHEN e.event_type = 'error' AND e.k % 5 = 0
                THEN ([400, 401, 403, 404, 500, 502, 503])[(e.k // 5) % 7 + 1]
              WHEN e.event_type = 'signup' THEN 201
              ELSE 200 END AS BIGINT) AS status_code,
    (e.event_type = 'error' AND e.k % 5 = 0) AS error
  FROM keyed e JOIN dim d ON e.user_id % 3 = d.service_no AND e.k % 4 = d.slot),
dated AS (
  SELECT *, CAST(hour("timestamp") AS INT) AS "hour",
    dayname("timestamp") AS day_of_week,
    CAST(isodow("timestamp") - 1 AS INT) AS day_of_week_num,
    CAST("timestamp" AS DATE) AS "date",
    isodow("timestamp") >= 6 AS is_weekend,
    hour("timestamp") BETWEEN 18 AND 22 AS is_peak_hour
  FROM raw),
clean AS (
  SELECT * FROM dated
  WHERE response_time_ms >= 0
    AND status_code IN (200, 201, 400, 401, 403, 404, 500, 502, 503)),
model AS (
  SELECT c.*, d.base_ms, d.base_error_rate,
    (CASE WHEN "hour" BETWEEN 18 AND 22 THEN 2.5::DOUBLE
          WHEN "hour" BETWEEN 12 AND 14 THEN 1.5::DOUBLE
          WHEN "hour" BETWEEN 9 AND 17 THEN 1.2::DOUBLE
          WHEN "hour" BETWEEN 2 AND 6 THEN 0.3::DOUBLE
          ELSE 0.8::DOUBLE END)
    * (CASE WHEN day_of_week_num >= 5 THEN 0.7::DOUBLE
            WHEN day_of_week_num = 0 THEN 1.1::DOUBLE
            WHEN day_of_week_num = 4 THEN 1.2::DOUBLE
            ELSE 1.0::DOUBLE END) AS m
  FROM clean c JOIN dim d USING (service, endpoint))
"""

REASON = """
CASE WHEN "timestamp" IS NULL THEN 'invalid_timestamp'
     WHEN response_time_ms < 0 THEN 'negative_response_time'
     WHEN status_code IS NULL OR status_code NOT IN
       (200, 201, 400, 401, 403, 404, 500, 502, 503) THEN 'invalid_status_code'
     WHEN response_time_ms IS NULL THEN 'null_response_time' END
"""

MEAN = "avg(response_time_ms)"
MEDIAN = "quantile_cont(response_time_ms, 0.5)"
P95 = "quantile_cont(response_time_ms, 0.95)"
RATE = "avg(CAST(error AS INT))"
COARSE = f"round_even({RATE}, 2) * 100"
ERRORS = "CAST(count(*) FILTER (WHERE error) AS BIGINT)"
CLEAN_COLUMNS = (
    'event_id, "timestamp", service, endpoint, response_time_ms, status_code, error, '
    '"hour", day_of_week, day_of_week_num, "date", is_weekend, is_peak_hour'
)
RAW_COLUMNS = (
    'event_id, "timestamp", service, endpoint, response_time_ms, status_code, error'
)
LONG_PERIOD = "CASE WHEN is_peak_hour THEN 'Peak (6-10 PM)' ELSE 'Off-Peak' END"

INCIDENT = 'dayofmonth("timestamp") = 5 AND hour("timestamp") = 14'

def sample_rank(salt: str) -> str:
    return f"row_number() OVER (ORDER BY md5('{salt}' || event_id))"


def sample_size(fraction: str) -> str:
    return f"greatest(1, floor(count(*) OVER () * {fraction}::DOUBLE))"


def six(expression: str, name: str) -> str:
    return f'round_even({expression}, 6) AS "{name}"'


def two(expression: str, name: str) -> str:
    return f'round_even({expression}, 2) AS "{name}"'


LINES = """
, texts AS (
  SELECT event_id % 100 AS c, CAST(event_id AS VARCHAR) || ',' || CAST("timestamp" AS VARCHAR) AS a,
    service, endpoint || ',' || response_time_ms || ',' || status_code AS b, error, event_id
  FROM raw),
lines AS (
  SELECT *, CASE c WHEN 21 THEN a || ',' || service || ',' || b || ',' || error || ',x,"y,z"'
      WHEN 22 THEN a || ',' || service || ',' || b
      WHEN 23 THEN a || ',"' || service || ',' || b || ',' || error
      WHEN 24 THEN CAST(event_id AS VARCHAR)
      WHEN 25 THEN a || ',' || service || ',' || b || ',' || error || ',' END AS line,
    CASE WHEN c IN (21, 25) THEN 'too_many_fields' WHEN c IN (22, 24) THEN 'too_few_fields'
      WHEN c = 23 THEN 'open_quote' END AS line_reason
  FROM texts WHERE c <> 27)
"""

# The log with latencies of up to 64 bits in three of a thousand rows.
LARGE = """
, large AS (
  SELECT * REPLACE (CAST(CASE event_id % 1000 WHEN 1 THEN 4000000000
      WHEN 2 THEN 200000000000000000 WHEN 3 THEN 9000000000000000000
      ELSE response_time_ms END AS BIGINT) AS response_time_ms)
  FROM clean)
"""


def digits(expression: str, name: str) -> str:
    return f"printf('%.10e', CAST({expression} AS DOUBLE)) AS {name}"


REPORTS = {
    # sources and sinks
    "src_raw_log": f"SELECT {RAW_COLUMNS} FROM raw",
    "src_clean_log": f"SELECT {CLEAN_COLUMNS} FROM clean",
    "sink_clean_roundtrip": f"SELECT {CLEAN_COLUMNS} FROM clean",
    # parsing, cleaning and quality
    "malformed_lines": f"""
        {LINES}
        SELECT line, line_reason AS reject_reason FROM lines WHERE line_reason IS NOT NULL""",
    "malformed_report": f"""
        {LINES}
        SELECT coalesce(line_reason, reason) AS reject_reason, count(*) AS rejected
        FROM lines JOIN (SELECT event_id, {REASON} AS reason FROM raw) USING (event_id)
        WHERE line_reason IS NOT NULL OR reason IS NOT NULL GROUP BY 1""",
    "clean_from_lines": """
        SELECT event_id, service, response_time_ms, status_code, error FROM clean
        WHERE event_id % 100 NOT IN (21, 22, 23, 24, 25, 27)""",
    "parse_timestamps": """
        SELECT event_id,
          TRY_CAST(CASE WHEN event_id % 500 = 3 THEN 'x' ELSE '' END
                   || CAST("timestamp" AS VARCHAR) AS TIMESTAMP) AS "timestamp"
        FROM raw""",
    "ensure_dtypes": "SELECT event_id, response_time_ms, status_code, error FROM raw",
    "clean_from_text": """
        SELECT event_id, CASE WHEN reason IS NULL THEN ms END AS response_time_ms,
          CASE WHEN reason IS NULL THEN status_code END AS status_code,
          CASE WHEN reason IS NULL THEN error OR c = 15 END AS error, reason
        FROM (
          SELECT event_id, event_id % 100 AS c, error,
            CASE event_id % 100 WHEN 1 THEN 3000000000 WHEN 4 THEN 12
              ELSE response_time_ms END AS ms,
            CASE event_id % 100 WHEN 12 THEN 200 ELSE status_code END AS status_code,
            CASE WHEN event_id % 100 = 5 THEN 'invalid_timestamp'
              WHEN event_id % 100 = 2
                OR (response_time_ms < 0 AND event_id % 100 NOT IN (1, 3, 4, 6, 9))
                THEN 'negative_response_time'
              WHEN event_id % 100 IN (8, 13) OR (status_code = 999 AND event_id % 100 <> 12)
                THEN 'invalid_status_code'
              WHEN event_id % 100 IN (3, 6, 9) THEN 'unparsable_response_time' END AS reason
          FROM raw)""",
    "derived_columns": """
        SELECT event_id, "timestamp", "hour", day_of_week, day_of_week_num, "date",
          is_weekend, is_peak_hour FROM dated""",
    "filter_response_time": f"SELECT {RAW_COLUMNS} FROM raw WHERE response_time_ms >= 0",
    "filter_status": f"""
        SELECT {RAW_COLUMNS} FROM raw
        WHERE status_code IN (200, 201, 400, 401, 403, 404, 500, 502, 503)""",
    "clean_log": f"SELECT {CLEAN_COLUMNS} FROM clean",
    "rejected_log": f"""
        SELECT * FROM (SELECT {RAW_COLUMNS}, {REASON} AS reject_reason FROM raw)
        WHERE reject_reason IS NOT NULL""",
    "reject_report": f"""
        SELECT reject_reason, count(*) AS rejected
        FROM (SELECT {REASON} AS reject_reason FROM raw)
        WHERE reject_reason IS NOT NULL GROUP BY 1""",
    "invalid_codes": """
        SELECT DISTINCT status_code FROM raw
        WHERE response_time_ms >= 0
          AND status_code NOT IN (200, 201, 400, 401, 403, 404, 500, 502, 503)""",
    "removal_summary": f"""
        SELECT count(*) AS rows_in, count(*) - count(r) AS rows_kept,
          count(r) AS rows_removed,
          {six('count(r) / count(*)::DOUBLE * 100', 'removed_percent')}
        FROM (SELECT {REASON} AS r FROM raw)""",
    "null_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) - count(\"{name}\") AS null_count "
        "FROM clean"
        for name in [
            "event_id", "timestamp", "service", "endpoint", "response_time_ms",
            "status_code", "error", "hour", "day_of_week", "day_of_week_num", "date",
            "is_weekend", "is_peak_hour",
        ]
    ),
    "validation_ranges": """
        SELECT min(response_time_ms) AS min_ms, max(response_time_ms) AS max_ms,
          (SELECT string_agg(CAST(s AS VARCHAR), ',' ORDER BY s)
           FROM (SELECT DISTINCT status_code AS s FROM clean)) AS status_codes,
          min("timestamp") AS first_request, max("timestamp") AS last_request,
          (SELECT string_agg(s, ',' ORDER BY s)
           FROM (SELECT DISTINCT service AS s FROM clean)) AS services
        FROM clean""",
    "raw_summary": f"""
        SELECT min("timestamp") AS first_request, max("timestamp") AS last_request,
          (SELECT string_agg(s, ',' ORDER BY s)
           FROM (SELECT DISTINCT service AS s FROM raw)) AS services,
          count(*) AS total_requests, {six(f'{RATE} * 100', 'error_rate')},
          {six(MEAN, 'mean_ms')}, {six(P95, 'p95_ms')}
        FROM raw""",
    "clean_summary": f"""
        SELECT count(*) AS total_records, min("date") AS first_date,
          max("date") AS last_date, count(DISTINCT "date") AS unique_days,
          {six(f'{RATE} * 100', 'error_rate')}, {six(MEAN, 'mean_ms')},
          {six(MEDIAN, 'median_ms')}, {six(P95, 'p95_ms')},
          {six('quantile_cont(response_time_ms, 0.99)', 'p99_ms')}
        FROM clean""",
    # traffic
    "requests_by_hour": 'SELECT "hour", count(*) AS requests FROM clean GROUP BY 1',
    "requests_by_day": 'SELECT "date", count(*) AS requests FROM clean GROUP BY 1',
    "service_counts": "SELECT service, count(*) AS requests FROM clean GROUP BY 1",
    "status_counts": """
        SELECT status_code, count(*) AS requests,
          CASE WHEN status_code = 200 THEN 'Success' ELSE 'Error' END AS outcome
        FROM clean GROUP BY 1""",
    "service_share": f"""
        SELECT service, requests,
          {six('requests / sum(requests) OVER ()::DOUBLE * 100', 'share_percent')}
        FROM (SELECT service, count(*) AS requests FROM clean GROUP BY 1)""",
    "traffic_by_hour": """
        SELECT CAST(h AS INT) AS "hour", count(c.event_id) AS requests,
          CASE WHEN h BETWEEN 18 AND 22 THEN 'Peak (6-10 PM)' ELSE 'Off-Peak' END
            AS period
        FROM range(24) t(h) LEFT JOIN clean c ON c."hour" = h GROUP BY h""",
    "service_distribution": """
        SELECT s.service, count(c.event_id) AS requests
        FROM (SELECT DISTINCT service FROM dim) s LEFT JOIN clean c USING (service)
        GROUP BY 1""",
    "flat_distribution_check": """
        SELECT count(*) AS services, count(DISTINCT requests) AS distinct_counts,
          count(DISTINCT requests) = 1 AS is_flat
        FROM (SELECT s.service, count(c.event_id) AS requests
              FROM (SELECT DISTINCT service FROM dim) s
              LEFT JOIN clean c USING (service) GROUP BY 1)""",
    "hourly_vs_average": f"""
        SELECT "hour", requests, {six('avg(requests) OVER ()', 'average_requests')},
          requests > avg(requests) OVER () AS above_average
        FROM (SELECT "hour", count(*) AS requests FROM clean GROUP BY 1)""",
    "hour_labels": """
        SELECT CAST(h AS INT) AS "hour", printf('%02d:00', h) AS label,
          count(c.event_id) AS requests
        FROM range(24) t(h) LEFT JOIN clean c ON c."hour" = h GROUP BY h""",
    "peak_ratio": f"""
        SELECT {six('p', 'peak_average')}, {six('o', 'off_peak_average')},
          {six('p / o', 'peak_ratio')}
        FROM (SELECT avg(n) FILTER (WHERE "hour" BETWEEN 18 AND 22) AS p,
                avg(n) FILTER (WHERE "hour" NOT BETWEEN 18 AND 22) AS o
              FROM (SELECT "hour", count(*) AS n FROM clean GROUP BY 1))""",
    "busiest_quietest_hour": """
        , h AS (SELECT "hour", count(*) AS n FROM clean GROUP BY 1)
        SELECT (SELECT "hour" FROM h ORDER BY n DESC, "hour" LIMIT 1) AS busiest_hour,
          (SELECT max(n) FROM h) AS busiest_requests,
          (SELECT "hour" FROM h ORDER BY n, "hour" LIMIT 1) AS quietest_hour,
          (SELECT min(n) FROM h) AS quietest_requests""",
    # latency
    "response_time_stats": f"""
        SELECT {six(MEAN, 'mean_ms')}, {six(MEDIAN, 'median_ms')},
          {six('stddev_samp(response_time_ms)', 'std_ms')}, {six(MEDIAN, 'p50_ms')},
          {six('quantile_cont(response_time_ms, 0.9)', 'p90_ms')},
          {six(P95, 'p95_ms')},
          {six('quantile_cont(response_time_ms, 0.99)', 'p99_ms')},
          max(response_time_ms) AS max_ms
        FROM clean""",
    "response_by_hour": f"""
        SELECT "hour", {two(MEAN, 'mean_ms')}, {two(MEDIAN, 'median_ms')},
          {two(P95, 'p95_ms')} FROM clean GROUP BY 1""",
    "daily_response": f"""
        SELECT "date", {six(MEAN, 'mean_ms')}, {six(P95, 'p95_ms')}
        FROM clean GROUP BY 1""",
    "response_trend": f"""
        SELECT "date", {two(MEAN, 'mean_ms')}, {two(MEDIAN, 'median_ms')},
          {two(P95, 'p95_ms')} FROM clean GROUP BY 1""",
    "daily_metrics": f"""
        SELECT "date", {two(MEAN, 'mean_rt_ms')}, {two(MEDIAN, 'median_rt_ms')},
          {two(P95, 'p95_rt_ms')}, {COARSE} AS error_rate, {ERRORS} AS error_count,
          count(*) AS total_requests FROM clean GROUP BY 1""",
    "hourly_metrics": f"""
        SELECT "hour", {two(MEAN, 'mean_rt_ms')}, {two(P95, 'p95_rt_ms')},
          {COARSE} AS error_rate, count(*) AS total_requests FROM clean GROUP BY 1""",
    "latency_histogram": f"""
        , b AS (SELECT min(response_time_ms)::DOUBLE AS lo,
                  max(response_time_ms)::DOUBLE AS hi FROM clean),
        c AS (SELECT least(floor((response_time_ms - lo) * 50 / (hi - lo)) + 1, 50)
                AS bucket, count(*) AS n FROM clean, b GROUP BY 1)
        SELECT CAST(t.i AS INT) AS bucket,
          {six('lo + (t.i - 1) * (hi - lo) / 50', 'bucket_start')},
          {six('lo + t.i * (hi - lo) / 50', 'bucket_end')},
          coalesce(c.n, 0) AS requests
        FROM range(1, 51) t(i) CROSS JOIN b LEFT JOIN c ON c.bucket = t.i""",
    "large_latency_stats": f"""
        {LARGE}
        SELECT {digits(MEAN, 'mean_ms')}, {digits(MEDIAN, 'median_ms')},
          {digits('stddev_samp(response_time_ms::DOUBLE)', 'std_ms')}, {digits(MEDIAN, 'p50_ms')},
          {digits('quantile_cont(response_time_ms, 0.9)', 'p90_ms')}, {digits(P95, 'p95_ms')},
          {digits('quantile_cont(response_time_ms, 0.99)', 'p99_ms')},
          max(response_time_ms) AS max_ms, count(*) AS requests,
          CAST(sum(response_time_ms::HUGEINT) AS VARCHAR) AS total_ms
        FROM large""",
    "large_latency_endpoints": f"""
        {LARGE}
        SELECT service, endpoint, CAST(sum(response_time_ms::HUGEINT) AS VARCHAR) AS total_ms,
          {digits('sum(response_time_ms::HUGEINT)::DOUBLE / count(*)', 'mean_ms')},
          {digits(MEDIAN, 'median_ms')}, {digits(P95, 'p95_ms')}, count(*) AS requests
        FROM large GROUP BY 1, 2""",
    "large_latency_histogram": f"""
        {LARGE}
        , b AS (SELECT min(response_time_ms)::HUGEINT AS lo, max(response_time_ms)::HUGEINT AS hi
                FROM large),
        c AS (SELECT least((response_time_ms::HUGEINT - lo) * 50 // (hi - lo) + 1, 50) AS bucket,
                count(*) AS n FROM large, b GROUP BY 1)
        SELECT CAST(t.i AS INT) AS bucket,
          {digits('lo::DOUBLE + (t.i - 1) * ((hi - lo)::DOUBLE / 50)', 'bucket_start')},
          {digits('lo::DOUBLE + t.i * ((hi - lo)::DOUBLE / 50)', 'bucket_end')},
          coalesce(c.n, 0) AS requests
        FROM range(1, 51) t(i) CROSS JOIN b LEFT JOIN c ON c.bucket = t.i""",
    # errors
    "overall_error_rate": f"""
        SELECT count(*) AS requests, {ERRORS} AS errors,
          {six(f'{RATE} * 100', 'error_rate')} FROM clean""",
    "error_rate_by_hour": f"""
        SELECT "hour", {six(RATE, 'error')}, {six(f'{RATE} * 100', 'error_rate')}
        FROM clean GROUP BY 1""",
    "daily_errors": f"""
        SELECT "date", {six(f'{RATE} * 100', 'error_rate')},
          count(*) AS total_requests FROM clean GROUP BY 1""",
    "error_status_share": f"""
        SELECT status_code, requests,
          {six('requests / sum(requests) OVER ()::DOUBLE * 100', 'share_percent')}
        FROM (SELECT status_code, count(*) AS requests FROM clean WHERE error
              GROUP BY 1)""",
    "error_spike_hours": f"""
        , g AS (SELECT {RATE} * 100 AS o FROM clean)
        SELECT "hour", {six(f'{RATE} * 100', 'error_rate')},
          {six('any_value(o)', 'overall_error_rate')},
          {RATE} * 100 > any_value(o) AS above_average
        FROM clean CROSS JOIN g GROUP BY 1""",
    "error_heatmap": f"""
        SELECT CAST(d AS INT) AS day_of_week_num,
          (['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday',
            'Sunday'])[d + 1] AS day_of_week,
          CAST(h AS INT) AS "hour",
          {six(f'coalesce({RATE} * 100, 0)', 'error_rate')},
          count(c.event_id) AS requests
        FROM range(7) a(d) CROSS JOIN range(24) b(h)
        LEFT JOIN clean c ON c.day_of_week_num = d AND c."hour" = h
        GROUP BY d, h""",
    "error_heatmap_wide": "SELECT day_of_week, "
    + ", ".join(
        six(f'coalesce({RATE} FILTER (WHERE "hour" = {hour}) * 100, 0)', f"h{hour:02d}")
        for hour in range(24)
    )
    + """
        FROM (SELECT unnest(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday',
                             'Saturday', 'Sunday']) AS day_of_week)
        LEFT JOIN clean USING (day_of_week) GROUP BY 1""",
    "error_by_service": f"""
        SELECT s.service, {six(f'coalesce({RATE} * 100, 0)', 'error_rate')},
          count(c.event_id) AS total_requests
        FROM (SELECT DISTINCT service FROM dim) s LEFT JOIN clean c USING (service)
        GROUP BY 1""",
    "status_distribution": """
        SELECT CAST(s AS VARCHAR) AS status_code, count(c.event_id) AS "count",
          CASE WHEN CAST(s AS VARCHAR) LIKE '2%' THEN 'Success' ELSE 'Error' END
            AS "type"
        FROM (SELECT unnest([200, 400, 401, 403, 404, 500, 502, 503]) AS s)
        LEFT JOIN clean c ON c.status_code = s GROUP BY s""",
    # endpoints and services
    "endpoint_performance": f"""
        SELECT service, endpoint, {two(MEAN, 'mean_ms')}, {two(MEDIAN, 'median_ms')},
          {two(P95, 'p95_ms')}, count(*) AS request_count, {COARSE} AS error_rate
        FROM clean GROUP BY 1, 2""",
    "slowest_endpoint": f"""
        SELECT service, endpoint, {two(MEAN, 'mean_ms')}, {two(MEDIAN, 'median_ms')},
          {two(P95, 'p95_ms')}, count(*) AS request_count, {COARSE} AS error_rate
        FROM clean GROUP BY 1, 2 ORDER BY p95_ms DESC, service, endpoint LIMIT 1""",
    "service_summary": f"""
        SELECT service, {two(MEAN, 'mean_ms')}, {two(P95, 'p95_ms')},
          {COARSE} AS error_rate, count(*) AS total_requests FROM clean GROUP BY 1""",
    "endpoint_dashboard": f"""
        SELECT service, endpoint, {two(MEAN, 'mean_ms')}, {two(P95, 'p95_ms')},
          {COARSE} AS error_rate, count(*) AS requests,
          service || endpoint AS full_endpoint
        FROM clean GROUP BY service, endpoint""",
    "endpoint_severity": f"""
        SELECT full_endpoint, error_rate,
          CASE WHEN error_rate > 5 THEN 'high' WHEN error_rate > 3 THEN 'elevated'
               ELSE 'normal' END AS severity
        FROM (SELECT service || endpoint AS full_endpoint, {COARSE} AS error_rate
              FROM clean GROUP BY 1)""",
    # peak hours
    "peak_vs_offpeak": f"""
        SELECT CASE WHEN is_peak_hour THEN 'Peak' ELSE 'Off-Peak' END AS period,
          {two(MEAN, 'mean_ms')}, {two(MEDIAN, 'median_ms')}, {two(P95, 'p95_ms')},
          {COARSE} AS error_rate, count(*) AS request_count FROM clean GROUP BY 1""",
    "peak_degradation": f"""
        , p AS (SELECT is_peak_hour AS k, {two(MEAN, 'a')}, {COARSE} AS b,
                  count(*)::DOUBLE AS c FROM clean GROUP BY 1)
        SELECT {six('(x.a / y.a - 1) * 100', 'response_time_increase')},
          {six('(x.b / y.b - 1) * 100', 'error_rate_increase')},
          {six('(x.c / y.c - 1) * 100', 'traffic_increase')}
        FROM (SELECT * FROM p WHERE k) x, (SELECT * FROM p WHERE NOT k) y""",
    "peak_comparison": f"""
        SELECT is_peak_hour, {six(MEAN, 'response_time_ms')},
          {six(f'{RATE} * 100', 'error')}, {LONG_PERIOD} AS period
        FROM clean GROUP BY is_peak_hour""",
    "metric_labels": f"""
        SELECT {LONG_PERIOD} AS period,
          CAST(round_even({MEAN}, 0) AS BIGINT) || 'ms' AS latency_label,
          printf('%.2f%%', round_even({RATE} * 100, 2)) AS error_label,
          format('{{:,}}', count(*)) AS requests_label
        FROM clean GROUP BY is_peak_hour""",
    # dashboards
    "kpis": f"""
        , h AS (SELECT "hour", count(*) AS n FROM clean GROUP BY 1),
        r AS (SELECT avg(n) FILTER (WHERE "hour" BETWEEN 18 AND 22)
                / avg(n) FILTER (WHERE "hour" NOT BETWEEN 18 AND 22) AS v FROM h)
        SELECT count(*) AS total_requests, count(DISTINCT "date") AS total_days,
          {six('count(*)::DOUBLE / count(DISTINCT "date")', 'avg_daily')},
          {six(MEAN, 'mean_rt')}, {six(P95, 'p95_rt')},
          {six(f'{RATE} * 100', 'error_rate')}, {ERRORS} AS total_errors,
          {six('(SELECT v FROM r)', 'peak_ratio')}
        FROM clean""",
    "summary_dashboard": f"""
        , h AS (SELECT "hour", count(*) AS n FROM clean GROUP BY 1)
        SELECT count(*) AS total_requests, count(DISTINCT "date") AS total_days,
          {six('count(*)::DOUBLE / count(DISTINCT "date")', 'avg_daily_requests')},
          {six(MEAN, 'mean_rt')}, {six(P95, 'p95_rt')},
          {six(f'{RATE} * 100', 'error_rate')}, {ERRORS} AS total_errors,
          (SELECT "hour" FROM h ORDER BY n DESC, "hour" LIMIT 1) AS busiest_hour,
          (SELECT "hour" FROM h ORDER BY n, "hour" LIMIT 1) AS quietest_hour
        FROM clean""",
    # summaries that merge
    "daily_percentiles_sketch": """
        SELECT "date", count(*) AS requests, avg(response_time_ms) AS mean_ms,
          min(response_time_ms) AS min_ms, quantile_disc(response_time_ms, 0.5) AS p50_ms,
          quantile_disc(response_time_ms, 0.95) AS p95_ms,
          quantile_disc(response_time_ms, 0.99) AS p99_ms, max(response_time_ms) AS max_ms
        FROM clean GROUP BY 1""",
    "endpoint_percentiles_sketch": """
        SELECT service, endpoint, count(*) AS requests, avg(response_time_ms) AS mean_ms,
          min(response_time_ms) AS min_ms, max(response_time_ms) AS max_ms
        FROM clean GROUP BY 1, 2""",
    "distinct_days_by_endpoint": """
        SELECT service, endpoint, count(DISTINCT "date") AS distinct_days
        FROM clean GROUP BY 1, 2""",
    "distinct_keys_by_month": """
        SELECT CAST(date_trunc('month', "date") AS DATE) AS "month",
          count(DISTINCT service) AS distinct_services,
          count(DISTINCT (service, endpoint)) AS distinct_endpoints
        FROM clean GROUP BY 1""",
    "top_endpoints": """
        SELECT service, endpoint, count(*) AS requests FROM clean GROUP BY 1, 2
        ORDER BY requests DESC, service, endpoint LIMIT 5""",
    "top_users": """
        SELECT user_id, count(*) AS requests FROM events GROUP BY 1
        ORDER BY requests DESC, user_id LIMIT 20""",
    "incidents_by_window": f"""
        , w AS (SELECT k || ' ' || "date" AS label, "date"::TIMESTAMP + s AS "start",
                  "date"::TIMESTAMP + e AS "end"
                FROM (SELECT DISTINCT "date" FROM clean) CROSS JOIN (VALUES
                  ('hour', INTERVAL 14 HOUR, INTERVAL 15 HOUR),
                  ('days', INTERVAL 12 HOUR, INTERVAL 70 HOUR),
                  ('minutes', INTERVAL 540 MINUTE, INTERVAL 547 MINUTE),
                  ('later', INTERVAL 9000 DAY, INTERVAL 9001 DAY)) v(k, s, e))
        SELECT label, "start", "end", count(event_id) AS requests, {ERRORS} AS errors,
          {six(f'{RATE} * 100', 'error_rate')}, {six(MEAN, 'mean_ms')}
        FROM w LEFT JOIN clean ON "timestamp" >= "start" AND "timestamp" < "end"
        GROUP BY 1, 2, 3""",
    # load model
    "traffic_band": """
        SELECT "hour",
          CASE WHEN "hour" BETWEEN 18 AND 22 THEN 'evening'
               WHEN "hour" BETWEEN 12 AND 14 THEN 'lunch'
               WHEN "hour" BETWEEN 9 AND 17 THEN 'business'
               WHEN "hour" BETWEEN 2 AND 6 THEN 'night' ELSE 'other' END AS band,
          CAST(CASE WHEN "hour" BETWEEN 18 AND 22 THEN 2.5
               WHEN "hour" BETWEEN 12 AND 14 THEN 1.5
               WHEN "hour" BETWEEN 9 AND 17 THEN 1.2
               WHEN "hour" BETWEEN 2 AND 6 THEN 0.3 ELSE 0.8 END AS DOUBLE)
            AS multiplier,
          count(*) AS requests
        FROM clean GROUP BY "hour" """,
    "day_multiplier": """
        SELECT day_of_week_num, day_of_week,
          CAST(CASE WHEN day_of_week_num >= 5 THEN 0.7 WHEN day_of_week_num = 0 THEN 1.1
               WHEN day_of_week_num = 4 THEN 1.2 ELSE 1.0 END AS DOUBLE) AS multiplier,
          count(*) AS requests
        FROM clean GROUP BY day_of_week_num, day_of_week""",
    "expected_vs_observed": f"""
        , g AS (SELECT service, endpoint, "hour", count(*) AS requests,
                  avg(base_ms * (1 + (m - 1) * 0.4::DOUBLE)) AS e, {MEAN} AS o
                FROM model GROUP BY 1, 2, 3)
        SELECT service, endpoint, "hour", requests, {six('e', 'expected_ms')},
          {six('o', 'observed_ms')}, {six('o / e', 'observed_ratio')} FROM g""",
    "expected_error_rate": f"""
        SELECT service, endpoint, count(*) AS requests,
          {six('''avg(least(base_error_rate * (1 + (m - 1) * 0.5::DOUBLE)
            * CASE WHEN response_time_ms > base_ms * 3 THEN 1.5::DOUBLE
                   WHEN response_time_ms > base_ms * 2 THEN 1.2::DOUBLE
                   ELSE 1.0::DOUBLE END, 0.25::DOUBLE)) * 100''',
                'expected_error_rate')},
          {six(f'{RATE} * 100', 'observed_error_rate')}
        FROM model GROUP BY 1, 2""",
    "expected_traffic": f"""
        , b(service, base) AS (VALUES ('auth', 150), ('events', 100), ('payments', 50)),
        g AS (SELECT service, "date", "hour", any_value(m) AS m, count(*) AS n
              FROM model GROUP BY 1, 2, 3)
        SELECT service, "hour", count(*) AS days,
          {six('avg(floor(base * m))', 'expected_requests')},
          {six('avg(n)', 'observed_requests')}
        FROM g JOIN b USING (service) GROUP BY 1, 2""",
    "endpoint_mix": f"""
        SELECT service, endpoint, requests, {six('''requests
          / sum(requests) OVER (PARTITION BY service)::DOUBLE''', 'observed_share')},
          {six('weight', 'configured_share')}
        FROM (SELECT service, endpoint, count(*) AS requests FROM clean GROUP BY 1, 2)
        JOIN dim USING (service, endpoint)""",
    "error_code_mix": f"""
        , w(status_code, weight) AS (VALUES (400, 0.25::DOUBLE), (401, 0.15::DOUBLE),
          (403, 0.10::DOUBLE), (404, 0.15::DOUBLE), (500, 0.20::DOUBLE),
          (502, 0.05::DOUBLE), (503, 0.10::DOUBLE))
        SELECT status_code, requests,
          {six('requests / sum(requests) OVER ()::DOUBLE', 'observed_share')},
          {six('weight', 'configured_share')}
        FROM (SELECT status_code, count(*) AS requests FROM clean WHERE error
              GROUP BY 1) JOIN w USING (status_code)""",
    # incidents and samples
    "incident_window": f"SELECT {RAW_COLUMNS} FROM raw WHERE {INCIDENT}",
    "sample_n": f"""
        SELECT 'latency' AS "sample", event_id FROM raw
        QUALIFY {sample_rank('latency:')} <= {sample_size('0.001')}
        UNION ALL
        SELECT 'status' AS "sample", event_id FROM raw
        QUALIFY {sample_rank('status:')} <= {sample_size('0.0005')}""",
    "sample_fraction": f"""
        SELECT {RAW_COLUMNS} FROM raw WHERE {INCIDENT}
        QUALIFY {sample_rank('incident:')} <= round_even(count(*) OVER () * 0.3::DOUBLE, 0)""",
}

REPORTS["daily_metrics_via_rollup"] = REPORTS["daily_metrics"]
for table in ["daily_metrics", "reject_report"]:
    REPORTS[f"{table}_streamed"] = REPORTS[table]
for table in ["null_counts", "removal_summary", "reject_report"]:
    REPORTS[f"{table}_gathered"] = REPORTS[table]
REPORTS["sorted_csv_roundtrip"] = REPORTS["clean_log"]
for table in ["endpoint_performance", "daily_metrics", "hourly_metrics"]:
    REPORTS[f"{table}_roundtrip"] = REPORTS[table]
for report in ["kpis", "endpoint_performance"]:
    REPORTS[f"{report}_shared_scan"] = REPORTS[report]
REPORTS["error_heatmap_shared_scan"] = REPORTS["error_heatmap_wide"]

ORACLES = {name: f"{BASE}{sql}" for name, sql in REPORTS.items()}
