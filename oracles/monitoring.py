"""Checks of profiles, samples, log questions, metric alarms and file events."""

import re

from .common import FILE_EVENTS, LOGS, METRICS, TRIPS, out
from .zones import COLS

P = "tpep_pickup_datetime"
TYPES = {
    "trip_ref": "string", "VendorID": "int", P: "timestamp_ntz", "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "int", "trip_distance": "double", "RatecodeID": "int", "store_and_fwd_flag": "string",
    "PULocationID": "int", "DOLocationID": "int", "payment_type": "int", "fare_amount": "double", "extra": "double",
    "mta_tax": "double", "tip_amount": "double", "tolls_amount": "double", "improvement_surcharge": "double",
    "congestion_surcharge": "double", "airport_fee": "double", "total_amount": "double",
}
NUMERIC = [c for c, t in TYPES.items() if t in ("int", "double")]


def pct(part, whole):
    return f"round({part} * 100.0 / {whole} + 1e-9, 2)"


SCHEMA = " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null, count(*) - count({c}) AS nulls,"
    f" {pct(f'(count(*) - count({c}))', 'count(*)')} AS null_pct FROM trips"
    for i, (c, t) in enumerate(TYPES.items())
)
NUM = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,"
    f" min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, quantile_cont({c}::DOUBLE, 0.25) AS p25,"
    f" quantile_cont({c}::DOUBLE, 0.5) AS p50, quantile_cont({c}::DOUBLE, 0.75) AS p75 FROM trips"
    for c in NUMERIC
)
CAT = " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS \"column\", count(*) OVER () AS n_unique,"
    f" row_number() OVER (ORDER BY count(*) DESC, {c}) AS rank, {c} AS value, count(*) AS n,"
    f" {pct('count(*)', '(SELECT count(*) FROM trips)')} AS pct FROM trips GROUP BY {c}) WHERE rank <= 5"
    for c in ("trip_ref", "store_and_fwd_flag")
)
TIMES = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", min({c}) AS min, max({c}) AS max, epoch(max({c})) - epoch(min({c})) AS range_seconds"
    " FROM trips"
    for c in (P, "tpep_dropoff_datetime")
)
HASHED = "hashed AS (SELECT *, md5(trip_ref || '-42') AS h FROM trips)"
N = 1003
STRATIFIED = (
    HASHED
    + f", size AS (SELECT PULocationID, round_even(count(*) * ({N}::DOUBLE / (SELECT count(*) FROM trips)), 0) AS quota"
    " FROM trips WHERE PULocationID IS NOT NULL GROUP BY 1),"
    " ranked AS (SELECT *, row_number() OVER (PARTITION BY PULocationID ORDER BY h) AS rn FROM hashed),"
    " first AS (SELECT ranked.* FROM ranked JOIN size USING (PULocationID) WHERE rn <= quota),"
    f" trimmed AS (SELECT * FROM first ORDER BY h LIMIT {N}),"
    " rest AS (SELECT * FROM ranked WHERE trip_ref NOT IN (SELECT trip_ref FROM first)),"
    f" more AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY h) AS k FROM rest)"
    f" WHERE k <= {N} - (SELECT count(*) FROM first)),"
    " chosen AS (SELECT * FROM trimmed UNION ALL SELECT * EXCLUDE (k) FROM more)"
)
VALID = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", (SELECT avg({c}) FROM trips) AS original_mean, (SELECT avg({c}) FROM s) AS sample_mean"
    for c in NUMERIC
)
HANDLERS = "log_group LIKE '/lambda/%'"
JOBS = "log_group LIKE '/glue/%'"
EVERY = f"({HANDLERS} OR {JOBS})"


def has(pattern: str) -> str:
    return f"regexp_matches(message, '{pattern}')"


def field(pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract(message, '{pattern}', {group}), '')"


ERROR_CLASS = r"(\w+Exception): (.*)"
RECORDS = r"records processed: (\d+)"
SECONDS = r"execution time: (\d+)"
SIZE_MB = r'"size_mb": ([\d.]+)'
BIN5 = "time_bucket(INTERVAL '5 minutes', ts)"
HOUR = "time_bucket(INTERVAL '1 hour', ts)"
USED = "max_memory_used / memory_size::DOUBLE"

RULES = [
    ("errors", "error", "sum", 3600, ">=", 100.0, 1, False),
    ("clicks-stale", "click", "max", 3600, ">", 60.0, 1, True),
    ("daily-purchases", "purchase", "max", 86400, ">", 60.0, 1, False),
    ("slow-views", "view", "max", 21600, ">", 25.0, 2, False),
    ("signup-average", "signup", "avg", 86400, ">", 20.0, 3, False),
]


def _alarm(name, metric, stat, period, op, limit, n, missing) -> str:
    return (
        f"SELECT '{name}' AS rule, dim, make_timestamp(p * 1000000) AS period_start, value, breaching, CASE WHEN"
        f" count(*) FILTER (WHERE breaching) OVER (PARTITION BY dim ORDER BY p ROWS BETWEEN {n - 1} PRECEDING"
        f" AND CURRENT ROW) = {n} THEN 'ALARM' ELSE 'OK' END AS state FROM (SELECT g.dim, g.p, value,"
        f" coalesce(value {op} {limit}, {missing}) AS breaching FROM (SELECT dim, unnest(generate_series("
        f" (SELECT floor(min(epoch(ts)))::BIGINT // {period} * {period} FROM metrics),"
        f" (SELECT floor(max(epoch(ts)))::BIGINT FROM metrics), {period})) AS p FROM"
        f" (SELECT DISTINCT dim FROM metrics WHERE metric = '{metric}')) g LEFT JOIN"
        f" (SELECT dim, floor(epoch(ts))::BIGINT // {period} * {period} AS p, {stat}(value) AS value FROM metrics"
        f" WHERE metric = '{metric}' GROUP BY 1, 2) r ON r.dim = g.dim AND r.p = g.p)"
    )


SUFFIX = "(lower(key) LIKE '%.parquet' OR lower(key) LIKE '%.csv' OR lower(key) LIKE '%.csv.gz')"
REASON = (
    "CASE WHEN event_name NOT LIKE 'ObjectCreated%' THEN 'not_a_creation' WHEN bucket = '' OR key = ''"
    " THEN 'missing_bucket_or_key' WHEN key NOT LIKE 'raw/taxi/%' THEN 'outside_prefix'"
    f" WHEN NOT {SUFFIX} THEN 'unsupported_type' END"
)

ORACLES = {
    "profile_schema": out(SCHEMA, 'i:position "column" type i:non_null i:nulls d:null_pct', TRIPS),
    "missing_summary": out(f"SELECT * FROM ({SCHEMA}) WHERE nulls > 0", '"column" i:nulls d:null_pct', TRIPS),
    "profile_numeric": out(NUM, '"column" i:count d:mean d:std d:min d:max d:p25 d:p50 d:p75', TRIPS),
    "profile_categorical": out(CAT, '"column" i:n_unique i:rank value i:n d:pct', TRIPS),
    "profile_datetime": out(TIMES, '"column" min max i:range_seconds', TRIPS),
    "sample_statistics": out(
        f"SELECT count(*) AS total_trips, min({P}) AS date_start, max({P}) AS date_end,"
        " avg(trip_distance) AS distance_mean, quantile_cont(trip_distance, 0.5) AS distance_median,"
        " max(trip_distance) AS distance_max, avg(fare_amount) AS fare_mean, quantile_cont(fare_amount, 0.5)"
        " AS fare_median, sum(fare_amount) AS fare_total, avg(passenger_count) AS passengers_mean, (SELECT"
        " passenger_count FROM trips WHERE passenger_count IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"
        " AS passengers_mode FROM trips",
        "i:total_trips date_start date_end d:distance_mean d:distance_median d:distance_max d:fare_mean d:fare_median"
        " d:fare_total d:passengers_mean i:passengers_mode",
        TRIPS,
    ),
    "duplicate_rows_columns": out(
        f"SELECT n AS row_count, n - u AS duplicates, {pct('(n - u)', 'n')} AS duplicate_pct FROM (SELECT"
        " (SELECT count(*) FROM trips) AS n, (SELECT count(*) FROM (SELECT DISTINCT VendorID, PULocationID,"
        " DOLocationID, payment_type, tolls_amount FROM trips)) AS u)",
        "i:row_count i:duplicates d:duplicate_pct",
        TRIPS,
    ),
    "duplicate_rows": out(
        "SELECT n AS row_count, n - u AS duplicates, round((n - u) * 100.0 / n + 1e-9, 2) AS duplicate_pct FROM"
        " (SELECT (SELECT count(*) FROM trips) AS n, (SELECT count(*) FROM (SELECT DISTINCT * FROM trips)) AS u)",
        "i:row_count i:duplicates d:duplicate_pct",
        TRIPS,
    ),
    "sample_random": out("SELECT * FROM hashed ORDER BY h LIMIT 1000", COLS, TRIPS + ", " + HASHED),
    "sample_stratified": out("FROM chosen", COLS, TRIPS + ", " + STRATIFIED),
    "sample_time_range": out(
        f"SELECT * FROM hashed WHERE {P} >= TIMESTAMP '1998-01-01' AND {P} <= TIMESTAMP '1998-12-31'"
        " ORDER BY h LIMIT 500",
        COLS,
        TRIPS + ", " + HASHED,
    ),
    "sample_validation": out(
        'SELECT *, CASE WHEN original_mean = 0 THEN 0 ELSE abs(original_mean - sample_mean) * 100 / original_mean END'
        f" AS diff_pct FROM ({VALID})",
        '"column" d:original_mean d:sample_mean d:diff_pct',
        TRIPS + ", " + HASHED + ", s AS (SELECT * FROM hashed ORDER BY h LIMIT 1000)",
    ),
    "log_query": out(
        f"FROM logs WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' AND {HANDLERS}",
        "i:event_id ts log_group type message d:duration d:billed_duration i:memory_size i:max_memory_used",
        LOGS,
    ),
    "log_failed_records": out(
        f"SELECT {field('(ERROR|FAIL|Exception): (.*)')} AS error_type,"
        f" {field('(ERROR|FAIL|Exception): (.*)', 2)} AS error_message, count(*) AS count FROM logs"
        f" WHERE {EVERY} AND {has('ERROR|FAIL|Exception')} GROUP BY 1, 2 ORDER BY 3 DESC, 1 NULLS FIRST, 2 LIMIT 20",
        "error_type error_message i:count",
        LOGS,
    ),
    "log_processing_time": out(
        f"SELECT {BIN5} AS bin, avg(duration) AS avg_duration, max(duration) AS max_duration,"
        " min(duration) AS min_duration, quantile_cont(duration, 0.5) AS p50, quantile_cont(duration, 0.95) AS p95"
        f" FROM logs WHERE type = 'REPORT' AND {HANDLERS} GROUP BY 1",
        "bin d:avg_duration d:max_duration d:min_duration d:p50 d:p95",
        LOGS,
    ),
    "log_error_patterns": out(
        f"SELECT {field(ERROR_CLASS)} AS error_class, count(*) AS error_count FROM logs WHERE {EVERY}"
        f" AND {has('ERROR|Exception|Error')} GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 10",
        "error_class i:error_count",
        LOGS,
    ),
    "log_performance": out(
        f"SELECT {BIN5} AS bin, avg(billed_duration) AS avg_duration, max(billed_duration) AS max_duration,"
        f" avg({USED}) * 100 AS avg_memory_utilization FROM logs WHERE type = 'REPORT' AND {HANDLERS} GROUP BY 1",
        "bin d:avg_duration d:max_duration d:avg_memory_utilization",
        LOGS,
    ),
    "log_errors_detailed": out(
        f"SELECT ts, event_id, message FROM logs WHERE {HANDLERS} AND {has('ERROR|Error|error')}"
        " ORDER BY ts DESC, event_id DESC LIMIT 50",
        "ts i:event_id message",
        LOGS,
    ),
    "log_job_metrics": out(
        f"SELECT {HOUR} AS bin, sum({field(RECORDS)}::BIGINT) AS total_records,"
        f" avg({field(SECONDS)}::BIGINT) AS avg_exec_time FROM logs WHERE {JOBS}"
        f" AND {has('Job run succeeded|Job run failed|records processed')} GROUP BY 1",
        "bin i:total_records d:avg_exec_time",
        LOGS,
    ),
    "log_job_failures": out(
        f"SELECT message AS error_message, count(*) AS failure_count FROM logs WHERE {JOBS}"
        f" AND {has('FAILED|Exception|Error')} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
        "error_message i:failure_count",
        LOGS,
    ),
    "log_upload_tracking": out(
        f"""SELECT {HOUR} AS bin, sum({field(SIZE_MB)}::DOUBLE) AS total_mb, count(*) AS file_count
        FROM logs WHERE log_group = '/lambda/s3-notification-handler' AND {has('S3_FILE_UPLOADED')} GROUP BY 1""",
        "bin d:total_mb i:file_count",
        LOGS,
    ),
    "log_quality_issues": out(
        f"SELECT {field('(validation|quality|invalid|missing)[^:]*: (.*)')} AS issue_type, count(*) AS issue_count"
        f" FROM logs WHERE {EVERY} AND {has('validation|quality|invalid|missing')} GROUP BY 1",
        "issue_type i:issue_count",
        LOGS,
    ),
    "log_executions": out(
        f"SELECT {field('(ExecutionStarted|ExecutionSucceeded|ExecutionFailed)')} AS execution_status, {HOUR} AS bin,"
        " count(*) AS count FROM logs WHERE log_group LIKE '/states/%' AND"
        f" {has('ExecutionStarted|ExecutionSucceeded|ExecutionFailed')} GROUP BY 1, 2",
        "execution_status bin i:count",
        LOGS,
    ),
    "log_underutilized": out(
        f"SELECT count(*) AS underutilized_invocations, avg({USED}) * 100 AS avg_memory_util FROM logs"
        f" WHERE type = 'REPORT' AND {HANDLERS} AND max_memory_used < memory_size * 0.5",
        "i:underutilized_invocations d:avg_memory_util",
        LOGS,
    ),
    "log_hourly_activity": out(
        f"SELECT {HOUR} AS bin, count(*) AS event_count FROM logs WHERE {EVERY} GROUP BY 1", "bin i:event_count", LOGS
    ),
    "log_job_states": out(
        f"SELECT {BIN5} AS bin, count(*) AS count FROM logs WHERE {JOBS} AND {has('(?i)(SUCCEEDED|FAILED|TIMEOUT)')}"
        " GROUP BY 1",
        "bin i:count",
        LOGS,
    ),
    "metric_rollup": out(
        f"SELECT namespace, metric, dim, {BIN5} AS period_start, avg(value) AS value FROM metrics GROUP BY 1, 2, 3, 4",
        "namespace metric i:dim period_start d:value",
        METRICS,
    ),
    "metric_rollup_sum_hourly": out(
        f"SELECT namespace, metric, dim, {HOUR} AS period_start, sum(value) AS value FROM metrics GROUP BY 1, 2, 3, 4",
        "namespace metric i:dim period_start d:value",
        METRICS,
    ),
    "metric_alarms": out(
        " UNION ALL ".join(_alarm(*r) for r in RULES), "rule i:dim period_start d:value breaching state", METRICS
    ),
    "data_freshness": out(
        f"SELECT max({P}) AS newest, (epoch(TIMESTAMP '2001-11-06 06:00:00') - epoch(max({P}))) / 3600 AS hours_since,"
        f" epoch(TIMESTAMP '2001-11-06 06:00:00') - epoch(max({P})) > 24 * 3600 AS stale FROM trips",
        "newest d:hours_since stale",
        TRIPS,
    ),
    "file_events": out(
        "SELECT strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, bucket, key, size AS size_bytes,"
        " round(size / 1048576.0::DOUBLE, 2) AS size_mb, event_name AS event_type FROM file_events",
        "timestamp bucket key i:size_bytes d:size_mb event_type",
        FILE_EVENTS,
    ),
    "route_events": out(
        f"SELECT event_id, {REASON} AS reject_reason, round(size / 1048576.0::DOUBLE, 2) AS size_mb FROM file_events",
        "i:event_id reject_reason d:size_mb",
        FILE_EVENTS,
    ),
    "dedup_executions": out(
        "SELECT DISTINCT 'etl-' || strftime(event_time, '%Y%m%d-%H%M%S') || '-' ||"
        " replace(regexp_extract(key, '[^/]*$'), '.', '-')[:50] AS execution_name, bucket, key, event_time"
        " FROM (FROM file_events UNION ALL SELECT * REPLACE (replace(key, 'raw/taxi/', 'raw/taxi/other/') AS key)"
        f" FROM file_events) WHERE ({REASON}) IS NULL",
        "execution_name bucket key event_time",
        FILE_EVENTS,
    ),
    "windowed_counts": out(
        f"SELECT {BIN5} AS window_start, count(*) AS n FROM events GROUP BY 1", "window_start i:n"
    ),
    "windowed_counts_hourly": out(
        f"SELECT {HOUR} AS window_start, count(*) AS n FROM events GROUP BY 1", "window_start i:n"
    ),
}
for _name in ("log_failed_records", "log_error_patterns", "log_errors_detailed", "log_job_failures"):
    ORACLES[f"{_name}_all"] = re.sub(r" (ORDER BY [^()]*)?LIMIT \d+\)$", ")", ORACLES[_name])
