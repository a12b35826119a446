"""Checks of cleaners, data-quality operators and curated datasets."""

from .common import ETL, FILE_EVENTS, PROCESSED, TRIPS, out

P, D = "tpep_pickup_datetime", "tpep_dropoff_datetime"
COLS = (
    f"trip_ref i:VendorID {P} {D} i:passenger_count d:trip_distance i:RatecodeID store_and_fwd_flag i:PULocationID"
    " i:DOLocationID i:payment_type d:fare_amount d:extra d:mta_tax d:tip_amount d:tolls_amount"
    " d:improvement_surcharge d:congestion_surcharge d:airport_fee d:total_amount"
)
BASIC = f"trip_distance>0 AND fare_amount>0 AND passenger_count>0 AND {D}>{P}"
MIN = f"(epoch({D})-epoch({P}))/60.0"
PROC = TRIPS + ", " + PROCESSED
EMIT = TRIPS + ", " + ETL
ZERO = "passenger_count extra mta_tax tip_amount tolls_amount improvement_surcharge congestion_surcharge".split()
FILLED = (
    "filled AS (SELECT * REPLACE ("
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in ZERO)
    + f") FROM trips WHERE {P} IS NOT NULL AND {D} IS NOT NULL AND PULocationID IS NOT NULL"
    " AND DOLocationID IS NOT NULL)"
)
ALL_COLS = [w.split(":")[-1] for w in COLS.split()]

PASS = {
    "null_in_required_field": " AND ".join(
        f"{c} IS NOT NULL" for c in (P, D, "passenger_count", "trip_distance", "fare_amount", "total_amount")
    ),
    "numeric_range_violation": "passenger_count BETWEEN 1 AND 6 AND trip_distance BETWEEN 0.1 AND 100"
    " AND fare_amount BETWEEN 0.01 AND 500 AND total_amount BETWEEN 0.01 AND 1000"
    " AND tip_amount BETWEEN 0 AND 200 AND tolls_amount BETWEEN 0 AND 100 AND extra BETWEEN 0 AND 10"
    " AND mta_tax BETWEEN 0 AND 1",
    "invalid_datetime_sequence": f"{D} > {P}",
    "invalid_trip_duration": "trip_duration_minutes BETWEEN 1 AND 300",
    "invalid_tip_percentage": "tip_percentage BETWEEN 0 AND 100",
}
JOB_PASS = {
    "null_in_required_field": " AND ".join(
        f"{c} IS NOT NULL" for c in (P, D, "passenger_count", "trip_distance", "fare_amount")
    ),
    "numeric_range_violation": "passenger_count BETWEEN 1 AND 6 AND trip_distance BETWEEN 0.1 AND 100"
    " AND fare_amount BETWEEN 0.01 AND 500",
    "invalid_trip_duration": PASS["invalid_trip_duration"],
    "invalid_tip_percentage": PASS["invalid_tip_percentage"],
}


def verdict(checks: dict[str, str], strict: bool, valid: str = "NULL") -> str:
    arms = []
    for reason, passes in checks.items():
        if strict:
            arms.append(f"WHEN ({passes}) IS NULL THEN 'lost' WHEN NOT ({passes}) THEN '{reason}'")
        else:
            arms.append(f"WHEN ({passes}) IS NOT TRUE THEN '{reason}'")
    return f"CASE {' '.join(arms)} ELSE {valid} END"


def tagged(checks, strict):
    return out(f"SELECT trip_ref, {verdict(checks, strict)} AS failure_reason FROM etl", "trip_ref failure_reason", EMIT)


def classified(strict):
    return (
        f"SELECT *, CASE WHEN ({BASIC}) IS NOT TRUE THEN 'pre_filtered' ELSE "
        f"({verdict(JOB_PASS, strict, chr(39) + 'ok' + chr(39))}) END AS outcome FROM etl"
    )


_SINGLE = {
    "check_null_values": ["null_in_required_field"],
    "validate_numeric_ranges": ["numeric_range_violation"],
    "validate_datetime_logic": ["invalid_datetime_sequence"],
    "validate_trip_duration": ["invalid_trip_duration"],
    "validate_tip_percentage": ["invalid_tip_percentage"],
    "run_all_checks": list(PASS),
}
METRIC = {
    "null_in_required_field": "null_violations",
    "numeric_range_violation": "range_violations",
    "invalid_datetime_sequence": "datetime_violations",
    "invalid_trip_duration": "duration_violations",
    "invalid_tip_percentage": "tip_percentage_violations",
}
TAGGED = f"tagged AS (SELECT *, {verdict(PASS, False)} AS failure_reason FROM etl)"
OKS = f"oks AS (SELECT * FROM ({classified(True)}) WHERE outcome = 'ok')"


def _gate() -> str:
    rows = [("row_count", "issue", "count(*)", "count(*) < 1000"), ("required_columns", "issue", "0 * count(*)", "count(*) < 0")]
    for c in (P, D, "passenger_count", "trip_distance", "fare_amount"):
        share = f"(count(*) - count({c})) * 100.0 / count(*)"
        rows.append((f"null_pct_{c}", "warning", share, f"{share} > 5"))
    for name, sev, cond in (
        ("negative_distance", "issue", "trip_distance < 0"),
        ("long_trips", "warning", "trip_distance > 100"),
        ("negative_fare", "issue", "fare_amount < 0"),
        ("high_fares", "warning", "fare_amount > 500"),
        ("dropoff_before_pickup", "issue", f"{D} < {P}"),
    ):
        rows.append((name, sev, f"count(*) FILTER (WHERE {cond})", f"count(*) FILTER (WHERE {cond}) > 0"))
    parts = " UNION ALL ".join(
        f"SELECT '{n}' AS \"check\", '{s}' AS severity, ({v})::DOUBLE AS value, {r} AS raised FROM trips"
        for n, s, v, r in rows
    )
    return f"SELECT *, NOT bool_or(raised AND severity = 'issue') OVER () AS passed FROM ({parts})"


def _ruleset() -> str:
    rules = [
        ("RowCount > 0", "CASE WHEN count(*) > 0 THEN 0 ELSE 1 END"),
        (f"IsComplete {P}", f"count(*) FILTER (WHERE {P} IS NULL)"),
        (f"IsComplete {D}", f"count(*) FILTER (WHERE {D} IS NULL)"),
    ] + [
        (f"ColumnValues {c} >= 0", f"count(*) FILTER (WHERE ({c} >= 0) IS NOT TRUE)")
        for c in ("passenger_count", "trip_distance", "fare_amount")
    ]
    parts = " UNION ALL ".join(f"SELECT '{n}' AS rule, {e} AS failing FROM trips" for n, e in rules)
    return f"SELECT *, CASE WHEN failing = 0 THEN 'Passed' ELSE 'Failed' END AS outcome FROM ({parts})"


def _issues() -> str:
    checks = [
        (f"negative {c}", f"{c} < 0") for c in ("trip_distance", "fare_amount", "total_amount", "passenger_count")
    ] + [("0 passengers", "passenger_count = 0"), ("over 100 miles", "trip_distance > 100")]
    parts = " UNION ALL ".join(f"SELECT '{n}' AS issue, count(*) AS n FROM trips WHERE {c}" for n, c in checks)
    return f"SELECT * FROM ({parts}) WHERE n > 0"


def _holes(table: str) -> str:
    cells = " + ".join(f"(count(*) - count({c}))" for c in ALL_COLS)
    return f"(SELECT {cells} FROM {table})"


GOOD_SUFFIX = "(lower(key) LIKE '%.parquet' OR lower(key) LIKE '%.csv' OR lower(key) LIKE '%.csv.gz')"
MANIFEST = f"""
SELECT *, named AND msgs = '' AS is_valid,
  CASE WHEN NOT named THEN 'Missing required fields: bucket or key' WHEN msgs = '' THEN 'All validations passed'
       ELSE 'Validation failed: ' || msgs END AS message,
  CASE WHEN named THEN round(size / 1048576.0::DOUBLE, 2) END AS size_mb,
  CASE WHEN named THEN regexp_extract(key, '[^/]*$') END AS file_name
FROM (SELECT *, CASE WHEN probs <> '' THEN probs WHEN there THEN '' ELSE 'File not found' END AS msgs FROM (
  SELECT *, bucket <> '' AND key <> '' AS named,
    event_name LIKE 'ObjectCreated%' AS there,
    concat_ws('; ',
      CASE WHEN key NOT LIKE 'raw/taxi/%' THEN 'Invalid prefix. Expected: raw/taxi/, Got: ' || key[:20] || '...' END,
      CASE WHEN NOT {GOOD_SUFFIX} THEN 'Unsupported file type. Supported: .parquet, .csv, .csv.gz' END,
      CASE WHEN size < 100 THEN 'File too small: ' || size || ' bytes (minimum: 100 bytes)'
           WHEN size > 10737418240 THEN 'File too large: ' || size || ' bytes (maximum: 10737418240 bytes)' END
    ) AS probs FROM file_events))
"""

ORACLES = {
    "drop_null_critical": out(f"SELECT * FROM trips WHERE {P} IS NOT NULL AND {D} IS NOT NULL", COLS, TRIPS),
    "filter_basic": out(f"SELECT * FROM trips WHERE {BASIC}", COLS, TRIPS),
    "filter_removed_report": out(
        "SELECT b AS records_before, a AS records_after, b - a AS records_removed, (b - a) * 100.0 / b AS removed_pct"
        f" FROM (SELECT count(*) AS b, count(*) FILTER (WHERE {BASIC}) AS a FROM trips)",
        "i:records_before i:records_after i:records_removed d:removed_pct",
        TRIPS,
    ),
    "derive_etl": out(
        "FROM etl", COLS + " d:trip_duration_minutes d:tip_percentage i:year i:month etl_job_name", EMIT
    ),
    "raw_to_processed": out(
        "FROM processed",
        COLS + " d:trip_duration_minutes d:avg_speed_mph i:pickup_hour i:pickup_day_of_week i:year i:month quality_flag",
        PROC,
    ),
    "quality_flag": out("FROM processed", "trip_ref quality_flag", PROC),
    "processed_sample_stats": out(
        "SELECT avg(trip_distance) AS avg_trip_distance, avg(fare_amount) AS avg_fare,"
        " avg(trip_duration_minutes) AS avg_duration, count(*) AS total_records FROM processed",
        "d:avg_trip_distance d:avg_fare d:avg_duration i:total_records",
        PROC,
    ),
    "clean_ingest": out(
        f"SELECT *, {MIN} AS trip_duration_minutes FROM trips WHERE {BASIC} AND trip_distance < 100"
        f" AND fare_amount < 500 AND passenger_count <= 6 AND {MIN} > 1 AND {MIN} < 300",
        COLS + " d:trip_duration_minutes",
        TRIPS,
    ),
    "clean_missing": out("FROM filled", COLS, TRIPS + ", " + FILLED),
    "clean_calculated": out(
        f"SELECT *, CASE WHEN fare_amount > 0 THEN least(tip_amount / fare_amount * 100, 100) ELSE 0 END"
        f" AS tip_percentage, trip_distance / trip_duration * 60 AS avg_speed_mph, hour({P}) AS pickup_hour,"
        f" isodow({P}) - 1 AS pickup_day_of_week, cast({P} AS date) AS pickup_date,"
        " CASE WHEN trip_distance > 0 THEN total_amount / trip_distance ELSE 0 END AS cost_per_mile FROM"
        f" (SELECT *, {MIN} AS trip_duration FROM filled) WHERE trip_duration > 0 AND trip_duration <= 1440"
        " AND trip_distance / trip_duration * 60 <= 100",
        COLS + " d:trip_duration d:tip_percentage d:avg_speed_mph i:pickup_hour i:pickup_day_of_week pickup_date"
        " d:cost_per_mile",
        TRIPS + ", " + FILLED,
    ),
    "cleaning_issues": out(_issues(), "issue i:n", TRIPS),
    "cleaning_summary": out(
        "SELECT b AS initial_rows, b - a AS rows_removed, a AS final_rows, missing_before, missing_after FROM (SELECT"
        f" (SELECT count(*) FROM trips) AS b, (SELECT count(*) FROM filled) AS a, {_holes('trips')} AS missing_before,"
        f" {_holes('filled')} AS missing_after)",
        "i:initial_rows i:rows_removed i:final_rows i:missing_before i:missing_after",
        TRIPS + ", " + FILLED,
    ),
    "filter_date_range": out(
        f"FROM trips WHERE {P} >= TIMESTAMP '1998-01-01' AND {P} < TIMESTAMP '1999-01-01'", f"trip_ref {P}", TRIPS
    ),
    "filter_date_range_last_days": out(
        f"FROM trips WHERE {P} >= DATE '2001-11-04' - INTERVAL 90 DAY", f"trip_ref {P}", TRIPS
    ),
    "fact_projection": out(
        f"SELECT *, {P} AS pickup_datetime, {D} AS dropoff_datetime FROM processed",
        "pickup_datetime dropoff_datetime i:PULocationID i:DOLocationID i:passenger_count d:trip_distance d:fare_amount"
        " d:extra d:mta_tax d:tip_amount d:tolls_amount d:total_amount i:payment_type d:trip_duration_minutes"
        " d:avg_speed_mph i:pickup_hour i:pickup_day_of_week quality_flag i:year i:month",
        PROC,
    ),
    "daily_statistics": out(
        f"SELECT cast({P} AS date) AS date, year, month, count(*) AS total_trips, sum(fare_amount) AS total_revenue,"
        " avg(fare_amount) AS avg_fare, avg(trip_distance) AS avg_distance, avg(trip_duration_minutes) AS avg_duration,"
        " sum(passenger_count) AS total_passengers, avg(passenger_count) AS avg_passengers_per_trip,"
        " count(DISTINCT VendorID) AS active_vendors FROM processed GROUP BY 1, 2, 3",
        "date i:year i:month i:total_trips d:total_revenue d:avg_fare d:avg_distance d:avg_duration i:total_passengers"
        " d:avg_passengers_per_trip i:active_vendors",
        PROC,
    ),
    "hourly_patterns": out(
        "SELECT pickup_hour, count(*) AS total_trips, avg(fare_amount) AS avg_fare, avg(trip_distance) AS avg_distance,"
        " avg(trip_duration_minutes) AS avg_duration, avg(passenger_count) AS avg_passengers FROM processed GROUP BY 1",
        "i:pickup_hour i:total_trips d:avg_fare d:avg_distance d:avg_duration d:avg_passengers",
        PROC,
    ),
    "day_of_week_patterns": out(
        "SELECT pickup_day_of_week, count(*) AS total_trips, avg(fare_amount) AS avg_fare,"
        " avg(trip_distance) AS avg_distance, avg(trip_duration_minutes) AS avg_duration FROM processed GROUP BY 1",
        "i:pickup_day_of_week i:total_trips d:avg_fare d:avg_distance d:avg_duration",
        PROC,
    ),
    "payment_analysis_daily": out(
        f"SELECT payment_type, cast({P} AS date) AS date, count(*) AS total_trips, sum(fare_amount) AS total_revenue,"
        " avg(fare_amount) AS avg_fare, avg(tip_amount) AS avg_tip FROM processed GROUP BY 1, 2",
        "i:payment_type date i:total_trips d:total_revenue d:avg_fare d:avg_tip",
        PROC,
    ),
    "location_top100": out(
        "SELECT PULocationID, count(*) AS total_pickups, avg(fare_amount) AS avg_fare_from_location,"
        " avg(trip_distance) AS avg_distance_from_location FROM processed GROUP BY 1"
        " ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 100",
        "i:PULocationID i:total_pickups d:avg_fare_from_location d:avg_distance_from_location",
        PROC,
    ),
    "curated_summary": out(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count FROM (SELECT DISTINCT {key} FROM processed)"
            for name, key in (
                ("daily_statistics", f"cast({P} AS date)"),
                ("hourly_patterns", "pickup_hour"),
                ("day_of_week_patterns", "pickup_day_of_week"),
                ("payment_analysis", f"payment_type, cast({P} AS date)"),
            )
        )
        + " UNION ALL SELECT 'location_analysis', least(100, count(*)) FROM (SELECT DISTINCT PULocationID FROM processed)"
        " UNION ALL SELECT 'fact_taxi_trips', count(*) FROM processed",
        "table_name i:row_count",
        PROC,
    ),
    "etl_classify": out(classified(False), "trip_ref outcome", EMIT),
    "etl_classify_strict": out(classified(True), "trip_ref outcome", EMIT),
    "etl_classify_complete": out(classified(False), "trip_ref outcome", EMIT),
    "quality_metrics": out(
        " UNION ALL ".join(
            f"SELECT '{m}' AS metric, count(*) FILTER (WHERE failure_reason = '{r}') AS violations FROM tagged"
            for r, m in METRIC.items()
        ),
        "metric i:violations",
        EMIT + ", " + TAGGED,
    ),
    "dq_summary": out(
        "SELECT n AS records_processed, p AS records_passed, n - p AS records_rejected, (n - p) * 100.0 / n AS rejected_pct"
        " FROM (SELECT count(*) AS n, count(*) FILTER (WHERE failure_reason IS NULL) AS p FROM tagged)",
        "i:records_processed i:records_passed i:records_rejected d:rejected_pct",
        EMIT + ", " + TAGGED,
    ),
    "combine_invalid": out(
        "SELECT trip_ref, CASE WHEN failure_reason = 'null_in_required_field' THEN store_and_fwd_flag END"
        " AS store_and_fwd_flag, failure_reason, 'run-1' AS run_id FROM tagged"
        " WHERE failure_reason IN ('null_in_required_field', 'numeric_range_violation')",
        "trip_ref store_and_fwd_flag failure_reason run_id",
        EMIT + ", " + TAGGED,
    ),
    "quality_report": out(
        "SELECT count(*) AS total_records, avg(trip_distance) AS avg_trip_distance, avg(fare_amount) AS avg_fare_amount,"
        " avg(trip_duration_minutes) AS avg_trip_duration, avg(tip_percentage) AS avg_tip_percentage,"
        f" min({P}) AS min_pickup_date, max({P}) AS max_pickup_date FROM oks",
        "i:total_records d:avg_trip_distance d:avg_fare_amount d:avg_trip_duration d:avg_tip_percentage"
        " min_pickup_date max_pickup_date",
        EMIT + ", " + OKS,
    ),
    "records_by_month": out(
        "SELECT year, month, count(*) AS record_count FROM oks GROUP BY 1, 2", "i:year i:month i:record_count",
        EMIT + ", " + OKS,
    ),
    "dataset_gate": out(_gate(), 'passed "check" severity d:value raised', TRIPS),
    "ruleset_eval": out(_ruleset(), "rule i:failing outcome", TRIPS),
    "manifest_check": out(MANIFEST, "i:event_id is_valid message d:size_mb file_name", FILE_EVENTS),
}
for _name, _reasons in _SINGLE.items():
    _checks = {r: PASS[r] for r in _reasons}
    ORACLES[_name] = tagged(_checks, False)
    ORACLES[f"{_name}_strict"] = tagged(_checks, True)
