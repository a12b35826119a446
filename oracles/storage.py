"""Checks of readers, sinks, whole runs and streams."""

from .analytics import HOURLY
from .common import ETL, PROCESSED, TRIPS, out
from .monitoring import BIN5
from .monitoring import ORACLES as MONITORING
from .star import FACT1, LOC
from .star import ORACLES as STAR
from .zones import COLS, ORACLES as ZONES
from .zones import classified

P, D = "tpep_pickup_datetime", "tpep_dropoff_datetime"
PROC = TRIPS + ", " + PROCESSED
EMIT = TRIPS + ", " + ETL
MONTH = "year = 1998 AND month = 3"
JUDGED = f"judged AS ({classified(False)})"
STRICT = f"judged AS ({classified(True)})"
REJECTED = "outcome NOT IN ('ok', 'pre_filtered', 'lost')"
DEAD = out(
    f"SELECT trip_ref, outcome AS failure_reason, 'run-1' AS run_id FROM judged WHERE {REJECTED}",
    "trip_ref failure_reason run_id",
    EMIT + ", " + JUDGED,
)
WEEK1 = (
    f"week1 AS (SELECT *, (epoch({D})-epoch({P}))/60.0 AS m FROM trips WHERE trip_distance > 0 AND trip_distance < 100"
    " AND fare_amount > 0 AND fare_amount < 500 AND passenger_count BETWEEN 1 AND 6 AND m > 1 AND m < 300)"
)
OUTCOMES = (
    "ok pre_filtered lost null_in_required_field numeric_range_violation invalid_datetime_sequence"
    " invalid_trip_duration invalid_tip_percentage".split()
)

ORACLES = {
    "read_zone": out(
        f"FROM processed WHERE {MONTH}", "trip_ref d:fare_amount d:trip_distance i:year i:month", PROC
    ),
    "read_any": out(
        "FROM orders", "i:o_orderkey i:o_custkey o_orderstatus d:o_totalprice o_orderdate o_orderpriority"
    ),
    "catalog_month_agg": out(
        "SELECT year, month, count(*) AS trip_count, avg(trip_distance) AS avg_distance, avg(fare_amount) AS avg_fare"
        f" FROM processed WHERE {MONTH} GROUP BY 1, 2",
        "i:year i:month i:trip_count d:avg_distance d:avg_fare",
        PROC,
    ),
    "write_processed": ZONES["raw_to_processed"],
    "write_curated": ZONES["fact_projection"],
    "write_table": out(
        f"FROM trips WHERE {P} IS NOT NULL AND {D} IS NOT NULL", "trip_ref i:VendorID d:fare_amount", TRIPS
    ),
    "write_dead_letter": DEAD,
    "export_csv": out(
        f"SELECT trip_ref, VendorID::VARCHAR AS VendorID, strftime({P}, '%Y-%m-%d %H:%M:%S') AS {P},"
        " passenger_count::VARCHAR AS passenger_count, tip_amount::VARCHAR AS tip_amount FROM trips",
        f"trip_ref VendorID {P} passenger_count tip_amount",
        TRIPS,
    ),
    "discover_schema": out(
        "SELECT year, month, count(*) AS trips, count(CASE WHEN year >= 1998 THEN tip_amount END) AS with_tip"
        " FROM processed GROUP BY 1, 2",
        "i:year i:month i:trips i:with_tip",
        PROC,
    ),
    "verify_schema": out(
        "SELECT 'columns' AS kind, 'expected 19' AS name, false AS found, 25 AS value UNION ALL"
        " SELECT 'partition_key', unnest(['year', 'month']), true, 1 UNION ALL SELECT 'key_column',"
        " unnest(['vendorid', 'tpep_pickup_datetime', 'tpep_dropoff_datetime', 'passenger_count', 'trip_distance',"
        " 'fare_amount']), true, 1 UNION ALL SELECT 'partition', 'year=' || year || '/month=' || month, true, count(*)"
        " FROM processed GROUP BY year, month",
        "kind name found i:value",
        PROC,
    ),
    "table_counts": out(
        "SELECT 'dim_location' AS table_name, count(*) AS row_count FROM dim_location UNION ALL SELECT 'dim_time',"
        f" count(DISTINCT {P}) FROM trips UNION ALL SELECT 'dim_rate', 6 UNION ALL SELECT 'fact_trips', count(*) FROM fact",
        "table_name i:row_count",
        ", ".join([TRIPS, FACT1, LOC]),
    ),
    "materialize": out(
        "FROM hourly",
        "i:pickup_hour i:day_of_week day_type time_period i:trip_count d:avg_distance d:avg_speed_mph d:avg_fare"
        " d:avg_tip d:avg_tip_percentage d:avg_duration_minutes d:avg_passengers",
        HOURLY,
    ),
    "run_processed": out(
        "FROM judged WHERE outcome = 'ok'",
        "trip_ref d:trip_duration_minutes d:tip_percentage etl_job_name i:year i:month",
        EMIT + ", " + JUDGED,
    ),
    "run_processed_dead_letters": DEAD,
    "run_processed_summary": out(
        "SELECT 'records_processed' AS item, count(*) AS n FROM judged"
        + "".join(f" UNION ALL SELECT '{o}', count(*) FROM judged WHERE outcome = '{o}'" for o in OUTCOMES),
        "item i:n",
        EMIT + ", " + JUDGED,
    ),
    "run_curated": ZONES["curated_summary"],
    "run_curated_payment": ZONES["payment_analysis_daily"],
    "run_star": out(
        "SELECT 'dim_location' AS table_name, 67 + count(*) AS row_count FROM (SELECT PULocationID AS l FROM processed"
        " UNION SELECT DOLocationID FROM processed) WHERE l NOT IN (SELECT location_id FROM seed)"
        f" UNION ALL SELECT 'dim_time', count(DISTINCT {P}) FROM processed UNION ALL SELECT 'dim_rate', 6"
        " UNION ALL SELECT 'fact_trips', count(*) FROM processed WHERE PULocationID IS NOT NULL",
        "table_name i:row_count",
        PROC + ", " + LOC,
    ),
    "run_week1": MONITORING["sample_statistics"].replace(TRIPS, TRIPS + ", " + WEEK1).replace(
        "FROM trips WHERE passenger_count", "FROM week1 WHERE passenger_count"
    ).replace("passengers_mode FROM trips", "passengers_mode FROM week1"),
    "incremental_ingest": out("FROM trips", COLS, TRIPS),
    "streaming_etl": out(
        f"SELECT trip_ref, outcome FROM ({classified(False)}) WHERE outcome <> 'pre_filtered'", "trip_ref outcome", EMIT
    ),
    "windowed_counts_stream": out(
        f"SELECT {BIN5} AS window_start, count(*) AS n FROM events GROUP BY 1 HAVING"
        " window_start + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE",
        "window_start i:n",
    ),
    "windowed_counts_stream_all": out(
        f"SELECT {BIN5} AS window_start, count(*) AS n, 0 AS late, CASE WHEN window_start + INTERVAL 5 MINUTE"
        " <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE THEN 'closed' ELSE 'open' END AS state"
        " FROM events GROUP BY 1",
        "window_start i:n i:late state",
    ),
    "windowed_counts_stream_late": out(
        f"SELECT window_start, count(*) AS n, count(*) FILTER (late) AS late, CASE WHEN window_start + INTERVAL 5 MINUTE"
        " > (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE THEN 'open' WHEN bool_and(late) THEN 'late' ELSE 'closed' END AS state"
        f" FROM (SELECT {BIN5} AS window_start, event_id % 7 = 0 AND {BIN5} + INTERVAL 5 MINUTE"
        " <= (SELECT max(ts) FROM events WHERE event_id % 7 <> 0) - INTERVAL 10 MINUTE AS late FROM events) GROUP BY 1",
        "window_start i:n i:late state",
    ),
    "dedup_executions_stream": MONITORING["dedup_executions"].replace(
        "(FROM file_events UNION ALL SELECT * REPLACE (replace(key, 'raw/taxi/', 'raw/taxi/other/') AS key) FROM file_events)",
        "file_events",
    ),
}
for _name in ("run_processed", "run_processed_dead_letters", "run_processed_summary"):
    ORACLES[f"{_name}_strict"] = ORACLES[_name].replace(JUDGED, STRICT)
ORACLES["run_processed_twice"] = ORACLES["run_processed"]
ORACLES["run_processed_report"] = ZONES["quality_report"]
ORACLES["run_processed_months"] = ZONES["records_by_month"]
for _name in ("rds_top_pickups", "rds_hourly", "rds_weekend"):
    ORACLES[f"run_star_{_name}"] = STAR[_name].replace(FACT1, PROCESSED + ", " + FACT1.replace("FROM trips WHERE", "FROM processed WHERE"))

