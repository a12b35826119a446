"""Shared parts of the DuckDB checks."""

from __future__ import annotations

from .given import FILE_EVENT_COLUMNS, LOG_COLUMNS, METRIC_COLUMNS, TOTAL, TRIP_COLUMNS

TRIPS = (
    "trips AS (SELECT *, "
    + TOTAL
    + " AS total_amount FROM (SELECT "
    + TRIP_COLUMNS
    + " FROM lineitem))"
)
CURATED = TRIPS + (
    ", curated AS (SELECT VendorID AS vendor_id, tpep_pickup_datetime AS pickup_datetime,"
    " tpep_dropoff_datetime AS dropoff_datetime, passenger_count, trip_distance,"
    " RatecodeID AS rate_code_id, store_and_fwd_flag, PULocationID AS pickup_location_id,"
    " DOLocationID AS dropoff_location_id, payment_type, fare_amount, extra, mta_tax, tip_amount,"
    " tolls_amount, improvement_surcharge, total_amount, congestion_surcharge, airport_fee FROM trips)"
)
LOGS = f"logs AS (SELECT {LOG_COLUMNS} FROM events)"
FILE_EVENTS = f"file_events AS (SELECT {FILE_EVENT_COLUMNS} FROM events)"
METRICS = f"metrics AS (SELECT {METRIC_COLUMNS} FROM events)"
WEATHER = (
    "weather AS (SELECT cast(o_orderdate AS date) AS date, min(o_orderpriority) AS weather_condition,"
    " cast(30+day(min(o_orderdate))%60 AS int) AS temperature_f,"
    " cast(day(min(o_orderdate))%4 AS double)/4 AS precipitation_inches"
    " FROM orders WHERE day(o_orderdate)%3<>0 GROUP BY cast(o_orderdate AS date))"
)

ETL = (
    "etl AS (SELECT *, (epoch(tpep_dropoff_datetime)-epoch(tpep_pickup_datetime))/60.0 AS trip_duration_minutes,"
    " CASE WHEN fare_amount>0 THEN tip_amount/fare_amount*100 ELSE 0.0 END AS tip_percentage,"
    " year(tpep_pickup_datetime) AS year, month(tpep_pickup_datetime) AS month,"
    " 'job-process-taxi-data' AS etl_job_name FROM trips)"
)
PROCESSED = (
    "timed AS (SELECT *, (epoch(tpep_dropoff_datetime)-epoch(tpep_pickup_datetime))/60.0 AS trip_duration_minutes"
    " FROM trips WHERE tpep_dropoff_datetime > tpep_pickup_datetime AND trip_distance > 0 AND trip_distance < 100"
    " AND fare_amount > 0 AND fare_amount < 500 AND passenger_count BETWEEN 1 AND 6),"
    " fast AS (SELECT *, trip_distance/(trip_duration_minutes/60) AS avg_speed_mph FROM timed"
    " WHERE trip_duration_minutes BETWEEN 1 AND 300),"
    " processed AS (SELECT *, hour(tpep_pickup_datetime) AS pickup_hour,"
    " dayofweek(tpep_pickup_datetime)+1 AS pickup_day_of_week,"
    " year(tpep_pickup_datetime) AS year, month(tpep_pickup_datetime) AS month,"
    " CASE WHEN trip_distance<0.5 AND fare_amount>20 THEN 'suspicious_fare'"
    " WHEN avg_speed_mph>60 THEN 'high_speed' ELSE 'normal' END AS quality_flag"
    " FROM fast WHERE avg_speed_mph < 100)"
)


def out(body: str, spec: str, with_: str = "") -> str:
    """Final select: ``spec`` lists columns as ``kind:name``.

    i integer, m NUMERIC(10,2), d double rounded to 4 digits, any other column is passed through.
    """
    cols = []
    for word in spec.split():
        kind, _, name = word.partition(":")
        if not name:
            cols.append(kind)
        elif kind == "i":
            cols.append(f"CAST({name} AS BIGINT) AS {name}")
        elif kind == "m":
            cols.append(f"CAST({name} AS DECIMAL(10,2)) AS {name}")
        else:
            cols.append(f"round(CAST({name} AS DOUBLE)+1e-9, 4) AS {name}")
    head = f"WITH {with_} " if with_ else ""
    return f"{head}SELECT {', '.join(cols)} FROM ({body})"


def half_up(expr: str, digits: int) -> str:
    return f"round(({expr})+sign({expr})*1e-9, {digits})"


MINUTES = "(epoch(dropoff_datetime)-epoch(pickup_datetime))/60.0"
SPEED = f"CASE WHEN trip_distance>0 AND {MINUTES}>0 THEN trip_distance/({MINUTES})*60 END"
TIP_PCT = "CASE WHEN fare_amount>0 THEN tip_amount/fare_amount*100 ELSE 0 END"
DAYS = "['Sunday','Monday','Tuesday','Wednesday','Thursday','Friday','Saturday']"


def period(hour: str, night: str = "Late Night/Early Morning") -> str:
    return (
        f"CASE WHEN {hour}<6 THEN '{night}' WHEN {hour}<10 THEN 'Morning Rush' WHEN {hour}<16 THEN 'Midday'"
        f" WHEN {hour}<20 THEN 'Evening Rush' ELSE 'Evening' END"
    )
