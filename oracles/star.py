"""Checks of the star-schema builders and questions."""

from farelake.operators.seeds import LOCATIONS, RATE_CODES

from .common import CURATED, PROCESSED, TRIPS, half_up, out

P, D = "tpep_pickup_datetime", "tpep_dropoff_datetime"


def _values(rows) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def money(e: str) -> str:
    """NUMERIC(10,2): rounded half up on the shortest decimal text of the double."""
    return f"CAST(round(CAST(CAST({e} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DECIMAL(10,2))"


SEED = f"seed(location_id, borough, zone, service_zone) AS (VALUES {_values(LOCATIONS)})"
RATE = f"dim_rate(rate_code_id, rate_code_name, description) AS (VALUES {_values(RATE_CODES)})"
PAYMENTS = "Credit Card,Cash,No Charge,Dispute,Unknown,Voided Trip".split(",")
PAY = "dim_payment(payment_type_key, payment_type_name) AS (VALUES " + ", ".join(
    f"({i}, '{n}')" for i, n in enumerate(PAYMENTS, 1)
) + ")"
LOC = SEED + (
    ", missing AS (SELECT DISTINCT location_id FROM (SELECT PULocationID AS location_id FROM trips UNION ALL"
    " SELECT DOLocationID FROM trips) WHERE location_id IS NOT NULL AND location_id NOT IN"
    " (SELECT location_id FROM seed)), dim_location AS (FROM seed UNION ALL SELECT location_id, 'Unknown',"
    " 'Location ' || location_id, 'Unknown' FROM missing)"
)
TIME = (
    f"dim_time AS (SELECT epoch_us(t) AS time_id, t AS pickup_datetime, year(t) AS year, month(t) AS month,"
    " day(t) AS day, hour(t) AS hour, isodow(t)-1 AS weekday, isodow(t) > 5 AS is_weekend, quarter(t) AS quarter,"
    f" dayofyear(t) AS day_of_year, week(t) AS week_of_year FROM (SELECT DISTINCT {P} AS t FROM trips"
    f" WHERE {P} IS NOT NULL))"
)
MONEY1 = (
    "fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge congestion_surcharge total_amount".split()
)
FACT1 = (
    f"fact AS (SELECT trip_ref AS trip_id, epoch_us({P}) AS time_id, PULocationID AS pickup_location_id,"
    " DOLocationID AS dropoff_location_id, CASE WHEN RatecodeID BETWEEN 1 AND 6 THEN RatecodeID ELSE 1 END"
    " AS rate_code_id, coalesce(passenger_count, 1) AS passenger_count,"
    f" {money('coalesce(trip_distance, 0)')} AS trip_distance,"
    f" {money(f'(epoch({D})-epoch({P}))/60.0')} AS trip_duration, "
    + ", ".join(f"{money(f'coalesce({c}, 0)')} AS {c}" for c in MONEY1)
    + ", coalesce(payment_type, 1) AS payment_type FROM trips"
    f" WHERE {P} IS NOT NULL AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL)"
)
MONEY2 = (
    "trip_distance trip_duration_minutes fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge"
    " total_amount congestion_surcharge airport_fee avg_speed_mph".split()
)


def _date_key(c):
    return f"cast(strftime({c}, '%Y%m%d') AS int)"


def _clock_key(c):
    return f"hour({c})*100+minute({c})"


FACT2 = (
    f"fact AS (SELECT trip_ref AS trip_key, {_date_key(P)} AS pickup_date_key, {_clock_key(P)} AS pickup_time_key,"
    f" {_date_key(D)} AS dropoff_date_key, {_clock_key(D)} AS dropoff_time_key, PULocationID AS pickup_location_key,"
    " DOLocationID AS dropoff_location_key, payment_type AS payment_type_key, RatecodeID AS rate_code_key,"
    " VendorID AS vendor_id, passenger_count, "
    + ", ".join(f"{money(c)} AS {c}" for c in MONEY2)
    + ", quality_flag FROM processed)"
)
DATE = (
    "dim_date AS (SELECT cast(strftime(d, '%Y%m%d') AS int) AS date_key, d AS full_date, year(d) AS year,"
    " quarter(d) AS quarter, month(d) AS month, strftime(d, '%B') AS month_name, day(d) AS day,"
    " dayofweek(d) AS day_of_week, strftime(d, '%A') AS day_name, dayofweek(d) IN (0,6) AS is_weekend,"
    " false AS is_holiday FROM (SELECT cast(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS date) AS d FROM"
    f" (SELECT cast(least(min({P}), min({D})) AS date) AS lo, cast(greatest(max({P}), max({D})) AS date) AS hi"
    " FROM trips)))"
)
CLOCK = (
    "dim_clock AS (SELECT h*100+m AS time_key, h AS hour, m AS minute, CASE WHEN h BETWEEN 6 AND 11 THEN 'Morning'"
    " WHEN h BETWEEN 12 AND 16 THEN 'Afternoon' WHEN h BETWEEN 17 AND 20 THEN 'Evening' ELSE 'Night' END"
    " AS time_of_day, h IN (7,8,9,16,17,18,19) AS is_rush_hour FROM (SELECT range//60 AS h, range%60 AS m"
    " FROM range(1440)))"
)
T1 = TRIPS + ", " + FACT1
T2 = TRIPS + ", " + PROCESSED + ", " + FACT2
JT = "FROM fact JOIN dim_clock ON pickup_time_key = time_key"
JD = "FROM fact JOIN dim_date ON pickup_date_key = date_key"
TIME_COLS = (
    "i:time_id pickup_datetime i:year i:month i:day i:hour i:weekday is_weekend i:quarter i:day_of_year i:week_of_year"
)
SUMMARY = (
    "summary AS (SELECT f.*, pickup_datetime, year, month, day, hour, weekday, is_weekend, p.borough AS pickup_borough,"
    " p.zone AS pickup_zone, q.borough AS dropoff_borough, q.zone AS dropoff_zone, rate_code_name FROM fact f"
    " JOIN dim_time USING (time_id) JOIN dim_location p ON p.location_id = pickup_location_id"
    " JOIN dim_location q ON q.location_id = dropoff_location_id JOIN dim_rate USING (rate_code_id))"
)
CHECKS = [
    (f"chk_{c}", f"SELECT count(*) FROM fact WHERE {c} < 0")
    for c in ("passenger_count", "trip_distance", "trip_duration", "fare_amount", "total_amount")
] + [
    (f"not_null_{c}", f"SELECT count(*) FROM fact WHERE {c} IS NULL")
    for c in ("time_id", "pickup_location_id", "dropoff_location_id", "rate_code_id")
] + [
    (f"fk_{c}", f"SELECT count(*) FROM fact WHERE {c} NOT IN (SELECT {k} FROM {t})")
    for c, t, k in (
        ("time_id", "dim_time", "time_id"),
        ("pickup_location_id", "dim_location", "location_id"),
        ("dropoff_location_id", "dim_location", "location_id"),
        ("rate_code_id", "dim_rate", "rate_code_id"),
    )
] + [("unique_pickup_datetime", "SELECT count(*) - count(DISTINCT pickup_datetime) FROM dim_time")]


def usage(dim: str, key: str, fact_key: str, cols: str, with_: str) -> str:
    return out(
        f"SELECT d.*, (SELECT count(*) FROM fact WHERE {fact_key} = d.{key}) AS trips FROM {dim} d", cols + " i:trips",
        with_,
    )


def avgs(**cols) -> str:
    return ", ".join(f"avg({e}) AS {n}" for n, e in cols.items())


ORACLES = {
    "missing_locations": out("FROM missing", "i:location_id", TRIPS + ", " + LOC),
    "build_dim_location": out("FROM dim_location", "i:location_id borough zone service_zone", TRIPS + ", " + LOC),
    "build_dim_time": out("FROM dim_time", TIME_COLS, TRIPS + ", " + TIME),
    "build_dim_time_incremental": out("FROM dim_time", TIME_COLS, TRIPS + ", " + TIME),
    "fact_lookup": out(
        f"SELECT trip_ref, epoch_us({P}) AS time_id FROM trips WHERE {P} IS NOT NULL",
        "trip_ref i:time_id",
        TRIPS,
    ),
    "build_fact_trips": out(
        "FROM fact",
        "trip_id i:time_id i:pickup_location_id i:dropoff_location_id i:rate_code_id i:passenger_count m:trip_distance"
        " m:trip_duration " + " ".join(f"m:{c}" for c in MONEY1) + " i:payment_type",
        T1,
    ),
    "build_dim_date": out(
        "FROM dim_date",
        "i:date_key full_date i:year i:quarter i:month month_name i:day i:day_of_week day_name is_weekend is_holiday",
        TRIPS + ", " + DATE,
    ),
    "build_fact_taxi_trips": out(
        "FROM fact",
        "trip_key i:pickup_date_key i:pickup_time_key i:dropoff_date_key i:dropoff_time_key i:pickup_location_key"
        " i:dropoff_location_key i:payment_type_key i:rate_code_key i:vendor_id i:passenger_count "
        + " ".join(f"m:{c}" for c in MONEY2) + " quality_flag",
        T2,
    ),
    "load_summary": out(
        f"SELECT (SELECT count(*) FROM trips) AS source_rows, (SELECT count(DISTINCT {P}) FROM trips) AS dim_time,"
        " (SELECT count(*) FROM fact) AS fact_trips, (SELECT count(*) FROM missing) AS dim_location,"
        " (SELECT count(*) FROM trips) - (SELECT count(*) FROM fact) AS skipped",
        "i:source_rows i:dim_time i:fact_trips i:dim_location i:skipped",
        T1 + ", " + LOC,
    ),
    "build_dim_rate": usage(
        "dim_rate", "rate_code_id", "rate_code_id", "i:rate_code_id rate_code_name description", T1 + ", " + RATE
    ),
    "build_dim_rate_code": usage(
        "(SELECT rate_code_id AS rate_code_key, rate_code_id, rate_code_name, description AS rate_code_description"
        " FROM dim_rate)",
        "rate_code_key", "fact.rate_code_key",
        "i:rate_code_key i:rate_code_id rate_code_name rate_code_description", T2 + ", " + RATE,
    ),
    "build_dim_payment_type": usage(
        "(SELECT payment_type_key, payment_type_key AS payment_type_id, payment_type_name FROM dim_payment)",
        "payment_type_key", "fact.payment_type_key", "i:payment_type_key i:payment_type_id payment_type_name",
        T2 + ", " + PAY,
    ),
    "build_dim_time_of_day": usage(
        "dim_clock", "time_key", "pickup_time_key", "i:time_key i:hour i:minute time_of_day is_rush_hour",
        T2 + ", " + CLOCK,
    ),
    "trip_summary": out(
        "FROM summary",
        "trip_id pickup_datetime i:year i:month i:day i:hour i:weekday is_weekend pickup_borough pickup_zone"
        " dropoff_borough dropoff_zone rate_code_name i:passenger_count m:trip_distance m:trip_duration m:fare_amount"
        " m:tip_amount m:total_amount i:payment_type",
        ", ".join([T1, TIME, LOC, RATE, SUMMARY]),
    ),
    "constraint_check": out(
        " UNION ALL ".join(f"SELECT '{n}' AS \"constraint\", ({q}) AS violations" for n, q in CHECKS),
        '"constraint" i:violations',
        ", ".join([T1, TIME, LOC, RATE]),
    ),
    "aq01_daily_revenue": out(
        "SELECT full_date, day_name, count(*) AS total_trips, sum(total_amount) AS total_revenue, "
        + avgs(avg_fare="total_amount", avg_distance="trip_distance", avg_duration="trip_duration_minutes")
        + f", sum(passenger_count) AS total_passengers {JD} WHERE year = 1998 AND month = 3 GROUP BY 1, 2",
        "full_date day_name i:total_trips d:total_revenue d:avg_fare d:avg_distance d:avg_duration i:total_passengers",
        T2 + ", " + DATE,
    ),
    "aq02_peak_hours": out(
        "SELECT hour, time_of_day, count(*) AS total_trips, "
        + avgs(avg_fare="total_amount", avg_distance="trip_distance", avg_tip="tip_amount") + f" {JT} GROUP BY 1, 2",
        "i:hour time_of_day i:total_trips d:avg_fare d:avg_distance d:avg_tip",
        T2 + ", " + CLOCK,
    ),
    "aq03_top_pickups": out(
        "SELECT zone, borough, count(*) AS total_pickups, sum(cast(total_amount AS decimal(18,2))) AS total_revenue, "
        + avgs(avg_fare="total_amount", avg_distance="trip_distance")
        + " FROM fact JOIN dim_location ON pickup_location_key = location_id GROUP BY 1, 2"
        " ORDER BY total_revenue DESC, 1, 2 LIMIT 20",
        "zone borough i:total_pickups d:total_revenue d:avg_fare d:avg_distance",
        T2 + ", " + LOC,
    ),
    "aq04_payment": out(
        "SELECT payment_type_name, count(*) AS total_trips, sum(total_amount) AS total_revenue, "
        + avgs(avg_fare="total_amount", avg_tip="tip_amount")
        + ", avg(tip_amount / nullif(fare_amount, 0)) * 100 AS avg_tip_percentage"
        " FROM fact JOIN dim_payment USING (payment_type_key) GROUP BY 1",
        "payment_type_name i:total_trips d:total_revenue d:avg_fare d:avg_tip d:avg_tip_percentage",
        T2 + ", " + PAY,
    ),
    "aq05_weekend": out(
        "SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type, count(*) AS total_trips,"
        " sum(total_amount) AS total_revenue, "
        + avgs(avg_fare="total_amount", avg_distance="trip_distance", avg_duration="trip_duration_minutes")
        + f" {JD} GROUP BY 1",
        "day_type i:total_trips d:total_revenue d:avg_fare d:avg_distance d:avg_duration",
        T2 + ", " + DATE,
    ),
    "aq06_routes": out(
        "SELECT p.zone AS pickup_zone, q.zone AS dropoff_zone, count(*) AS trip_count, "
        + avgs(avg_distance="trip_distance", avg_duration="trip_duration_minutes", avg_fare="total_amount")
        + " FROM fact JOIN dim_location p ON pickup_location_key = p.location_id"
        " JOIN dim_location q ON dropoff_location_key = q.location_id GROUP BY 1, 2"
        " ORDER BY trip_count DESC, 1, 2 LIMIT 20",
        "pickup_zone dropoff_zone i:trip_count d:avg_distance d:avg_duration d:avg_fare",
        T2 + ", " + LOC,
    ),
    "aq07_rush_hour": out(
        "SELECT full_date, is_rush_hour, count(*) AS total_trips, sum(total_amount) AS total_revenue,"
        f" avg(total_amount) AS avg_fare {JD} JOIN dim_clock ON pickup_time_key = time_key GROUP BY 1, 2",
        "full_date is_rush_hour i:total_trips d:total_revenue d:avg_fare",
        ", ".join([T2, DATE, CLOCK]),
    ),
    "aq08_monthly": out(
        "SELECT year, month, month_name, count(*) AS total_trips, sum(total_amount) AS total_revenue, "
        + avgs(avg_distance="trip_distance", avg_passengers="passenger_count") + f" {JD} GROUP BY 1, 2, 3",
        "i:year i:month month_name i:total_trips d:total_revenue d:avg_distance d:avg_passengers",
        T2 + ", " + DATE,
    ),
    "aq09_quality_share": out(
        "SELECT quality_flag, count(*) AS trip_count, count(*) * 100.0 / sum(count(*)) OVER () AS percentage"
        " FROM fact GROUP BY 1",
        "quality_flag i:trip_count d:percentage",
        T2,
    ),
    "aq10_speed_by_tod": out(
        "SELECT time_of_day, "
        + avgs(avg_speed="avg_speed_mph", avg_distance="trip_distance", avg_duration="trip_duration_minutes")
        + f" {JT} WHERE avg_speed_mph > 0 AND avg_speed_mph < 100 GROUP BY 1",
        "time_of_day d:avg_speed d:avg_distance d:avg_duration",
        T2 + ", " + CLOCK,
    ),
    "rds_top_pickups": out(
        f"SELECT zone, borough, count(*) AS trip_count, {half_up('avg(total_amount)', 2)} AS avg_fare FROM fact"
        " JOIN dim_location ON pickup_location_id = location_id GROUP BY 1, 2 ORDER BY trip_count DESC, 1, 2 LIMIT 10",
        "zone borough i:trip_count d:avg_fare",
        T1 + ", " + LOC,
    ),
    "rds_hourly": out(
        f"SELECT hour, count(*) AS trip_count, {half_up('avg(total_amount)', 2)} AS avg_fare,"
        f" {half_up('avg(trip_distance)', 2)} AS avg_distance FROM fact JOIN dim_time USING (time_id) GROUP BY 1",
        "i:hour i:trip_count d:avg_fare d:avg_distance",
        T1 + ", " + TIME,
    ),
    "rds_weekend": out(
        "SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type, count(*) AS trip_count,"
        f" {half_up('avg(total_amount)', 2)} AS avg_fare, {half_up('avg(trip_distance)', 2)} AS avg_distance,"
        f" {half_up('avg(tip_amount)', 2)} AS avg_tip FROM fact JOIN dim_time USING (time_id) GROUP BY 1",
        "day_type i:trip_count d:avg_fare d:avg_distance d:avg_tip",
        T1 + ", " + TIME,
    ),
    "rds_weekend_routes": out(
        "SELECT pickup_zone, dropoff_zone, avg(total_amount) AS avg_fare FROM summary WHERE is_weekend GROUP BY 1, 2"
        " ORDER BY round(avg_fare, 6) DESC, 1, 2 LIMIT 10",
        "pickup_zone dropoff_zone d:avg_fare",
        ", ".join([T1, TIME, LOC, RATE, SUMMARY]),
    ),
    "w1_daily_counts": out(
        f"SELECT cast({P} AS date) AS trip_date, count(*) AS trip_count, avg(trip_distance) AS avg_distance,"
        " avg(fare_amount) AS avg_fare FROM trips GROUP BY 1",
        "trip_date i:trip_count d:avg_distance d:avg_fare",
        TRIPS,
    ),
    "w1_payment": out(
        "SELECT payment_type, count(*) AS count, avg(total_amount) AS avg_amount FROM trips GROUP BY 1",
        'i:payment_type i:count d:avg_amount',
        TRIPS,
    ),
    "w1_hours": out(
        f"SELECT hour({P}) AS hour, count(*) AS trip_count FROM trips GROUP BY 1", "i:hour i:trip_count", TRIPS
    ),
    "w1_daily_summary": out(
        f"SELECT cast({P} AS date) AS trip_date, count(*) AS total_trips, sum(fare_amount) AS total_revenue,"
        " avg(trip_distance) AS avg_distance, avg(passenger_count) AS avg_passengers FROM trips GROUP BY 1"
        " ORDER BY 1 DESC NULLS LAST LIMIT 7",
        "trip_date i:total_trips d:total_revenue d:avg_distance d:avg_passengers",
        TRIPS,
    ),
    "w1_daily_trip_size": out(
        f"SELECT cast({P} AS date) AS pickup_date, count(*) AS trips FROM trips WHERE {P} IS NOT NULL GROUP BY 1",
        "pickup_date i:trips",
        TRIPS,
    ),
    "w1_fare_distance_corr": out(
        "SELECT corr(trip_distance, fare_amount) AS correlation FROM trips", "d:correlation", TRIPS
    ),
    "demo_daily": out(
        "SELECT date_trunc('day', pickup_datetime)::TIMESTAMP AS trip_date, count(*) AS daily_trips,"
        " sum(total_amount) AS daily_revenue, avg(trip_distance) AS avg_distance,"
        " quantile_cont(fare_amount, 0.5) AS median_fare FROM curated WHERE pickup_datetime >= TIMESTAMP '1998-03-01'"
        " AND pickup_datetime < TIMESTAMP '1998-04-01' GROUP BY 1 ORDER BY 1 LIMIT 10",
        "trip_date i:daily_trips d:daily_revenue d:avg_distance d:median_fare",
        CURATED,
    ),
}
ORACLES["write_fact_taxi_trips"] = ORACLES["build_fact_taxi_trips"]
