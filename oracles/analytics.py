"""Checks of the views and analysis queries."""

from .common import CURATED, DAYS, MINUTES, SPEED, TIP_PCT, TRIPS, WEATHER, half_up, out, period

AS_OF = "DATE '2001-11-04'"

DAILY = (
    CURATED
    + ", daily AS (SELECT date_trunc('day', pickup_datetime)::TIMESTAMP AS trip_date, count(*) AS total_trips,"
    " count(DISTINCT vendor_id) AS unique_vendors, sum(fare_amount) AS total_fare, sum(tip_amount) AS total_tips,"
    " sum(tolls_amount) AS total_tolls, sum(total_amount) AS total_revenue, avg(fare_amount) AS avg_fare,"
    " avg(tip_amount) AS avg_tip, avg(total_amount) AS avg_total, avg(trip_distance) AS avg_distance,"
    " avg(fare_amount / nullif(trip_distance, 0)) AS avg_fare_per_mile,"
    " quantile_cont(total_amount, 0.5) AS median_fare, sum(passenger_count) AS total_passengers,"
    " avg(passenger_count) AS avg_passengers_per_trip"
    " FROM curated WHERE pickup_datetime IS NOT NULL AND total_amount > 0 AND total_amount < 1000"
    " AND fare_amount > 0 GROUP BY 1)"
)
HOURLY = (
    CURATED
    + f", h AS (SELECT hour(pickup_datetime) AS pickup_hour, dayofweek(pickup_datetime) AS day_of_week,"
    f" count(*) AS trip_count, avg(trip_distance) AS avg_distance, avg({SPEED}) AS avg_speed_mph,"
    f" avg(fare_amount) AS avg_fare, avg(tip_amount) AS avg_tip, avg({TIP_PCT}) AS avg_tip_percentage,"
    f" avg({MINUTES}) AS avg_duration_minutes, avg(passenger_count) AS avg_passengers FROM curated"
    " WHERE dropoff_datetime > pickup_datetime AND total_amount > 0 AND trip_distance > 0 AND trip_distance < 100"
    " GROUP BY 1, 2), hourly AS (SELECT *, CASE WHEN day_of_week IN (0,6) THEN 'Weekend' ELSE 'Weekday' END"
    f" AS day_type, {period('pickup_hour')} AS time_period FROM h)"
)


def _names(codes: str) -> str:
    labels = ["Credit Card", "Cash", "No Charge", "Dispute", "Unknown", "Voided Trip"]
    return "CASE payment_type " + " ".join(
        f"WHEN {i} THEN '{n}'" for i, n in enumerate(labels, 1) if str(i) in codes
    ) + " ELSE 'Other' END"


PAY = (
    CURATED
    + f", g AS (SELECT payment_type, count(*) AS total_transactions, sum(fare_amount) AS total_fare_amount,"
    " sum(tip_amount) AS total_tip_amount, sum(total_amount) AS total_transaction_amount,"
    f" avg(fare_amount) AS avg_fare, avg(tip_amount) AS avg_tip, avg({TIP_PCT}) AS avg_tip_percentage,"
    " quantile_cont(tip_amount, 0.5) AS median_tip, quantile_cont(tip_amount, 0.75) AS p75_tip,"
    " quantile_cont(tip_amount, 0.9) AS p90_tip, max(tip_amount) AS max_tip,"
    " count(*) FILTER (WHERE tip_amount > 0) AS trips_with_tip, avg(trip_distance) AS avg_trip_distance,"
    " avg(passenger_count) AS avg_passengers FROM curated WHERE total_amount > 0 AND fare_amount > 0"
    " AND payment_type IS NOT NULL GROUP BY payment_type),"
    f" pay AS (SELECT *, {_names('123456')} AS payment_type_name,"
    f" {half_up('total_transactions * 100.0 / (SELECT sum(total_transactions) FROM g)', 2)}"
    " AS percentage_of_transactions,"
    f" {half_up('trips_with_tip * 100.0 / total_transactions', 2)} AS tip_frequency_percentage FROM g)"
)
ROUTES = (
    CURATED
    + ", pairs AS (SELECT count(*) AS n FROM curated WHERE pickup_location_id IS NOT NULL"
    " AND dropoff_location_id IS NOT NULL GROUP BY pickup_location_id, dropoff_location_id),"
    " lim AS (SELECT quantile_cont(n, 0.9) AS hi, quantile_cont(n, 0.5) AS mid FROM pairs),"
    f" r AS (SELECT pickup_location_id, dropoff_location_id, count(*) AS trip_count,"
    f" avg(trip_distance) AS avg_distance, avg(fare_amount) AS avg_fare, avg(tip_amount) AS avg_tip,"
    f" avg(total_amount) AS avg_total_amount, avg({MINUTES}) AS avg_duration_minutes,"
    f" avg({SPEED}) AS avg_speed_mph, avg({TIP_PCT}) AS avg_tip_percentage, sum(fare_amount) AS total_revenue,"
    " avg(passenger_count) AS avg_passengers, quantile_cont(fare_amount, 0.5) AS median_fare FROM curated"
    " WHERE dropoff_datetime > pickup_datetime AND pickup_location_id IS NOT NULL"
    " AND dropoff_location_id IS NOT NULL AND trip_distance > 0 AND trip_distance < 100"
    " AND total_amount > 0 AND total_amount < 1000 GROUP BY ALL HAVING count(*) >= 10),"
    f" routes AS (SELECT r.*, {half_up('trip_count * 100.0 / (SELECT sum(trip_count) FROM r)', 4)}"
    " AS percentage_of_total, CASE WHEN trip_count >= hi THEN 'High Volume' WHEN trip_count >= mid"
    " THEN 'Medium Volume' ELSE 'Low Volume' END AS volume_category FROM r, lim)"
)
TIE = "pickup_location_id, dropoff_location_id"

ORACLES = {
    "curated_trips": out(
        "FROM curated",
        "i:vendor_id pickup_datetime dropoff_datetime i:passenger_count d:trip_distance i:rate_code_id"
        " store_and_fwd_flag i:pickup_location_id i:dropoff_location_id i:payment_type d:fare_amount d:extra"
        " d:mta_tax d:tip_amount d:tolls_amount d:improvement_surcharge d:total_amount d:congestion_surcharge"
        " d:airport_fee",
        CURATED,
    ),
    "v_daily_revenue": out(
        "FROM daily",
        "trip_date i:total_trips i:unique_vendors d:total_fare d:total_tips d:total_tolls d:total_revenue d:avg_fare"
        " d:avg_tip d:avg_total d:avg_distance d:avg_fare_per_mile d:median_fare i:total_passengers"
        " d:avg_passengers_per_trip",
        DAILY,
    ),
    "v_hourly_trips": out(
        "FROM hourly",
        "i:pickup_hour i:day_of_week day_type time_period i:trip_count d:avg_distance d:avg_speed_mph d:avg_fare"
        " d:avg_tip d:avg_tip_percentage d:avg_duration_minutes d:avg_passengers",
        HOURLY,
    ),
    "v_payment_analysis": out(
        "FROM pay",
        "i:payment_type payment_type_name i:total_transactions d:percentage_of_transactions d:total_fare_amount"
        " d:total_tip_amount d:total_transaction_amount d:avg_fare d:avg_tip d:avg_tip_percentage d:median_tip"
        " d:p75_tip d:p90_tip d:max_tip i:trips_with_tip d:tip_frequency_percentage d:avg_trip_distance"
        " d:avg_passengers",
        PAY,
    ),
    "v_location_performance": out(
        "FROM routes",
        "i:pickup_location_id i:dropoff_location_id i:trip_count d:percentage_of_total d:avg_distance d:avg_fare"
        " d:avg_tip d:avg_total_amount d:avg_duration_minutes d:avg_speed_mph d:avg_tip_percentage d:total_revenue"
        " d:avg_passengers d:median_fare volume_category",
        ROUTES,
    ),
    "q1_1_monthly_revenue": out(
        "SELECT m AS month, strftime(m, '%Y-%m') AS month_label, * EXCLUDE (m), prev AS prev_month_revenue, "
        + half_up("(total_revenue - prev) / nullif(prev, 0) * 100", 2)
        + " AS revenue_growth_pct FROM (SELECT *, lag(total_revenue) OVER (ORDER BY m) AS prev FROM"
        " (SELECT date_trunc('month', trip_date)::TIMESTAMP AS m, sum(total_trips) AS total_trips,"
        " sum(total_revenue) AS total_revenue, sum(total_fare) AS total_fare, sum(total_tips) AS total_tips,"
        " sum(total_tolls) AS total_tolls, avg(avg_fare) AS avg_fare_per_trip, avg(avg_tip) AS avg_tip_per_trip,"
        " avg(avg_distance) AS avg_distance_miles, sum(total_passengers) AS total_passengers FROM daily GROUP BY m))"
        " ORDER BY m DESC LIMIT 24",
        "month month_label i:total_trips d:total_revenue d:total_fare d:total_tips d:total_tolls d:avg_fare_per_trip"
        " d:avg_tip_per_trip d:avg_distance_miles i:total_passengers d:prev_month_revenue d:revenue_growth_pct",
        DAILY,
    ),
    "q1_2_yoy": out(
        "SELECT month(trip_date) AS month_number, strftime(trip_date, '%B') AS month_name, year(trip_date) AS year,"
        " sum(total_revenue) AS total_revenue, sum(total_trips) AS total_trips, avg(avg_fare) AS avg_fare,"
        " avg(avg_tip) AS avg_tip FROM daily GROUP BY 1, 2, 3",
        "i:month_number month_name i:year d:total_revenue i:total_trips d:avg_fare d:avg_tip",
        DAILY,
    ),
    "q1_3_revenue_by_dow": out(
        f"SELECT dayofweek(trip_date) AS day_of_week_num, {DAYS}[dayofweek(trip_date)+1] AS day_of_week,"
        " CASE WHEN dayofweek(trip_date) IN (0,6) THEN 'Weekend' ELSE 'Weekday' END AS day_type,"
        " sum(total_trips) AS total_trips, sum(total_revenue) AS total_revenue, avg(avg_fare) AS avg_fare,"
        " avg(avg_tip) AS avg_tip, avg(total_trips) AS avg_trips_per_day, avg(total_revenue) AS avg_revenue_per_day"
        f" FROM daily WHERE trip_date >= {AS_OF} - INTERVAL 90 DAY GROUP BY 1, 2, 3",
        "i:day_of_week_num day_of_week day_type i:total_trips d:total_revenue d:avg_fare d:avg_tip"
        " d:avg_trips_per_day d:avg_revenue_per_day",
        DAILY,
    ),
    "q1_4_top_days": out(
        "SELECT *, " + half_up("(total_revenue - m) / nullif(s, 0)", 2) + " AS revenue_zscore FROM (SELECT *,"
        " strftime(trip_date, '%A, %d %b %Y') AS formatted_date, dayofweek(trip_date) AS day_of_week,"
        " avg(total_revenue) OVER () AS m, stddev_samp(total_revenue) OVER () AS s FROM daily"
        f" WHERE trip_date >= {AS_OF} - INTERVAL 365 DAY) ORDER BY total_revenue DESC, trip_date LIMIT 20",
        "trip_date formatted_date i:day_of_week i:total_trips d:total_revenue d:avg_fare d:avg_tip d:revenue_zscore",
        DAILY,
    ),
    "q2_1_top_routes": out(
        "SELECT *, " + half_up("avg_fare / nullif(avg_duration_minutes, 0)", 2) + " AS revenue_per_minute FROM routes"
        f" WHERE volume_category = 'High Volume' ORDER BY trip_count DESC, {TIE} LIMIT 20",
        "i:pickup_location_id i:dropoff_location_id i:trip_count d:percentage_of_total d:avg_distance d:avg_fare"
        " d:avg_tip d:avg_duration_minutes d:avg_speed_mph d:total_revenue volume_category d:revenue_per_minute",
        ROUTES,
    ),
    "q2_2_profitable_routes": out(
        "SELECT *, " + half_up("avg_fare / nullif(avg_distance, 0)", 2) + " AS fare_per_mile, "
        + half_up("avg_tip / nullif(avg_fare, 0) * 100", 2) + " AS tip_percentage FROM routes"
        f" WHERE trip_count >= 50 AND avg_distance > 0 ORDER BY avg_fare DESC, {TIE} LIMIT 20",
        "i:pickup_location_id i:dropoff_location_id i:trip_count d:avg_fare d:avg_tip d:avg_distance"
        " d:avg_duration_minutes d:total_revenue d:fare_per_mile d:tip_percentage",
        ROUTES,
    ),
    "q2_3_short_frequent": out(
        "SELECT *, " + half_up("trip_count / nullif(avg_distance, 0)", 2) + " AS trips_per_mile_efficiency FROM routes"
        " WHERE avg_distance > 0 AND avg_distance <= 5 AND trip_count >= 100"
        f" ORDER BY trip_count DESC, {TIE} LIMIT 20",
        "i:pickup_location_id i:dropoff_location_id i:trip_count d:avg_distance d:avg_fare d:avg_duration_minutes"
        " d:trips_per_mile_efficiency",
        ROUTES,
    ),
    "q2_4_rank_in_period": out(
        "SELECT *, rank() OVER (PARTITION BY time_period ORDER BY trip_count DESC) AS route_rank_in_period"
        " FROM hourly WHERE day_type = 'Weekday'",
        "i:pickup_hour time_period day_type i:trip_count d:avg_distance d:avg_fare d:avg_tip d:avg_speed_mph"
        " d:avg_duration_minutes d:avg_tip_percentage i:route_rank_in_period",
        HOURLY,
    ),
    "q3_1_hourly_demand": out(
        "SELECT pickup_hour, time_period, coalesce(sum(trip_count) FILTER (WHERE day_type='Weekday'),0) AS weekday_trips,"
        " coalesce(sum(trip_count) FILTER (WHERE day_type='Weekend'),0) AS weekend_trips,"
        " avg(avg_fare) FILTER (WHERE day_type='Weekday') AS weekday_avg_fare,"
        " avg(avg_fare) FILTER (WHERE day_type='Weekend') AS weekend_avg_fare,"
        " avg(avg_speed_mph) FILTER (WHERE day_type='Weekday') AS weekday_avg_speed,"
        " avg(avg_speed_mph) FILTER (WHERE day_type='Weekend') AS weekend_avg_speed,"
        " avg(avg_tip_percentage) AS avg_tip_pct, avg(avg_duration_minutes) AS avg_duration FROM hourly GROUP BY 1, 2",
        "i:pickup_hour time_period i:weekday_trips i:weekend_trips d:weekday_avg_fare d:weekend_avg_fare"
        " d:weekday_avg_speed d:weekend_avg_speed d:avg_tip_pct d:avg_duration",
        HOURLY,
    ),
    "q3_2_rush_compare": out(
        "SELECT *, " + half_up("avg_distance / nullif(avg_speed, 0) * 60", 2) + " AS expected_duration_if_no_traffic, "
        + half_up("avg_duration - avg_distance / nullif(avg_speed, 0) * 60", 2) + " AS traffic_delay_minutes FROM"
        " (SELECT time_period, day_type, sum(trip_count) AS total_trips, avg(avg_fare) AS avg_fare,"
        " avg(avg_tip) AS avg_tip, avg(avg_speed_mph) AS avg_speed, avg(avg_duration_minutes) AS avg_duration,"
        " avg(avg_distance) AS avg_distance FROM hourly WHERE time_period LIKE '%Rush' GROUP BY 1, 2)",
        "time_period day_type i:total_trips d:avg_fare d:avg_tip d:avg_speed d:avg_duration d:avg_distance"
        " d:expected_duration_if_no_traffic d:traffic_delay_minutes",
        HOURLY,
    ),
    "q3_3_peak_offpeak": out(
        "SELECT CASE WHEN time_period LIKE '%Rush' THEN 'Peak Hours' ELSE 'Off-Peak Hours' END AS hour_category,"
        " day_type, sum(trip_count) AS total_trips, avg(avg_fare) AS avg_fare, avg(avg_tip) AS avg_tip,"
        " avg(avg_tip_percentage) AS avg_tip_pct, avg(avg_speed_mph) AS avg_speed,"
        " avg(avg_duration_minutes) AS avg_duration, avg(avg_passengers) AS avg_passengers FROM hourly GROUP BY 1, 2",
        "hour_category day_type i:total_trips d:avg_fare d:avg_tip d:avg_tip_pct d:avg_speed d:avg_duration"
        " d:avg_passengers",
        HOURLY,
    ),
    "q3_4_late_night": out(
        f"SELECT *, {DAYS}[day_of_week+1] AS day_name FROM hourly WHERE pickup_hour <= 5",
        "i:pickup_hour i:day_of_week day_name i:trip_count d:avg_fare d:avg_tip d:avg_tip_percentage d:avg_distance"
        " d:avg_duration_minutes",
        HOURLY,
    ),
    "q4_1_tip_by_payment": out(
        "SELECT *, " + half_up("total_tip_amount / total_transactions", 2) + " AS tip_per_transaction, "
        + half_up("total_tip_amount / nullif(total_fare_amount, 0) * 100", 2) + " AS overall_tip_rate FROM pay",
        "payment_type_name i:total_transactions d:percentage_of_transactions d:total_tip_amount d:avg_tip"
        " d:avg_tip_percentage d:median_tip d:p75_tip d:p90_tip d:max_tip i:trips_with_tip"
        " d:tip_frequency_percentage d:avg_fare d:avg_trip_distance d:tip_per_transaction d:overall_tip_rate",
        PAY,
    ),
    "q4_2_fare_buckets": out(
        "SELECT *, " + half_up("trips_with_tip * 100.0 / trip_count", 2) + " AS tip_frequency_pct FROM (SELECT CASE"
        " WHEN fare_amount<=10 THEN '$0-10' WHEN fare_amount<=20 THEN '$10-20' WHEN fare_amount<=30 THEN '$20-30'"
        " WHEN fare_amount<=50 THEN '$30-50' WHEN fare_amount<=100 THEN '$50-100' ELSE '$100+' END AS fare_bucket,"
        f" payment_type, {_names('1234')} AS payment_type_name, count(*) AS trip_count, avg(fare_amount) AS avg_fare,"
        f" avg(tip_amount) AS avg_tip, avg({TIP_PCT}) AS avg_tip_percentage,"
        " count(*) FILTER (WHERE tip_amount > 0) AS trips_with_tip FROM curated"
        " WHERE fare_amount > 0 AND total_amount > 0 AND payment_type IN (1, 2) GROUP BY 1, 2, 3)",
        "fare_bucket i:payment_type payment_type_name i:trip_count d:avg_fare d:avg_tip d:avg_tip_percentage"
        " i:trips_with_tip d:tip_frequency_pct",
        CURATED,
    ),
    "q4_3_tip_buckets": out(
        "SELECT *, " + half_up("trip_count * 100.0 / sum(trip_count) OVER ()", 2) + " AS percentage_of_trips FROM"
        " (SELECT CASE WHEN p<=10 THEN '0-10%' WHEN p<=15 THEN '10-15%' WHEN p<=20 THEN '15-20%'"
        " WHEN p<=25 THEN '20-25%' WHEN p<=30 THEN '25-30%' ELSE '30%+' END AS tip_percentage_bucket,"
        " count(*) AS trip_count, avg(fare_amount) AS avg_fare, avg(tip_amount) AS avg_tip,"
        " avg(trip_distance) AS avg_distance, avg(passenger_count) AS avg_passengers FROM"
        f" (SELECT *, {TIP_PCT} AS p FROM curated WHERE payment_type=1 AND fare_amount>0 AND tip_amount>=0"
        " AND total_amount>0) GROUP BY 1)",
        "tip_percentage_bucket i:trip_count d:percentage_of_trips d:avg_fare d:avg_tip d:avg_distance d:avg_passengers",
        CURATED,
    ),
    "q4_4_tip_by_time": out(
        f"SELECT *, {DAYS}[day_of_week+1] AS day_name, {period('pickup_hour', 'Late Night')} AS time_period, "
        + half_up("trips_with_tip * 100.0 / trip_count", 2) + " AS tip_frequency_pct FROM"
        " (SELECT dayofweek(pickup_datetime) AS day_of_week, hour(pickup_datetime) AS pickup_hour,"
        f" count(*) AS trip_count, avg(tip_amount) AS avg_tip, avg({TIP_PCT}) AS avg_tip_pct,"
        " count(*) FILTER (WHERE tip_amount > 0) AS trips_with_tip FROM curated WHERE payment_type=1"
        " AND fare_amount>0 AND pickup_datetime IS NOT NULL GROUP BY 1, 2)",
        "i:day_of_week day_name i:pickup_hour time_period i:trip_count d:avg_tip d:avg_tip_pct i:trips_with_tip"
        " d:tip_frequency_pct",
        CURATED,
    ),
    "qb2_passengers": out(
        "SELECT passenger_count, count(*) AS trip_count, avg(fare_amount) AS avg_fare, avg(tip_amount) AS avg_tip,"
        f" avg({TIP_PCT}) AS avg_tip_pct, avg(trip_distance) AS avg_distance FROM curated WHERE payment_type=1"
        " AND passenger_count BETWEEN 1 AND 6 AND fare_amount>0 GROUP BY 1",
        "i:passenger_count i:trip_count d:avg_fare d:avg_tip d:avg_tip_pct d:avg_distance",
        CURATED,
    ),
    "qb3_distance_buckets": out(
        "SELECT CASE WHEN trip_distance<=1 THEN '0-1 miles' WHEN trip_distance<=2 THEN '1-2 miles'"
        " WHEN trip_distance<=5 THEN '2-5 miles' WHEN trip_distance<=10 THEN '5-10 miles'"
        " WHEN trip_distance<=20 THEN '10-20 miles' ELSE '20+ miles' END AS distance_bucket, count(*) AS trip_count,"
        f" avg(fare_amount) AS avg_fare, avg(tip_amount) AS avg_tip, avg({TIP_PCT}) AS avg_tip_pct,"
        f" avg({MINUTES}) AS avg_duration_minutes, avg({SPEED}) AS avg_speed_mph FROM curated"
        " WHERE trip_distance>0 AND trip_distance<100 AND dropoff_datetime>pickup_datetime GROUP BY 1",
        "distance_bucket i:trip_count d:avg_fare d:avg_tip d:avg_tip_pct d:avg_duration_minutes d:avg_speed_mph",
        CURATED,
    ),
    "weather_join": out(
        "SELECT date_trunc('day', pickup_datetime)::TIMESTAMP AS trip_date, weather_condition, temperature_f,"
        " precipitation_inches, count(*) AS trip_count, avg(fare_amount) AS avg_fare,"
        " avg(trip_distance) AS avg_distance, avg(tip_amount) AS avg_tip FROM curated"
        " LEFT JOIN weather ON cast(pickup_datetime AS date) = weather.date GROUP BY 1, 2, 3, 4",
        "trip_date weather_condition i:temperature_f d:precipitation_inches i:trip_count d:avg_fare d:avg_distance"
        " d:avg_tip",
        CURATED + ", " + WEATHER,
    ),
}
