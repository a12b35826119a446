"""The four analytics views over ``curated_trips`` (see operators.curated)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators.joins import mean_of, partial_sums, rows_total, sum_of
from ..operators.percentiles import add_percentiles, range_parts
from ..session import stored

ROUTE = ["pickup_location_id", "dropoff_location_id"]


def trip_minutes() -> Column:
    return fn.minutes_between("pickup_datetime", "dropoff_datetime")


def trip_speed() -> Column:
    return fn.speed_mph_or_null("trip_distance", trip_minutes())


def tips_given() -> Column:
    return F.count_if(F.col("tip_amount") > 0)


def share(count: str, digits: int) -> Column:
    """Percent of the total over a result that has a handful of rows (labels, codes)."""
    return fn.round_stable(F.col(count) * 100.0 / F.sum(count).over(Window.partitionBy()), digits)


def rate(part: str, whole: str, digits: int = 2) -> Column:
    return fn.round_stable(F.col(part) * 100.0 / F.col(whole), digits)


def _moving_forward() -> Column:
    return (
        F.col("pickup_datetime").isNotNull()
        & F.col("dropoff_datetime").isNotNull()
        & (F.col("dropoff_datetime") > F.col("pickup_datetime"))
    )


def _revenue_trips(curated: DataFrame) -> DataFrame:
    return curated.where(
        F.col("pickup_datetime").isNotNull()
        & (F.col("total_amount") > 0)
        & (F.col("total_amount") < 1000)
        & (F.col("fare_amount") > 0)
    ).withColumn("trip_date", F.date_trunc("day", "pickup_datetime").cast("timestamp_ntz"))


_DAILY = {
    "fare": "fare_amount", "tip": "tip_amount", "tolls": "tolls_amount", "total": "total_amount", "distance": "trip_distance",
    "passengers": "passenger_count",
}


def _daily_measures() -> dict[str, Column]:
    return {name: F.col(c) for name, c in _DAILY.items()} | {"per_mile": fn.fare_per_mile()}


def _daily_rollup(parts: DataFrame) -> DataFrame:
    """Days from sums per day and vendor (and whatever else the sums are split by)."""
    return parts.groupBy("trip_date").agg(
        rows_total().alias("total_trips"),
        F.count_distinct("vendor_id").alias("unique_vendors"),
        sum_of("fare").alias("total_fare"),
        sum_of("tip").alias("total_tips"),
        sum_of("tolls").alias("total_tolls"),
        sum_of("total").alias("total_revenue"),
        mean_of("fare").alias("avg_fare"),
        mean_of("tip").alias("avg_tip"),
        mean_of("total").alias("avg_total"),
        mean_of("distance").alias("avg_distance"),
        mean_of("per_mile").alias("avg_fare_per_mile"),
        sum_of("passengers").alias("total_passengers"),
        mean_of("passengers").alias("avg_passengers_per_trip"),
    )


def daily_revenue(curated: DataFrame) -> DataFrame:
    """``v_daily_revenue`` without the median, which the analysis queries do not read."""
    return _daily_rollup(partial_sums(_revenue_trips(curated), ["trip_date", "vendor_id"], _daily_measures()))


def v_daily_revenue(curated: DataFrame) -> DataFrame:
    trips, day = _revenue_trips(curated), ["trip_date"]
    parts = range_parts(trips, day, "total_amount", _daily_measures(), also=["vendor_id"])
    days = add_percentiles(_daily_rollup(parts), parts, trips, day, "total_amount", {"median_fare": 0.5})
    return days.orderBy(F.desc("trip_date"))


def v_hourly_trips(curated: DataFrame) -> DataFrame:
    kept = curated.where(
        _moving_forward()
        & (F.col("total_amount") > 0)
        & (F.col("trip_distance") > 0)
        & (F.col("trip_distance") < 100)
    )
    # Day type and period follow from hour and weekday, so they are added after the aggregation.
    return (
        kept.groupBy(
            F.hour("pickup_datetime").alias("pickup_hour"),
            fn.day_of_week("pickup_datetime").alias("day_of_week"),
        )
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.avg("trip_distance").alias("avg_distance"),
            F.avg(trip_speed()).alias("avg_speed_mph"),
            F.avg("fare_amount").alias("avg_fare"),
            F.avg("tip_amount").alias("avg_tip"),
            F.avg(fn.tip_percentage()).alias("avg_tip_percentage"),
            F.avg(trip_minutes()).alias("avg_duration_minutes"),
            F.avg("passenger_count").alias("avg_passengers"),
        )
        .withColumns(
            {"day_type": fn.day_type("day_of_week"), "time_period": fn.time_period("pickup_hour")}
        )
        .orderBy("day_of_week", "pickup_hour")
    )


def _paid_trips(curated: DataFrame) -> DataFrame:
    return curated.where(
        (F.col("total_amount") > 0)
        & (F.col("fare_amount") > 0)
        & F.col("payment_type").isNotNull()
    )


def v_payment_analysis(curated: DataFrame) -> DataFrame:
    paid, key = _paid_trips(curated), ["payment_type"]
    measures = {"fare": "fare_amount", "tip": "tip_amount", "total": "total_amount", "distance": "trip_distance", "passengers": "passenger_count"}
    measures = {name: F.col(c) for name, c in measures.items()} | {"tip_pct": fn.tip_percentage()}
    parts = range_parts(paid, key, "tip_amount", measures, [F.max("tip_amount").alias("max_tip"), tips_given().alias("with_tip")])
    grouped = parts.groupBy(*key).agg(
        rows_total().alias("total_transactions"),
        sum_of("fare").alias("total_fare_amount"),
        sum_of("tip").alias("total_tip_amount"),
        sum_of("total").alias("total_transaction_amount"),
        mean_of("fare").alias("avg_fare"),
        mean_of("tip").alias("avg_tip"),
        mean_of("tip_pct").alias("avg_tip_percentage"),
        F.max("max_tip").alias("max_tip"),
        F.sum("with_tip").alias("trips_with_tip"),
        mean_of("distance").alias("avg_trip_distance"),
        mean_of("passengers").alias("avg_passengers"),
    )
    named = grouped.withColumns(
        {
            "payment_type_name": fn.payment_type_name("payment_type"),
            "percentage_of_transactions": share("total_transactions", 2),
            "tip_frequency_percentage": rate("trips_with_tip", "total_transactions"),
        }
    )
    probs = {"median_tip": 0.5, "p75_tip": 0.75, "p90_tip": 0.9}
    return add_percentiles(named, parts, paid, key, "tip_amount", probs).orderBy(F.desc("total_transactions"), "payment_type")


def _route_condition() -> Column:
    return (
        _moving_forward()
        & (F.col("trip_distance") > 0)
        & (F.col("trip_distance") < 100)
        & (F.col("total_amount") > 0)
        & (F.col("total_amount") < 1000)
    )


def _all_routes(curated: DataFrame) -> DataFrame:
    """Trips with a route; ``inside`` are those that the view looks at."""
    return curated.dropna(subset=ROUTE).withColumn("inside", F.coalesce(_route_condition(), F.lit(False)))


def _route_totals(counts: DataFrame) -> Column:
    """Struct (trips of the routes in the view, p90 and p50 of the trip counts of all routes) from ``n``, ``n_inside`` per route.

    The thresholds leave out the view's filters. Distinct counts c satisfy sum(c) <= trips, so the buffer of
    ``percentile`` holds at most sqrt(2 * trips) values.
    """
    total = F.sum(F.when(F.col("n_inside") >= 10, F.col("n_inside"))).alias("total")
    volume = F.percentile("n", F.array(F.lit(0.9), F.lit(0.5))).alias("p")
    return counts.agg(F.struct(total, volume)).scalar()


def _route_measures() -> dict[str, Column]:
    """What the view sums up, of its own trips only."""
    measures = {"distance": "trip_distance", "fare": "fare_amount", "tip": "tip_amount", "total": "total_amount", "passengers": "passenger_count"}
    measures = {name: F.col(c) for name, c in measures.items()}
    measures |= {"minutes": trip_minutes(), "speed": trip_speed(), "tip_pct": fn.tip_percentage()}
    return {name: F.when(F.col("inside"), c) for name, c in measures.items()}


def _routes(parts: DataFrame, totals: Column) -> DataFrame:
    """Routes of the view from sums per route and ``inside``."""
    inside = F.sum(F.when(F.col("inside"), F.col("_n")))
    routes = parts.groupBy(*ROUTE).agg(
        inside.alias("trip_count"),
        mean_of("distance").alias("avg_distance"),
        mean_of("fare").alias("avg_fare"),
        mean_of("tip").alias("avg_tip"),
        mean_of("total").alias("avg_total_amount"),
        mean_of("minutes").alias("avg_duration_minutes"),
        mean_of("speed").alias("avg_speed_mph"),
        mean_of("tip_pct").alias("avg_tip_percentage"),
        sum_of("fare").alias("total_revenue"),
        mean_of("passengers").alias("avg_passengers"),
    ).where(F.col("trip_count") >= 10)
    return routes.withColumns(
        {
            "percentage_of_total": fn.round_stable(F.col("trip_count") * 100.0 / totals["total"], 4),
            "volume_category": F.when(F.col("trip_count") >= totals["p"][0], "High Volume")
            .when(F.col("trip_count") >= totals["p"][1], "Medium Volume")
            .otherwise("Low Volume"),
        }
    )


def location_performance(curated: DataFrame) -> DataFrame:
    """``v_location_performance`` without the median fare, which the route queries do not read.

    Two scans of the trips: the measures, and the totals of all routes as one scalar subquery, which reads keys and filters only.
    """
    trips = _all_routes(curated)
    counts = trips.groupBy(*ROUTE).agg(F.count(F.lit(1)).alias("n"), F.count_if("inside").alias("n_inside"))
    return _routes(partial_sums(trips.where("inside"), [*ROUTE, "inside"], _route_measures()), _route_totals(counts))


def v_location_performance(curated: DataFrame) -> DataFrame:
    """Two scans: sums and fare ranges of all routes, stored, from which the totals follow too; then the medians."""
    trips = _all_routes(curated)
    fare = trips.withColumn("_fare", F.when(F.col("inside"), F.col("fare_amount")))
    parts = range_parts(fare, ROUTE, "_fare", _route_measures(), also=["inside"])
    counts = parts.groupBy(*ROUTE).agg(F.sum("_n").alias("n"), F.sum(F.when(F.col("inside"), F.col("_n"))).alias("n_inside"))
    routes = _routes(parts, _route_totals(counts))
    # medians of the routes in the view only
    listed = stored(routes, "routes")
    kept = parts.join(listed.select(*ROUTE), ROUTE, "left_semi")
    return add_percentiles(listed, kept, fare, ROUTE, "_fare", {"median_fare": 0.5}).orderBy(F.desc("trip_count"), *ROUTE)
