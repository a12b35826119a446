"""Analysis queries over the views and over ``curated_trips``.

``daily``, ``hourly``, ``routes`` and ``payments`` are the view results of ``plans.views``.
Averages of the views' averages are unweighted, as the questions define them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as fn
from .views import rate, share, tips_given, trip_minutes, trip_speed


def _over(num: Column, den: Column) -> Column:
    return num / F.nullif(den, F.lit(0.0))


def _since(daily: DataFrame, as_of, days: int) -> DataFrame:
    day = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return daily.where(F.col("trip_date") >= F.date_sub(day, days))


def q1_1_monthly_revenue(daily: DataFrame, months: int = 24) -> DataFrame:
    """Month totals with growth against the month before; the newest ``months``."""
    by_month = daily.groupBy(
        F.date_trunc("month", "trip_date").cast("timestamp_ntz").alias("month")
    ).agg(
        F.sum("total_trips").alias("total_trips"),
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_fare").alias("total_fare"),
        F.sum("total_tips").alias("total_tips"),
        F.sum("total_tolls").alias("total_tolls"),
        F.avg("avg_fare").alias("avg_fare_per_trip"),
        F.avg("avg_tip").alias("avg_tip_per_trip"),
        F.avg("avg_distance").alias("avg_distance_miles"),
        F.sum("total_passengers").alias("total_passengers"),
    )
    # One row per calendar month: the unpartitioned window is bounded by the calendar.
    before = F.lag("total_revenue").over(Window.orderBy("month"))
    return (
        by_month.withColumn("prev_month_revenue", before)
        .withColumns(
            {
                "month_label": F.date_format("month", "yyyy-MM"),
                "revenue_growth_pct": fn.round_stable(
                    _over(
                        F.col("total_revenue") - F.col("prev_month_revenue"),
                        F.col("prev_month_revenue"),
                    )
                    * 100,
                    2,
                ),
            }
        )
        .orderBy(F.desc("month"))
        .limit(months)
    )


def q1_2_yoy(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy(
            F.month("trip_date").alias("month_number"),
            F.date_format("trip_date", "MMMM").alias("month_name"),
            F.year("trip_date").alias("year"),
        )
        .agg(
            F.sum("total_revenue").alias("total_revenue"),
            F.sum("total_trips").alias("total_trips"),
            F.avg("avg_fare").alias("avg_fare"),
            F.avg("avg_tip").alias("avg_tip"),
        )
        .orderBy("month_number", F.desc("year"))
    )


def q1_3_revenue_by_dow(daily: DataFrame, as_of=None, days: int = 90) -> DataFrame:
    return (
        _since(daily, as_of, days)
        .groupBy(fn.day_of_week("trip_date").alias("day_of_week_num"))
        .agg(
            F.sum("total_trips").alias("total_trips"),
            F.sum("total_revenue").alias("total_revenue"),
            F.avg("avg_fare").alias("avg_fare"),
            F.avg("avg_tip").alias("avg_tip"),
            F.avg("total_trips").alias("avg_trips_per_day"),
            F.avg("total_revenue").alias("avg_revenue_per_day"),
        )
        .withColumns(
            {
                "day_of_week": fn.day_name("day_of_week_num"),
                "day_type": fn.day_type("day_of_week_num"),
            }
        )
        .orderBy("day_of_week_num")
    )


def q1_4_top_days(daily: DataFrame, as_of=None, days: int = 365, k: int = 20) -> DataFrame:
    """Best days with the z-score of their revenue among the days looked at (at most ``days`` + 1)."""
    every = Window.partitionBy()
    score = _over(
        F.col("total_revenue") - F.avg("total_revenue").over(every),
        F.stddev("total_revenue").over(every),
    )
    return (
        _since(daily, as_of, days)
        .select(
            "trip_date",
            F.date_format("trip_date", "EEEE, dd MMM yyyy").alias("formatted_date"),
            fn.day_of_week("trip_date").alias("day_of_week"),
            "total_trips",
            "total_revenue",
            "avg_fare",
            "avg_tip",
            fn.round_stable(score, 2).alias("revenue_zscore"),
        )
        .orderBy(F.desc("total_revenue"), "trip_date")
        .limit(k)
    )


_ROUTE_TIE = ("pickup_location_id", "dropoff_location_id")


def q2_1_top_routes(routes: DataFrame, k: int = 20) -> DataFrame:
    return (
        routes.where(F.col("volume_category") == "High Volume")
        .select(
            *_ROUTE_TIE,
            "trip_count",
            "percentage_of_total",
            "avg_distance",
            "avg_fare",
            "avg_tip",
            "avg_duration_minutes",
            "avg_speed_mph",
            "total_revenue",
            "volume_category",
            fn.round_stable(_over(F.col("avg_fare"), F.col("avg_duration_minutes")), 2).alias(
                "revenue_per_minute"
            ),
        )
        .orderBy(F.desc("trip_count"), *_ROUTE_TIE)
        .limit(k)
    )


def q2_2_profitable_routes(routes: DataFrame, min_trips: int = 50, k: int = 20) -> DataFrame:
    return (
        routes.where((F.col("trip_count") >= min_trips) & (F.col("avg_distance") > 0))
        .select(
            *_ROUTE_TIE,
            "trip_count",
            "avg_fare",
            "avg_tip",
            "avg_distance",
            "avg_duration_minutes",
            "total_revenue",
            fn.round_stable(_over(F.col("avg_fare"), F.col("avg_distance")), 2).alias("fare_per_mile"),
            fn.round_stable(_over(F.col("avg_tip"), F.col("avg_fare")) * 100, 2).alias("tip_percentage"),
        )
        .orderBy(F.desc("avg_fare"), *_ROUTE_TIE)
        .limit(k)
    )


def q2_3_short_frequent(
    routes: DataFrame, max_miles: float = 5, min_trips: int = 100, k: int = 20
) -> DataFrame:
    per_mile = _over(F.col("trip_count").cast("double"), F.col("avg_distance"))
    return (
        routes.where(
            (F.col("avg_distance") > 0)
            & (F.col("avg_distance") <= max_miles)
            & (F.col("trip_count") >= min_trips)
        )
        .select(
            *_ROUTE_TIE,
            "trip_count",
            "avg_distance",
            "avg_fare",
            "avg_duration_minutes",
            fn.round_stable(per_mile, 2).alias("trips_per_mile_efficiency"),
        )
        .orderBy(F.desc("trip_count"), *_ROUTE_TIE)
        .limit(k)
    )


def q2_4_rank_in_period(hourly: DataFrame) -> DataFrame:
    ranked = F.rank().over(Window.partitionBy("time_period").orderBy(F.desc("trip_count")))
    return (
        hourly.where(F.col("day_type") == "Weekday")
        .select(
            "pickup_hour",
            "time_period",
            "day_type",
            "trip_count",
            "avg_distance",
            "avg_fare",
            "avg_tip",
            "avg_speed_mph",
            "avg_duration_minutes",
            "avg_tip_percentage",
            ranked.alias("route_rank_in_period"),
        )
        .orderBy("pickup_hour", F.desc("trip_count"))
    )


def q3_1_hourly_demand(hourly: DataFrame) -> DataFrame:
    def on(kind: str, value: str) -> Column:
        return F.when(F.col("day_type") == kind, F.col(value))

    def trips(kind: str) -> Column:
        return F.sum(F.coalesce(on(kind, "trip_count"), F.lit(0)))

    return (
        hourly.groupBy("pickup_hour", "time_period")
        .agg(
            trips("Weekday").alias("weekday_trips"),
            trips("Weekend").alias("weekend_trips"),
            F.avg(on("Weekday", "avg_fare")).alias("weekday_avg_fare"),
            F.avg(on("Weekend", "avg_fare")).alias("weekend_avg_fare"),
            F.avg(on("Weekday", "avg_speed_mph")).alias("weekday_avg_speed"),
            F.avg(on("Weekend", "avg_speed_mph")).alias("weekend_avg_speed"),
            F.avg("avg_tip_percentage").alias("avg_tip_pct"),
            F.avg("avg_duration_minutes").alias("avg_duration"),
        )
        .orderBy("pickup_hour")
    )


def q3_2_rush_compare(hourly: DataFrame) -> DataFrame:
    expected = _over(F.col("avg_distance"), F.col("avg_speed")) * 60
    return (
        hourly.where(F.col("time_period").isin("Morning Rush", "Evening Rush"))
        .groupBy("time_period", "day_type")
        .agg(
            F.sum("trip_count").alias("total_trips"),
            F.avg("avg_fare").alias("avg_fare"),
            F.avg("avg_tip").alias("avg_tip"),
            F.avg("avg_speed_mph").alias("avg_speed"),
            F.avg("avg_duration_minutes").alias("avg_duration"),
            F.avg("avg_distance").alias("avg_distance"),
        )
        .withColumns(
            {
                "expected_duration_if_no_traffic": fn.round_stable(expected, 2),
                "traffic_delay_minutes": fn.round_stable(F.col("avg_duration") - expected, 2),
            }
        )
        .orderBy("time_period", "day_type")
    )


def q3_3_peak_offpeak(hourly: DataFrame) -> DataFrame:
    return (
        hourly.groupBy(fn.hour_category("time_period").alias("hour_category"), "day_type")
        .agg(
            F.sum("trip_count").alias("total_trips"),
            F.avg("avg_fare").alias("avg_fare"),
            F.avg("avg_tip").alias("avg_tip"),
            F.avg("avg_tip_percentage").alias("avg_tip_pct"),
            F.avg("avg_speed_mph").alias("avg_speed"),
            F.avg("avg_duration_minutes").alias("avg_duration"),
            F.avg("avg_passengers").alias("avg_passengers"),
        )
        .orderBy("hour_category", "day_type")
    )


def q3_4_late_night(hourly: DataFrame) -> DataFrame:
    """Night hours by weekday. Hours from 22 on belong to 'Evening', so only 0-5 remain."""
    return (
        hourly.where(F.col("time_period") == "Late Night/Early Morning")
        .where((F.col("pickup_hour") >= 22) | (F.col("pickup_hour") <= 5))
        .select(
            "pickup_hour",
            "day_of_week",
            fn.day_name("day_of_week").alias("day_name"),
            "trip_count",
            "avg_fare",
            "avg_tip",
            "avg_tip_percentage",
            "avg_distance",
            "avg_duration_minutes",
        )
        .orderBy("day_of_week", "pickup_hour")
    )


def q4_1_tip_by_payment(payments: DataFrame) -> DataFrame:
    tips = F.col("total_tip_amount")
    return payments.select(
        "payment_type_name",
        "total_transactions",
        "percentage_of_transactions",
        "total_tip_amount",
        "avg_tip",
        "avg_tip_percentage",
        "median_tip",
        "p75_tip",
        "p90_tip",
        "max_tip",
        "trips_with_tip",
        "tip_frequency_percentage",
        "avg_fare",
        "avg_trip_distance",
        fn.round_stable(_over(tips, F.col("total_transactions").cast("double")), 2).alias(
            "tip_per_transaction"
        ),
        fn.round_stable(_over(tips, F.col("total_fare_amount")) * 100, 2).alias("overall_tip_rate"),
    ).orderBy(F.desc("total_transactions"), "payment_type_name")


def q4_2_fare_buckets(curated: DataFrame) -> DataFrame:
    return (
        curated.where((F.col("fare_amount") > 0) & (F.col("total_amount") > 0))
        .where(F.col("payment_type").isin(1, 2))
        .groupBy(fn.fare_bucket().alias("fare_bucket"), "payment_type")
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.avg("fare_amount").alias("avg_fare"),
            F.avg("tip_amount").alias("avg_tip"),
            F.avg(fn.tip_percentage()).alias("avg_tip_percentage"),
            tips_given().alias("trips_with_tip"),
        )
        .withColumns(
            {
                "payment_type_name": fn.payment_type_name("payment_type", known=4),
                "tip_frequency_pct": rate("trips_with_tip", "trip_count"),
            }
        )
        .orderBy("fare_bucket", "payment_type")
    )


def q4_3_tip_buckets(curated: DataFrame) -> DataFrame:
    return (
        curated.where((F.col("payment_type") == 1) & (F.col("fare_amount") > 0))
        .where((F.col("tip_amount") >= 0) & (F.col("total_amount") > 0))
        .groupBy(fn.tip_bucket(fn.tip_percentage()).alias("tip_percentage_bucket"))
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.avg("fare_amount").alias("avg_fare"),
            F.avg("tip_amount").alias("avg_tip"),
            F.avg("trip_distance").alias("avg_distance"),
            F.avg("passenger_count").alias("avg_passengers"),
        )
        .withColumn("percentage_of_trips", share("trip_count", 2))
        .orderBy(F.desc("trip_count"), "tip_percentage_bucket")
    )


def q4_4_tip_by_time(curated: DataFrame) -> DataFrame:
    return (
        curated.where(F.col("payment_type") == 1)
        .where((F.col("fare_amount") > 0) & F.col("pickup_datetime").isNotNull())
        .groupBy(
            fn.day_of_week("pickup_datetime").alias("day_of_week"),
            F.hour("pickup_datetime").alias("pickup_hour"),
        )
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.avg("tip_amount").alias("avg_tip"),
            F.avg(fn.tip_percentage()).alias("avg_tip_pct"),
            tips_given().alias("trips_with_tip"),
        )
        .withColumns(
            {
                "day_name": fn.day_name("day_of_week"),
                "time_period": fn.time_period("pickup_hour", "Late Night"),
                "tip_frequency_pct": rate("trips_with_tip", "trip_count"),
            }
        )
        .orderBy("day_of_week", "pickup_hour")
    )


def qb2_passengers(curated: DataFrame) -> DataFrame:
    return (
        curated.where((F.col("payment_type") == 1) & (F.col("fare_amount") > 0))
        .where((F.col("passenger_count") > 0) & (F.col("passenger_count") <= 6))
        .groupBy("passenger_count")
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.avg("fare_amount").alias("avg_fare"),
            F.avg("tip_amount").alias("avg_tip"),
            F.avg(fn.tip_percentage()).alias("avg_tip_pct"),
            F.avg("trip_distance").alias("avg_distance"),
        )
        .orderBy("passenger_count")
    )


def qb3_distance_buckets(curated: DataFrame) -> DataFrame:
    return (
        curated.where((F.col("trip_distance") > 0) & (F.col("trip_distance") < 100))
        .where(F.col("dropoff_datetime") > F.col("pickup_datetime"))
        .groupBy(fn.distance_bucket().alias("distance_bucket"))
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.avg("fare_amount").alias("avg_fare"),
            F.avg("tip_amount").alias("avg_tip"),
            F.avg(fn.tip_percentage()).alias("avg_tip_pct"),
            F.avg(trip_minutes()).alias("avg_duration_minutes"),
            F.avg(trip_speed()).alias("avg_speed_mph"),
            F.min("trip_distance").alias("_from"),
        )
        .orderBy("_from")
        .drop("_from")
    )


def weather_join(curated: DataFrame, weather: DataFrame) -> DataFrame:
    """Daily trips next to that day's weather; days without weather stay.

    Trips are summed per day before the join, so the join moves days, not trips, and a busy
    day costs no more than a quiet one.
    """
    sums = ("fare_amount", "trip_distance", "tip_amount")
    daily = curated.groupBy(
        F.date_trunc("day", "pickup_datetime").cast("timestamp_ntz").alias("trip_date")
    ).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(c).alias(f"s_{c}") for c in sums],
        *[F.count(c).alias(f"n_{c}") for c in sums],
    )

    def mean(c: str) -> Column:
        return F.sum(f"s_{c}") / F.nullif(F.sum(f"n_{c}"), F.lit(0))

    return (
        daily.join(weather, F.to_date("trip_date") == F.col("date"), "left")
        .groupBy("trip_date", "weather_condition", "temperature_f", "precipitation_inches")
        .agg(
            F.sum("n").alias("trip_count"),
            mean("fare_amount").alias("avg_fare"),
            mean("trip_distance").alias("avg_distance"),
            mean("tip_amount").alias("avg_tip"),
        )
        .orderBy(F.desc("trip_date"))
    )
