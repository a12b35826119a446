"""Questions to the star schemas.

Facts are summed per foreign key first and the few sums are joined with the dimension.
``fact`` is ``build_fact_taxi_trips`` for the ``aq`` questions and ``build_fact_trips`` for
the ``rds`` ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators.cleaning import PICKUP
from ..operators.joins import mean_of, partial_sums, rows_total, sum_of
from ..operators.percentiles import add_percentiles, range_parts
from .views import share

_MEASURES = ("total_amount", "trip_distance", "trip_duration_minutes", "tip_amount", "passenger_count")


def _sums(fact: DataFrame, keys: list[str], *names: str) -> DataFrame:
    return partial_sums(fact, keys, {n: F.col(n) for n in names or _MEASURES})


def _by_date(fact: DataFrame, dim_date: DataFrame, *names: str) -> DataFrame:
    sums = _sums(fact, ["pickup_date_key"], *names)
    return sums.join(dim_date, F.col("pickup_date_key") == F.col("date_key"))


def _by_clock(fact: DataFrame, clock: DataFrame, *names: str) -> DataFrame:
    sums = _sums(fact, ["pickup_time_key"], *names)
    return sums.join(clock, F.col("pickup_time_key") == F.col("time_key"))


def aq01_daily_revenue(fact: DataFrame, dim_date: DataFrame, year=2023, month=1) -> DataFrame:
    """Days of one month; the month also bounds the fact's date key, so a sorted fact is pruned."""
    first = year * 10000 + month * 100
    kept = fact.where(F.col("pickup_date_key").between(first + 1, first + 31))
    days = dim_date.where((F.col("year") == year) & (F.col("month") == month))
    return (
        _by_date(kept, days)
        .groupBy("full_date", "day_name")
        .agg(
            rows_total().alias("total_trips"),
            sum_of("total_amount").alias("total_revenue"),
            mean_of("total_amount").alias("avg_fare"),
            mean_of("trip_distance").alias("avg_distance"),
            mean_of("trip_duration_minutes").alias("avg_duration"),
            sum_of("passenger_count").alias("total_passengers"),
        )
        .orderBy("full_date")
    )


def aq02_peak_hours(fact: DataFrame, clock: DataFrame) -> DataFrame:
    return (
        _by_clock(fact, clock)
        .groupBy("hour", "time_of_day")
        .agg(
            rows_total().alias("total_trips"),
            mean_of("total_amount").alias("avg_fare"),
            mean_of("trip_distance").alias("avg_distance"),
            mean_of("tip_amount").alias("avg_tip"),
        )
        .orderBy("hour")
    )


def aq03_top_pickups(fact: DataFrame, dim_location: DataFrame, k: int = 20) -> DataFrame:
    return (
        _sums(fact, ["pickup_location_key"], "total_amount", "trip_distance")
        .join(dim_location, F.col("pickup_location_key") == F.col("location_id"))
        .groupBy("zone", "borough")
        .agg(
            rows_total().alias("total_pickups"),
            sum_of("total_amount").alias("total_revenue"),
            mean_of("total_amount").alias("avg_fare"),
            mean_of("trip_distance").alias("avg_distance"),
        )
        .orderBy(F.desc("total_revenue"), "zone", "borough")
        .limit(k)
    )


def aq04_payment(fact: DataFrame, dim_payment: DataFrame) -> DataFrame:
    ratio = F.col("tip_amount").cast("double") / F.nullif(F.col("fare_amount").cast("double"), F.lit(0.0))
    sums = partial_sums(
        fact,
        ["payment_type_key"],
        {"total_amount": F.col("total_amount"), "tip_amount": F.col("tip_amount"), "ratio": ratio},
    )
    return (
        sums.join(dim_payment, "payment_type_key")
        .groupBy("payment_type_name")
        .agg(
            rows_total().alias("total_trips"),
            sum_of("total_amount").alias("total_revenue"),
            mean_of("total_amount").alias("avg_fare"),
            mean_of("tip_amount").alias("avg_tip"),
            (mean_of("ratio") * 100).alias("avg_tip_percentage"),
        )
        .orderBy(F.desc("total_trips"), "payment_type_name")
    )


def aq05_weekend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    label = F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday")
    return (
        _by_date(fact, dim_date)
        .groupBy(label.alias("day_type"))
        .agg(
            rows_total().alias("total_trips"),
            sum_of("total_amount").alias("total_revenue"),
            mean_of("total_amount").alias("avg_fare"),
            mean_of("trip_distance").alias("avg_distance"),
            mean_of("trip_duration_minutes").alias("avg_duration"),
        )
    )


def aq06_routes(fact: DataFrame, dim_location: DataFrame, k: int = 20) -> DataFrame:
    pickup = dim_location.select(
        F.col("location_id").alias("pickup_location_key"), F.col("zone").alias("pickup_zone")
    )
    dropoff = dim_location.select(
        F.col("location_id").alias("dropoff_location_key"), F.col("zone").alias("dropoff_zone")
    )
    return (
        _sums(
            fact,
            ["pickup_location_key", "dropoff_location_key"],
            "trip_distance",
            "trip_duration_minutes",
            "total_amount",
        )
        .join(pickup, "pickup_location_key")
        .join(dropoff, "dropoff_location_key")
        .groupBy("pickup_zone", "dropoff_zone")
        .agg(
            rows_total().alias("trip_count"),
            mean_of("trip_distance").alias("avg_distance"),
            mean_of("trip_duration_minutes").alias("avg_duration"),
            mean_of("total_amount").alias("avg_fare"),
        )
        .orderBy(F.desc("trip_count"), "pickup_zone", "dropoff_zone")
        .limit(k)
    )


def aq07_rush_hour(fact: DataFrame, dim_date: DataFrame, clock: DataFrame) -> DataFrame:
    return (
        _sums(fact, ["pickup_date_key", "pickup_time_key"], "total_amount")
        .join(clock, F.col("pickup_time_key") == F.col("time_key"))
        .groupBy("pickup_date_key", "is_rush_hour")
        .agg(
            rows_total().alias("_n"),
            sum_of("total_amount").alias("_s_total_amount"),
            F.sum("_c_total_amount").alias("_c_total_amount"),
        )
        .join(dim_date, F.col("pickup_date_key") == F.col("date_key"))
        .groupBy("full_date", "is_rush_hour")
        .agg(
            rows_total().alias("total_trips"),
            sum_of("total_amount").alias("total_revenue"),
            mean_of("total_amount").alias("avg_fare"),
        )
        .orderBy("full_date")
    )


def aq08_monthly(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return (
        _by_date(fact, dim_date)
        .groupBy("year", "month", "month_name")
        .agg(
            rows_total().alias("total_trips"),
            sum_of("total_amount").alias("total_revenue"),
            mean_of("trip_distance").alias("avg_distance"),
            mean_of("passenger_count").alias("avg_passengers"),
        )
        .orderBy("year", "month")
    )


def aq09_quality_share(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("quality_flag")
        .agg(F.count(F.lit(1)).alias("trip_count"))
        .withColumn("percentage", share("trip_count", 12))
        .orderBy(F.desc("trip_count"), "quality_flag")
    )


def aq10_speed_by_tod(fact: DataFrame, clock: DataFrame) -> DataFrame:
    rank = F.array_position(
        F.array(*[F.lit(p) for p in ("Morning", "Afternoon", "Evening", "Night")]), F.col("time_of_day")
    )
    kept = fact.where((F.col("avg_speed_mph") > 0) & (F.col("avg_speed_mph") < 100))
    return (
        _by_clock(kept, clock, "avg_speed_mph", "trip_distance", "trip_duration_minutes")
        .groupBy("time_of_day")
        .agg(
            mean_of("avg_speed_mph").alias("avg_speed"),
            mean_of("trip_distance").alias("avg_distance"),
            mean_of("trip_duration_minutes").alias("avg_duration"),
        )
        .orderBy(rank)
    )


def _rounded(name: str):
    return fn.round_stable(mean_of(name), 2)


def rds_top_pickups(fact: DataFrame, dim_location: DataFrame, k: int = 5) -> DataFrame:
    return (
        _sums(fact, ["pickup_location_id"], "total_amount")
        .join(dim_location, F.col("pickup_location_id") == F.col("location_id"))
        .groupBy("zone", "borough")
        .agg(rows_total().alias("trip_count"), _rounded("total_amount").alias("avg_fare"))
        .orderBy(F.desc("trip_count"), "zone", "borough")
        .limit(k)
    )


def _by_time(fact: DataFrame, dim_time: DataFrame, *names: str) -> DataFrame:
    # The sums are already distributed by time_id, the key of the join.
    return _sums(fact, ["time_id"], *names).join(dim_time, "time_id")


def rds_hourly(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    return (
        _by_time(fact, dim_time, "total_amount", "trip_distance")
        .groupBy("hour")
        .agg(
            rows_total().alias("trip_count"),
            _rounded("total_amount").alias("avg_fare"),
            _rounded("trip_distance").alias("avg_distance"),
        )
        .orderBy("hour")
    )


def rds_weekend(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    label = F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday")
    return (
        _by_time(fact, dim_time, "total_amount", "trip_distance", "tip_amount")
        .groupBy(label.alias("day_type"))
        .agg(
            rows_total().alias("trip_count"),
            _rounded("total_amount").alias("avg_fare"),
            _rounded("trip_distance").alias("avg_distance"),
            _rounded("tip_amount").alias("avg_tip"),
        )
    )


def rds_weekend_routes(summary: DataFrame, k: int = 10) -> DataFrame:
    return (
        summary.where("is_weekend")
        .groupBy("pickup_zone", "dropoff_zone")
        .agg(F.avg(F.col("total_amount").cast("double")).alias("avg_fare"))
        .orderBy(F.desc(F.round("avg_fare", 6)), "pickup_zone", "dropoff_zone")
        .limit(k)
    )


# -- exploratory questions to raw trips ----------------------------------------------


def w1_daily_counts(trips: DataFrame) -> DataFrame:
    return (
        trips.groupBy(F.to_date(PICKUP).alias("trip_date"))
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.avg("trip_distance").alias("avg_distance"),
            F.avg("fare_amount").alias("avg_fare"),
        )
        .orderBy("trip_date")
    )


def w1_payment(trips: DataFrame) -> DataFrame:
    return trips.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("count"), F.avg("total_amount").alias("avg_amount")
    )


def w1_hours(trips: DataFrame) -> DataFrame:
    return (
        trips.groupBy(F.hour(PICKUP).alias("hour"))
        .agg(F.count(F.lit(1)).alias("trip_count"))
        .orderBy("hour")
    )


def w1_daily_summary(trips: DataFrame, days: int = 7) -> DataFrame:
    """The newest ``days`` days."""
    return (
        trips.groupBy(F.to_date(PICKUP).alias("trip_date"))
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            F.sum("fare_amount").alias("total_revenue"),
            F.avg("trip_distance").alias("avg_distance"),
            F.avg("passenger_count").alias("avg_passengers"),
        )
        .orderBy(F.desc("trip_date"))
        .limit(days)
    )


def w1_daily_trip_size(trips: DataFrame) -> DataFrame:
    return (
        trips.dropna(subset=[PICKUP])
        .groupBy(F.to_date(PICKUP).alias("pickup_date"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .orderBy("pickup_date")
    )


def w1_fare_distance_corr(trips: DataFrame) -> DataFrame:
    return trips.agg(F.corr("trip_distance", "fare_amount").alias("correlation"))


def catalog_month_agg(zone: DataFrame, year: int, month: int) -> DataFrame:
    """One month of a zone partitioned by year and month; only its folder is read."""
    return (
        zone.where((F.col("year") == year) & (F.col("month") == month))
        .groupBy("year", "month")
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.avg("trip_distance").alias("avg_distance"),
            F.avg("fare_amount").alias("avg_fare"),
        )
    )


def demo_daily(curated: DataFrame, start: str, end: str, limit: int = 10) -> DataFrame:
    kept = curated.where(
        (F.col("pickup_datetime") >= F.lit(start).cast("timestamp_ntz"))
        & (F.col("pickup_datetime") < F.lit(end).cast("timestamp_ntz"))
    ).withColumn("trip_date", F.date_trunc("day", "pickup_datetime").cast("timestamp_ntz"))
    day, measures = ["trip_date"], {"total": F.col("total_amount"), "distance": F.col("trip_distance")}
    parts = range_parts(kept, day, "fare_amount", measures)
    days = parts.groupBy(*day).agg(
        rows_total().alias("daily_trips"), sum_of("total").alias("daily_revenue"), mean_of("distance").alias("avg_distance")
    )
    days = days.orderBy("trip_date").limit(limit)
    return add_percentiles(days, parts, kept, day, "fare_amount", {"median_fare": 0.5})
