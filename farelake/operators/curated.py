"""Curated datasets built from processed trips."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cleaning import PICKUP

# The snake_case names of the curated trip table.
CURATED_NAMES = {
    "vendor_id": "VendorID",
    "pickup_datetime": "tpep_pickup_datetime",
    "dropoff_datetime": "tpep_dropoff_datetime",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "rate_code_id": "RatecodeID",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "pickup_location_id": "PULocationID",
    "dropoff_location_id": "DOLocationID",
    "payment_type": "payment_type",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount",
    "congestion_surcharge": "congestion_surcharge",
    "airport_fee": "airport_fee",
}
FACT_COLUMNS = (
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "payment_type",
    "trip_duration_minutes",
    "avg_speed_mph",
    "pickup_hour",
    "pickup_day_of_week",
    "quality_flag",
    "year",
    "month",
)


def curated_trips(trips: DataFrame) -> DataFrame:
    """Bridge from lake names to the names the views use."""
    return trips.select(*[F.col(old).alias(new) for new, old in CURATED_NAMES.items()])


def fact_projection(processed: DataFrame) -> DataFrame:
    return processed.select(
        F.col(PICKUP).alias("pickup_datetime"),
        F.col("tpep_dropoff_datetime").alias("dropoff_datetime"),
        *FACT_COLUMNS,
    )


def _trips():
    return F.count(F.lit(1)).alias("total_trips")


def daily_statistics(processed: DataFrame) -> DataFrame:
    return processed.groupBy(F.to_date(PICKUP).alias("date"), "year", "month").agg(
        _trips(),
        F.sum("fare_amount").alias("total_revenue"),
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("trip_duration_minutes").alias("avg_duration"),
        F.sum("passenger_count").alias("total_passengers"),
        F.avg("passenger_count").alias("avg_passengers_per_trip"),
        F.count_distinct("VendorID").alias("active_vendors"),
    )


def hourly_patterns(processed: DataFrame) -> DataFrame:
    return (
        processed.groupBy("pickup_hour")
        .agg(
            _trips(),
            F.avg("fare_amount").alias("avg_fare"),
            F.avg("trip_distance").alias("avg_distance"),
            F.avg("trip_duration_minutes").alias("avg_duration"),
            F.avg("passenger_count").alias("avg_passengers"),
        )
        .orderBy("pickup_hour")
    )


def day_of_week_patterns(processed: DataFrame) -> DataFrame:
    return (
        processed.groupBy("pickup_day_of_week")
        .agg(
            _trips(),
            F.avg("fare_amount").alias("avg_fare"),
            F.avg("trip_distance").alias("avg_distance"),
            F.avg("trip_duration_minutes").alias("avg_duration"),
        )
        .orderBy("pickup_day_of_week")
    )


def payment_analysis_daily(processed: DataFrame) -> DataFrame:
    return processed.groupBy("payment_type", F.to_date(PICKUP).alias("date")).agg(
        _trips(),
        F.sum("fare_amount").alias("total_revenue"),
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("tip_amount").alias("avg_tip"),
    )


def location_top100(processed: DataFrame, k: int = 100) -> DataFrame:
    return (
        processed.groupBy("PULocationID")
        .agg(
            F.count(F.lit(1)).alias("total_pickups"),
            F.avg("fare_amount").alias("avg_fare_from_location"),
            F.avg("trip_distance").alias("avg_distance_from_location"),
        )
        .orderBy(F.desc("total_pickups"), "PULocationID")
        .limit(k)
    )


CURATED_DATASETS = {
    "daily_statistics": (daily_statistics, ("year", "month")),
    "hourly_patterns": (hourly_patterns, ()),
    "day_of_week_patterns": (day_of_week_patterns, ()),
    "payment_analysis": (payment_analysis_daily, ()),
    "location_analysis": (location_top100, ()),
    "fact_taxi_trips": (fact_projection, ("year", "month")),
}


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def curated_summary(processed: DataFrame) -> DataFrame:
    return table_counts({name: build(processed) for name, (build, _) in CURATED_DATASETS.items()})
