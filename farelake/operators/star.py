"""Builders of both star schemas.

Keys are derived from values (timestamp, date, clock time, trip reference), so they are
the same in every run and need neither a global sort nor a look-up of the highest key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from .cleaning import DROPOFF, PICKUP
from .seeds import LOCATIONS, RATE_CODES

MONEY = "decimal(10,2)"


def numeric(value: Column) -> Column:
    """NUMERIC(10,2) of a double, rounding half up as on decimals; too large a value is an error."""
    return fn.round_half_up(value, 2).cast(MONEY)


# -- schema with one row per pickup time ---------------------------------------------


def seed_locations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        LOCATIONS, "location_id int, borough string, zone string, service_zone string"
    )


def build_dim_rate(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        RATE_CODES, "rate_code_id int, rate_code_name string, description string"
    )


def missing_locations(trips: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Zone ids that occur in trips but not in the dimension; one pass, distinct map-side."""
    dim = seed_locations(trips.sparkSession) if dim is None else dim
    ids = (
        trips.select(F.explode(F.array("PULocationID", "DOLocationID")).alias("location_id"))
        .dropna()
        .distinct()
    )
    return ids.join(dim.select("location_id"), "location_id", "left_anti")


def unknown_locations(ids: DataFrame) -> DataFrame:
    """Placeholders for zone ids that are not known."""
    return ids.select(
        "location_id",
        F.lit("Unknown").alias("borough"),
        F.concat(F.lit("Location "), F.col("location_id")).alias("zone"),
        F.lit("Unknown").alias("service_zone"),
    )


def build_dim_location(trips: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Known zones plus a placeholder for every id not seen before (insert if absent)."""
    dim = seed_locations(trips.sparkSession) if dim is None else dim
    return dim.unionByName(unknown_locations(missing_locations(trips, dim)))


def time_id(ts: str | Column) -> Column:
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def pickup_month() -> Column:
    """Month of a fact's ``time_id`` as yyyymm."""
    return F.date_format(F.timestamp_micros("time_id"), "yyyyMM").cast("int")


def pickup_times(trips: DataFrame) -> DataFrame:
    """The distinct pickup times."""
    return trips.select(F.col(PICKUP).alias("pickup_datetime")).dropna().distinct()


def time_attributes(times: DataFrame) -> DataFrame:
    """Rows of the time dimension for distinct pickup times."""
    ts = F.col("pickup_datetime")
    return times.select(
        time_id(ts).alias("time_id"),
        "pickup_datetime",
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        F.hour(ts).alias("hour"),
        F.weekday(ts).alias("weekday"),
        (F.weekday(ts) >= 5).alias("is_weekend"),
        F.quarter(ts).alias("quarter"),
        F.dayofyear(ts).alias("day_of_year"),
        F.weekofyear(ts).alias("week_of_year"),
    )


def build_dim_time(trips: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """One row per distinct pickup time; with ``dim`` only new times are added to it."""
    times = pickup_times(trips)
    if dim is not None:
        times = times.join(dim.select("pickup_datetime"), "pickup_datetime", "left_anti")
    added = time_attributes(times)
    return added if dim is None else dim.unionByName(added)


def fact_lookup(trips: DataFrame, dim_time: DataFrame) -> DataFrame:
    """``time_id`` by pickup time from a dimension; trips without a match are dropped."""
    known = dim_time.select(F.col("pickup_datetime").alias(PICKUP), "time_id")
    return trips.join(known, PICKUP)


def _or(column: str, default) -> Column:
    return F.coalesce(F.col(column), F.lit(default))


def loadable(trips: DataFrame) -> DataFrame:
    """Trips that can become facts: both zones known."""
    return trips.dropna(subset=["PULocationID", "DOLocationID"])


def build_fact_trips(trips: DataFrame, dim_time: DataFrame | None = None) -> DataFrame:
    """Facts with defaults for missing values and NUMERIC(10,2) measures.

    Without ``dim_time`` the time key is computed instead of looked up: a dimension built or
    extended from the same trips holds every pickup time, so the join could not drop a row.
    """
    if dim_time is None:
        keyed = trips.dropna(subset=[PICKUP]).withColumn("time_id", time_id(PICKUP))
    else:
        keyed = fact_lookup(trips, dim_time)
    rate = _or("RatecodeID", 1).cast("int")
    minutes = fn.minutes_between(PICKUP, DROPOFF)
    if "trip_duration" in trips.columns:
        minutes = F.coalesce("trip_duration", minutes)
    # Measures of the fact.
    money = (
        "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "congestion_surcharge",
        "total_amount",
    )
    return loadable(keyed).select(
        F.col("trip_ref").alias("trip_id"),
        "time_id",
        F.col("PULocationID").cast("int").alias("pickup_location_id"),
        F.col("DOLocationID").cast("int").alias("dropoff_location_id"),
        F.when(rate.between(1, 6), rate).otherwise(1).alias("rate_code_id"),
        _or("passenger_count", 1).cast("int").alias("passenger_count"),
        numeric(_or("trip_distance", 0.0)).alias("trip_distance"),
        numeric(minutes).alias("trip_duration"),
        *[numeric(_or(c, 0.0)).alias(c) for c in money],
        _or("payment_type", 1).cast("int").alias("payment_type"),
    )


def load_summary(trips: DataFrame) -> DataFrame:
    """Source rows, rows per table a load adds to the seeds, and rows that cannot be loaded."""
    both = F.col("PULocationID").isNotNull() & F.col("DOLocationID").isNotNull()
    timed = F.col(PICKUP).isNotNull()
    counts = trips.agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count_distinct(PICKUP).alias("dim_time"),
        F.count_if(both & timed).alias("fact_trips"),
    )
    added = missing_locations(trips).agg(F.count(F.lit(1))).scalar()
    return counts.withColumns(
        {"dim_location": added, "skipped": F.col("source_rows") - F.col("fact_trips")}
    )


def trip_summary(
    fact: DataFrame, dim_time: DataFrame, dim_location: DataFrame, dim_rate: DataFrame
) -> DataFrame:
    """Facts with all dimension texts. Small dimensions should come in ``checked_broadcast``;

    the time dimension grows with the data and is joined by shuffle on its key.
    """
    return (
        fact.join(dim_time, "time_id")
        .join(
            dim_location.select(
                F.col("location_id").alias("pickup_location_id"),
                F.col("borough").alias("pickup_borough"),
                F.col("zone").alias("pickup_zone"),
            ),
            "pickup_location_id",
        )
        .join(
            dim_location.select(
                F.col("location_id").alias("dropoff_location_id"),
                F.col("borough").alias("dropoff_borough"),
                F.col("zone").alias("dropoff_zone"),
            ),
            "dropoff_location_id",
        )
        .join(dim_rate.select("rate_code_id", "rate_code_name"), "rate_code_id")
        .select(
            "trip_id",
            "pickup_datetime",
            "year",
            "month",
            "day",
            "hour",
            "weekday",
            "is_weekend",
            "pickup_borough",
            "pickup_zone",
            "dropoff_borough",
            "dropoff_zone",
            "rate_code_name",
            "passenger_count",
            "trip_distance",
            "trip_duration",
            "fare_amount",
            "tip_amount",
            "total_amount",
            "payment_type",
        )
    )


def constraint_check(
    fact: DataFrame, dim_time: DataFrame, dim_location: DataFrame, dim_rate: DataFrame
) -> DataFrame:
    """Violations per declared constraint: value checks, missing keys, foreign keys, uniqueness.

    One scan of the facts for the values and one for the foreign keys, which are checked on counts per key of all four
    references together: a hot key costs one row per task.
    """
    checked = ("passenger_count", "trip_distance", "trip_duration", "fare_amount", "total_amount")
    references = {
        "time_id": (dim_time, "time_id"),
        "pickup_location_id": (dim_location, "location_id"),
        "dropoff_location_id": (dim_location, "location_id"),
        "rate_code_id": (dim_rate, "rate_code_id"),
    }

    def rows(one_row: DataFrame) -> DataFrame:
        pairs = [F.struct(F.lit(n).alias("constraint"), F.col(n).alias("violations")) for n in one_row.columns]
        return one_row.select(F.inline(F.array(*pairs)))

    values = fact.agg(
        *[F.count_if(F.col(c) < 0).alias(f"chk_{c}") for c in checked],
        *[F.count_if(F.col(c).isNull()).alias(f"not_null_{c}") for c in references],
    )

    number = {n: i for i, n in enumerate(references)}

    def keys(frame: DataFrame, names: dict[str, str]) -> DataFrame:
        """(number of the reference, key) of every row, one per entry of ``names``."""
        items = [F.struct(F.lit(number[n]).alias("reference"), F.col(c).cast("long").alias("key")) for n, c in names.items()]
        return frame.select(F.inline(F.array(*items))).where("key IS NOT NULL")

    used = keys(fact, {n: n for n in references}).groupBy("reference", "key").agg(F.count(F.lit(1)).alias("n"))
    known = [
        keys(dim, {n: c for n, (d, c) in references.items() if d is dim}) for dim in (dim_time, dim_location, dim_rate)
    ]
    known = known[0].unionByName(known[1]).unionByName(known[2])
    orphans = used.join(known, ["reference", "key"], "left_anti").agg(
        *[F.coalesce(F.sum(F.when(F.col("reference") == number[n], F.col("n"))), F.lit(0)).alias(f"fk_{n}") for n in references]
    )
    repeated = dim_time.groupBy("pickup_datetime").agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("unique_pickup_datetime")
    )
    return rows(values).unionByName(rows(orphans)).unionByName(rows(repeated))


# -- schema with calendar and clock dimensions ---------------------------------------


def date_bounds(trips: DataFrame) -> DataFrame:
    """First and last calendar day of the trips, one row (start, end)."""
    return trips.agg(
        F.to_date(F.least(F.min(PICKUP), F.min(DROPOFF))).alias("start"),
        F.to_date(F.greatest(F.max(PICKUP), F.max(DROPOFF))).alias("end"),
    )


def build_dim_date(bounds: DataFrame, holidays: tuple[dt.date, ...] = ()) -> DataFrame:
    """Calendar from ``start`` to ``end``; ``bounds`` is a one-row frame, see ``date_bounds``."""
    d = F.col("full_date")
    dow = fn.day_of_week(d)
    return bounds.select(F.explode(F.sequence("start", "end")).alias("full_date")).select(
        fn.calendar_key(d).alias("date_key"),
        "full_date",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"),
        (d.isin(*holidays) if holidays else F.lit(False)).alias("is_holiday"),
    )


def calendar(spark: SparkSession, start: dt.date, end: dt.date, holidays=()) -> DataFrame:
    return build_dim_date(spark.createDataFrame([(start, end)], "start date, end date"), holidays)


def build_dim_time_of_day(spark: SparkSession) -> DataFrame:
    minute = F.col("id")
    hour = F.floor(minute / 60).cast("int")
    return spark.range(1440).select(
        (hour * 100 + (minute % 60).cast("int")).alias("time_key"),
        hour.alias("hour"),
        (minute % 60).cast("int").alias("minute"),
        fn.part_of_day(hour).alias("time_of_day"),
        fn.is_rush_hour(hour).alias("is_rush_hour"),
    )


def build_dim_payment_type(spark: SparkSession) -> DataFrame:
    rows = [(code, code, name) for code, name in fn.PAYMENT_NAMES.items()]
    return spark.createDataFrame(
        rows, "payment_type_key int, payment_type_id int, payment_type_name string"
    )


def build_dim_rate_code(spark: SparkSession) -> DataFrame:
    rows = [(code, code, name, text) for code, name, text in RATE_CODES]
    return spark.createDataFrame(
        rows,
        "rate_code_key int, rate_code_id int, rate_code_name string, rate_code_description string",
    )


def build_fact_taxi_trips(processed: DataFrame) -> DataFrame:
    """Facts with calendar and clock keys for both ends; keys are formulas, so no join is needed."""
    # Measures of the fact.
    money = (
        "trip_distance", "trip_duration_minutes", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
        "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee", "avg_speed_mph",
    )
    return processed.select(
        F.col("trip_ref").alias("trip_key"),
        fn.calendar_key(PICKUP).alias("pickup_date_key"),
        fn.clock_key(PICKUP).alias("pickup_time_key"),
        fn.calendar_key(DROPOFF).alias("dropoff_date_key"),
        fn.clock_key(DROPOFF).alias("dropoff_time_key"),
        F.col("PULocationID").cast("int").alias("pickup_location_key"),
        F.col("DOLocationID").cast("int").alias("dropoff_location_key"),
        F.col("payment_type").cast("int").alias("payment_type_key"),
        F.col("RatecodeID").cast("int").alias("rate_code_key"),
        F.col("VendorID").cast("int").alias("vendor_id"),
        F.col("passenger_count").cast("int").alias("passenger_count"),
        *[numeric(F.col(c)).alias(c) for c in money],
        "quality_flag",
    )


def lay_out_fact(fact: DataFrame) -> DataFrame:
    """Cluster by pickup zone and sort by time for the write.

    Rebalancing instead of a plain hash repartition lets adaptive execution split a zone
    that holds a large share of all trips over several files.
    """
    return fact.hint("rebalance", "pickup_location_key").sortWithinPartitions(
        "pickup_location_key", "pickup_date_key", "pickup_time_key"
    )
