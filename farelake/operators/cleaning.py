"""Filters, derived columns and the cleaners of the raw, processed and exploration paths.

Every cleaner keeps its own bounds: they differ on purpose (see README, 'Semantics').
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"

# Job label, zero-filled columns, columns that must not be negative.
JOB_LABEL = "job-process-taxi-data"
ZERO_FILLED = (
    "passenger_count",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
)
NON_NEGATIVE = ("trip_distance", "fare_amount", "total_amount", "passenger_count")


def drop_null_critical(trips: DataFrame, cols: tuple[str, ...] = (PICKUP, DROPOFF)) -> DataFrame:
    return trips.dropna(subset=[c for c in cols if c in trips.columns])


def _basic_condition() -> Column:
    return (
        (F.col("trip_distance") > 0)
        & (F.col("fare_amount") > 0)
        & (F.col("passenger_count") > 0)
        & (F.col(DROPOFF) > F.col(PICKUP))
    )


def filter_basic(trips: DataFrame) -> DataFrame:
    return trips.where(_basic_condition())


def filter_removed_report(trips: DataFrame, condition: Column | None = None) -> DataFrame:
    """Rows before, kept and removed by a filter, counted in one pass."""
    keep = F.coalesce(condition if condition is not None else _basic_condition(), F.lit(False))
    counts = trips.agg(
        F.count(F.lit(1)).alias("records_before"), F.count_if(keep).alias("records_after")
    )
    removed = F.col("records_before") - F.col("records_after")
    return counts.withColumns(
        {
            "records_removed": removed,
            "removed_pct": F.coalesce(
                F.try_divide(removed * 100.0, F.col("records_before")), F.lit(0.0)
            ),
        }
    )


def derive_etl(trips: DataFrame) -> DataFrame:
    """Duration, tip percentage, partition columns and processing metadata of the zone ETL."""
    return trips.withColumns(etl_columns())


def etl_columns() -> dict[str, Column]:
    return {
        "trip_duration_minutes": fn.minutes_between(PICKUP, DROPOFF, whole_seconds=True),
        "tip_percentage": fn.tip_percentage(),
        "quality_check_timestamp": F.current_timestamp(),
        "year": F.year(PICKUP),
        "month": F.month(PICKUP),
        "processed_at": F.current_timestamp(),
        "etl_job_name": F.lit(JOB_LABEL),
    }


def raw_to_processed(trips: DataFrame) -> DataFrame:
    """Raw trips to processed trips: bounds, derived columns, outlier filters, quality flag."""
    sane = (
        drop_null_critical(trips)
        .where(_basic_condition())
        .where((F.col("passenger_count") <= 6) & (F.col("trip_distance") < 100))
        .where(F.col("fare_amount") < 500)
    )
    timed = sane.withColumn(
        "trip_duration_minutes", fn.minutes_between(PICKUP, DROPOFF, whole_seconds=True)
    ).where(F.col("trip_duration_minutes").between(1, 300))
    return (
        timed.withColumn("avg_speed_mph", fn.speed_mph("trip_distance", "trip_duration_minutes"))
        .where(F.col("avg_speed_mph") < 100)
        .withColumns(
            {
                "pickup_hour": F.hour(PICKUP),
                "pickup_day_of_week": F.dayofweek(PICKUP),
                "year": F.year(PICKUP),
                "month": F.month(PICKUP),
                "quality_flag": fn.quality_flag(),
                "processed_timestamp": F.current_timestamp(),
            }
        )
    )


def processed_sample_stats(processed: DataFrame) -> DataFrame:
    return processed.agg(
        F.avg("trip_distance").alias("avg_trip_distance"),
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("trip_duration_minutes").alias("avg_duration"),
        F.count(F.lit(1)).alias("total_records"),
    )


def clean_ingest(trips: DataFrame) -> DataFrame:
    """First-week cleaner: open duration bounds (1, 300)."""
    return (
        drop_null_critical(trips)
        .where(_basic_condition())
        .where(
            (F.col("trip_distance") < 100)
            & (F.col("fare_amount") < 500)
            & (F.col("passenger_count") <= 6)
        )
        .withColumn("trip_duration_minutes", fn.minutes_between(PICKUP, DROPOFF))
        .where((F.col("trip_duration_minutes") > 1) & (F.col("trip_duration_minutes") < 300))
    )


def clean_missing(trips: DataFrame) -> DataFrame:
    """Drop rows without times or zones, fill seven amounts with 0."""
    kept = drop_null_critical(trips, (PICKUP, DROPOFF, "PULocationID", "DOLocationID"))
    return kept.fillna(0, subset=[c for c in ZERO_FILLED if c in trips.columns])


def clean_calculated(clean: DataFrame) -> DataFrame:
    """Derived columns of the exploration path; drops impossible durations and speeds."""
    return (
        clean.withColumn("trip_duration", fn.minutes_between(PICKUP, DROPOFF))
        .where(~((F.col("trip_duration") <= 0) | (F.col("trip_duration") > 1440)))
        .withColumns(
            {
                "tip_percentage": fn.tip_percentage(cap=100),
                "avg_speed_mph": fn.speed_mph_per_minute("trip_distance", "trip_duration"),
            }
        )
        .where(~F.coalesce(F.col("avg_speed_mph") > 100, F.lit(False)))
        .withColumns(
            {
                "pickup_hour": F.hour(PICKUP),
                "pickup_day_of_week": fn.weekday_from_monday(PICKUP),
                "pickup_date": F.to_date(PICKUP),
                "cost_per_mile": fn.cost_per_mile(),
            }
        )
    )


def _rows(one_row: DataFrame, names: list[str], key: str, value: str) -> DataFrame:
    """A one-row aggregate turned into (name, value) rows."""
    pairs = F.array(*[F.struct(F.lit(n).alias(key), F.col(n).alias(value)) for n in names])
    return one_row.select(F.inline(pairs))


def cleaning_issues(trips: DataFrame) -> DataFrame:
    """Counts of suspicious values; only issues that occur are reported."""
    checks = {f"negative {c}": F.col(c) < 0 for c in NON_NEGATIVE if c in trips.columns}
    if "passenger_count" in trips.columns:
        checks["0 passengers"] = F.col("passenger_count") == 0
    if "trip_distance" in trips.columns:
        checks["over 100 miles"] = F.col("trip_distance") > 100
    counts = trips.agg(*[F.count_if(cond).alias(name) for name, cond in checks.items()])
    return _rows(counts, list(checks), "issue", "n").where(F.col("n") > 0)


def cleaning_summary(trips: DataFrame) -> DataFrame:
    """Rows and missing cells before and after ``clean_missing``, in one pass over the input."""
    critical = [c for c in (PICKUP, DROPOFF, "PULocationID", "DOLocationID") if c in trips.columns]
    kept = reduce(lambda a, c: a & F.col(c).isNotNull(), critical, F.lit(True))

    def holes(cols) -> Column:
        return reduce(lambda a, c: a + F.col(c).isNull().cast("long"), cols, F.lit(0).cast("long"))

    unfilled = [c for c in trips.columns if c not in ZERO_FILLED and c not in critical]
    counts = trips.agg(
        F.count(F.lit(1)).alias("initial_rows"),
        F.count_if(kept).alias("final_rows"),
        F.coalesce(F.sum(holes(trips.columns)), F.lit(0)).alias("missing_before"),
        F.coalesce(F.sum(F.when(kept, holes(unfilled))), F.lit(0)).alias("missing_after"),
    )
    return counts.select(
        "initial_rows",
        (F.col("initial_rows") - F.col("final_rows")).alias("rows_removed"),
        "final_rows",
        "missing_before",
        "missing_after",
    )


def filter_date_range(
    trips: DataFrame,
    start=None,
    end=None,
    col: str = PICKUP,
    inclusive_end: bool = False,
    last_days: int | None = None,
    as_of=None,
) -> DataFrame:
    """Rows in [start, end) or [start, end]; or the last ``last_days`` days before ``as_of``."""
    out = trips
    if last_days is not None:
        day = F.current_date() if as_of is None else F.lit(as_of).cast("date")
        out = out.where(F.col(col) >= F.date_sub(day, last_days))
    if start is not None:
        out = out.where(F.col(col) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        stop = F.lit(end).cast("timestamp_ntz")
        out = out.where(F.col(col) <= stop if inclusive_end else F.col(col) < stop)
    return out
