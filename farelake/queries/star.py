"""Star-schema builders and the questions to them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import star as s
from ..operators.cleaning import raw_to_processed
from ..operators.curated import curated_trips
from ..operators.joins import checked_broadcast
from ..plans import star_queries as sq
from ..registry import query
from ..sources import given_tables as given

YEAR, MONTH = 1998, 3  # month of the single-month questions; the given trips span 1995-2001


def _trips(spark, sf_dir):
    return given.trips(spark, sf_dir)


def _fact1(spark, sf_dir):
    return s.build_fact_trips(_trips(spark, sf_dir))


def _fact2(spark, sf_dir):
    return s.build_fact_taxi_trips(raw_to_processed(_trips(spark, sf_dir)))


def _dim_time(spark, sf_dir):
    return s.build_dim_time(_trips(spark, sf_dir))


def _dim_location(spark, sf_dir):
    return s.build_dim_location(_trips(spark, sf_dir))


def _dim_date(spark, sf_dir):
    return s.build_dim_date(s.date_bounds(_trips(spark, sf_dir)))


def _clock(spark, sf_dir):
    return s.build_dim_time_of_day(spark)


query("missing_locations")(lambda spark, sf_dir: s.missing_locations(_trips(spark, sf_dir)))
query("build_dim_location")(_dim_location)
query("build_dim_time")(_dim_time)
query("build_fact_trips")(_fact1)
query("build_dim_date")(_dim_date)
query("build_fact_taxi_trips")(_fact2)
query("load_summary")(lambda spark, sf_dir: s.load_summary(_trips(spark, sf_dir)))


@query("build_dim_time_incremental")
def _get_or_insert(spark, sf_dir):
    """Two loads: the second adds only pickup times the first did not have."""
    trips = _trips(spark, sf_dir)
    first = s.build_dim_time(trips.where("VendorID = 1"))
    return s.build_dim_time(trips, first)


@query("fact_lookup")
def _lookup(spark, sf_dir):
    """Trips matched against the time dimension of all trips."""
    trips = _trips(spark, sf_dir)
    return s.fact_lookup(trips, s.build_dim_time(trips)).select("trip_ref", "time_id")


def _usage(dim, fact, dim_key, fact_key):
    """A fixed dimension with the number of facts that refer to each of its rows."""
    used = fact.groupBy(F.col(fact_key).alias(dim_key)).agg(F.count(F.lit(1)).alias("trips"))
    return dim.join(used, dim_key, "left").fillna(0, ["trips"])


query("build_dim_rate")(
    lambda spark, d: _usage(s.build_dim_rate(spark), _fact1(spark, d), "rate_code_id", "rate_code_id")
)
query("build_dim_rate_code")(
    lambda spark, d: _usage(s.build_dim_rate_code(spark), _fact2(spark, d), "rate_code_key", "rate_code_key")
)
query("build_dim_payment_type")(
    lambda spark, d: _usage(
        s.build_dim_payment_type(spark), _fact2(spark, d), "payment_type_key", "payment_type_key"
    )
)
query("build_dim_time_of_day")(
    lambda spark, d: _usage(_clock(spark, d), _fact2(spark, d), "time_key", "pickup_time_key")
)


def _summary(spark, sf_dir):
    return s.trip_summary(
        _fact1(spark, sf_dir),
        _dim_time(spark, sf_dir),
        checked_broadcast(_dim_location(spark, sf_dir)),
        checked_broadcast(s.build_dim_rate(spark)),
    )


query("trip_summary")(_summary)
query("constraint_check")(
    lambda spark, d: s.constraint_check(
        _fact1(spark, d), _dim_time(spark, d), _dim_location(spark, d), s.build_dim_rate(spark)
    )
)

query("aq01_daily_revenue")(
    lambda spark, d: sq.aq01_daily_revenue(_fact2(spark, d), _dim_date(spark, d), YEAR, MONTH)
)
query("aq02_peak_hours")(lambda spark, d: sq.aq02_peak_hours(_fact2(spark, d), _clock(spark, d)))
query("aq03_top_pickups")(lambda spark, d: sq.aq03_top_pickups(_fact2(spark, d), _dim_location(spark, d)))
query("aq04_payment")(
    lambda spark, d: sq.aq04_payment(_fact2(spark, d), s.build_dim_payment_type(spark))
)
query("aq05_weekend")(lambda spark, d: sq.aq05_weekend(_fact2(spark, d), _dim_date(spark, d)))
query("aq06_routes")(lambda spark, d: sq.aq06_routes(_fact2(spark, d), _dim_location(spark, d)))
query("aq07_rush_hour")(
    lambda spark, d: sq.aq07_rush_hour(_fact2(spark, d), _dim_date(spark, d), _clock(spark, d))
)
query("aq08_monthly")(lambda spark, d: sq.aq08_monthly(_fact2(spark, d), _dim_date(spark, d)))
query("aq09_quality_share")(lambda spark, d: sq.aq09_quality_share(_fact2(spark, d)))
query("aq10_speed_by_tod")(lambda spark, d: sq.aq10_speed_by_tod(_fact2(spark, d), _clock(spark, d)))

query("rds_top_pickups")(
    lambda spark, d: sq.rds_top_pickups(_fact1(spark, d), _dim_location(spark, d), k=10)
)
query("rds_hourly")(lambda spark, d: sq.rds_hourly(_fact1(spark, d), _dim_time(spark, d)))
query("rds_weekend")(lambda spark, d: sq.rds_weekend(_fact1(spark, d), _dim_time(spark, d)))
query("rds_weekend_routes")(lambda spark, d: sq.rds_weekend_routes(_summary(spark, d)))

for _f in (
    sq.w1_daily_counts,
    sq.w1_payment,
    sq.w1_hours,
    sq.w1_daily_summary,
    sq.w1_daily_trip_size,
    sq.w1_fare_distance_corr,
):
    query(_f.__name__)(lambda spark, d, f=_f: f(_trips(spark, d)))


@query("demo_daily")
def _demo(spark, sf_dir):
    return sq.demo_daily(curated_trips(_trips(spark, sf_dir)), "1998-03-01", "1998-04-01")
