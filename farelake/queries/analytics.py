"""Views and analysis queries."""

from __future__ import annotations

import datetime as dt

from ..operators.curated import curated_trips
from ..plans import analysis as an
from ..plans import views as v
from ..registry import query
from ..sources import given_tables as given

AS_OF = dt.date(2001, 11, 4)  # newest pickup day of the given trips


def curated(spark, sf_dir):
    return curated_trips(given.trips(spark, sf_dir))


query("curated_trips")(curated)

for _view in (v.v_daily_revenue, v.v_hourly_trips, v.v_payment_analysis, v.v_location_performance):
    query(_view.__name__)(lambda spark, sf_dir, f=_view: f(curated(spark, sf_dir)))

_INPUT = {
    v.daily_revenue: (an.q1_1_monthly_revenue, an.q1_2_yoy),
    v.location_performance: (an.q2_1_top_routes, an.q2_2_profitable_routes, an.q2_3_short_frequent),
    v.v_hourly_trips: (
        an.q2_4_rank_in_period,
        an.q3_1_hourly_demand,
        an.q3_2_rush_compare,
        an.q3_3_peak_offpeak,
        an.q3_4_late_night,
    ),
    v.v_payment_analysis: (an.q4_1_tip_by_payment,),
}
for _base, _asked in _INPUT.items():
    for _f in _asked:
        query(_f.__name__)(lambda spark, sf_dir, b=_base, f=_f: f(b(curated(spark, sf_dir))))

for _f in (an.q1_3_revenue_by_dow, an.q1_4_top_days):
    query(_f.__name__)(
        lambda spark, sf_dir, f=_f: f(v.daily_revenue(curated(spark, sf_dir)), as_of=AS_OF)
    )

for _f in (
    an.q4_2_fare_buckets,
    an.q4_3_tip_buckets,
    an.q4_4_tip_by_time,
    an.qb2_passengers,
    an.qb3_distance_buckets,
):
    query(_f.__name__)(lambda spark, sf_dir, f=_f: f(curated(spark, sf_dir)))


@query("weather_join")
def _weather(spark, sf_dir):
    return an.weather_join(curated(spark, sf_dir), given.weather(spark, sf_dir))
