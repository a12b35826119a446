"""Profiles, samples, log questions, metric alarms and file events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import file_events as fe
from ..operators import log_analytics as lg
from ..operators import metric_alarms as ma
from ..operators import profiling as pf
from ..operators import sampling as sm
from ..registry import query
from ..sources import given_tables as given
from ..streaming.windows import windowed_counts

_trips = given.trips

for _f in (
    pf.profile_schema,
    pf.missing_summary,
    pf.profile_numeric,
    pf.profile_categorical,
    pf.profile_datetime,
    pf.sample_statistics,
):
    query(_f.__name__)(lambda spark, d, f=_f: f(_trips(spark, d)))


query("duplicate_rows")(lambda spark, d: pf.duplicate_rows(_trips(spark, d)))


@query("duplicate_rows_columns")
def _duplicates(spark, sf_dir):
    """Whole rows never repeat in the given trips; these columns do."""
    columns = ("VendorID", "PULocationID", "DOLocationID", "payment_type", "tolls_amount")
    return pf.duplicate_rows(_trips(spark, sf_dir).select(*columns))


query("sample_random")(lambda spark, d: sm.sample_random(_trips(spark, d), 1000))
query("sample_stratified")(
    lambda spark, d: sm.sample_stratified(_trips(spark, d), 1003, "PULocationID")
)
query("sample_time_range")(
    lambda spark, d: sm.sample_time_range(_trips(spark, d), 500, "1998-01-01", "1998-12-31")
)


@query("sample_validation")
def _validation(spark, sf_dir):
    trips = _trips(spark, sf_dir)
    return sm.sample_validation(trips, sm.sample_random(trips, 1000))


# Questions about the most frequent or newest rows, with the k that their reports show.
for _f, _k in ((lg.log_failed_records, 20), (lg.log_error_patterns, 10), (lg.log_errors_detailed, 50), (lg.log_job_failures, 20)):
    query(_f.__name__)(lambda spark, d, f=_f, k=_k: f(given.logs(spark, d), k=k))
    query(f"{_f.__name__}_all")(lambda spark, d, f=_f: f(given.logs(spark, d)))

for _f in (
    lg.log_processing_time,
    lg.log_performance,
    lg.log_job_metrics,
    lg.log_upload_tracking,
    lg.log_quality_issues,
    lg.log_executions,
    lg.log_underutilized,
    lg.log_hourly_activity,
    lg.log_job_states,
):
    query(_f.__name__)(lambda spark, d, f=_f: f(given.logs(spark, d)))

query("log_query")(
    lambda spark, d: lg.log_query(given.logs(spark, d), "2024-01-05", "2024-01-20", lg.HANDLERS)
)
query("metric_rollup")(lambda spark, d: ma.metric_rollup(given.metrics(spark, d), "Average", 300))
query("metric_rollup_sum_hourly")(lambda spark, d: ma.metric_rollup(given.metrics(spark, d), "Sum", 3600))

# The shapes of the fixed alarm rules, with metrics and thresholds that occur in the given events.
GIVEN_RULES = (
    ma.AlarmRule("errors", "error", "Sum", 3600, ">=", 100.0),
    ma.AlarmRule("clicks-stale", "click", "Maximum", 3600, ">", 60.0, 1, "breaching"),
    ma.AlarmRule("daily-purchases", "purchase", "Maximum", 86400, ">", 60.0),
    ma.AlarmRule("slow-views", "view", "Maximum", 21600, ">", 25.0, 2),
    ma.AlarmRule("signup-average", "signup", "Average", 86400, ">", 20.0, 3),
)
query("metric_alarms")(lambda spark, d: ma.metric_alarms(given.metrics(spark, d), GIVEN_RULES))
query("data_freshness")(
    lambda spark, d: ma.data_freshness(_trips(spark, d), "tpep_pickup_datetime", "2001-11-06 06:00:00")
)

query("file_events")(lambda spark, d: fe.file_events(given.notifications(spark, d)))
query("route_events")(
    lambda spark, d: fe.route_events(given.file_events(spark, d)).select(
        "event_id", "reject_reason", "size_mb"
    )
)


@query("dedup_executions")
def _dedup(spark, sf_dir):
    """Every notification arrives twice, and a second file of the same base name in another folder with it."""
    files = given.file_events(spark, sf_dir)
    other = files.withColumn("key", F.replace("key", F.lit("raw/taxi/"), F.lit("raw/taxi/other/")))
    return fe.dedup_executions(files.unionByName(files).unionByName(other))


query("windowed_counts")(lambda spark, d: windowed_counts(given.table(spark, d, "events"), "5 minutes"))
query("windowed_counts_hourly")(lambda spark, d: windowed_counts(given.table(spark, d, "events"), "1 hour"))
