"""Cleaners, data-quality operators and curated datasets."""

from __future__ import annotations

from ..operators import cleaning as c
from ..operators import curated as cu
from ..operators import quality as q
from ..operators.rulesets import ruleset_eval
from ..registry import query
from ..sources import given_tables as given

CLOCK = ("quality_check_timestamp", "processed_at", "processed_timestamp", "failed_at")


def _trips(spark, sf_dir):
    return given.trips(spark, sf_dir)


def _derived(spark, sf_dir):
    return c.derive_etl(_trips(spark, sf_dir))


def _processed(spark, sf_dir):
    return c.raw_to_processed(_trips(spark, sf_dir)).drop(*CLOCK)


def _on(source, name, f):
    query(name)(lambda spark, sf_dir: f(source(spark, sf_dir)))


for _f in (
    c.drop_null_critical,
    c.filter_basic,
    c.filter_removed_report,
    c.clean_ingest,
    c.clean_missing,
    c.cleaning_issues,
    c.cleaning_summary,
    q.dataset_gate,
    ruleset_eval,
):
    _on(_trips, _f.__name__, _f)

_on(_trips, "derive_etl", lambda t: c.derive_etl(t).drop(*CLOCK))
_on(_trips, "raw_to_processed", lambda t: c.raw_to_processed(t).drop(*CLOCK))
_on(_trips, "clean_calculated", lambda t: c.clean_calculated(c.clean_missing(t)))
_on(
    _trips,
    "filter_date_range",
    lambda t: c.filter_date_range(t, "1998-01-01", "1999-01-01").select("trip_ref", c.PICKUP),
)
_on(
    _trips,
    "filter_date_range_last_days",
    lambda t: c.filter_date_range(t, last_days=90, as_of="2001-11-04").select("trip_ref", c.PICKUP),
)
_on(_processed, "quality_flag", lambda p: p.select("trip_ref", "quality_flag"))

for _f in (
    c.processed_sample_stats,
    cu.fact_projection,
    cu.daily_statistics,
    cu.hourly_patterns,
    cu.day_of_week_patterns,
    cu.payment_analysis_daily,
    cu.location_top100,
    cu.curated_summary,
):
    _on(_processed, _f.__name__, _f)

# Single checks and whole rule sets: one tagged frame, NULL reason = valid.
_SINGLE = {
    "check_null_values": q.DQRules(required=q.FULL_RULES.required),
    "validate_numeric_ranges": q.DQRules(ranges=q.FULL_RULES.ranges),
    "validate_datetime_logic": q.DQRules(datetime_order=True),
    "validate_trip_duration": q.DQRules(duration=(1, 300)),
    "validate_tip_percentage": q.DQRules(tip_max=100),
    "run_all_checks": q.FULL_RULES,
}


def _tagged(rules, mode):
    return lambda d: q.tag(d, rules, mode).select("trip_ref", "failure_reason")


for _name, _rules in _SINGLE.items():
    _on(_derived, _name, _tagged(_rules, "complete"))
    _on(_derived, f"{_name}_strict", _tagged(_rules, "strict"))

for _name, _mode in (("etl_classify", "complete"), ("etl_classify_complete", "complete"), ("etl_classify_strict", "strict")):
    _on(_trips, _name, lambda t, m=_mode: q.etl_outcome(t, mode=m).select("trip_ref", "outcome"))

_on(_derived, "quality_metrics", lambda d: q.quality_metrics(q.tag(d)))
_on(_derived, "dq_summary", lambda d: q.dq_summary(q.tag(d)))


def _reject_sets(d):
    """Two checks in sequence; the second set lacks a column to exercise the union by name."""
    valid, nulls = q.check_null_values(d)
    _, ranges = q.validate_numeric_ranges(valid)
    return [nulls, ranges.drop("store_and_fwd_flag")]


_on(
    _derived,
    "combine_invalid",
    lambda d: q.combine_invalid(_reject_sets(d), "run-1").select(
        "trip_ref", "store_and_fwd_flag", "failure_reason", "run_id"
    ),
)
_on(_trips, "quality_report", lambda t: q.quality_report(q.etl_classify(t)[0]))
_on(_trips, "records_by_month", lambda t: q.records_by_month(q.etl_classify(t)[0]))


@query("manifest_check")
def _manifest(spark, sf_dir):
    """Files of removal events are not in the listing."""
    files = given.file_events(spark, sf_dir)
    listing = files.where("event_name LIKE 'ObjectCreated%'")
    return q.manifest_check(files, listing).select(
        "event_id", "is_valid", "message", "size_mb", "file_name"
    )
