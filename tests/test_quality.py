import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import ETL_SCHEMA, SF, at
from farelake.operators import cleaning as c
from farelake.operators import quality as q
from farelake.sources import given_tables as given

CLEAN = [
    (3, 42, 4, 11.7, 38.4, 7.2, 46.6, 0.0, 0.5, 0.5),
    (7, 9, 1, 1.3, 7.9, 0.0, 9.4, 1.0, 0.0, 0.5),
    (11, 27, 6, 4.4, 18.6, 3.1, 22.7, 0.0, 0.5, 0.5),
]


def sizes(pair):
    return pair[0].count(), pair[1].count()


def test_clean_rows_pass_every_check(dq):
    df = dq(*CLEAN)
    for check in (q.check_null_values, q.validate_numeric_ranges, q.validate_datetime_logic, q.run_all_checks):
        assert sizes(check(df)) == (3, 0)


def test_nulls(dq, spark):
    df = dq(CLEAN[0], (7, 9, None, *CLEAN[1][3:]), (11, 27, 6, None, *CLEAN[2][4:]))
    no_pickup = dq(CLEAN[1]).withColumn("tpep_pickup_datetime", F.lit(None).cast("timestamp_ntz"))
    whole = df.unionByName(no_pickup)
    assert sizes(q.check_null_values(whole)) == (1, 3)
    metrics = {r.metric: r.violations for r in q.quality_metrics(q.tag(whole)).collect()}
    assert metrics["null_violations"] == 3 and sum(metrics.values()) == 3


def test_ranges(dq):
    rows = [list(CLEAN[0]) for _ in range(4)]
    rows[1][2], rows[2][3], rows[3][4] = 9, 101.5, 777.0
    valid, invalid = q.validate_numeric_ranges(dq(*map(tuple, rows)))
    assert (valid.count(), invalid.count()) == (1, 3)
    assert {r.failure_reason for r in invalid.collect()} == {"numeric_range_violation"}
    assert "failed_at" in invalid.columns


def test_datetime_order(dq):
    rest = CLEAN[0][2:]
    valid, invalid = q.validate_datetime_logic(dq((0, 42, *rest), (1, -7, *rest), (2, 0, *rest)))
    assert (valid.count(), invalid.count()) == (1, 2)
    assert invalid.first().failure_reason == "invalid_datetime_sequence"


def test_duration_and_tip(dq):
    rest = CLEAN[0][2:]
    derived = c.derive_etl(dq((0, 0.25, *rest), (1, 301, *rest), (2, 44, *rest)))
    assert sizes(q.validate_trip_duration(derived)) == (1, 2)
    tips = c.derive_etl(dq((0, 15, 1, 2.0, 8.0, 9.0, 17.0, 0.0, 0.0, 0.0), (1, 15, 1, 2.0, 16.0, 4.0, 20.0, 0.0, 0.0, 0.0)))
    assert sizes(q.validate_tip_percentage(tips)) == (1, 1)


def test_checks_on_absent_columns_are_skipped(dq):
    df = dq(*CLEAN).drop("tip_amount", "mta_tax")
    assert sizes(q.run_all_checks(df)) == (3, 0)
    assert sizes(q.validate_trip_duration(df)) == (3, 0)


def test_strict_mode_loses_null_conditions_and_complete_mode_charges_them(dq):
    df = dq((0, 15, 2, 2.5, 12.5, None, 15.5, 0.5, 0.5, 0.5))
    assert sizes(q.validate_numeric_ranges(df, mode="strict")) == (0, 0)
    assert sizes(q.validate_numeric_ranges(df, mode="complete")) == (0, 1)
    with pytest.raises(ValueError):
        q.tag(df, mode="other")


@pytest.mark.parametrize("mode", ["strict", "complete"])
def test_every_row_has_one_outcome(spark, mode):
    trips = given.trips(spark, SF)
    judged = q.etl_outcome(trips, mode=mode)
    counts = {r.outcome: r["count"] for r in judged.groupBy("outcome").count().collect()}
    assert sum(counts.values()) == trips.count()
    assert (q.LOST in counts) == (mode == "strict")
    if mode == "strict":
        assert counts == {
            "ok": 4072, "numeric_range_violation": 896, "invalid_trip_duration": 89,
            "invalid_tip_percentage": 11, "lost": 47, "pre_filtered": 885,
        }


def test_basic_filter(spark, five_trips):
    assert c.filter_basic(five_trips).count() == 5
    bad = [
        (1, at(0), at(0, 15), 1, 0.0, 12.5, 2.0, 14.5, 1),
        (1, at(0), at(0, 15), 1, 2.0, 0.0, 2.0, 14.5, 1),
        (1, at(0), at(0, 15), 0, 2.0, 12.5, 2.0, 14.5, 1),
        (1, at(0), at(0, -15), 1, 2.0, 12.5, 2.0, 14.5, 1),
        (1, at(0), at(0, 15), None, 2.0, 12.5, 2.0, 14.5, 1),
    ]
    mixed = five_trips.unionByName(spark.createDataFrame(bad, ETL_SCHEMA))
    assert c.filter_basic(mixed).count() == 5
    report = c.filter_removed_report(mixed).first()
    assert (report.records_before, report.records_after, report.records_removed, report.removed_pct) == (10, 5, 5, 50.0)


def test_reports_on_empty_input(spark):
    empty = spark.createDataFrame([], ETL_SCHEMA)
    assert c.filter_removed_report(empty).first().removed_pct == 0.0
    assert q.dq_summary(q.tag(empty)).first().rejected_pct == 0.0
    gate = q.dataset_gate(empty).where("raised").collect()
    assert [r.check for r in gate] == ["row_count"] and not gate[0].passed
    assert c.cleaning_summary(empty).first().missing_before == 0
    assert c.cleaning_issues(empty).count() == 0


def test_derived_columns(five_trips):
    row = c.derive_etl(five_trips).orderBy("tpep_pickup_datetime").first()
    assert row.trip_duration_minutes == 15.0 and row.tip_percentage == 16.0
    assert (row.year, row.month, row.etl_job_name) == (2023, 1, "job-process-taxi-data")


def test_quality_flag_first_match_wins(spark):
    rows = [(0.4, 30.0, 70.0), (2.0, 30.0, 70.0), (2.0, 30.0, 60.0), (0.4, 20.0, 10.0)]
    df = spark.createDataFrame(rows, "trip_distance double, fare_amount double, avg_speed_mph double")
    from farelake import functions as fn

    flags = [r.f for r in df.select(fn.quality_flag().alias("f")).collect()]
    assert flags == ["suspicious_fare", "high_speed", "normal", "normal"]


def test_gate_missing_column(five_trips):
    rows = {r.check: r for r in q.dataset_gate(five_trips.drop("passenger_count"), min_rows=1).collect()}
    assert rows["required_columns"].raised and not rows["row_count"].raised
    assert not any(name.startswith("null_pct") for name in rows)


def test_date_range(spark):
    rows = [(dt.datetime(2024, 1, d),) for d in (1, 2, 3)]
    df = spark.createDataFrame(rows, "tpep_pickup_datetime timestamp_ntz")
    assert c.filter_date_range(df, "2024-01-01", "2024-01-03").count() == 2
    assert c.filter_date_range(df, "2024-01-01", "2024-01-03", inclusive_end=True).count() == 3
    assert c.filter_date_range(df, last_days=1, as_of="2024-01-03").count() == 2


def test_manifest_messages(spark):
    rows = [
        ("lake", "raw/taxi/a.parquet", 1048576), ("lake", "raw/taxi/b.parquet", 5),
        ("", "raw/taxi/c.parquet", 1000), ("lake", "tmp/d.json", 1000), ("lake", "raw/taxi/gone.csv", 1000),
    ]
    files = spark.createDataFrame(rows, "bucket string, key string, size long")
    listing = files.where("key NOT LIKE '%gone%'")
    out = {r.key: r for r in q.manifest_check(files, listing).collect()}
    assert out["raw/taxi/a.parquet"].is_valid and out["raw/taxi/a.parquet"].size_mb == 1.0
    assert out["raw/taxi/b.parquet"].message == "Validation failed: File too small: 5 bytes (minimum: 100 bytes)"
    assert out["raw/taxi/c.parquet"].message == "Missing required fields: bucket or key"
    assert out["tmp/d.json"].message.count(";") == 1
    assert out["raw/taxi/gone.csv"].message == "Validation failed: File not found"
