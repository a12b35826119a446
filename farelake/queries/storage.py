"""Readers, sinks, whole runs and streams: each query writes and returns what it reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import quality as q
from ..operators import star as s
from ..operators.cleaning import clean_ingest, drop_null_critical, raw_to_processed
from ..operators.curated import curated_trips, fact_projection, payment_analysis_daily, table_counts
from ..plans import runs, views
from ..plans.star_queries import catalog_month_agg
from ..registry import query
from ..session import scratch_dir
from ..sources import given_tables as given
from ..sources import zones as z
from ..streaming import executions, ingest, windows
from ..streaming.windows import windowed_counts

CLOCK = ("quality_check_timestamp", "processed_at", "processed_timestamp", "failed_at")
YEAR, MONTH = 1998, 3


def _trips(spark, sf_dir):
    return given.trips(spark, sf_dir)


def _processed(spark, sf_dir):
    return raw_to_processed(_trips(spark, sf_dir)).drop(*CLOCK)


def _stored_zone(spark, sf_dir):
    path = scratch_dir(spark, "processed")
    z.write_processed(_processed(spark, sf_dir), path)
    return path


def _table_name(stem):
    return f"{stem}_{uuid.uuid4().hex[:12]}"


@query("read_zone")
def _read_zone(spark, sf_dir):
    columns = ["trip_ref", "fare_amount", "trip_distance", "year", "month"]
    return z.read_zone(spark, _stored_zone(spark, sf_dir), columns, YEAR, MONTH)


@query("read_any")
def _read_any(spark, sf_dir):
    return z.read_any(spark, f"{sf_dir}/orders.parquet")


@query("catalog_month_agg")
def _catalog_month(spark, sf_dir):
    return catalog_month_agg(z.read_zone(spark, _stored_zone(spark, sf_dir)), YEAR, MONTH)


@query("write_processed")
def _write_processed(spark, sf_dir):
    return z.read_zone(spark, _stored_zone(spark, sf_dir))


@query("write_curated")
def _write_curated(spark, sf_dir):
    """A full write, then one year written again with dynamic partition overwrite."""
    path = scratch_dir(spark, "fact")
    facts = fact_projection(_processed(spark, sf_dir))
    z.write_curated(facts, path, ("year", "month"))
    z.write_curated(facts.where(F.col("year") == YEAR), path, ("year", "month"), dynamic=True)
    return spark.read.parquet(path)


@query("write_table")
def _write_table(spark, sf_dir):
    """Created with one half of the rows, extended by the other."""
    name, path = _table_name("trips"), scratch_dir(spark, "table")
    trips = drop_null_critical(_trips(spark, sf_dir)).select("trip_ref", "VendorID", "fare_amount")
    z.write_table(trips.where("VendorID = 1"), name, "fail", path)
    z.write_table(trips.where("VendorID = 2"), name, "append", path)
    return spark.table(name)


@query("write_dead_letter")
def _write_dead_letter(spark, sf_dir):
    path = scratch_dir(spark, "dead_letter")
    _, invalid = q.etl_classify(_trips(spark, sf_dir))
    for _ in range(2):  # a repeated run replaces its own rows
        z.write_dead_letter(invalid, path, "run-1")
    return spark.read.parquet(path).select("trip_ref", "failure_reason", "run_id")


@query("export_csv")
def _export_csv(spark, sf_dir):
    path = scratch_dir(spark, "export.csv")
    columns = ["trip_ref", "VendorID", "tpep_pickup_datetime", "passenger_count", "tip_amount"]
    z.export_csv(_trips(spark, sf_dir).select(*columns), path)
    return z.read_any(spark, path, schema=", ".join(f"{c} string" for c in columns))


@query("discover_schema")
def _discover(spark, sf_dir):
    """Crawled twice: the second crawl adds the partitions and the new column of a later write."""
    name, path = _table_name("crawled"), scratch_dir(spark, "crawl")
    processed = _processed(spark, sf_dir).select("trip_ref", "fare_amount", "tip_amount", "year", "month")
    z.write_processed(processed.where(f"year < {YEAR}").drop("tip_amount"), path)
    z.discover_schema(spark, path, name)
    z.write_processed(processed.where(f"year >= {YEAR}"), path)
    found = z.discover_schema(spark, path, name)
    return found.groupBy("year", "month").agg(F.count(F.lit(1)).alias("trips"), F.count("tip_amount").alias("with_tip"))


@query("write_fact_taxi_trips")
def _write_fact(spark, sf_dir):
    """The warehouse fact in its physical layout, read back."""
    path = scratch_dir(spark, "fact_layout")
    s.lay_out_fact(s.build_fact_taxi_trips(raw_to_processed(_trips(spark, sf_dir)))).write.parquet(path)
    return spark.read.parquet(path)


@query("verify_schema")
def _verify(spark, sf_dir):
    return z.verify_schema(z.read_zone(spark, _stored_zone(spark, sf_dir)))


@query("table_counts")
def _counts(spark, sf_dir):
    trips = _trips(spark, sf_dir)
    return table_counts(
        {
            "dim_location": s.build_dim_location(trips),
            "dim_time": s.build_dim_time(trips),
            "dim_rate": s.build_dim_rate(spark),
            "fact_trips": s.build_fact_trips(trips),
        }
    )


@query("materialize")
def _materialize(spark, sf_dir):
    """Stored, then refreshed after the view has changed."""
    name, path = _table_name("stored_view"), scratch_dir(spark, "view")
    curated = curated_trips(_trips(spark, sf_dir))
    z.materialize(views.v_hourly_trips(curated.where("vendor_id = 1")), name, path)
    z.materialize(views.v_hourly_trips(curated), name, path)
    return spark.table(name)


# -- whole runs ------------------------------------------------------------------------


def _run_processed(spark, sf_dir, mode="complete", times=1):
    root = scratch_dir(spark, "outcomes")
    for _ in range(times):
        counts = runs.run_processed(_trips(spark, sf_dir), root, "run-1", mode=mode)
    return root, counts


def _processed_rows(spark, sf_dir, mode="complete", times=1):
    root, _ = _run_processed(spark, sf_dir, mode, times)
    return z.read_outcomes(spark, root).select(
        "trip_ref", "trip_duration_minutes", "tip_percentage", "etl_job_name", "year", "month"
    )


def _dead_letters(spark, sf_dir, mode):
    root, _ = _run_processed(spark, sf_dir, mode)
    return z.read_outcomes(spark, root, z.REJECTED).select("trip_ref", "failure_reason", "run_id")


for _suffix, _mode in (("", "complete"), ("_strict", "strict")):
    query(f"run_processed{_suffix}")(lambda spark, d, m=_mode: _processed_rows(spark, d, m))
    query(f"run_processed_dead_letters{_suffix}")(lambda spark, d, m=_mode: _dead_letters(spark, d, m))
    query(f"run_processed_summary{_suffix}")(lambda spark, d, m=_mode: runs.report(lambda: _run_processed(spark, d, m)[1], spark))

query("run_processed_twice")(lambda spark, d: _processed_rows(spark, d, times=2))
query("run_processed_report")(lambda spark, d: runs.processed_report(spark, _run_processed(spark, d)[0], "run-1")[0])
query("run_processed_months")(lambda spark, d: runs.processed_report(spark, _run_processed(spark, d)[0], "run-1")[1])


def _run_curated(spark, sf_dir):
    zone = z.read_zone(spark, _stored_zone(spark, sf_dir))
    return runs.run_curated(zone, scratch_dir(spark, "curated"))


@query("run_curated")
def _curated_counts(spark, sf_dir):
    return table_counts({n: spark.read.parquet(p) for n, p in _run_curated(spark, sf_dir).items()})


@query("run_curated_payment")
def _curated_payment(spark, sf_dir):
    return spark.read.parquet(_run_curated(spark, sf_dir)["payment_analysis"])


def _star_root(spark, sf_dir):
    """Two disjoint loads and the second one again, which adds nothing."""
    root = scratch_dir(spark, "star")
    processed = _processed(spark, sf_dir)
    for vendor in (1, 2, 2):
        runs.run_star(processed.where(f"VendorID = {vendor}"), root)
    return root


query("run_star")(lambda spark, d: table_counts(runs.current_star(spark, _star_root(spark, d))))
for _q in ("rds_top_pickups", "rds_hourly", "rds_weekend"):
    query(f"run_star_{_q}")(lambda spark, d, q_=_q: runs.star_questions(spark, _star_root(spark, d))[q_])


@query("run_week1")
def _run_week1(spark, sf_dir):
    _, statistics = runs.run_week1(
        _trips(spark, sf_dir), _table_name("taxi_trips"), "fail", scratch_dir(spark, "week1")
    )
    return statistics


# -- streams ---------------------------------------------------------------------------


def _lineitem_stream(spark, sf_dir):
    schema = given.table(spark, sf_dir, "lineitem").schema
    return ingest.new_files(spark, sf_dir, schema, glob="lineitem.parquet")


@query("incremental_ingest")
def _incremental(spark, sf_dir):
    """Two runs over the same files with one checkpoint: the second adds nothing."""
    target, checkpoint = scratch_dir(spark, "raw"), scratch_dir(spark, "checkpoint")
    for _ in range(2):
        ingest.incremental_ingest(_lineitem_stream(spark, sf_dir), target, checkpoint, given.trips_from)
    return spark.read.parquet(target)


@query("streaming_etl")
def _streaming_etl(spark, sf_dir):
    root = scratch_dir(spark, "outcomes")
    ingest.streaming_etl(_lineitem_stream(spark, sf_dir), root, scratch_dir(spark, "checkpoint"), given.trips_from)
    ok = z.read_outcomes(spark, root).select("trip_ref", F.lit(q.OK).alias("outcome"))
    bad = z.read_outcomes(spark, root, z.REJECTED).select("trip_ref", F.col("failure_reason").alias("outcome"))
    return ok.unionByName(bad)


def _event_stream(spark, sf_dir):
    schema = given.table(spark, sf_dir, "events").schema
    return ingest.new_files(spark, sf_dir, schema, glob="events.parquet")


def _closed(spark, result, label):
    target = scratch_dir(spark, label)
    ingest.stream_to_files(result, target, scratch_dir(spark, "checkpoint"))
    return spark.read.parquet(target)


@query("windowed_counts_stream")
def _windowed_stream(spark, sf_dir):
    """Windows that the watermark has passed."""
    return _closed(spark, windowed_counts(_event_stream(spark, sf_dir), "5 minutes"), "windows")


@query("windowed_counts_stream_all")
def _windowed_all(spark, sf_dir):
    """Every window of the stream: open and closed ones, and late events."""
    root = scratch_dir(spark, "window_counts")
    windows.count_windows(_event_stream(spark, sf_dir), root, scratch_dir(spark, "checkpoint"))
    return windows.window_report(spark, root)


def _deliveries(spark, events, *conditions):
    """The events in so many files folders as conditions, and a stream that takes them one after the other."""
    source = scratch_dir(spark, "deliveries")
    for condition in conditions:
        events.where(condition).write.mode("append").parquet(source)
        yield ingest.new_files(spark, source, events.schema)


@query("windowed_counts_stream_late")
def _windowed_late(spark, sf_dir):
    """Every seventh event is delivered after all others, so most of these are late."""
    root, checkpoint = scratch_dir(spark, "window_counts"), scratch_dir(spark, "checkpoint")
    events = given.table(spark, sf_dir, "events")
    for stream in _deliveries(spark, events, "event_id % 7 != 0", "event_id % 7 = 0"):
        windows.count_windows(stream, root, checkpoint)
    return windows.window_report(spark, root)


@query("dedup_executions_stream")
def _dedup_stream(spark, sf_dir):
    """Every notification is delivered a second time, and every seventh one for the first time then, late."""
    root, checkpoint = scratch_dir(spark, "started"), scratch_dir(spark, "checkpoint")
    events = given.table(spark, sf_dir, "events")
    for stream in _deliveries(spark, events, "event_id % 7 != 0", "true"):
        files = stream.selectExpr(*[f"{text} AS {name}" for name, text in given.FILE_EVENT_EXPRESSIONS.items()])
        executions.start_executions(files, root, checkpoint)
    return executions.executions(spark, root).drop("late")
