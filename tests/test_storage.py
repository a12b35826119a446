import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF
from farelake.operators import cleaning as c
from farelake.operators import star as s
from farelake.plans import runs
from farelake.session import scratch_dir
from farelake.sources import given_tables as given
from farelake.sources import zones as z
from farelake.sources.commits import CommitLog
from farelake.streaming import ingest
from farelake.streaming.windows import windowed_counts


class FakeSession:
    """Settings only: the folder is fixed when a real session starts."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}

    def get(self, name, default=None):
        return self.settings.get(name, default)


def test_scratch_follows_the_cluster_setting(spark):
    shared = FakeSession(spark_checkpoint_dir="hdfs://shared/tmp/", spark_master="yarn")
    first, second = scratch_dir(shared, "x"), scratch_dir(shared, "x")
    assert first.startswith("hdfs://shared/tmp/farelake-") and first != second
    with pytest.raises(RuntimeError):
        scratch_dir(FakeSession(spark_master="yarn"), "x")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_read_any_formats(spark, tmp_path):
    df = spark.range(5).select("id", (F.col("id") * 2).alias("twice"))
    df.write.parquet(str(tmp_path / "a.parquet"))
    df.write.option("header", True).csv(str(tmp_path / "b.csv"))
    df.toPandas().to_csv(tmp_path / "c.csv.gz", index=False)
    for name in ("a.parquet", "b.csv", "c.csv.gz"):
        assert z.read_any(spark, str(tmp_path / name)).agg(F.sum("twice")).first()[0] == 20
    assert z.read_any(spark, str(tmp_path / "a.parquet"), nrows=2).count() == 2
    with pytest.raises(ValueError):
        z.read_any(spark, "x.json")


def test_discovery_merges_columns_and_keeps_partitions(spark, tmp_path):
    path = str(tmp_path / "zone")
    spark.sql("SELECT 1 AS a, 2024 AS year, 1 AS month").write.partitionBy("year", "month").parquet(path)
    spark.sql("SELECT 2 AS a, 'x' AS b, 2024 AS year, 2 AS month").write.mode("append").partitionBy("year", "month").parquet(path)
    found = z.discover_schema(spark, path, "discovered_zone")
    assert set(found.columns) == {"a", "b", "year", "month"}
    assert found.count() == 2
    spark.sql("SELECT 3 AS a, 'y' AS b, 2025 AS year, 1 AS month").write.mode("append").partitionBy("year", "month").parquet(path)
    assert z.discover_schema(spark, path, "discovered_zone").count() == 3
    spark.sql("DROP TABLE discovered_zone")


def test_verify_schema_reports_missing(spark):
    rows = z.verify_schema(spark.sql("SELECT 1 AS VendorID, 2024 AS year")).collect()
    found = {(r.kind, r.name): r.found for r in rows}
    assert found[("key_column", "vendorid")] and not found[("key_column", "fare_amount")]
    assert found[("partition_key", "year")] and not found[("partition_key", "month")]
    assert ("partition", "year=2024") in found


def test_write_table_modes(spark, tmp_path):
    df = spark.range(3)
    z.write_table(df, "mode_table", "fail", str(tmp_path / "t"))
    with pytest.raises(Exception):
        z.write_table(df, "mode_table", "fail", str(tmp_path / "t"))
    z.write_table(df, "mode_table", "append")
    assert spark.table("mode_table").count() == 6
    z.write_table(df, "mode_table", "replace")
    assert spark.table("mode_table").count() == 3
    spark.sql("DROP TABLE mode_table")


def test_star_load_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path)
    good = c.raw_to_processed(given.trips(spark, SF))
    first = runs.run_star(good, root)
    before = {t: df.count() for t, df in runs.current_star(spark, root).items()}
    with pytest.raises(ValueError, match="chk_fare_amount"):
        runs.run_star(given.trips(spark, SF), root)
    assert {t: df.count() for t, df in runs.current_star(spark, root).items()} == before
    second = runs.run_star(good.where("VendorID = 1"), root)
    assert first != second  # nothing new: the same load again adds no row
    assert {t: df.count() for t, df in runs.current_star(spark, root).items()} == before


def test_star_loads_add_up(spark, tmp_path):
    good = c.raw_to_processed(given.trips(spark, SF))
    for vendor in (1, 2, 2):
        runs.run_star(good.where(f"VendorID = {vendor}"), str(tmp_path / "parts"))
    runs.run_star(good, str(tmp_path / "whole"))
    parts, whole = (runs.current_star(spark, str(tmp_path / x)) for x in ("parts", "whole"))
    for name in runs.STAR_TABLES:
        assert sorted(map(tuple, parts[name].collect()), key=str) == sorted(map(tuple, whole[name].collect()), key=str)
    assert runs.star_questions(spark, str(tmp_path / "parts"))["rds_hourly"].count() == 24


def test_a_repeated_run_replaces_its_rows(spark, tmp_path):
    trips, root = given.trips(spark, SF), str(tmp_path)
    for run in ("r1", "r1", "r2"):
        got = runs.run_processed(trips, root, run)
    assert z.read_outcomes(spark, root).count() == 2 * got["ok"]
    assert z.read_outcomes(spark, root, run_id="r1").count() == got["ok"]
    report, months = runs.processed_report(spark, root, "r2")
    assert report.first().total_records == got["ok"] == sum(r.record_count for r in months.collect())


def test_a_second_crawl_adds_new_columns(spark, tmp_path):
    path = str(tmp_path)
    z.write_processed(spark.sql("SELECT 1 AS a, 2023 AS year, 1 AS month"), path)
    z.discover_schema(spark, path, "crawled_twice")
    z.write_processed(spark.sql("SELECT 2 AS a, 'x' AS b, 2024 AS year, 1 AS month"), path)
    rows = z.discover_schema(spark, path, "crawled_twice").select("a", "b").orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, None), (2, "x")]
    spark.sql("DROP TABLE crawled_twice")


def test_processed_run_counts_add_up(spark, tmp_path):
    trips, root = given.trips(spark, SF), str(tmp_path)
    got = runs.run_processed(trips, root, "r1")
    assert got["records_processed"] == trips.count() == sum(v for k, v in got.items() if k not in ("records_processed", "run_id"))
    assert z.read_outcomes(spark, root).count() == got["ok"]
    assert z.read_outcomes(spark, root, z.REJECTED).count() == got["records_processed"] - got["ok"] - got["pre_filtered"]


def test_fact_rows_plus_skipped_is_input(spark):
    trips = given.trips(spark, SF)
    row = s.load_summary(trips).first()
    assert row.fact_trips + row.skipped == row.source_rows == trips.count()
    assert s.build_fact_trips(trips).count() == row.fact_trips
    assert s.build_fact_trips(trips, s.build_dim_time(trips)).count() == row.fact_trips


def test_fixed_dimensions(spark):
    assert s.build_dim_time_of_day(spark).count() == 1440
    row = s.build_dim_time_of_day(spark).where("time_key = 1630").first()
    assert (row.hour, row.minute, row.time_of_day, row.is_rush_hour) == (16, 30, "Afternoon", True)
    assert s.build_dim_rate(spark).count() == s.build_dim_rate_code(spark).count() == s.build_dim_payment_type(spark).count() == 6
    days = s.calendar(spark, dt.date(2023, 12, 30), dt.date(2024, 1, 2), holidays=(dt.date(2024, 1, 1),)).orderBy("date_key").collect()
    assert [d.date_key for d in days] == [20231230, 20231231, 20240101, 20240102]
    assert [d.is_holiday for d in days] == [False, False, True, False] and days[0].is_weekend


def test_ingest_takes_only_new_files(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "id long"

    def run(checkpoint=mark, out=target):
        ingest.incremental_ingest(ingest.new_files(spark, source, schema), out, checkpoint)
        return spark.read.parquet(out).count()

    spark.range(0, 5, 1, 1).write.parquet(source)
    assert run() == 5
    assert run() == 5
    spark.range(5, 8, 1, 1).write.mode("append").parquet(source)
    assert run() == 8
    assert run(str(tmp_path / "mark2"), str(tmp_path / "out2")) == 8  # a new checkpoint starts over


def test_streaming_etl_equals_batch_and_survives_replay(spark, tmp_path):
    raw = given.table(spark, SF, "lineitem")
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    raw.repartition(4).write.parquet(source)

    def stream(checkpoint):
        files = ingest.new_files(spark, source, raw.schema, files_per_batch=2)
        ingest.streaming_etl(files, root, str(tmp_path / checkpoint), given.trips_from)
        return z.read_outcomes(spark, root).count(), z.read_outcomes(spark, root, z.REJECTED).count()

    batch = runs.run_processed(given.trips(spark, SF), str(tmp_path / "batch"), "r")
    want = (batch["ok"], batch["records_processed"] - batch["ok"] - batch["pre_filtered"])
    assert stream("c1") == want
    # The same batches again, as after a lost commit: what they had committed is replaced.
    assert stream("c2") == want


def test_stream_windows_are_final_and_equal_batch(spark, tmp_path):
    events = given.table(spark, SF, "events")
    files = ingest.new_files(spark, SF, events.schema, glob="events.parquet")
    ingest.stream_to_files(windowed_counts(files, "1 hour"), str(tmp_path / "w"), str(tmp_path / "c"))
    got = {r.window_start: r.n for r in spark.read.parquet(str(tmp_path / "w")).collect()}
    batch = {r.window_start: r.n for r in windowed_counts(events, "1 hour").collect()}
    assert got and all(batch[k] == n for k, n in got.items())
    assert set(batch) - set(got) <= {max(batch), sorted(batch)[-2]}


def test_a_load_of_other_times_reads_no_older_fact(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    good = c.raw_to_processed(given.trips(spark, SF))
    cut = "tpep_pickup_datetime < '1998-01-01'"
    runs.run_star(good.where(cut), root)
    looked_at = []
    inner = runs.bloom.may_hold
    monkeypatch.setattr(runs.bloom, "may_hold", lambda *a: looked_at.append(a) or inner(*a))
    runs.run_star(good.where(f"NOT {cut}"), root)
    assert not looked_at  # the range of pickup times rules the first load out
    runs.run_star(good.where("VendorID = 1"), root)  # overlaps with both, and holds nothing new
    assert len(looked_at) == 2
    records = CommitLog(spark, root).records()
    assert records[2]["rows"] == {"dim_location": 0, "dim_time": 0, "dim_rate": 0, "fact_trips": 0}
    assert sum(r["rows"]["fact_trips"] for r in records) == runs.current_star(spark, root)["fact_trips"].count()


def test_a_load_between_known_ones_is_ruled_out_by_its_filter(spark, tmp_path):
    good = c.raw_to_processed(given.trips(spark, SF))
    runs.run_star(good.where("VendorID = 1"), str(tmp_path))
    record = CommitLog(spark, str(tmp_path)).records()[0]
    mine = s.build_fact_trips(good.where("VendorID = 1")).limit(1)
    other = s.build_fact_trips(good.where("VendorID = 2")).limit(5)
    assert runs._loads_that_may_hold(spark, mine, [record]) == [record]
    assert runs._loads_that_may_hold(spark, other, [record]) == []


def test_of_two_racing_loads_one_wins_and_one_starts_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    good = c.raw_to_processed(given.trips(spark, SF)).where("tpep_pickup_datetime < '1996-01-01'")
    inner, tries = runs._load, []

    def slow(*args):
        tries.append(args[2])
        record = inner(*args)
        if len(tries) == 1:  # another load commits while the first is at work
            runs.run_star(good.where("VendorID = 2"), root, "second")
        return record

    monkeypatch.setattr(runs, "_load", slow)
    runs.run_star(good, root, "first")
    assert tries == ["first", "second", "first"]
    assert [r["load_id"] for r in CommitLog(spark, root).records()] == ["second", "first"]
    whole = runs.current_star(spark, root)
    assert whole["fact_trips"].count() == whole["fact_trips"].select("trip_id").distinct().count() == s.build_fact_trips(good).count()
    assert whole["dim_time"].count() == whole["dim_time"].distinct().count()
    assert whole["dim_location"].count() == whole["dim_location"].select("location_id").distinct().count()
