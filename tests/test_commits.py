"""Data counts once its record is in the log: crashes, retries, racing writers."""

import json

import pytest
from conftest import SF
from pyspark.sql import functions as F

from farelake.plans import runs
from farelake.sources import given_tables as given
from farelake.sources import zones as z
from farelake.sources.commits import CommitConflict, CommitLog


def rows(spark, root, sink=z.VALID):
    return sorted(r.trip_ref for r in z.read_outcomes(spark, root, sink).select("trip_ref").collect())


def test_records_come_in_order_and_one_of_two_racing_writers_wins(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "zone"))
    assert log.version == 0 and log.records() == []
    assert log.append({"a": 1}) == 1 and log.append({"a": 2}, expected=1) == 2
    with pytest.raises(CommitConflict):
        log.append({"a": 3}, expected=1)
    assert log.append({"a": 4}) == 3
    assert [(r["version"], r["a"]) for r in log.records()] == [(1, 1), (2, 2), (3, 4)]
    assert [r["a"] for r in log.records(upto=2)] == [1, 2]
    assert sorted(p.name for p in (tmp_path / "zone" / "_log").iterdir() if p.suffix != ".crc") == [f"{n:012d}.json" for n in (1, 2, 3)]


def test_a_run_that_dies_before_its_record_shows_nothing_and_a_retry_shows_its_rows_once(spark, tmp_path, monkeypatch):
    root, trips = str(tmp_path), given.trips(spark, SF)
    first = runs.run_processed(trips.where("VendorID = 1"), root, "r1")
    before = rows(spark, root), rows(spark, root, z.REJECTED)

    def dies(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(CommitLog, "append", dies)
        with pytest.raises(OSError):
            runs.run_processed(trips.where("VendorID = 2"), root, "r2")
    assert (rows(spark, root), rows(spark, root, z.REJECTED)) == before
    second = runs.run_processed(trips.where("VendorID = 2"), root, "r2")
    assert len(rows(spark, root)) == len(set(rows(spark, root))) == first["ok"] + second["ok"]
    whole = runs.run_processed(trips, str(tmp_path / "whole"), "r")
    assert rows(spark, root) == rows(spark, str(tmp_path / "whole"))
    assert rows(spark, root, z.REJECTED) == rows(spark, str(tmp_path / "whole"), z.REJECTED)
    assert all(first[k] + second[k] == n for k, n in whole.items() if k != "run_id")


def test_a_run_reads_its_input_once(spark, tmp_path):
    trips = given.trips(spark, SF)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    got = runs.run_processed(trips.mapInArrow(count, trips.schema), str(tmp_path), "r")
    assert seen.value == got["records_processed"] == trips.count()


@pytest.mark.parametrize("condition", ["1 = 0", "fare_amount < 0"])
def test_runs_without_rows_in_a_sink(spark, tmp_path, condition):
    root = str(tmp_path)
    got = runs.run_processed(given.trips(spark, SF).where(condition), root, "r")
    assert got["ok"] == 0 and rows(spark, root) == []
    assert len(rows(spark, root, z.REJECTED)) == got["records_processed"] - got["pre_filtered"]
    with pytest.raises(ValueError, match="nothing has been committed"):
        z.read_outcomes(spark, str(tmp_path / "none"))


def test_skipped_rows_leave_counts_but_no_data(spark, tmp_path):
    root = str(tmp_path)
    got = runs.run_processed(given.trips(spark, SF), root, "r")
    kept = spark.read.parquet(f"{root}/attempts").where(F.col("sink") == z.SKIPPED)
    assert kept.count() == got["pre_filtered"] + got["lost"] and kept.where("trip_ref IS NOT NULL").count() == 0
    record = json.loads(next(p for p in (tmp_path / "_log").iterdir() if p.suffix == ".json").read_text())
    assert record["outcomes"]["ok"] == got["ok"]
