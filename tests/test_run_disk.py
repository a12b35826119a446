"""What runs that follow each other keep on disk: no rows that were moved, and small files."""

import time

import pyarrow.parquet as pq
import pytest
from conftest import SF

from farelake.plans import runs
from farelake.session import DROP_SHUFFLES, dropping_shuffles
from farelake.sources import given_tables as given
from farelake.sources import zones as z


def shuffle_files(spark):
    """Name and bytes of every shuffle file that is on disk now."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = [files.apply(i) for i in range(files.size())]
    return {f.getName(): f.length() for f in found if f.getName().startswith("shuffle_")}


def left(spark, before, most, seconds=10):
    """Bytes of shuffle files that are new; they go shortly after a query has ended."""
    until = time.time() + seconds
    while (n := sum(v for k, v in shuffle_files(spark).items() if k not in before)) > most and time.time() < until:
        time.sleep(0.1)
    return n


def test_a_repeated_run_does_not_find_the_moved_rows_of_the_first(spark, tmp_path):
    trips, root = given.trips(spark, SF), str(tmp_path)
    n, before = trips.count(), set(shuffle_files(spark))
    for _ in range(2):
        got = runs.run_processed(trips, root, "r")
        assert left(spark, before, n) <= n  # a trip takes about 100 bytes when it is moved
    assert z.read_outcomes(spark, root).count() == got["ok"]
    assert spark.conf.get(DROP_SHUFFLES) == "false"


def test_a_frame_with_a_shuffle_of_its_own_can_be_read_again_after_the_run(spark, tmp_path):
    trips = given.trips(spark, SF).repartition(3, "VendorID")
    want = sorted(r.trip_ref for r in trips.collect())
    got = runs.run_processed(trips, str(tmp_path), "r")
    assert got["records_processed"] == len(want) and sorted(r.trip_ref for r in trips.collect()) == want


def test_the_setting_ends_with_its_block_and_with_whoever_set_it(spark):
    with pytest.raises(OSError), dropping_shuffles(spark):
        raise OSError("lost")
    assert spark.conf.get(DROP_SHUFFLES) == "false"
    with dropping_shuffles(spark):
        with dropping_shuffles(spark):
            pass
        assert spark.conf.get(DROP_SHUFFLES) == "true"
    assert spark.conf.get(DROP_SHUFFLES) == "false"


def test_attempts_are_written_small(spark, tmp_path):
    runs.run_processed(given.trips(spark, SF), str(tmp_path), "r")
    files = list(tmp_path.glob("attempts/**/*.parquet"))
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
