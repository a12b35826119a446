"""Streams that lose nothing: late events, redeliveries after any delay, replayed batches."""

import datetime as dt
import re

import pytest

from farelake.sources.commits import CommitLog
from farelake.streaming import executions as ex
from farelake.streaming import ingest
from farelake.streaming import windows as wi

EVENT = "id int, ts timestamp_ntz, user string"
FILE = "event_name string, bucket string, key string, size long, event_time timestamp_ntz"
DAY = dt.datetime(2024, 1, 10)


def deliver(spark, source, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    return ingest.new_files(spark, source, schema)


def at(hour, minute=0, day=0):
    return DAY + dt.timedelta(days=day, hours=hour, minutes=minute)


@pytest.fixture
def counts(spark, tmp_path):
    source, root, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))

    def run(*rows, checkpoint=mark):
        wi.count_windows(deliver(spark, source, rows, EVENT), root, checkpoint, "1 hour", lateness="30 minutes")
        return {r.window_start: (r.n, r.late, r.state) for r in wi.window_report(spark, root, "1 hour", "30 minutes").collect()}

    run.root, run.source = root, source
    return run


def test_windows_count_late_events_as_late(spark, counts):
    assert counts((1, at(8, 10), "a"), (2, at(10, 20), "b")) == {at(8): (1, 0, "closed"), at(10): (1, 0, "open")}
    # 8 and 7 have closed; 10 has not; the window of 7 never had an event in time
    got = counts((3, at(8, 50), "c"), (4, at(7, 5), "d"), (4, at(7, 5), "d"), (5, at(10, 59), "e"), (6, at(12, 31), "f"), (7, None, "g"))
    assert got == {at(7): (2, 2, "late"), at(8): (2, 1, "closed"), at(10): (2, 0, "closed"), at(12): (1, 0, "open")}
    late = sorted((r.id, r.user, r.n) for r in wi.late_events(spark, counts.root).collect())
    assert late == [(3, "c", 1), (4, "d", 2), (7, "g", 1)]


def test_a_window_that_is_still_open_takes_events_in_any_order(counts):
    counts((1, at(10, 20), "a"))
    assert counts((2, at(9, 45), "b"), (3, at(10, 1), "c")) == {at(9): (1, 0, "open"), at(10): (2, 0, "open")}


def test_replayed_batches_count_once(spark, counts, tmp_path):
    counts((1, at(8, 10), "a"), (2, at(10, 20), "b"))
    first = counts((3, at(8, 50), "c"), (4, at(11, 45), "d"))
    # the same files again under a new checkpoint, as after a lost commit: one batch takes the place of the first
    files = ingest.new_files(spark, counts.source, EVENT, files_per_batch=1)
    wi.count_windows(files, counts.root, str(tmp_path / "again"), "1 hour", lateness="30 minutes")
    got = {r.window_start: (r.n, r.late, r.state) for r in wi.window_report(spark, counts.root, "1 hour", "30 minutes").collect()}
    assert sum(n for n, _, _ in got.values()) == sum(n for n, _, _ in first.values()) == 4


@pytest.fixture
def started(spark, tmp_path):
    source, root, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))

    def run(*rows, checkpoint=mark):
        rows = [("ObjectCreated:Put", "b", f"raw/taxi/{k}.parquet", 1, t) for k, t in rows]
        ex.start_executions(deliver(spark, source, rows, FILE), root, checkpoint)
        return sorted((r.key[9:-8], r.late) for r in ex.executions(spark, root).collect())

    run.root = root
    return run


def test_redelivery_after_any_delay_starts_nothing(started):
    assert started(("a", at(1)), ("b", at(2)), ("a", at(1))) == [("a", False), ("b", False)]
    assert started(("c", at(1, day=90))) == [("a", False), ("b", False), ("c", False)]
    assert started(("a", at(1)), ("b", at(2)), ("c", at(1, day=90))) == [("a", False), ("b", False), ("c", False)]


def test_a_late_first_notification_is_started_and_counted(spark, started):
    started(("a", at(1, day=3)))
    assert started(("old", at(1)), ("b", at(2, day=3))) == [("a", False), ("b", False), ("old", True)]
    assert ex.late_starts(spark, started.root) == 1
    assert started(("old", at(1))) == [("a", False), ("b", False), ("old", True)]
    assert ex.late_starts(spark, started.root) == 1


def test_a_batch_without_accepted_files_changes_nothing(spark, started):
    started(("a", at(1)))
    assert started(("x.txt/../y", at(1, day=1))) == started(("a", at(1)))


def test_only_the_days_of_a_batch_are_read(spark, started):
    for day in range(3):
        started((f"f{day}", at(1, day=day)))
    log = CommitLog(spark, started.root)
    asked = spark.createDataFrame([(at(5, day=1).date(),)], "day date")
    found = ex._started(spark, started.root, log.records(), asked)
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ = 2024-01-11", plan)
