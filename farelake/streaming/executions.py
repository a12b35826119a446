"""Executions started by a stream of file notifications, each once, however late it is delivered again."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.file_events import dedup_executions
from ..session import stored
from ..sources.commits import CommitLog, commit_attempt, newest, read_attempts

SAME = ["bucket", "key", "second"]
MOST_DAYS = 1000  # days of a batch that are listed in the filter on the folders; a batch that spans more reads all of them


def _records(log: CommitLog) -> list[dict]:
    return list(newest(log.records(), "run_id").values())


def _started(spark: SparkSession, root: str, records: list[dict], asked: DataFrame) -> DataFrame:
    """What has been started on the days of ``asked``; folders of other days are not read."""
    started = read_attempts(spark, root, records, "executions").select("day", *SAME)
    days = [r.day for r in asked.select("day").distinct().limit(MOST_DAYS + 1).collect()]
    return started.where(F.col("day").isin(days)) if len(days) <= MOST_DAYS else started


def start_executions(
    files: DataFrame, root: str, checkpoint: str, ts: str = "event_time", lateness: str = "1 hour"
) -> None:
    """Stream of notifications into executions; read them with ``executions``.

    An execution is a bucket, a full key and a second. What has been started is kept as Parquet, partitioned by the day of
    that second, so a batch is held against the days it speaks of and against nothing else, and nothing is ever forgotten: a
    notification that comes again starts nothing after any delay. One that comes first but more than ``lateness`` behind
    the latest event time of the batches before is started as well and marked ``late``. A batch is committed at once; a
    replay of it replaces what it had started.
    """
    spark, log = files.sparkSession, CommitLog(files.sparkSession, root)

    def handle(batch: DataFrame, batch_id: int) -> None:
        before = [r for r in _records(log) if r["batch"] < batch_id]
        highs = [r["high"] for r in before if r["high"] is not None]
        mark = F.lit(max(highs) - pd.Timedelta(lateness).value // 1000 if highs else None).cast("long")
        once = dedup_executions(batch, ts)
        second = F.date_trunc("second", ts)
        late = F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")) < mark, F.lit(False))
        asked = stored(once.select("*", second.alias("second"), late.alias("late"), second.cast("date").alias("day")), "asked")
        if any(r["counts"] for r in before):
            asked = asked.join(_started(spark, root, before, asked), ["day", *SAME], "left_anti")
        high = lambda written: {
            "high": max([*highs, written.agg(F.max(F.unix_micros(F.col(ts).cast("timestamp")))).first()[0] or 0]) or None,
            "late": written.where("late").count(),
        }
        commit_attempt(log, asked.withColumn("sink", F.lit("executions")), f"batch-{batch_id}", ["day"], high, {"batch": batch_id})

    query = files.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query.start().awaitTermination()


def executions(spark: SparkSession, root: str, ts: str = "event_time") -> DataFrame:
    """Everything that was started: name, bucket, key, time, and whether its first notification was late."""
    found = read_attempts(spark, root, _records(CommitLog(spark, root)), "executions")
    return found.select("execution_name", "bucket", "key", ts, "late")


def late_starts(spark: SparkSession, root: str) -> int:
    """How many first notifications were late, from the commit records."""
    return sum(r["late"] for r in _records(CommitLog(spark, root)))
