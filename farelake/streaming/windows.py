"""Tumbling event-time windows, as a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.commits import CommitLog, commit_attempt, newest, read_attempts


def windowed_counts(
    events: DataFrame, period: str = "5 minutes", ts: str = "ts", lateness: str = "10 minutes"
) -> DataFrame:
    """Events per window. On a stream, windows are final once the watermark has passed them."""
    timed = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark("_ts", lateness)
    grouped = timed.groupBy(F.window("_ts", period).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return grouped.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n")


def _span(text: str) -> int:
    """Microseconds of an interval such as '10 minutes'."""
    import pandas as pd

    return int(pd.Timedelta(text).value // 1000)


def count_windows(
    events: DataFrame, root: str, checkpoint: str, period: str = "5 minutes", ts: str = "ts", lateness: str = "10 minutes"
) -> None:
    """Stream of events into counts per window, with late events as data; read them with ``window_report``.

    The watermark is that of Spark's own windows: the latest event time of the batches before, less ``lateness``. An event
    whose window ends at or before it is late; it is kept, as a row with all its columns and the number of times it came
    (``late_events``), instead of being dropped. A batch is one aggregate and one commit, so a replayed batch counts once and
    the watermark is the same as the first time. Events without time belong to no window and count as late.
    """
    log = CommitLog(events.sparkSession, root)

    def handle(batch: DataFrame, batch_id: int) -> None:
        before = [r["high"] for r in log.records() if r["batch"] < batch_id and r["high"] is not None]
        mark = F.lit(max(before) - _span(lateness) if before else None).cast("long")
        time = F.col(ts).cast("timestamp")
        start = F.floor(F.unix_micros(time) / F.lit(_span(period))) * _span(period)
        late = F.coalesce(start + _span(period) <= mark, time.isNull())
        marked = batch.select("*", start.cast("long").alias("_start"), late.alias("_late"), F.unix_micros(time).alias("_at"))
        # only late events keep their columns, so the others meet in their window
        row = F.struct(*[F.when(F.col("_late"), F.col(c)).alias(c) for c in batch.columns]).alias("event")
        sink = F.when(F.col("_late"), "late").otherwise("counts").alias("sink")
        counted = marked.groupBy(sink, "_start", row).agg(F.count(F.lit(1)).alias("n"), F.max("_at").alias("latest"))
        rows = counted.select(F.col("_start").alias("window_start"), "n", "latest", "event", "sink")
        high = lambda written: {"high": written.agg(F.max("latest")).first()[0]}
        commit_attempt(log, rows, f"batch-{batch_id}", [], high, {"batch": batch_id})

    query = events.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query.start().awaitTermination()


def _parts(spark: SparkSession, root: str, sink: str) -> DataFrame:
    return read_attempts(spark, root, list(newest(CommitLog(spark, root).records(), "run_id").values()), sink)


def late_events(spark: SparkSession, root: str) -> DataFrame:
    """Events that came too late for their window, with the number of times each came."""
    return _parts(spark, root, "late").select("event.*", "n")


def window_report(spark: SparkSession, root: str, period: str = "5 minutes", lateness: str = "10 minutes") -> DataFrame:
    """Every window: n events, of these ``late`` ones, and its state under the stream's watermark.

    ``open`` windows can still grow, ``closed`` ones cannot; a window that closed without an event and got late ones only is
    ``late``.
    """
    highs = [r["high"] for r in CommitLog(spark, root).records() if r["high"] is not None]
    mark = max(highs) - _span(lateness) if highs else None
    counted = _parts(spark, root, "counts").select("window_start", F.col("n").alias("timely"), F.lit(0).cast("long").alias("late"))
    late = _parts(spark, root, "late").where("window_start IS NOT NULL").select("window_start", F.lit(0).cast("long"), F.col("n"))
    whole = counted.union(late).groupBy("window_start").agg(F.sum("timely").alias("timely"), F.sum("late").alias("late"))
    passed = F.coalesce(F.col("window_start") + _span(period) <= F.lit(mark).cast("long"), F.lit(False))
    state = F.when(~passed, "open").when(F.col("timely") > 0, "closed").otherwise("late")
    start = F.timestamp_micros("window_start").cast("timestamp_ntz").alias("window_start")
    return whole.select(start, (F.col("timely") + F.col("late")).alias("n"), "late", state.alias("state"))
