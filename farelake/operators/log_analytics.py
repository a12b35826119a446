"""Log questions over a ``logs`` table: ts, log_group, type, message, duration, memory columns.

Every question is ``f(logs, start, end, groups, last_hours, limit)``: a time range, group patterns with ``*`` that hold
from the start of the name, and an upper bound on the reported rows. Questions about the most frequent or the newest
rows take ``k`` instead. Both are off by default: ``None`` reports all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import log_field
from .joins import mean_of
from .percentiles import add_percentiles, range_parts

# Which group patterns a question looks at.
HANDLERS = ("/lambda/*",)
JOBS = ("/glue/*",)
STATES = ("/states/*",)
UPLOADS = ("/lambda/s3-notification-handler",)
EVERYTHING = HANDLERS + JOBS


def log_query(logs: DataFrame, start=None, end=None, groups=None, last_hours: float | None = None, limit: int | None = None):
    """Lines of a time range [start, end) and of the groups that match a pattern; with ``limit`` the newest of them."""
    out = logs
    if last_hours is not None:
        until = F.current_timestamp() if end is None else F.lit(end).cast("timestamp")
        seconds = int(last_hours * 3600)
        out = out.where(
            F.col("ts").cast("timestamp") >= F.timestamp_add("SECOND", F.lit(-seconds), until)
        )
    if start is not None:
        out = out.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        out = out.where(F.col("ts") < F.lit(end).cast("timestamp_ntz"))
    if groups:
        hit = F.lit(False)
        for pattern in groups:
            hit = hit | F.col("log_group").like(pattern.replace("_", r"\_").replace("*", "%"))
        out = out.where(hit)
    return out if limit is None else out.orderBy(F.desc("ts"), F.desc("event_id")).limit(limit)


def _bin(period: str) -> Column:
    return F.window("ts", period)["start"].alias("bin")


def _capped(df: DataFrame, limit: int | None, *order: Column | str) -> DataFrame:
    ordered = df.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


def _top(df: DataFrame, by: list[Column], names: list[str], count: str, k: int | None) -> DataFrame:
    grouped = df.groupBy(*[c.alias(n) for c, n in zip(by, names)]).agg(F.count(F.lit(1)).alias(count))
    return _capped(grouped, k, F.desc(count), *names)


# The expressions that follow in the questions below.


def log_failed_records(logs, start=None, end=None, groups=EVERYTHING, last_hours=None, k=None) -> DataFrame:
    kept = log_query(logs, start, end, groups, last_hours).where(F.col("message").rlike("ERROR|FAIL|Exception"))
    pattern = "(ERROR|FAIL|Exception): (.*)"
    return _top(
        kept,
        [log_field("message", pattern, 1), log_field("message", pattern, 2)],
        ["error_type", "error_message"],
        "count",
        k,
    )


def log_processing_time(logs, start=None, end=None, groups=HANDLERS, last_hours=None, limit=None) -> DataFrame:
    kept = log_query(logs, start, end, groups, last_hours).where("type = 'REPORT'").withColumn("bin", _bin("5 minutes"))
    ends = [F.max("duration").alias("most"), F.min("duration").alias("least")]
    parts = range_parts(kept, ["bin"], "duration", {"duration": F.col("duration")}, ends)
    grouped = parts.groupBy("bin").agg(
        mean_of("duration").alias("avg_duration"), F.max("most").alias("max_duration"), F.min("least").alias("min_duration")
    )
    out = add_percentiles(grouped, parts, kept, ["bin"], "duration", {"p50": 0.5, "p95": 0.95})
    return _capped(out, limit, F.desc("bin"))


def log_error_patterns(logs, start=None, end=None, groups=EVERYTHING, last_hours=None, k=None) -> DataFrame:
    kept = log_query(logs, start, end, groups, last_hours).where(F.col("message").rlike("ERROR|Exception|Error"))
    return _top(
        kept,
        [log_field("message", r"(\w+Exception): (.*)", 1)],
        ["error_class"],
        "error_count",
        k,
    )


def log_performance(logs, start=None, end=None, groups=HANDLERS, last_hours=None, limit=None) -> DataFrame:
    used = F.col("max_memory_used") / F.nullif(F.col("memory_size"), F.lit(0))
    out = (
        log_query(logs, start, end, groups, last_hours)
        .where("type = 'REPORT'")
        .groupBy(_bin("5 minutes"))
        .agg(
            F.avg("billed_duration").alias("avg_duration"),
            F.max("billed_duration").alias("max_duration"),
            (F.avg(used) * 100).alias("avg_memory_utilization"),
        )
    )
    return _capped(out, limit, F.desc("bin"))


def log_errors_detailed(logs, start=None, end=None, groups=HANDLERS, last_hours=None, k=None) -> DataFrame:
    kept = log_query(logs, start, end, groups, last_hours).where(F.col("message").rlike("ERROR|Error|error"))
    return _capped(
        kept.select("ts", "event_id", "message"), k, F.desc("ts"), F.desc("event_id")
    )


def log_job_metrics(logs, start=None, end=None, groups=JOBS, last_hours=None, limit=None) -> DataFrame:
    records = log_field("message", r"records processed: (\d+)").cast("long")
    seconds = log_field("message", r"execution time: (\d+)").cast("long")
    out = (
        log_query(logs, start, end, groups, last_hours)
        .where(F.col("message").rlike("Job run succeeded|Job run failed|records processed"))
        .groupBy(_bin("1 hour"))
        .agg(F.sum(records).alias("total_records"), F.avg(seconds).alias("avg_exec_time"))
    )
    return _capped(out, limit, F.desc("bin"))


def log_job_failures(logs, start=None, end=None, groups=JOBS, last_hours=None, k=None) -> DataFrame:
    kept = log_query(logs, start, end, groups, last_hours).where(F.col("message").rlike("FAILED|Exception|Error"))
    return _top(kept, [F.col("message")], ["error_message"], "failure_count", k)


def log_upload_tracking(logs, start=None, end=None, groups=UPLOADS, last_hours=None, limit=None) -> DataFrame:
    size = log_field("message", r'"size_mb": ([\d.]+)').cast("double")
    out = (
        log_query(logs, start, end, groups, last_hours)
        .where(F.col("message").rlike("S3_FILE_UPLOADED"))
        .groupBy(_bin("1 hour"))
        .agg(F.sum(size).alias("total_mb"), F.count(F.lit(1)).alias("file_count"))
    )
    return _capped(out, limit, F.desc("bin"))


def log_quality_issues(logs, start=None, end=None, groups=EVERYTHING, last_hours=None, limit=None) -> DataFrame:
    words = "validation|quality|invalid|missing"
    kept = log_query(logs, start, end, groups, last_hours).where(F.col("message").rlike(words))
    kind = log_field("message", f"({words})[^:]*: (.*)", 1)
    return _top(kept, [kind], ["issue_type"], "issue_count", limit)


def log_executions(logs, start=None, end=None, groups=STATES, last_hours=None, limit=None) -> DataFrame:
    pattern = "(ExecutionStarted|ExecutionSucceeded|ExecutionFailed)"
    out = (
        log_query(logs, start, end, groups, last_hours)
        .where(F.col("message").rlike(pattern))
        .groupBy(log_field("message", pattern).alias("execution_status"), _bin("1 hour"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return _capped(out, limit, F.desc("bin"), "execution_status")


def log_underutilized(logs, start=None, end=None, groups=HANDLERS, last_hours=None, limit=None) -> DataFrame:
    used = F.col("max_memory_used") / F.nullif(F.col("memory_size"), F.lit(0))
    kept = log_query(logs, start, end, groups, last_hours).where("type = 'REPORT'")
    return kept.where(F.col("max_memory_used") < F.col("memory_size") * 0.5).agg(
        F.count(F.lit(1)).alias("underutilized_invocations"), (F.avg(used) * 100).alias("avg_memory_util")
    )


def log_hourly_activity(logs, start=None, end=None, groups=EVERYTHING, last_hours=None, limit=None) -> DataFrame:
    out = log_query(logs, start, end, groups, last_hours).groupBy(_bin("1 hour")).agg(
        F.count(F.lit(1)).alias("event_count")
    )
    return _capped(out, limit, F.desc("bin"))


def log_job_states(logs, start=None, end=None, groups=JOBS, last_hours=None, limit=None) -> DataFrame:
    """Final job states per five minutes; the state words match in any letter case."""
    pattern = "(?i)(SUCCEEDED|FAILED|TIMEOUT)"
    out = (
        log_query(logs, start, end, groups, last_hours)
        .where(F.col("message").rlike(pattern))
        .groupBy(_bin("5 minutes"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return _capped(out, limit, F.desc("bin"))
