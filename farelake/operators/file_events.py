"""File-arrival notifications: flatten, route, name and count executions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn

RECORDS = (
    "Records array<struct<eventName:string,eventTime:string,"
    "s3:struct<bucket:struct<name:string>,object:struct<key:string,size:bigint>>>>"
)


def file_events(messages: DataFrame, body: str = "body") -> DataFrame:
    """One row per record of the JSON messages; a missing text is 'Unknown', a missing size 0."""
    record = F.explode(F.from_json(F.col(body), RECORDS)["Records"]).alias("r")
    size = F.coalesce("r.s3.object.size", F.lit(0).cast("long"))
    return messages.select(record).select(
        F.col("r.eventTime").alias("timestamp"),
        F.coalesce("r.s3.bucket.name", F.lit("Unknown")).alias("bucket"),
        F.coalesce("r.s3.object.key", F.lit("Unknown")).alias("key"),
        size.alias("size_bytes"),
        fn.megabytes(size).alias("size_mb"),
        F.coalesce("r.eventName", F.lit("Unknown")).alias("event_type"),
    )


def route_events(files: DataFrame, prefix: str = "raw/taxi/") -> DataFrame:
    """Add ``reject_reason``: NULL for a new trip file to process, else why it is skipped.

    Works on a batch or a streaming frame with event_name, bucket and key.
    """
    named = (F.coalesce("bucket", F.lit("")) != "") & (F.coalesce("key", F.lit("")) != "")
    reason = (
        F.when(~F.coalesce("event_name", F.lit("")).startswith("ObjectCreated"), "not_a_creation")
        .when(~named, "missing_bucket_or_key")
        .when(~F.col("key").startswith(prefix), "outside_prefix")
        .when(~fn.has_known_suffix("key"), "unsupported_type")
    )
    return files.withColumns({"reject_reason": reason, "size_mb": fn.megabytes("size")})


def execution_name(files: DataFrame, ts: str = "event_time") -> DataFrame:
    stem = F.substring(F.translate(fn.file_name("key"), ".", "-"), 1, 50)
    stamp = F.date_format(F.col(ts), "yyyyMMdd-HHmmss")
    return files.withColumn("execution_name", F.concat(F.lit("etl-"), stamp, F.lit("-"), stem))


def dedup_executions(files: DataFrame, ts: str = "event_time") -> DataFrame:
    """Accepted files, once per bucket, full key and second of the event, with the earliest time of that second.

    ``execution_name`` is a label only: different files may share it. For a stream see ``streaming.executions``, which
    applies this to every batch and remembers what it has started.
    """
    accepted = execution_name(route_events(files).where("reject_reason IS NULL"), ts)
    slim = accepted.select("execution_name", "bucket", "key", F.col(ts).cast("timestamp").alias(ts))
    same = ["bucket", "key", F.date_trunc("second", ts).alias("_second")]
    once = slim.groupBy(*same).agg(F.min_by("execution_name", ts).alias("execution_name"), F.min(ts).alias(ts))
    return once.select("execution_name", "bucket", "key", ts)
