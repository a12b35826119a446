"""Incremental ingest of new files with Structured Streaming.

The checkpoint remembers which files have been taken, so a run processes only new ones; a new
checkpoint folder starts over. ``availableNow`` takes what is there and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators import quality
from ..sources.zones import write_outcomes

Transform = Callable[[DataFrame], DataFrame]


def new_files(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream of the parquet files under ``source``; the schema is explicit, never inferred."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(source)


def _finish(writer) -> None:
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def incremental_ingest(
    files: DataFrame,
    target: str,
    checkpoint: str,
    transform: Transform = lambda df: df,
    partition: tuple[str, ...] = (),
) -> None:
    """Append the rows of new files to ``target`` exactly once.

    The file sink keeps a log of committed files; read ``target`` with ``spark.read.parquet``.
    """
    writer = transform(files).writeStream.format("parquet").outputMode("append")
    if partition:
        writer = writer.partitionBy(*partition)
    _finish(writer.option("path", target).option("checkpointLocation", checkpoint))


def streaming_etl(
    files: DataFrame, root: str, checkpoint: str, transform: Transform = lambda df: df, mode: str = "complete"
) -> None:
    """New files through the quality checks into both sinks of ``root``; read them with ``zones.read_outcomes``.

    A batch is judged and written once, and one record commits its valid and its rejected rows together. A batch that is
    replayed after a failure replaces what it had committed, one that died before its record shows nothing.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        judged = quality.etl_outcome(transform(batch), mode=mode)
        write_outcomes(judged, root, f"batch-{batch_id}", quality.sinks(), **quality.moved_once())

    _finish(files.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint))


def stream_to_files(result: DataFrame, target: str, checkpoint: str) -> None:
    """Run a streaming result (append mode) to the end of the available input."""
    _finish(
        result.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
    )
