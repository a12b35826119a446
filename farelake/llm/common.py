"""What the operators of this subpackage share: session settings, stored intermediate tables, word rules."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare, scratch_dir

# Python tasks get batches bounded in rows and in bytes, so that very long texts do not meet in one batch.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def ready(spark: SparkSession) -> SparkSession:
    """Session settings of the library, bounded Arrow batches, and a package that Python workers find.

    Workers look for the package where the driver has it; where executors lack that path, ship it with --py-files.
    """
    prepare(spark)
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    return spark


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(divisor)


def map_batches(df: DataFrame, schema: str, work: Callable[[dict[str, list]], dict[str, list]]) -> DataFrame:
    """Apply ``work`` to every Arrow batch: a dict of Python lists in, a dict of lists out.

    String columns arrive as ``str``, binary ones as ``bytes``. ``work`` may return any number of rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = work({name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)})
            yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def fresh(names: Iterable[str], *wanted: str) -> list[str]:
    """Names like ``wanted`` that no column of ``names`` has in any spelling."""
    taken, out = {n.lower() for n in names}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def bounded_sample(df: DataFrame, rows: int, key: str) -> DataFrame:
    """At most ``rows`` rows, the first by a hash of ``key``: the same in every run.

    A filter on the hash comes first, with room for twice as many rows, so no task sends its own ``rows`` rows.
    """
    share = min(1.0, 2.0 * rows / max(df.count(), 1))
    spread = F.pmod(F.xxhash64(key), F.lit(1 << 30))
    return df.where(spread < F.lit(int(share * (1 << 30)))).orderBy(F.xxhash64(key), key).limit(rows)


def total_bytes(df: DataFrame, column: str) -> int:
    """Bytes of one text column over the whole table; one narrow aggregate."""
    return int(df.agg(F.sum(F.octet_length(column))).first()[0] or 0)
