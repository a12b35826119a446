"""A commit log below a folder: what has been written counts once its record stands in the log.

Writers put their data into an attempt folder of their own and append one numbered record. Records are written beside the log
and moved into place under the next free number; the move fails if another writer has taken it, so of two racing writers
one wins and the other one sees a conflict. Readers resolve the log, so data without a record is never seen.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import dropping_shuffles

LOG = "_log"
DIGITS = 12
#: Attempts that were replaced keep their files, so these are written small: a quarter less than with snappy for trips.
COMPRESSION = "zstd"


class CommitConflict(RuntimeError):
    """Another writer has committed since the log was read."""


class CommitLog:
    """The log of ``root``. Every record is a JSON object; ``version`` is the number of the newest one, 0 for none."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = self._hadoop.Path(f"{self.root}/{LOG}")
        self._files = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        if not self._files.exists(self._path):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(self._path)]
        return sorted(int(n[:DIGITS]) for n in names if n.endswith(".json") and n[:DIGITS].isdigit())

    @property
    def version(self) -> int:
        return max(self._numbers(), default=0)

    def records(self, upto: int | None = None) -> list[dict]:
        """Records in order, with their number as ``version``."""
        numbers = [n for n in self._numbers() if upto is None or n <= upto]
        if not numbers:
            return []
        paths = [f"{self.root}/{LOG}/{n:0{DIGITS}d}.json" for n in numbers]
        rows = self.spark.read.option("wholetext", True).text(paths).collect()
        return sorted((json.loads(r.value) for r in rows), key=lambda r: r["version"])

    def append(self, record: dict, expected: int | None = None) -> int:
        """Commit ``record`` as the next version and return its number.

        With ``expected`` the log must still end there, else ``CommitConflict``; without it the next free number is taken.
        """
        while True:
            number = (self.version if expected is None else expected) + 1
            if self._move_in(json.dumps(record | {"version": number}), number):
                return number
            if expected is not None:
                raise CommitConflict(f"version {number} of {self.root} was committed by another writer")

    def _move_in(self, text: str, number: int) -> bool:
        beside = self._hadoop.Path(f"{self.root}/{LOG}/.{uuid.uuid4().hex}.tmp")
        place = self._hadoop.Path(f"{self.root}/{LOG}/{number:0{DIGITS}d}.json")
        out = self._files.create(beside, False)
        out.write(bytearray(text.encode()))
        out.close()
        context = self._hadoop.FileContext.getFileContext(self._files.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark._sc._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            context.rename(beside, place, options)
            return True
        except Py4JJavaError as e:
            self._files.delete(beside, False)
            if "FileAlreadyExists" in e.java_exception.toString():
                return False
            raise


def ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def commit_attempt(
    log: CommitLog, df: DataFrame, run_id: str, keys: list[str], note: Callable[[DataFrame], dict], extra: dict | None = None,
    clustered: bool = False,
) -> dict:
    """Write ``df`` (column ``sink`` and further partition ``keys``) into an attempt folder in one job and commit it.

    ``note`` looks at the rows written and returns what the record says beside its rows per sink, its folder and schema. What the
    write has shuffled is removed when it ends: attempts that follow each other in one application never have it on disk together.
    """
    spark, folder = log.spark, f"run_id={run_id}/attempt={uuid.uuid4().hex}"
    keys = ["sink", *keys]
    path = f"{log.root}/attempts/{folder}"
    rows = df if clustered else df.hint("rebalance", *keys)
    with dropping_shuffles(df.sparkSession):
        rows.write.partitionBy(*keys).parquet(path, compression=COMPRESSION)
    fields = [f for f in df.schema.fields if f.name not in keys] + [df.schema[k] for k in keys]
    schema = StructType(fields).add("run_id", "string").add("attempt", "string")
    written = spark.read.schema(schema).option("basePath", f"{log.root}/attempts").parquet(path)
    counts = {r["sink"]: r["count"] for r in written.groupBy("sink").count().collect()}
    record = {"run_id": run_id, "folder": folder, "counts": counts, "schema": ddl(schema)} | note(written) | (extra or {})
    log.append(record)
    return record


def newest(records: list[dict], key: str) -> dict:
    """The last record of each value of ``key``: a repeated run replaces what it committed before."""
    return {r[key]: r for r in records}


def read_attempts(spark: SparkSession, root: str, records: list[dict], sink: str) -> DataFrame:
    """Rows of one sink of the given attempts; the attempt's folder names come back as columns.

    The schema is that of the newest record, so nothing is inferred and attempts without rows in the sink need no files.
    """
    if not records:
        raise ValueError(f"nothing has been committed to {root}")
    base = f"{root.rstrip('/')}/attempts"
    paths = [f"{base}/{r['folder']}/sink={sink}" for r in records if r["counts"].get(sink)]
    schema = max(records, key=lambda r: r["version"])["schema"]
    if not paths:
        return spark.createDataFrame([], schema).drop("sink")
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).drop("sink")
