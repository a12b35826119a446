"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every operator relies on; all of them are dynamic SQL confs, so
# they can be applied to a session that somebody else created.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM does not compile methods beyond 8000 bytes of bytecode. Wide trip projections
    # under many filters exceed that and would run interpreted; past this limit Spark
    # falls back to smaller generated functions, which are compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin UTC and adaptive execution on an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# Off by default: shuffle files stay until the driver collects its garbage, which on a cluster it hardly ever does.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside remove their shuffle files when they end, for large moves that nothing reads again.

    A later action on the very same result would compute its stages again, so the setting is not one of the whole session.
    """
    if spark.conf.get(DROP_SHUFFLES, None) == "true":
        yield  # on already: whoever set it decides when it ends
        return
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES)


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the bench; on a cluster the caller brings the session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("farelake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a local
    session may fall back to a machine-local temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/farelake-{uuid.uuid4().hex}/{label}"
    if spark.conf.get("spark.master", "local").startswith("local"):
        return f"{tempfile.mkdtemp(prefix='farelake-')}/{label}"
    raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a small intermediate result to the scratch folder and read it back, so that it is computed once.

    Unlike a cached one it outlives lost executors.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
