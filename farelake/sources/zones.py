"""Zone files and catalog tables: reading, writing, discovery and verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .commits import CommitLog, commit_attempt, newest, read_attempts

# What a crawled trip table has to look like.
EXPECTED_COLUMNS = 19
EXPECTED_PARTITIONS = ("year", "month")
KEY_COLUMNS = (
    "vendorid",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
)


def read_zone(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    year: int | None = None,
    month: int | None = None,
) -> DataFrame:
    """A zone partitioned by year and month; the two values prune folders, the columns the scan."""
    df = spark.read.parquet(path)
    if "run_id" in df.columns and not (columns and "run_id" in columns):
        df = df.drop("run_id")  # folder of the run that wrote the rows
    if year is not None:
        df = df.where(F.col("year") == year)
    if month is not None:
        df = df.where(F.col("month") == month)
    return df.select(*columns) if columns else df


def read_any(
    spark: SparkSession, path: str, nrows: int | None = None, schema: StructType | str | None = None
) -> DataFrame:
    """Parquet or CSV (also gzipped) by suffix; without ``schema`` CSV types are inferred."""
    low = path.lower().rstrip("/")
    if low.endswith(".parquet"):
        df = spark.read.parquet(path)
    elif low.endswith((".csv", ".csv.gz")):
        reader = spark.read.option("header", True)
        reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
        df = reader.csv(path)
    else:
        raise ValueError(f"unsupported file format: {path}")
    return df if nrows is None else df.limit(nrows)


def by_month(df: DataFrame) -> DataFrame:
    """Bring the rows of a month together before a partitioned write.

    Otherwise every task writes a file into every month it has seen. The rebalance is
    adaptive: a month with a large share of all rows is split, small ones are put together.
    """
    return df.hint("rebalance", "year", "month")


def write_processed(df: DataFrame, path: str, clustered: bool = False, run_id: str | None = None) -> None:
    """Append to the processed zone; ``clustered`` input (files of one month) is not moved again.

    With ``run_id`` the rows go under ``run_id=…`` and replace those of an earlier attempt of the same run. A zone is
    written either with run ids or without.
    """
    writer = (df if clustered else by_month(df)).write.partitionBy("year", "month")
    if run_id is None:
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").parquet(f"{path}/run_id={run_id}")


def write_curated(
    df: DataFrame, path: str, partition: tuple[str, ...] = (), dynamic: bool = False
) -> None:
    """Replace a curated dataset; ``dynamic`` replaces only the partitions that ``df`` holds."""
    writer = (df.hint("rebalance", *partition) if partition else df).write.mode("overwrite")
    if partition:
        writer = writer.partitionBy(*partition)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


_TABLE_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


def write_table(df: DataFrame, name: str, if_exists: str = "append", path: str | None = None) -> None:
    writer = df.write.mode(_TABLE_MODES[if_exists]).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_dead_letter(invalid: DataFrame, path: str, run_id: str) -> None:
    """Rejected rows under ``run_id=…``, for callers that write them alone; repeating the run replaces its rows."""
    # Few rows from many tasks: gather them into files of a sensible size.
    invalid.drop("run_id").hint("rebalance").write.mode("overwrite").parquet(f"{path}/run_id={run_id}")


VALID, REJECTED, SKIPPED = "processed", "dead_letter", "skipped"


def write_outcomes(
    judged: DataFrame, root: str, run_id: str, sinks: dict[str, Column], clustered: bool = False, near: Column | None = None,
    late: dict[str, Column] | None = None,
) -> dict[str, int]:
    """Write judged rows (column ``outcome``) into all their sinks at once and commit them together; rows per outcome.

    ``sinks`` maps outcomes to a sink; the rows of the sink ``skipped`` are kept as outcomes only, so that counts come from
    what was written and not from a second look at the input. One write goes into an attempt folder of its own, one record makes
    it current: a run that dies before has no rows anywhere, one that is repeated replaces its rows in every sink.

    Rows of equal ``near`` are brought together (default: of a sink and month). Skipped rows travel with the others then: by
    themselves they are so small when compressed that very many of them would meet in one task. Columns in ``late`` are left out
    of the move and computed after it.
    """
    sink = F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in sinks.items()], F.lit(SKIPPED))
    late, stays = late or {}, F.col("sink") != SKIPPED
    marked = judged.withColumn("sink", sink)
    kept = [c for c in marked.columns if c not in ("sink", "outcome", "failed_at")]
    rows = marked.select(*[F.when(stays, F.col(c)).alias(c) for c in kept if c not in late], "outcome", "sink", *[near.alias("near")] * (near is not None))
    if near is not None and not clustered:
        rows = rows.hint("rebalance", "near")
    rows = rows.withColumns({c: F.when(stays, value) for c, value in late.items()})
    rows = rows.withColumn("failed_at", F.when(F.col("sink") == REJECTED, F.current_timestamp()))
    rows = rows.select(*kept, "outcome", "failed_at", "sink")
    keys = [c for c in EXPECTED_PARTITIONS if c in kept]

    def outcomes(written: DataFrame) -> dict:
        return {"outcomes": {r["outcome"]: r["count"] for r in written.groupBy("outcome").count().collect()}}

    clustered = clustered or near is not None
    return commit_attempt(CommitLog(judged.sparkSession, root), rows, run_id, keys, outcomes, clustered=clustered)["outcomes"]


def committed_runs(spark: SparkSession, root: str) -> dict[str, dict]:
    """The record that counts of every run: its folder, its rows per sink and per outcome."""
    return newest(CommitLog(spark, root).records(), "run_id")


def read_outcomes(spark: SparkSession, root: str, sink: str = VALID, run_id: str | None = None) -> DataFrame:
    """Committed rows of a sink, of all runs or of one; rows of runs that did not commit are not there."""
    runs = committed_runs(spark, root)
    df = read_attempts(spark, root, [runs[run_id]] if run_id is not None else list(runs.values()), sink).drop("attempt")
    return df.drop("outcome", "failed_at", "failure_reason") if sink == VALID else df.drop("outcome")


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header; timestamps as 'yyyy-MM-dd HH:mm:ss', missing values empty."""
    columns = [
        F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
        if t in ("timestamp", "timestamp_ntz")
        else F.col(c).cast("string").alias(c)
        for c, t in df.dtypes
    ]
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def materialize(view: DataFrame, name: str, path: str | None = None) -> None:
    """Store the result of a view as a table; calling it again refreshes the table."""
    write_table(view, name, "replace", path)


def discover_schema(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Register the files under ``path`` as a table: merged schema, all partitions, nothing dropped.

    On a table that exists, columns of later files are added; types and columns it has stay as they are.
    """
    merged = spark.read.option("mergeSchema", True).parquet(path)
    if spark.catalog.tableExists(table):
        known = {c.lower() for c in spark.table(table).columns}
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in merged.schema if f.name.lower() not in known)
        if added:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
    else:
        keys = [c for c in EXPECTED_PARTITIONS if c in merged.columns]
        body = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in merged.schema)
        clause = f"PARTITIONED BY ({', '.join(keys)})" if keys else ""
        spark.sql(f"CREATE TABLE {table} ({body}) USING parquet {clause} LOCATION '{path}'")
    spark.sql(f"REFRESH TABLE {table}")
    if spark.sql(f"DESCRIBE TABLE {table}").where("col_name = '# Partition Information'").count():
        spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)


def verify_schema(zone: DataFrame, expected: int = EXPECTED_COLUMNS) -> DataFrame:
    """Findings about a zone: (kind, name, found, value). Mismatches are reported, never raised."""
    lower = {c.lower() for c in zone.columns}
    keys = [k for k in EXPECTED_PARTITIONS if k in lower]
    data = len(zone.columns) - len(keys)
    facts = [("columns", f"expected {expected}", data == expected, data)]
    facts += [("partition_key", k, k in lower, int(k in lower)) for k in EXPECTED_PARTITIONS]
    facts += [("key_column", c, c in lower, int(c in lower)) for c in KEY_COLUMNS]
    report = zone.sparkSession.createDataFrame(
        facts, "kind string, name string, found boolean, value long"
    )
    if not keys:
        return report
    parts = zone.groupBy(*keys).agg(F.count(F.lit(1)).alias("value"))
    name = F.concat_ws("/", *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys])
    return report.unionByName(
        parts.select(F.lit("partition").alias("kind"), name.alias("name"), F.lit(True).alias("found"), "value")
    )
