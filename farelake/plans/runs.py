"""Whole runs, from raw trips to stored zones and tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bloom, cleaning, curated, quality, star
from ..operators.profiling import sample_statistics
from ..session import stored
from ..sources import zones
from ..sources.commits import CommitConflict, CommitLog
from . import star_queries


def new_run_id() -> str:
    return f"{dt.datetime.now():%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:6]}"


def run_processed(
    trips: DataFrame, root: str, run_id: str | None = None, mode: str = "complete", clustered: bool = False
) -> dict[str, int | str]:
    """Derive, filter, check, write valid trips and dead letters together; returns counts per outcome.

    The input is read once: rows are judged in one expression and written by outcome in one job, and one record commits both
    sinks. Read them with ``zones.read_outcomes``. A run that dies in between shows nothing, a run that is repeated replaces
    its rows, and a failed write of dead letters fails the run. The counts are taken from the rows written, as accumulators
    would count a task again when its executor is lost.
    """
    run_id = run_id or new_run_id()
    outcomes = zones.write_outcomes(quality.etl_outcome(trips, mode=mode), root, run_id, quality.sinks(), clustered, **quality.moved_once())
    known = [quality.OK, quality.PRE_FILTERED, quality.LOST, *quality.REASON_METRICS]
    return {"run_id": run_id, "records_processed": sum(outcomes.values())} | {o: outcomes.get(o, 0) for o in known}


def processed_report(spark: SparkSession, root: str, run_id: str) -> tuple[DataFrame, DataFrame]:
    """What a processed run reports at its end, from its stored rows: averages with pickup range, rows per month."""
    stored = zones.read_outcomes(spark, root, run_id=run_id)
    return quality.quality_report(stored), quality.records_by_month(stored)


def run_curated(processed: DataFrame, curated_path: str) -> dict[str, str]:
    """Write the six curated datasets; each scan of the zone reads only the columns it needs."""
    paths = {}
    for name, (build, partition) in curated.CURATED_DATASETS.items():
        paths[name] = f"{curated_path}/{name}"
        zones.write_curated(build(processed), paths[name], partition)
    return paths


STAR_TABLES = ("dim_location", "dim_time", "dim_rate", "fact_trips")


def run_star(trips: DataFrame, root: str, load_id: str | None = None, enforce: bool = True) -> str:
    """Extend the star schema by a load, all or nothing, at the cost of what it adds.

    A load writes a folder of its own: the zones and times that the dimensions lack, and the facts whose trip (reference and
    pickup time) is not there yet. Its commit record holds the range of its pickup times and where its Bloom filter of trips
    lies, so a later load looks only at earlier ones whose times overlap with its own, and compares those trips only with their
    facts that the filter has seen. The input is read for the keys and again for the facts. A repeated load adds nothing, a failed
    one leaves the loads before it in place. If
    another load commits in between, the commit is refused and the load starts again from what is there then. With
    ``enforce`` a violated constraint stops the load, as it would stop the transaction.
    """
    spark, load_id = trips.sparkSession, load_id or new_run_id()
    log = CommitLog(spark, root)
    facts = star.build_fact_trips(trips)
    times = stored(star.pickup_times(trips).withColumn("time_id", star.time_id("pickup_datetime")), "times")
    zones_seen = stored(star.missing_locations(trips), "zones_seen")
    while True:
        version = log.version
        try:
            log.append(_load(spark, root, load_id, log.records(version), facts, times, zones_seen, enforce), expected=version)
            return load_id
        except CommitConflict:
            continue


def _load(
    spark: SparkSession, root: str, load_id: str, records: list[dict], facts: DataFrame, times: DataFrame, zones_seen: DataFrame,
    enforce: bool,
) -> dict:
    """Write what the loads in ``records`` lack and return the record of the load."""
    folder = f"{root.rstrip('/')}/loads/{load_id}/{uuid.uuid4().hex}"
    low, high = times.agg(F.min("time_id"), F.max("time_id")).first()
    near = [r for r in records if r["rows"]["dim_time"] and low is not None and r["low"] <= high and low <= r["high"]]
    now = _tables(spark, records)
    facts = _not_there(spark, facts, near)
    if near:
        # times of loads that do not overlap cannot be among the new ones
        known = spark.read.parquet(*[f"{r['folder']}/dim_time" for r in near]).where(F.col("time_id").between(low, high))
        times = times.join(known.select("time_id"), "time_id", "left_anti")
    if records:
        unseen = zones_seen.join(now["dim_location"].select("location_id"), "location_id", "left_anti")
        places = star.unknown_locations(unseen)
    else:
        places = star.seed_locations(spark).unionByName(star.unknown_locations(zones_seen))
    times, rates = star.time_attributes(times), star.build_dim_rate(spark)
    tables = {"dim_location": places, "dim_time": times, "dim_rate": rates.limit(0) if records else rates}
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}")
    # a month together and in the order of time, so that a later load skips row groups of other times
    by_month = facts.withColumn("month", star.pickup_month()).hint("rebalance", "month").sortWithinPartitions("time_id")
    by_month.drop("month").write.parquet(f"{folder}/fact_trips")
    added = spark.read.schema(facts.schema).parquet(f"{folder}/fact_trips")
    rows = {name: spark.read.schema(df.schema).parquet(f"{folder}/{name}").count() for name, df in tables.items()}
    rows["fact_trips"] = added.count()
    bits = bloom.size(rows["fact_trips"])
    bloom.build(added, TRIP, bits).write.parquet(f"{folder}/bloom")
    record = {"load_id": load_id, "folder": folder, "rows": rows, "low": low, "high": high, "bits": bits, "layout": bloom.LAYOUT}
    if enforce and any(rows.values()):
        # Checked on the stored tables: every one of them was computed once.
        whole = _tables(spark, [*records, record])
        broken = star.constraint_check(added, whole["dim_time"], whole["dim_location"], whole["dim_rate"]).where("violations > 0")
        faults = [f"{r['constraint']}: {r['violations']}" for r in broken.collect()]
        if faults:
            raise ValueError(f"load {load_id} violates {', '.join(sorted(faults))}")
    return record


TRIP = ["trip_id", "time_id"]


def _not_there(spark: SparkSession, facts: DataFrame, records: list[dict]) -> DataFrame:
    """The facts whose trip is in none of the given loads.

    A load's filter lets few trips pass that are not there, so its facts are joined with few keys, unless they repeat. Loads have
    no trip in common, so the trips found in each of them add up; if they are all, nothing is joined again.
    """
    asked: list[DataFrame] = []
    there = []
    for r, keys in zip(_loads_that_may_hold(spark, facts, records, asked), asked):
        low, high = keys.agg(F.min("time_id"), F.max("time_id")).first()
        known = spark.read.parquet(f"{r['folder']}/fact_trips").select(*TRIP).where(F.col("time_id").between(low, high))
        there.append(keys.join(known, TRIP, "left_semi"))
    found = sum(t.count() for t in there)
    if not found:
        return facts
    if found == facts.count():
        return facts.limit(0)
    return facts.join(stored(reduce(DataFrame.unionByName, there), "there"), TRIP, "left_anti")


def _loads_that_may_hold(spark: SparkSession, facts: DataFrame, records: list[dict], asked: list[DataFrame] | None = None) -> list[dict]:
    """Of the given loads those whose filter has seen one of the facts' trips; ``asked`` takes up which trips."""
    found = []
    for r in (r for r in records if r["rows"]["fact_trips"]):
        if r.get("layout") == bloom.LAYOUT:
            keys = bloom.may_hold(facts, TRIP, spark.read.parquet(f"{r['folder']}/bloom"), r["bits"])
        else:  # written by an earlier version, whose filters lie otherwise
            keys = stored(facts.select(*TRIP), "asked")
        if keys is not None:
            found.append(r)
            if asked is not None:
                asked.append(keys)
    return found


def _tables(spark: SparkSession, records: list[dict]) -> dict[str, DataFrame]:
    """All loads together: every load holds what it added to each table."""
    if not records:
        return {}
    tables = {}
    for t in STAR_TABLES:
        filled = [r for r in records if r["rows"][t]] or records[:1]
        tables[t] = spark.read.parquet(*[f"{r['folder']}/{t}" for r in filled])
    return tables


def current_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Dimensions and facts of all committed loads."""
    return _tables(spark, CommitLog(spark, root).records())


def star_questions(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The sample questions that end a load, on the stored tables."""
    t = current_star(spark, root)
    return {
        "rds_top_pickups": star_queries.rds_top_pickups(t["fact_trips"], t["dim_location"], k=10),
        "rds_hourly": star_queries.rds_hourly(t["fact_trips"], t["dim_time"]),
        "rds_weekend": star_queries.rds_weekend(t["fact_trips"], t["dim_time"]),
    }


def run_week1(
    trips: DataFrame, table: str, if_exists: str = "append", path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Clean, store as a table, then (stored rows, their statistics)."""
    zones.write_table(cleaning.clean_ingest(trips), table, if_exists, path)
    stored = trips.sparkSession.table(table)
    return stored, sample_statistics(stored)


def report(run: Callable[[], dict[str, int | str]], spark: SparkSession) -> DataFrame:
    """Counts of a run as rows (item, n)."""
    items = [(k, v) for k, v in run().items() if isinstance(v, int)]
    return spark.createDataFrame(items, "item string, n long")
