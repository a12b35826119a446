"""Exact-size samples that are the same in every run: rows with the smallest md5 of key and seed.

A first pass counts the rows of every stratum and every bucket of the first hash digits; that small histogram is stored.
Quotas, the bucket in which each stratum's sample ends, and the bucket in which a trimmed or topped-up sample ends all
follow from it. A second pass selects: rows before the last bucket are in, and only the rows of the last buckets are
ranked. No task sorts the table and the rows never meet in one place.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .joins import checked_broadcast

PREFIX = 4  # hex digits of the md5 that are counted: at most 65,536 buckets per stratum


def _digest(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key), F.lit(f"-{seed}")))


def _histogram(trips: DataFrame, stratum: str | None, seed: int, key: str) -> DataFrame:
    """Rows per stratum and hash bucket, stored: columns ``_s``, ``_b``, ``_in``."""
    value = F.col(stratum) if stratum else F.lit(0)
    counts = trips.groupBy(value.alias("_s"), F.substring(_digest(key, seed), 1, PREFIX).alias("_b"))
    return stored(counts.agg(F.count(F.lit(1)).alias("_in")), "sample_histogram")


def _end(counts: DataFrame, rows: int, column: str) -> tuple[str, int]:
    """The bucket that holds the last of ``rows`` rows in bucket order, and how many of its rows belong to them."""
    per_bucket = counts.groupBy("_b").agg(F.sum(column).alias("_in"))  # at most 16^PREFIX rows
    upto = F.sum("_in").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    before = (F.col("_upto") - F.col("_in")).alias("_before")
    last = per_bucket.withColumn("_upto", upto).where(F.col("_upto") >= rows).orderBy("_b").select("_b", before).first()
    return (last[0], rows - last[1]) if rows > 0 and last else ("", 0)


def _ranked(rows: DataFrame, by: list[str], end: Column) -> Column:
    """Rank by hash within ``by`` for the rows of an ending bucket; other rows get 0."""
    rank = F.row_number().over(Window.partitionBy(*by, F.when(~end, F.col("_h"))).orderBy("_h"))
    return F.when(end, rank).otherwise(F.lit(0))


def sample_random(trips: DataFrame, n: int = 10_000, seed: int = 42, key: str = "trip_ref") -> DataFrame:
    """Exactly ``n`` rows, or all rows if there are fewer. ``key`` must be unique."""
    counts = _histogram(trips, None, seed, key)
    rows = counts.agg(F.coalesce(F.sum("_in"), F.lit(0))).first()[0]
    return _first_rows(trips, counts, rows, n, seed, key)


def _first_rows(trips: DataFrame, counts: DataFrame, rows: int, n: int, seed: int, key: str) -> DataFrame:
    if n >= rows:
        return trips
    last, want = _end(counts, n, "_in")
    near = trips.withColumn("_h", _digest(key, seed)).withColumn("_b", F.substring("_h", 1, PREFIX)).where(F.col("_b") <= last)
    rank = _ranked(near, ["_b"], F.col("_b") == last)
    return near.withColumn("_n", rank).where(F.col("_n") <= want).select(*[F.col(f"`{c}`") for c in trips.columns])


def sample_stratified(
    trips: DataFrame, n: int = 10_000, stratum: str = "payment_type", seed: int = 42, key: str = "trip_ref"
) -> DataFrame:
    """Each stratum in proportion (rounded half to even), then topped up or trimmed to ``n``.

    Rows without stratum have no quota of their own and come in by the top-up only.
    """
    if stratum not in trips.columns:
        raise ValueError(f"column {stratum!r} not found")
    counts = _histogram(trips, stratum, seed, key)
    rows = counts.agg(F.coalesce(F.sum("_in"), F.lit(0))).first()[0]
    if n > rows:
        return trips
    # The same arithmetic as a fraction per stratum: round(size * (n / rows)).
    share = n / rows if rows else 0.0
    quota = F.bround(F.sum("_in").over(Window.partitionBy("_s")) * F.lit(share), 0).cast("long")
    running = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.withColumn("_quota", F.when(F.col("_s").isNull(), 0).otherwise(quota))
    placed = placed.withColumn("_before", F.sum("_in").over(running) - F.col("_in"))
    taken = F.least("_in", F.greatest(F.col("_quota") - F.col("_before"), F.lit(0)))
    placed = stored(placed.withColumn("_taken", taken).withColumn("_left", F.col("_in") - F.col("_taken")), "sample_quotas")
    total = placed.agg(F.coalesce(F.sum("_taken"), F.lit(0))).first()[0]
    # the bucket in which the sample of a stratum ends, and how many of its rows are in
    ends = placed.where("_taken > 0").groupBy(F.col("_s").alias("_of")).agg(F.max(F.struct("_b", "_taken")).alias("_end"))
    ends = checked_broadcast(stored(ends.select("_of", F.col("_end._b").alias("_last"), F.col("_end._taken").alias("_want")), "sample_ends"))
    trim = total > n
    if trim:
        bucket, want = _end(placed, n, "_taken")
    else:
        bucket, want = _end(placed, n - total, "_left")
    hashed = trips.withColumn("_h", _digest(key, seed)).withColumn("_b", F.substring("_h", 1, PREFIX))
    near = hashed.join(ends, F.col(stratum) == F.col("_of"), "left")
    mine, rest = F.col("_b") <= F.coalesce("_last", F.lit("")), F.col("_b") <= F.lit(bucket)
    near = near.where(mine & rest if trim else mine | rest)
    at_end = F.coalesce(F.col("_b") == F.col("_last"), F.lit(False))
    near = near.withColumn("_n", _ranked(near, ["_of", "_b"], at_end))
    near = near.withColumn("_chosen", F.coalesce((F.col("_b") < F.col("_last")) | at_end & (F.col("_n") <= F.col("_want")), F.lit(False)))
    # the rows that the trim leaves, or that the top-up adds: first by hash of the chosen, or of the others
    fits = F.col("_chosen") if trim else ~F.col("_chosen")
    at_bucket = fits & (F.col("_b") == F.lit(bucket))
    near = near.withColumn("_m", _ranked(near, ["_b", "_chosen"], at_bucket))
    inside = fits & ((F.col("_b") < F.lit(bucket)) | at_bucket & (F.col("_m") <= want))
    return near.where(inside if trim else F.col("_chosen") | inside).select(*[F.col(f"`{c}`") for c in trips.columns])


def sample_time_range(
    trips: DataFrame,
    n: int = 10_000,
    start: str | dt.datetime | None = None,
    end: str | dt.datetime | None = None,
    seed: int = 42,
    col: str = "tpep_pickup_datetime",
    key: str = "trip_ref",
) -> DataFrame:
    """Sample of the trips in [start, end]; an empty range is an error."""
    if col not in trips.columns:
        raise ValueError(f"column {col!r} not found")
    kept = trips
    if start is not None:
        kept = kept.where(F.col(col) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        kept = kept.where(F.col(col) <= F.lit(end).cast("timestamp_ntz"))
    counts = _histogram(kept, None, seed, key)
    rows = counts.agg(F.coalesce(F.sum("_in"), F.lit(0))).first()[0]
    if not rows:
        raise ValueError("no trips in the given time range")
    return _first_rows(kept, counts, rows, n, seed, key)


def sample_validation(
    trips: DataFrame, sample: DataFrame, columns: list[str] | None = None
) -> DataFrame:
    """Mean of numeric columns (all, or those given) in the data and in the sample, and the difference in %."""
    if columns is None:
        numeric = ("int", "bigint", "double", "float", "smallint")
        columns = [c for c, t in trips.dtypes if t in numeric]

    def means(df: DataFrame, name: str) -> DataFrame:
        row = df.agg(*[F.avg(c).alias(c) for c in columns])
        pairs = F.array(
            *[F.struct(F.lit(c).alias("column"), F.col(c).alias(name)) for c in columns]
        )
        return row.select(F.inline(pairs))

    diff = F.abs(F.col("original_mean") - F.col("sample_mean")) * 100.0 / F.nullif(
        F.col("original_mean"), F.lit(0.0)
    )
    return (
        means(trips, "original_mean")
        .join(means(sample, "sample_mean"), "column")
        .withColumn("diff_pct", F.when(F.col("original_mean") == 0, 0.0).otherwise(diff))
    )
