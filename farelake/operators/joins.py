"""Join helpers: broadcast only what has been counted, aggregate before joining."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def checked_broadcast(dim: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``dim`` with a broadcast hint if it has at most ``max_rows`` rows, else unchanged.

    The check counts no more than ``max_rows`` + 1 rows. Beyond the bound the join is planned
    as a shuffle join, where adaptive execution splits hot keys.
    """
    small = dim.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(dim) if small else dim


def partial_sums(fact: DataFrame, keys: list[str], measures: dict[str, Column], more: list[Column] = ()) -> DataFrame:
    """Rows, sums, non-null counts and the aggregates ``more`` per key: what a later roll-up needs to give sums and means.

    Reducing facts to their foreign keys first means a join with a dimension moves one row
    per key instead of one row per trip, so a hot key costs one row.
    """
    aggs = [F.count(F.lit(1)).alias("_n")]
    for name, value in measures.items():
        aggs += [F.sum(value).alias(f"_s_{name}"), F.count(value).alias(f"_c_{name}")]
    return fact.groupBy(*keys).agg(*aggs, *more)


def rows_total() -> Column:
    return F.sum("_n")


def sum_of(name: str) -> Column:
    return F.sum(f"_s_{name}")


def mean_of(name: str) -> Column:
    return F.sum(f"_s_{name}").cast("double") / F.nullif(F.sum(f"_c_{name}"), F.lit(0))
