"""Exact interpolated percentiles by radix selection, whose work stays spread out however large a group is.

Spark's own ``percentile`` keeps every distinct value of a group in one aggregation buffer. Here the first pass counts rows
per group and value range and notes the least and the greatest value of each; the small result is stored, and running totals
tell which ranges hold the wanted ranks. A range of one value is an answer. Any other is split into ``CELLS`` even cells, which
are counted in the next pass over its rows only, and so on until every wanted cell holds one value. A pass is one aggregate
with map-side partial sums: no task looks at the values of a range, and the rows of the table are never shuffled.

The first pass can carry further sums (``measures``, ``more``), so that a query reads its input once for them and the ranges,
and once more for the cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .joins import BROADCAST_ROWS, partial_sums

RANGES_PER_DOUBLING = 32
CELLS = 1 << 14
_SHIFT = 2000 * RANGES_PER_DOUBLING  # above any |log2| of a finite double


def _value_range(v: Column) -> Column:
    """Number of the value range; grows with the value, 0 for 0, about 2 % wide. Infinite values have their own."""
    exponent = F.when(F.abs(v) == float("inf"), F.lit(2000.0)).otherwise(F.log2(F.abs(v)))
    spread = F.floor(exponent * RANGES_PER_DOUBLING) + _SHIFT
    return F.when(v > 0, spread).when(v < 0, -spread).otherwise(F.lit(0))


def _number(value: str) -> Column:
    """The value as a double; NULL for what is no number."""
    v = F.col(value).cast("double")
    return F.when(~F.isnan(v), v)


def range_parts(
    df: DataFrame, keys: list[str], value: str, measures: dict[str, Column] | None = None, more: list[Column] = (),
    also: list[str] = (),
) -> DataFrame:
    """First pass, stored: per key, ``also`` and value range the sums of ``partial_sums``, the aggregates ``more`` and the
    count, least and greatest value (``_in``, ``_lo``, ``_hi``). Rows whose value is no number are in a range NULL."""
    ranged = df.withColumn("_v", _number(value)).withColumn("_r", F.when(F.col("_v").isNotNull(), _value_range(F.col("_v"))))
    own = [F.count("_v").alias("_in"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), *more]
    return stored(partial_sums(ranged, [*keys, *also, "_r"], measures or {}, own), "range_parts")


def _marks(probs: dict[str, float]) -> list[Column]:
    """Wanted ranks of a group of ``_n`` values: slots 2 i and 2 i + 1 are the ends between which entry i lies."""
    marks = []
    for i, p in enumerate(probs.values()):
        pos = (F.col("_n") - 1) * F.lit(float(p))
        for side, rank in ((0, F.floor(pos)), (1, F.ceil(pos))):
            part = (pos - F.floor(pos)).alias("part")
            marks.append(F.struct(F.lit(2 * i + side).alias("slot"), rank.cast("long").alias("rank"), part))
    return marks


def _holding(cells: DataFrame, by: list[str], order: str, marks: Column) -> DataFrame:
    """Cells that hold a wanted rank, with these ranks in ``_m``; ``_from`` is the rank at which their values begin."""
    running = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    placed = cells.withColumn("_to", F.col("_base") + F.sum("_in").over(running)).withColumn("_from", F.col("_to") - F.col("_in"))
    inside = lambda m: (m["rank"] >= F.col("_from")) & (m["rank"] < F.col("_to"))
    return placed.withColumn("_m", F.filter(marks, inside)).where(F.size("_m") > 0)


def _open_cells(values: DataFrame, open_: DataFrame, k: list[str], n: int) -> DataFrame:
    """Rows of ``values`` (k, _v) that lie in an open cell, with the cell in ``_cell``.

    Open cells are a list per key, of two per wanted percentile at most. Without keys it is a constant of the plan.
    """
    cell = F.struct(F.col("_lo").alias("lo"), F.col("_hi").alias("hi"))
    lists = open_.groupBy(*k).agg(F.collect_list(cell).alias("_cells"))
    if k:
        lists = lists.select(*[F.col(c).alias(f"w{c}") for c in k], "_cells")
        same = F.lit(True)
        for c in k:
            same = same & F.col(c).eqNullSafe(F.col(f"w{c}"))
        values = values.join(F.broadcast(lists) if n <= BROADCAST_ROWS else lists, same)
    else:
        found = lists.first()[0]
        values = values.withColumn("_cells", F.array(*[F.struct(F.lit(c.lo).alias("lo"), F.lit(c.hi).alias("hi")) for c in found]))
    mine = F.filter("_cells", lambda c: (F.col("_v") >= c["lo"]) & (F.col("_v") <= c["hi"]))
    return values.withColumn("_cell", F.get(mine, 0)).where(F.size(mine) > 0)


def ranked_values(parts: DataFrame, df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """One row per key with a column per entry of ``probs`` (linear interpolation), from the first pass and ``df``.

    ``keys`` may be NULL. Further passes run when this is called, until every wanted cell holds one value; each is one
    aggregate over the values of the open cells, and its result is stored.
    """
    k = [f"_k{i}" for i in range(len(keys))]
    named = [F.col(c).alias(a) for c, a in zip(keys, k)]
    cells = parts.where("_in > 0").groupBy(*named, "_r").agg(F.sum("_in").alias("_in"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    sized = cells.withColumn("_n", F.sum("_in").over(Window.partitionBy(*k))).withColumn("_base", F.lit(0).cast("long"))
    columns = [*k, "_from", "_lo", "_hi", "_m"]
    held = stored(_holding(sized, k, "_r", F.array(*_marks(probs))).select(*columns), "wanted_ranges")
    values = df.select(*named, _number(value).alias("_v"))
    answers = []
    while True:
        answers.append(held.where("_lo = _hi"))
        open_ = held.where("_lo < _hi")
        n = open_.count()
        if not n:
            break
        at = F.floor((F.col("_v") - F.col("_cell.lo")) / (F.col("_cell.hi") - F.col("_cell.lo")) * CELLS)
        split = _open_cells(values, open_, k, n).withColumn("_at", F.least(at, F.lit(CELLS - 1)))
        counted = split.groupBy(*k, F.col("_cell.lo").alias("_of"), "_at").agg(
            F.count("_v").alias("_in"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
        )
        parents = open_.select(*[F.col(c).alias(f"p{c}") for c in k], F.col("_lo").alias("p_lo"), F.col("_from").alias("_base"), F.col("_m").alias("_marks"))
        same = F.col("_of") == F.col("p_lo")
        for c in k:
            same = same & F.col(c).eqNullSafe(F.col(f"p{c}"))
        found = counted.join(F.broadcast(parents) if n <= BROADCAST_ROWS else parents, same)
        held = stored(_holding(found, [*k, "_of"], "_at", F.col("_marks")).select(*columns), "wanted_cells")
    picked = answers[0]
    for more in answers[1:]:
        picked = picked.unionByName(more)
    picked = picked.select(*k, F.col("_lo").alias("_v"), F.explode("_m").alias("_m"))

    def at_slot(slot: int, what: str) -> Column:
        return F.max(F.when(F.col("_m.slot") == slot, F.col(what)))

    columns = []
    for i, name in enumerate(probs):
        low, high, part = at_slot(2 * i, "_v"), at_slot(2 * i + 1, "_v"), at_slot(2 * i, "_m.part")
        # between equal or infinite ends there is nothing to interpolate
        columns.append(F.when((low == high) | (part == 0), low).otherwise(low + (high - low) * part).alias(name))
    out = picked.groupBy(*k).agg(*columns)
    return out.select(*[F.col(a).alias(c) for c, a in zip(keys, k)], *probs)


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """One row per key with a column per entry of ``probs`` (linear interpolation).

    NULL and NaN are left out, infinite values are ranked; a key without values has no row.
    """
    return ranked_values(range_parts(df, keys, value), df, keys, value, probs)


def add_percentiles(grouped: DataFrame, parts: DataFrame, df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """``grouped`` (one row per key) extended by exact percentiles of ``df``, whose first pass is ``parts``."""
    extra = ranked_values(parts, df, keys, value, probs)
    renamed = extra.select(*[F.col(c).alias(f"_p_{c}") for c in keys], *probs)
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_p_{c}"))
    return grouped.join(renamed, same, "left").drop(*[f"_p_{c}" for c in keys])
