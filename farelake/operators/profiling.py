"""Column profiles: every operator is one wide aggregate, turned into rows at the end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .percentiles import add_percentiles, range_parts, ranked_values

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")
_TIMES = ("timestamp", "timestamp_ntz", "date")


def _columns(df: DataFrame, kinds) -> list[str]:
    return [c for c, t in df.dtypes if t in kinds]


def _percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.round(F.try_divide(part * 100.0, whole) + 1e-9, 2), F.lit(0.0))


def profile_schema(df: DataFrame) -> DataFrame:
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(f"c_{c}") for c in df.columns])
    items = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("column"),
                F.lit(t).alias("type"),
                F.col(f"c_{c}").alias("non_null"),
                (F.col("_n") - F.col(f"c_{c}")).alias("nulls"),
                _percent(F.col("_n") - F.col(f"c_{c}"), F.col("_n")).alias("null_pct"),
            )
            for i, (c, t) in enumerate(df.dtypes)
        ]
    )
    return counts.select(F.inline(items))


def missing_summary(df: DataFrame) -> DataFrame:
    """Columns that have missing values."""
    return profile_schema(df).where(F.col("nulls") > 0).select("column", "nulls", "null_pct")


def _long_form(df: DataFrame, columns: list[str], *further: Column) -> DataFrame:
    """A row (column, value) for each row and column, with further columns beside the first of them only."""
    structs = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"), *[(x if i == 0 else F.lit(None)).alias(f"x{j}") for j, x in enumerate(further)])
        for i, c in enumerate(columns)
    ]
    return df.select(F.inline(F.array(*structs)))


def profile_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, standard deviation, extremes and exact quartiles per numeric column.

    All follow from one pass that sums every column up per value range, and one over the values of the ranges that the
    quartiles lie in. Variances of ranges are put together about their own means, so nothing cancels.
    """
    columns = columns or _columns(df, _NUMERIC)
    values, key = _long_form(df, columns), ["column"]
    value = F.col("value")
    own = [F.count(value).alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"), F.var_pop(value).alias("var"),
           F.min(value).alias("least"), F.max(value).alias("most")]
    parts = range_parts(values, key, "value", more=own)
    whole = parts.groupBy(*key).agg(F.sum("n").alias("count"), (F.sum("total") / F.sum("n")).alias("mean"), F.min("least").alias("min"), F.max("most").alias("max"))
    spread = F.col("var") * F.col("n") + F.col("n") * F.pow(F.col("part_mean") - F.col("mean"), 2)
    about = parts.select(*key, "n", "var", F.col("mean").alias("part_mean")).join(F.broadcast(whole.select(*key, "mean")), key)
    std = about.groupBy(*key).agg(F.sqrt(F.sum(spread) / F.nullif(F.sum("n") - 1, F.lit(0))).alias("std"))
    out = whole.join(std, key).select(*key, "count", "mean", "std", "min", "max")
    return add_percentiles(out, parts, values, key, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75})


def profile_categorical(df: DataFrame, columns: list[str] | None = None, k: int = 5) -> DataFrame:
    """Per text column: number of distinct values and the ``k`` most frequent with their share.

    Values are counted map-side; ``row_number() <= k`` is applied to every partition before
    the per-column shuffle, so a column of unique values does not gather in one task.
    """
    columns = columns or _columns(df, ("string",))
    values = df.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
        )
    )
    counts = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("column").agg(
        F.count("value").alias("n_unique"), F.sum("n").alias("_rows")
    )
    order = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    top = (
        counts.where(F.col("value").isNotNull())
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
    )
    return top.join(totals, "column").select(
        "column", "n_unique", "rank", "value", "n", _percent(F.col("n"), F.col("_rows")).alias("pct")
    )


def profile_datetime(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or _columns(df, _TIMES)
    row = df.agg(
        *[F.min(c).alias(f"min_{c}") for c in columns], *[F.max(c).alias(f"max_{c}") for c in columns]
    )
    items = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"min_{c}").alias("min"),
                F.col(f"max_{c}").alias("max"),
                F.timestamp_diff("SECOND", F.col(f"min_{c}"), F.col(f"max_{c}")).alias("range_seconds"),
            )
            for c in columns
        ]
    )
    return row.select(F.inline(items))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row; copies collapse map-side, so a mass of copies is cheap.

    Rows meet by a 256-bit digest of their values as text (with -0.0 as 0.0), so only the digest is shuffled.
    """
    values = [
        F.coalesce(F.concat(F.lit("="), (F.col(f"`{c}`") + F.lit(0.0) if t in ("double", "float") else F.col(f"`{c}`")).cast("string")), F.lit("-"))
        for c, t in df.dtypes
    ]
    sizes = F.concat_ws(",", *[F.length(v) for v in values])  # keeps apart values that meet at different places
    groups = df.select(F.sha2(F.concat_ws("|", sizes, *values), 256).alias("_row")).groupBy("_row").agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    ).withColumn("duplicate_pct", _percent(F.col("duplicates"), F.col("row_count")))


def sample_statistics(trips: DataFrame) -> DataFrame:
    """One row of headline statistics; the smallest value wins a tie of the mode.

    One pass sums distance, fare and passengers up per value range, a second one looks for the medians. The counts per number
    of passengers come from the first one too, as that column is split by its values.
    """
    values, key = _long_form(trips, ["trip_distance", "fare_amount", "passenger_count"], F.col("tpep_pickup_datetime")), ["column"]
    values = values.withColumn("each", F.when(F.col("column") == "passenger_count", F.col("value")))
    value, more = F.col("value"), [F.min("x0").alias("first"), F.max("x0").alias("last"), F.max("value").alias("most")]
    parts = range_parts(values, key, "value", {"value": value}, more, also=["each"])
    medians = ranked_values(parts.where("column != 'passenger_count'"), values, key, "value", {"median": 0.5})
    of = lambda c, what: F.sum(F.when(F.col("column") == c, F.col(what)))
    mean = lambda c: of(c, "_s_value").cast("double") / F.nullif(of(c, "_c_value"), F.lit(0))
    common = parts.where("each IS NOT NULL").groupBy("each").agg(F.sum("_n").alias("n"))
    mode = common.agg(F.max_by("each", F.struct("n", (-F.col("each")).alias("smallest"))).alias("m"))
    whole = parts.agg(
        F.coalesce(of("trip_distance", "_n"), F.lit(0)).alias("total_trips"),
        F.min("first").alias("date_start"),
        F.max("last").alias("date_end"),
        mean("trip_distance").alias("distance_mean"),
        F.max(F.when(F.col("column") == "trip_distance", F.col("most"))).alias("distance_max"),
        mean("fare_amount").alias("fare_mean"),
        of("fare_amount", "_s_value").alias("fare_total"),
        mean("passenger_count").alias("passengers_mean"),
    )
    median = lambda c: F.max(F.when(F.col("column") == c, F.col("median")))
    m = medians.agg(F.struct(median("trip_distance").alias("distance"), median("fare_amount").alias("fare"))).scalar()
    kind = trips.schema["passenger_count"].dataType
    return whole.withColumns(
        {"passengers_mode": mode.select(F.col("m").cast(kind)).scalar(), "distance_median": m["distance"], "fare_median": m["fare"]}
    )
