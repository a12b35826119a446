"""Radix selection against numpy, on few and narrow cells so that several levels are needed, and how often it reads its input."""

import numpy as np
import pandas as pd
import pytest
from conftest import SF
from pyspark.sql import functions as F

from farelake.operators import percentiles as pc
from farelake.operators import profiling as pf
from farelake.operators.curated import curated_trips
from farelake.plans import views
from farelake.sources import given_tables as given

PROBS = {"lo": 0.0, "p31": 0.31, "mid": 0.5, "hi": 1.0}


def counted(df):
    """``df`` and a counter of the rows that are read from it."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(count, df.schema), seen


@pytest.mark.parametrize("cells, ranges, broadcast", [(2, 1, 100), (8, 1, 0), (1 << 14, 32, 100)])
def test_a_continuous_column_under_one_key(spark, monkeypatch, cells, ranges, broadcast):
    monkeypatch.setattr(pc, "CELLS", cells)
    monkeypatch.setattr(pc, "RANGES_PER_DOUBLING", ranges)
    monkeypatch.setattr(pc, "_SHIFT", 2000 * ranges)
    monkeypatch.setattr(pc, "BROADCAST_ROWS", broadcast)
    rng = np.random.default_rng(cells)
    values = np.concatenate([rng.normal(0, 1, 900), rng.lognormal(0, 9, 300), -rng.lognormal(0, 9, 200), [0.0, -0.0, 5e-324, -5e-324, 1e308, -1e308]])
    keys = rng.choice(["hot", "hot", "hot", None, "x"], len(values))
    pdf = pd.DataFrame({"k": keys, "v": values})
    got = {r.k: tuple(r)[1:] for r in pc.exact_percentiles(spark.createDataFrame(pdf, "k string, v double"), ["k"], "v", PROBS).collect()}
    for k in ("hot", None, "x"):
        own = values[[x is k or x == k for x in keys]]
        assert np.allclose(got[k], np.percentile(own, [100 * p for p in PROBS.values()]), rtol=1e-12, atol=0)


def test_neighbouring_doubles_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(pc, "CELLS", 2)
    values = [1.0]
    for _ in range(40):
        values.append(float(np.nextafter(values[-1], 2)))
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert tuple(pc.exact_percentiles(df, [], "v", {"a": 0.25, "b": 0.5, "c": 0.975}).first()) == (values[10], values[20], values[39])


def test_one_value_per_key_needs_no_second_pass(spark):
    df, seen = counted(spark.range(50).select((F.col("id") % 5).alias("k"), (F.col("id") % 5).cast("double").alias("v")))
    assert sorted(map(tuple, pc.exact_percentiles(df, ["k"], "v", {"m": 0.5}).collect())) == [(k, float(k)) for k in range(5)]
    assert seen.value == 50


def test_profiles_read_their_input_twice(spark):
    trips = given.trips(spark, SF).select("trip_distance", "fare_amount", "passenger_count", "tpep_pickup_datetime", "tip_amount")
    for profile in (pf.profile_numeric, pf.sample_statistics):
        df, seen = counted(trips)
        profile(df).collect()
        assert seen.value == 2 * trips.count()


@pytest.mark.parametrize("view", [views.v_daily_revenue, views.v_payment_analysis, views.v_location_performance])
def test_views_read_their_input_twice(spark, view):
    curated = curated_trips(given.trips(spark, SF))
    df, seen = counted(curated)
    view(df).collect()
    assert seen.value <= 2 * curated.count()


def test_profile_of_empty_and_constant_columns(spark):
    df = spark.createDataFrame([(1.0, None, 1e9), (1.0, None, 1e9 + 1), (1.0, None, 1e9 + 2)], "a double, b double, c double")
    got = {r["column"]: r for r in pf.profile_numeric(df).collect()}
    assert (got["a"]["count"], got["a"]["std"], got["a"]["p50"]) == (3, 0.0, 1.0)
    assert got["b"]["count"] == 0 and got["b"]["mean"] is None and got["b"]["p50"] is None
    assert got["c"]["std"] == pytest.approx(1.0) and got["c"]["p25"] == 1e9 + 0.5
