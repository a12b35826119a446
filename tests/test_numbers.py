"""Percentiles, samples, profiles and functions against brute force."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given as hypothesis_given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farelake import functions as fn
from farelake.operators import percentiles as pc
from farelake.operators import profiling as pf
from farelake.operators import sampling as sm

PROBS = {"p25": 0.25, "p50": 0.5, "p90": 0.9}


def check_percentiles(spark, pdf):
    got = {
        r.k: (r.p25, r.p50, r.p90)
        for r in pc.exact_percentiles(spark.createDataFrame(pdf, "k string, v double"), ["k"], "v", PROBS).collect()
    }
    for key, group in pdf.groupby("k", dropna=False):
        want = np.percentile(group.v, [25, 50, 90])
        assert np.allclose(got[key if isinstance(key, str) else None], want, rtol=1e-12, atol=1e-12)


def test_percentiles_with_one_hot_group(spark):
    rng = np.random.default_rng(7)
    hot = pd.DataFrame({"k": "hot", "v": np.round(rng.lognormal(2, 2, 4000), 2)})
    cold = pd.DataFrame({"k": rng.choice(["a", "b", None], 500), "v": rng.normal(0, 10, 500)})
    same = pd.DataFrame({"k": "same", "v": np.zeros(300)})
    check_percentiles(spark, pd.concat([hot, cold, same], ignore_index=True))


def test_percentiles_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(pc, "BROADCAST_ROWS", 1)
    rng = np.random.default_rng(8)
    check_percentiles(spark, pd.DataFrame({"k": rng.choice(["a", "b"], 300), "v": rng.normal(0, 5, 300)}))


def test_percentiles_leave_out_what_is_no_number(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (float("nan"),), (float("inf"),)], "v double")
    assert pc.exact_percentiles(df, [], "v", {"m": 0.5}).first().m == 3.0  # infinity ranks above all numbers


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@hypothesis_given(st.lists(st.floats(-1e6, 1e6, allow_subnormal=False), min_size=1, max_size=40))
def test_percentiles_property(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = pc.exact_percentiles(df, [], "v", PROBS).first()
    assert np.allclose(tuple(row), np.percentile(values, [25, 50, 90]), rtol=1e-9, atol=1e-9)


@pytest.fixture(scope="module")
def skewed(spark):
    rows = [(f"r{i}", i % 2 if i % 3 else 0, None if i % 50 == 0 else float(i)) for i in range(900)]
    return spark.createDataFrame(rows, "trip_ref string, stratum int, value double")


@pytest.mark.parametrize("n", [0, 1, 17, 899, 900, 5000])
def test_random_sample_has_exact_size_and_repeats(skewed, n):
    first = {r.trip_ref for r in sm.sample_random(skewed, n).collect()}
    assert len(first) == min(n, 900)
    assert first == {r.trip_ref for r in sm.sample_random(skewed.repartition(7), n).collect()}
    if n == 17:
        assert first != {r.trip_ref for r in sm.sample_random(skewed, n, seed=1).collect()}


def test_random_sample_with_coarse_buckets_is_the_same(skewed, monkeypatch):
    fine = {r.trip_ref for r in sm.sample_random(skewed, 100).collect()}
    monkeypatch.setattr(sm, "PREFIX", 1)  # sixteen buckets: the cut falls inside one of them
    assert {r.trip_ref for r in sm.sample_random(skewed, 100).collect()} == fine


@pytest.mark.parametrize("n", [10, 101, 450])
def test_stratified_sample(skewed, n):
    got = sm.sample_stratified(skewed, n, "stratum").groupBy("stratum").count().collect()
    sizes = {r.stratum: r["count"] for r in skewed.groupBy("stratum").count().collect()}
    assert sum(r["count"] for r in got) == n
    for r in got:
        assert abs(r["count"] - n * sizes[r.stratum] / 900) <= 1


def test_stratified_sample_fills_up_from_rows_without_stratum(skewed):
    df = skewed.withColumn("stratum", F.when(F.col("stratum") == 1, 1))
    assert sm.sample_stratified(df, 300, "stratum").count() == 300
    with pytest.raises(ValueError):
        sm.sample_stratified(df, 3, "nothing")


def test_time_sample_of_nothing_is_an_error(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1))], "trip_ref string, tpep_pickup_datetime timestamp_ntz")
    assert sm.sample_time_range(df, 5, "2024-01-01", "2024-01-01").count() == 1
    with pytest.raises(ValueError):
        sm.sample_time_range(df, 5, "2025-01-01")


def test_profiles_against_pandas(skewed):
    pdf = skewed.toPandas()
    got = {r.column: r for r in pf.profile_numeric(skewed).collect()}
    want = pdf["value"].describe()
    row = got["value"]
    assert np.allclose([row["count"], row["mean"], row["std"], row["min"], row["p25"], row["p50"], row["p75"], row["max"]], want)
    schema = {r.column: r for r in pf.profile_schema(skewed).collect()}
    assert schema["value"].nulls == 18 and schema["value"].null_pct == 2.0
    assert [r.column for r in pf.missing_summary(skewed).collect()] == ["value"]
    top = pf.profile_categorical(skewed).collect()
    assert top[0].n_unique == 900 and len(top) == 5
    assert pf.duplicate_rows(skewed.unionByName(skewed.limit(3))).first().duplicates == 3


def test_all_null_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    row = pf.profile_numeric(df).first()
    assert row["count"] == 0 and row["mean"] is None and row["p50"] is None


def test_labels(spark):
    hours = spark.range(24).select(F.col("id").cast("int").alias("h"))
    got = [r.p for r in hours.select(fn.time_period("h").alias("p")).collect()]
    assert [got[h] for h in (0, 5, 6, 9, 10, 16, 20, 23)] == [
        "Late Night/Early Morning", "Late Night/Early Morning", "Morning Rush", "Morning Rush", "Midday",
        "Evening Rush", "Evening", "Evening",
    ]
    codes = spark.range(8).select(
        fn.payment_type_name("id").alias("a"), fn.payment_type_name("id", known=4).alias("b")
    ).collect()
    assert codes[5].a == "Unknown" and codes[5].b == "Other" and codes[7].a == "Other"
    day = spark.sql("SELECT timestamp_ntz'2024-01-07 10:00:00' AS t").select(
        fn.day_of_week("t").alias("d"), fn.weekday_from_monday("t").alias("w"), F.dayofweek("t").alias("s"),
        fn.day_name(fn.day_of_week("t")).alias("n"), fn.day_type(fn.day_of_week("t")).alias("k"),
        fn.calendar_key("t").alias("c"), fn.clock_key("t").alias("m"),
    ).first()
    assert tuple(day) == (0, 6, 1, "Sunday", "Weekend", 20240107, 1000)


def test_ratios_guard_zero(spark):
    df = spark.createDataFrame([(0.0, 5.0, 0.0), (10.0, None, 2.0), (None, 1.0, 1.0)], "fare_amount double, tip_amount double, trip_distance double")
    rows = df.select(fn.tip_percentage().alias("t"), fn.fare_per_mile().alias("f"), fn.guarded_ratio("tip_amount", "fare_amount").alias("g")).collect()
    assert [r.t for r in rows] == [0.0, None, 0.0]
    assert rows[0].f is None and rows[0].g is None and rows[1].f == 5.0


def test_rounding_lifts_binary_near_ties(spark):
    df = spark.createDataFrame([(1.005,), (-1.005,), (2.675,), (None,)], "v double")
    assert [r.x for r in df.select(fn.round_stable("v", 2).alias("x")).collect()] == [1.01, -1.01, 2.68, None]


def test_numeric_rounds_half_up_on_the_decimal(spark):
    from decimal import Decimal

    from farelake.operators.star import numeric

    values = [1.125, 99999999.125 / 10, 9999999.125, 1.0049999995, 1.005, -1.125, -2.675, 0.0, None]
    want = ["1.13", "9999999.91", "9999999.13", "1.00", "1.01", "-1.13", "-2.68", "0.00", None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.x for r in df.select(numeric(df["v"]).alias("x")).collect()]
    assert got == [None if w is None else Decimal(w) for w in want]
    wide = spark.createDataFrame([(99999999.125,)], "v double").select(fn.round_half_up("v", 2).cast("string").alias("x")).first().x
    assert wide.startswith("99999999.13")


def test_infinite_values_have_a_rank(spark):
    from farelake.operators.percentiles import exact_percentiles

    inf = float("inf")
    rows = [("a", v) for v in (1.0, 2.0, inf, inf, inf)] + [("b", v) for v in (-inf, 1.0, 3.0, float("nan"), None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.lo, r.mid, r.hi) for r in exact_percentiles(df, ["k"], "v", {"lo": 0.0, "mid": 0.5, "hi": 1.0}).collect()}
    assert got == {"a": (1.0, inf, inf), "b": (-inf, 1.0, 3.0)}


def test_sample_of_a_stratum_with_nearly_all_rows(spark):
    import hashlib

    from farelake.operators.sampling import sample_random, sample_stratified

    rows = [(f"k{i}", 1 if i % 100 else 2) for i in range(5000)]
    df = spark.createDataFrame(rows, "trip_ref string, payment_type int")
    smallest = sorted((k for k, _ in rows), key=lambda k: hashlib.md5(f"{k}-42".encode()).hexdigest())
    assert {r.trip_ref for r in sample_random(df, 300).collect()} == set(smallest[:300])
    got = sample_stratified(df, 500).collect()
    hot = [k for k in smallest if dict(rows)[k] == 1]
    assert len(got) == 500 and {r.trip_ref for r in got if r.payment_type == 1} == set(hot[:495])
