"""Samples against plain Python, on few buckets so that every kind of ending bucket occurs, and the size of their plans."""

import hashlib
import random
import re

import pytest

from farelake.operators import sampling as sm


def digest(key, seed):
    return hashlib.md5(f"{key}-{seed}".encode()).hexdigest()


def brute_stratified(rows, n, seed):
    """Quota of each stratum by round-half-even, then trimmed or topped up by hash."""
    if n > len(rows):
        return {k for k, _ in rows}
    strata = {}
    for k, s in rows:
        strata.setdefault(s, []).append(k)
    chosen = []
    for s, keys in strata.items():
        if s is not None:
            chosen += sorted(keys, key=lambda k: digest(k, seed))[: round(len(keys) * (n / len(rows)))]
    chosen.sort(key=lambda k: digest(k, seed))
    if len(chosen) < n:
        rest = sorted({k for k, _ in rows} - set(chosen), key=lambda k: digest(k, seed))
        chosen += rest[: n - len(chosen)]
    return set(chosen[:n])


@pytest.mark.parametrize("digits", [1, 4])
@pytest.mark.parametrize("n", [0, 1, 7, 45, 100, 299, 300, 301])
def test_stratified_equals_plain_python(spark, monkeypatch, digits, n):
    monkeypatch.setattr(sm, "PREFIX", digits)
    rng = random.Random(n)
    rows = [(f"t{i}", rng.choice([1, 1, 1, 1, 2, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, None])) for i in range(300)]
    trips = spark.createDataFrame(rows, "trip_ref string, payment_type int")
    got = [r.trip_ref for r in sm.sample_stratified(trips, n, seed=5).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_stratified(rows, n, 5)


@pytest.mark.parametrize("n", [0, 1, 50, 299, 300, 400])
def test_random_equals_plain_python(spark, monkeypatch, n):
    monkeypatch.setattr(sm, "PREFIX", 1)
    trips = spark.createDataFrame([(f"t{i}", i) for i in range(300)], "trip_ref string, payment_type int")
    got = [r.trip_ref for r in sm.sample_random(trips, n, seed=5).collect()]
    assert sorted(got) == sorted(sorted((f"t{i}" for i in range(300)), key=lambda k: digest(k, 5))[:n])


def test_one_stratum_and_an_empty_table(spark):
    trips = spark.createDataFrame([(f"t{i}", None) for i in range(20)], "trip_ref string, payment_type int")
    assert sm.sample_stratified(trips, 5).count() == 5
    assert sm.sample_stratified(trips.where("1 = 0"), 5).count() == sm.sample_random(trips.where("1 = 0"), 5).count() == 0
    with pytest.raises(ValueError, match="not found"):
        sm.sample_stratified(trips, 5, stratum="none")


@pytest.mark.parametrize("n", [2_000, 1_990, 2_003])
def test_a_stratified_sample_scans_its_input_twice(spark, tmp_path, n):
    """Once for the histogram, once to select; what the plan reads besides is the stored end of each stratum."""
    path = str(tmp_path / "trips")
    spark.range(20_000).selectExpr("concat('t', id) AS trip_ref", "cast(id % 7 AS int) AS payment_type").write.parquet(path)
    plan = sm.sample_stratified(spark.read.parquet(path), n)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"^.*Relation", plan, re.M)) <= 2
