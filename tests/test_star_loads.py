"""Star loads move little: a filter's bitmaps are built in one place, and only trips it has seen are compared with facts."""

from pyspark.sql import functions as F
from test_storage import SF

from farelake.operators import bloom
from farelake.operators import cleaning as c
from farelake.operators import star as s
from farelake.plans import runs
from farelake.sources import given_tables as given


def test_a_filter_sees_all_its_keys_and_hardly_any_other(spark):
    keys = spark.range(40_000).select(F.concat(F.lit("t-"), "id").alias("k"), (F.col("id") * 7).alias("t"))
    mine, other = keys.where("t < 140000"), keys.where("t >= 140000")
    bits = bloom.size(20_000)
    built = bloom.build(mine, ["k", "t"], bits)
    assert bloom.seen(mine.union(mine), ["k", "t"], built, bits).count() == 40_000
    assert bloom.seen(other, ["k", "t"], built, bits).count() < 40
    assert bloom.may_hold(other.limit(0), ["k", "t"], built, bits) is None


def test_the_bitmaps_of_a_filter_are_not_shuffled(spark):
    built = bloom.build(spark.range(1000), ["id"], bloom.size(1000))
    plan = built._jdf.queryExecution().optimizedPlan().toString(), built._jdf.queryExecution().executedPlan().toString()
    assert plan[1].count("Exchange") == 1 and plan[1].index("Exchange") > plan[1].rindex("bitmap_construct_agg")


def test_a_load_that_repeats_in_part_adds_the_rest(spark, tmp_path):
    root, good = str(tmp_path), c.raw_to_processed(given.trips(spark, SF))
    half = good.where("VendorID = 1")
    runs.run_star(half, root)
    mixed = good.where("VendorID = 2 OR hour(tpep_pickup_datetime) < 9")
    runs.run_star(mixed, root)
    got = runs.current_star(spark, root)["fact_trips"]
    want = s.build_fact_trips(good.where("VendorID = 1 OR VendorID = 2"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    runs.run_star(mixed, root)
    assert runs.current_star(spark, root)["fact_trips"].count() == want.count()
