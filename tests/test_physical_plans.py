"""What the plans have to look like for large inputs."""

import re

import pytest

from conftest import SF
from farelake.operators import cleaning as c
from farelake.operators import curated as cu
from farelake.operators import profiling as pf
from farelake.operators import star as s
from farelake.plans import star_queries as sq
from farelake.plans import views as v
from farelake.sources import given_tables as given
from farelake.sources import zones as z


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", autouse=True)
def whole_plan_text(spark):
    names = {"spark.sql.maxMetadataStringLength": "20000", "spark.sql.debug.maxToStringFields": "500"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.fixture(scope="module")
def zone(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("zone") / "processed")
    z.write_processed(c.raw_to_processed(given.trips(spark, SF)), path)
    return path


def test_zone_scan_prunes_partitions_and_columns(spark, zone):
    text = plan(z.read_zone(spark, zone, ["fare_amount"], 1998, 3).where("fare_amount > 10"))
    assert re.search(r"PartitionFilters: \[.*year.*1998.*month.*3", text)
    assert "ReadSchema: struct<fare_amount:double>" in text
    assert "GreaterThan(fare_amount,10.0)" in text


def test_filters_reach_the_scan(spark, zone):
    text = plan(c.filter_basic(spark.read.parquet(zone)))
    assert "GreaterThan(trip_distance,0.0)" in text and "Exchange" not in text


def test_row_wise_operators_do_not_shuffle(spark, zone):
    stored = spark.read.parquet(zone)
    for df in (c.clean_ingest(stored), c.clean_calculated(c.clean_missing(stored)), c.derive_etl(stored),
               s.build_fact_trips(stored), s.build_fact_taxi_trips(stored), cu.fact_projection(stored)):
        assert "Exchange" not in plan(df)


def test_aggregates_shuffle_partial_results_once(spark, zone):
    text = plan(cu.payment_analysis_daily(spark.read.parquet(zone)))
    assert "partial_count" in text and text.count("Exchange") == 1
    columns = re.search(r"ReadSchema: struct<(.*?)>", plan(cu.location_top100(spark.read.parquet(zone)))).group(1)
    assert sorted(x.split(":")[0] for x in columns.split(",")) == ["PULocationID", "fare_amount", "trip_distance"]


def test_top_k_does_not_sort_everything(spark, zone):
    assert "TakeOrderedAndProject" in plan(cu.location_top100(spark.read.parquet(zone)))


def test_facts_are_summed_before_the_join(spark, zone):
    fact = s.build_fact_taxi_trips(spark.read.parquet(zone))
    text = plan(sq.aq02_peak_hours(fact, s.build_dim_time_of_day(spark)))
    join, partial = text.index("Join"), text.index("partial_sum(total_amount")
    assert join < partial  # the partial aggregate lies below the join


def test_frequent_values_are_limited_before_the_shuffle(spark, zone):
    assert plan(pf.profile_categorical(spark.read.parquet(zone), ["trip_ref"])).count("WindowGroupLimit") == 2


def test_no_query_uses_python_or_cross_joins(spark):
    import farelake.queries  # noqa: F401
    from farelake.registry import QUERIES

    for name in ("v_daily_revenue", "v_location_performance", "etl_classify", "sample_stratified", "metric_alarms",
                 "profile_numeric", "trip_summary", "weather_join", "file_events"):
        text = plan(QUERIES[name](spark, SF))
        assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoopJoin", text), name


def test_view_columns_are_pruned_through_the_view(spark, zone):
    curated = cu.curated_trips(spark.read.parquet(zone))
    text = plan(v.daily_revenue(curated).select("trip_date", "total_trips"))
    read = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert "tolls_amount" not in read and "passenger_count" not in read
