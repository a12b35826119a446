"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from farelake.session import local_session  # noqa: E402

HEADLINE = (
    # zone ETL and quality
    "raw_to_processed run_all_checks etl_classify run_processed dataset_gate catalog_month_agg"
    # curated datasets
    " daily_statistics hourly_patterns payment_analysis_daily location_top100"
    # views and analysis
    " v_daily_revenue v_hourly_trips v_payment_analysis v_location_performance q1_1_monthly_revenue q1_4_top_days"
    " q2_1_top_routes q2_4_rank_in_period q3_1_hourly_demand q4_2_fare_buckets q4_3_tip_buckets weather_join"
    # star schema
    " build_dim_time build_fact_trips build_fact_taxi_trips trip_summary aq02_peak_hours aq06_routes aq08_monthly"
    " rds_hourly constraint_check"
    # profiling, sampling, monitoring, streams
    " profile_numeric sample_random sample_stratified metric_alarms log_processing_time file_events streaming_etl"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, memory="16g")

    import farelake.queries  # noqa: F401
    from farelake.registry import QUERIES

    trips = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()  # also warms the session up
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "trips": trips,
                "run_processed_rows_per_sec": round(trips / seconds["run_processed"]),
            }
        )
    )


if __name__ == "__main__":
    main()
