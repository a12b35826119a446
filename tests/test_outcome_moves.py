"""What a processed run moves: no derived column, and skipped rows among the others instead of all under one key."""

from pyspark.sql import functions as F
from test_storage import SF

from farelake.plans import runs
from farelake.sources import commits
from farelake.sources import given_tables as given
from farelake.sources import zones as z


def test_a_run_moves_raw_columns_in_parts_of_a_month(spark, tmp_path, monkeypatch):
    seen, inner = [], commits.commit_attempt
    monkeypatch.setattr(z, "commit_attempt", lambda log, df, *a, **k: seen.append((df, k["clustered"])) or inner(log, df, *a, **k))
    got = runs.run_processed(given.trips(spark, SF), str(tmp_path), "r")
    (df, clustered), = seen
    spark.conf.set("spark.sql.debug.maxToStringFields", "200")
    above, below = df._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions")
    assert clustered and "near" in below.splitlines()[0] and "sink" not in below.splitlines()[0]
    assert "etl_job_name" in above and "etl_job_name" not in below and "AS tip_percentage" not in below.splitlines()[1]
    skipped = df.where(F.col("sink") == z.SKIPPED)
    assert skipped.count() == got["pre_filtered"] + got["lost"] and skipped.where("etl_job_name IS NOT NULL OR year IS NOT NULL").isEmpty()
    wrong = df.where((F.col("sink") == z.REJECTED) != F.col("failure_reason").isNotNull())
    assert wrong.isEmpty()
