import datetime as dt
import json

from farelake.operators import file_events as fe
from farelake.operators import log_analytics as lg
from farelake.operators import metric_alarms as ma


def notification(**parts):
    return {"eventName": parts.get("name"), "eventTime": parts.get("time"),
            "s3": {"bucket": {"name": parts.get("bucket")}, "object": {"key": parts.get("key"), "size": parts.get("size")}}}


def test_file_events_defaults_and_sizes(spark):
    sizes = {1048576: 1.0, 52428800: 50.0, 104857600: 100.0, 1536: 0.0}
    bodies = [json.dumps({"Records": [notification(name="ObjectCreated:Put", bucket="b", key=f"k{s}", size=s) for s in sizes]}),
              json.dumps({"Records": []}), json.dumps({}), json.dumps({"Records": [{}]})]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    rows = fe.file_events(df).collect()
    assert {r.size_bytes: r.size_mb for r in rows if r.size_bytes} == sizes
    empty = [r for r in rows if not r.size_bytes]
    assert len(empty) == 1 and (empty[0].bucket, empty[0].key, empty[0].event_type) == ("Unknown",) * 3


def test_routing(spark):
    rows = [("ObjectCreated:Put", "b", "raw/taxi/a.parquet", 1), ("ObjectRemoved:Delete", "b", "raw/taxi/a.parquet", 1),
            ("ObjectCreated:Copy", "b", "raw/taxi/a.CSV.GZ", 1), ("ObjectCreated:Put", None, "raw/taxi/a.csv", 1),
            ("ObjectCreated:Put", "b", "other/a.csv", 1), ("ObjectCreated:Put", "b", "raw/taxi/a.txt", 1)]
    df = spark.createDataFrame(rows, "event_name string, bucket string, key string, size long")
    assert [r.reject_reason for r in fe.route_events(df).collect()] == [
        None, "not_a_creation", None, "missing_bucket_or_key", "outside_prefix", "unsupported_type"]


def test_redelivered_file_starts_one_execution(spark):
    t = dt.datetime(2024, 1, 1, 10, 0, 5)
    rows = [("ObjectCreated:Put", "b", "raw/taxi/x.csv.gz", 1, t)] * 3
    df = spark.createDataFrame(rows, "event_name string, bucket string, key string, size long, event_time timestamp_ntz")
    assert [r.execution_name for r in fe.dedup_executions(df).collect()] == ["etl-20240101-100005-x-csv-gz"]


def test_different_files_with_one_label_are_all_processed(spark):
    t = dt.datetime(2024, 1, 1, 10, 0, 5)
    long = "raw/taxi/" + "n" * 60
    keys = ["raw/taxi/2024/01/data.parquet", "raw/taxi/2024/02/data.parquet", long + "1.csv", long + "2.csv"]
    rows = [("ObjectCreated:Put", "b", k, 1, t) for k in keys * 2]
    df = spark.createDataFrame(rows, "event_name string, bucket string, key string, size long, event_time timestamp_ntz")
    assert sorted(r.key for r in fe.dedup_executions(df).collect()) == sorted(keys)


def test_log_questions_report_everything_by_default(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(hours=i), i, "/glue/jobs", "LOG", f"FAIL: code {i}") for i in range(300)]
    logs = spark.createDataFrame(rows, "ts timestamp_ntz, event_id long, log_group string, type string, message string")
    assert lg.log_hourly_activity(logs).count() == lg.log_failed_records(logs).count() == 300
    assert lg.log_failed_records(logs, k=20).count() == 20 and lg.log_hourly_activity(logs, limit=7).count() == 7
    assert lg.log_hourly_activity(logs, end=start + dt.timedelta(hours=100), last_hours=5).count() == 5
    assert lg.log_query(logs.withColumn("log_group", lg.F.lit("my/lambda/x")), groups=lg.HANDLERS).count() == 0


def metrics(spark, points):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(minutes=m), "pipeline", name, 1, float(v)) for m, name, v in points]
    return spark.createDataFrame(rows, "ts timestamp_ntz, namespace string, metric string, dim int, value double")


def states(spark, points, rule):
    out = ma.metric_alarms(metrics(spark, points), (rule,)).orderBy("period_start").collect()
    return [r.state for r in out]


def test_alarm_needs_consecutive_periods(spark):
    rule = ma.AlarmRule("slow", "m", "Maximum", 300, ">", 10.0, 2)
    assert states(spark, [(0, "m", 11), (5, "m", 12), (10, "m", 1), (15, "m", 20), (25, "m", 30)], rule) == [
        "OK", "ALARM", "OK", "OK", "OK", "OK"]


def test_alarm_missing_data_policy(spark):
    points = [(0, "m", 1), (15, "m", 1)]
    quiet = ma.AlarmRule("a", "m", "Maximum", 300, ">", 10.0)
    loud = ma.AlarmRule("a", "m", "Maximum", 300, ">", 10.0, 1, "breaching")
    assert states(spark, points, quiet) == ["OK"] * 4
    assert states(spark, points, loud) == ["OK", "ALARM", "ALARM", "OK"]


def test_fixed_alarm_rules(spark):
    points = [(0, "failed_tasks", 1), (1, "function_errors", 5), (2, "query_duration_ms", 300001), (7, "query_duration_ms", 400000)]
    out = ma.metric_alarms(metrics(spark, points)).where("state = 'ALARM'").collect()
    assert {r.rule for r in out} == {"job-failure", "slow-queries"}


def test_freshness(spark):
    df = metrics(spark, [(0, "m", 1)])
    assert not ma.data_freshness(df, "ts", "2024-01-02 00:00:00").first().stale
    assert ma.data_freshness(df, "ts", "2024-01-02 00:00:01").first().stale
    assert ma.data_freshness(df.limit(0), "ts", "2024-01-02").first().stale


def test_log_query_range_groups_and_limit(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(i, t + dt.timedelta(hours=i), g, "LOG", "ERROR: x", 1.0, 1.0, 128, 20)
            for i, g in enumerate(["/lambda/a", "/glue/jobs", "/states/x", "/other"])]
    logs = spark.createDataFrame(rows, "event_id int, ts timestamp_ntz, log_group string, type string, message string,"
                                 " duration double, billed_duration double, memory_size long, max_memory_used long")
    assert lg.log_query(logs, groups=lg.EVERYTHING).count() == 2
    assert lg.log_query(logs, groups=lg.STATES).count() == 1
    assert lg.log_query(logs, start="2024-01-01 01:00:00", end="2024-01-01 03:00:00").count() == 2
    assert lg.log_query(logs, end="2024-01-01 03:00:00", last_hours=1).count() == 1
    assert lg.log_hourly_activity(logs, limit=1).count() == 1
    row = lg.log_failed_records(logs).first()
    assert (row.error_type, row.error_message, row["count"]) == ("ERROR", "x", 2)
