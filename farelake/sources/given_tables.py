"""Trips, logs, file events, metrics and weather derived from the given parquet tables.

The expressions are plain SQL text shared with the checks in ``oracles``; only the way
to add seconds to a timestamp differs between the two dialects. All are row-wise
projections, so they apply to a batch or a streaming DataFrame alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OFF = "((l_orderkey*7919 + l_linenumber*104729 + l_partkey*31) % 86400)"
DUR = (
    "((l_partkey*37 + l_suppkey*101 + l_orderkey*13) % 3600 - 60"
    " + CASE WHEN l_partkey%199=0 THEN 20000 ELSE 0 END)"
)


def trip_expressions(plus_seconds) -> dict[str, str]:
    """Column name -> SQL text; ``plus_seconds(expr)`` renders l_shipdate + expr seconds."""
    return {
        "trip_ref": "concat(cast(l_orderkey AS varchar(20)),'-',cast(l_linenumber AS varchar(20)),'-',"
        "cast(l_partkey AS varchar(20)),'-',cast(l_suppkey AS varchar(20)),'-',"
        "cast(cast(floor(l_extendedprice*100+0.5) AS bigint) AS varchar(20)))",
        "VendorID": "cast(1+l_suppkey%2 AS int)",
        "tpep_pickup_datetime": f"CASE WHEN l_orderkey%701=0 THEN NULL ELSE {plus_seconds(OFF)} END",
        "tpep_dropoff_datetime": "CASE WHEN l_orderkey%709=0 THEN NULL ELSE "
        f"{plus_seconds(f'({OFF}+{DUR})')} END",
        "passenger_count": "cast(CASE WHEN l_partkey%101=0 THEN NULL WHEN l_suppkey%53=7 THEN 0"
        " ELSE l_linenumber END AS int)",
        "trip_distance": "(l_quantity-1)*(1+l_partkey%3)/8*(CASE WHEN l_partkey%211=0 THEN 20 ELSE 1 END)",
        "RatecodeID": "cast(CASE WHEN l_orderkey%499=0 THEN NULL WHEN l_orderkey%997=0 THEN 99"
        " ELSE 1+l_partkey%6 END AS int)",
        "store_and_fwd_flag": "CASE WHEN l_partkey%50=0 THEN 'Y' ELSE 'N' END",
        "PULocationID": "cast(CASE WHEN l_orderkey%311=0 THEN NULL WHEN l_suppkey%4=0 THEN 1"
        " ELSE 1+l_suppkey%20 END AS int)",
        "DOLocationID": "cast(1+l_partkey%12 AS int)",
        "payment_type": "cast(1+(l_orderkey+l_linenumber)%6 AS int)",
        "fare_amount": "CASE WHEN l_partkey%307=0 THEN cast(-5 AS double)"
        " ELSE floor(l_extendedprice*100/205)/100 END",
        "extra": "cast(CASE WHEN l_linenumber=3 THEN 0.5 ELSE 0 END AS double)",
        "mta_tax": "cast(CASE WHEN l_partkey%151=0 THEN 1.5 ELSE 0.5 END AS double)",
        "tip_amount": "CASE WHEN l_partkey%97=0 THEN NULL WHEN (l_orderkey+l_linenumber)%6=1"
        " THEN cast(0 AS double) ELSE floor(l_extendedprice*l_discount*"
        "(CASE WHEN l_partkey%89=0 THEN 1500 ELSE 250 END)/205)/100 END",
        "tolls_amount": "cast(CASE WHEN l_suppkey%10=0 THEN 5.75 ELSE 0 END AS double)",
        "improvement_surcharge": "cast(0.25 AS double)",
        "congestion_surcharge": "cast(2.5 AS double)",
        "airport_fee": "cast(CASE WHEN l_partkey%12=0 THEN 1.25 ELSE 0 END AS double)",
    }


TOTAL = (
    "fare_amount+extra+mta_tax+coalesce(tip_amount,0)+tolls_amount"
    "+improvement_surcharge+congestion_surcharge+airport_fee"
)

LOG_EXPRESSIONS = {
    "event_id": "event_id",
    "ts": "ts",
    "log_group": "CASE event_id%3 WHEN 0 THEN '/lambda/s3-notification-handler'"
    " WHEN 1 THEN '/glue/jobs/output' ELSE '/states/etl-pipeline' END",
    "type": "CASE WHEN event_type='view' THEN 'REPORT' ELSE 'LOG' END",
    "message": "CASE event_type"
    " WHEN 'error' THEN concat(CASE event_id%4 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'FAIL'"
    " WHEN 2 THEN 'ValueException' ELSE 'KeyException' END,': code ',cast(user_id%7 AS varchar(9)))"
    " WHEN 'click' THEN concat('S3_FILE_UPLOADED {\"key\": \"raw/taxi/f',cast(user_id AS varchar(9)),"
    "'.parquet\", \"size_mb\": ',cast(user_id%40 AS varchar(9)),'.5}')"
    " WHEN 'purchase' THEN concat('Job run ',CASE WHEN event_id%9=0 THEN 'failed' ELSE 'succeeded' END,"
    "' records processed: ',cast(event_id%1000 AS varchar(9)),' execution time: ',cast(user_id AS varchar(9)))"
    " WHEN 'signup' THEN concat(CASE event_id%4 WHEN 0 THEN 'validation step: ' WHEN 1 THEN 'quality step: '"
    " WHEN 2 THEN 'ExecutionSucceeded ' ELSE 'ExecutionStarted ' END,cast(user_id%5 AS varchar(9)))"
    " ELSE 'REPORT' END",
    "duration": "value*10",
    "billed_duration": "cast(ceil(value*10) AS double)",
    "memory_size": "cast(128 AS bigint)",
    "max_memory_used": "cast(20+user_id%100 AS bigint)",
}

FILE_EVENT_EXPRESSIONS = {
    "event_id": "event_id",
    "event_time": "ts",
    "event_name": "CASE WHEN event_id%13=0 THEN 'ObjectRemoved:Delete' ELSE 'ObjectCreated:Put' END",
    "bucket": "CASE WHEN event_id%91=0 THEN '' ELSE 'datalake' END",
    "key": "concat(CASE WHEN event_id%5=3 THEN 'other/' ELSE 'raw/taxi/' END,'f',cast(event_id AS varchar(12)),"
    "CASE event_id%5 WHEN 1 THEN '.csv' WHEN 2 THEN '.csv.gz' WHEN 4 THEN '.json' ELSE '.PARQUET' END)",
    "size": "CASE WHEN event_id%50=0 THEN cast(10 AS bigint) WHEN event_id%77=0"
    " THEN cast(11811160064 AS bigint) ELSE cast(floor(value*100000) AS bigint) END",
}

METRIC_EXPRESSIONS = {
    "ts": "ts",
    "namespace": "'pipeline'",
    "metric": "event_type",
    "dim": "cast(user_id%5 AS int)",
    "value": "value",
}


def _select(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{text} AS {name}" for name, text in expressions.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips_from(lineitem: DataFrame) -> DataFrame:
    """The raw trip table, one trip per line item."""
    body = trip_expressions(lambda e: f"timestampadd(SECOND, cast({e} AS int), l_shipdate)")
    return _select(lineitem, body).withColumn("total_amount", F.expr(TOTAL))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from(table(spark, sf_dir, "lineitem"))


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "events"), LOG_EXPRESSIONS)


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "events"), METRIC_EXPRESSIONS)


def file_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "events"), FILE_EVENT_EXPRESSIONS)


def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File events as they arrive: one JSON text with up to three ``Records``."""
    record = F.struct(
        F.col("event_name").alias("eventName"),
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("eventTime"),
        F.struct(
            F.struct(F.col("bucket").alias("name")).alias("bucket"),
            F.struct("key", "size").alias("object"),
        ).alias("s3"),
    )
    return (
        file_events(spark, sf_dir)
        .groupBy(F.expr("event_id div 3").alias("message_id"))
        .agg(F.to_json(F.struct(F.collect_list(record).alias("Records"))).alias("body"))
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .where("day(o_orderdate) % 3 <> 0")
        .groupBy(F.to_date("o_orderdate").alias("date"))
        .agg(
            F.min("o_orderpriority").alias("weather_condition"),
            F.expr("cast(30 + day(min(o_orderdate)) % 60 AS int)").alias("temperature_f"),
            F.expr("cast(day(min(o_orderdate)) % 4 AS double) / 4").alias("precipitation_inches"),
        )
    )
