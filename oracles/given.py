"""The derived tables of FIXTURES.md as DuckDB SQL, written out here so that the checks do not share text with the library."""

TRIP_COLUMNS = r"""
    concat(cast(l_orderkey AS varchar(20)),'-',cast(l_linenumber AS varchar(20)),'-',cast(l_partkey AS varchar(20)),'-',cast(l_suppkey AS varchar(20)),'-',cast(cast(floor(l_extendedprice*100+0.5) AS bigint) AS varchar(20))) AS trip_ref,
    cast(1+l_suppkey%2 AS int) AS VendorID,
    CASE WHEN l_orderkey%701=0 THEN NULL ELSE l_shipdate + to_seconds(cast(((l_orderkey*7919 + l_linenumber*104729 + l_partkey*31) % 86400) AS int)) END AS tpep_pickup_datetime,
    CASE WHEN l_orderkey%709=0 THEN NULL ELSE l_shipdate + to_seconds(cast((((l_orderkey*7919 + l_linenumber*104729 + l_partkey*31) % 86400)+((l_partkey*37 + l_suppkey*101 + l_orderkey*13) % 3600 - 60 + CASE WHEN l_partkey%199=0 THEN 20000 ELSE 0 END)) AS int)) END AS tpep_dropoff_datetime,
    cast(CASE WHEN l_partkey%101=0 THEN NULL WHEN l_suppkey%53=7 THEN 0 ELSE l_linenumber END AS int) AS passenger_count,
    (l_quantity-1)*(1+l_partkey%3)/8*(CASE WHEN l_partkey%211=0 THEN 20 ELSE 1 END) AS trip_distance,
    cast(CASE WHEN l_orderkey%499=0 THEN NULL WHEN l_orderkey%997=0 THEN 99 ELSE 1+l_partkey%6 END AS int) AS RatecodeID,
    CASE WHEN l_partkey%50=0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    cast(CASE WHEN l_orderkey%311=0 THEN NULL WHEN l_suppkey%4=0 THEN 1 ELSE 1+l_suppkey%20 END AS int) AS PULocationID,
    cast(1+l_partkey%12 AS int) AS DOLocationID,
    cast(1+(l_orderkey+l_linenumber)%6 AS int) AS payment_type,
    CASE WHEN l_partkey%307=0 THEN cast(-5 AS double) ELSE floor(l_extendedprice*100/205)/100 END AS fare_amount,
    cast(CASE WHEN l_linenumber=3 THEN 0.5 ELSE 0 END AS double) AS extra,
    cast(CASE WHEN l_partkey%151=0 THEN 1.5 ELSE 0.5 END AS double) AS mta_tax,
    CASE WHEN l_partkey%97=0 THEN NULL WHEN (l_orderkey+l_linenumber)%6=1 THEN cast(0 AS double) ELSE floor(l_extendedprice*l_discount*(CASE WHEN l_partkey%89=0 THEN 1500 ELSE 250 END)/205)/100 END AS tip_amount,
    cast(CASE WHEN l_suppkey%10=0 THEN 5.75 ELSE 0 END AS double) AS tolls_amount,
    cast(0.25 AS double) AS improvement_surcharge,
    cast(2.5 AS double) AS congestion_surcharge,
    cast(CASE WHEN l_partkey%12=0 THEN 1.25 ELSE 0 END AS double) AS airport_fee
"""

TOTAL = (
    "fare_amount+extra+mta_tax+coalesce(tip_amount,0)+tolls_amount"
    "+improvement_surcharge+congestion_surcharge+airport_fee"
)

LOG_COLUMNS = r"""
    event_id AS event_id,
    ts AS ts,
    CASE event_id%3 WHEN 0 THEN '/lambda/s3-notification-handler' WHEN 1 THEN '/glue/jobs/output' ELSE '/states/etl-pipeline' END AS log_group,
    CASE WHEN event_type='view' THEN 'REPORT' ELSE 'LOG' END AS type,
    CASE event_type WHEN 'error' THEN concat(CASE event_id%4 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'FAIL' WHEN 2 THEN 'ValueException' ELSE 'KeyException' END,': code ',cast(user_id%7 AS varchar(9))) WHEN 'click' THEN concat('S3_FILE_UPLOADED {"key": "raw/taxi/f',cast(user_id AS varchar(9)),'.parquet", "size_mb": ',cast(user_id%40 AS varchar(9)),'.5}') WHEN 'purchase' THEN concat('Job run ',CASE WHEN event_id%9=0 THEN 'failed' ELSE 'succeeded' END,' records processed: ',cast(event_id%1000 AS varchar(9)),' execution time: ',cast(user_id AS varchar(9))) WHEN 'signup' THEN concat(CASE event_id%4 WHEN 0 THEN 'validation step: ' WHEN 1 THEN 'quality step: ' WHEN 2 THEN 'ExecutionSucceeded ' ELSE 'ExecutionStarted ' END,cast(user_id%5 AS varchar(9))) ELSE 'REPORT' END AS message,
    value*10 AS duration,
    cast(ceil(value*10) AS double) AS billed_duration,
    cast(128 AS bigint) AS memory_size,
    cast(20+user_id%100 AS bigint) AS max_memory_used
"""

FILE_EVENT_COLUMNS = r"""
    event_id AS event_id,
    ts AS event_time,
    CASE WHEN event_id%13=0 THEN 'ObjectRemoved:Delete' ELSE 'ObjectCreated:Put' END AS event_name,
    CASE WHEN event_id%91=0 THEN '' ELSE 'datalake' END AS bucket,
    concat(CASE WHEN event_id%5=3 THEN 'other/' ELSE 'raw/taxi/' END,'f',cast(event_id AS varchar(12)),CASE event_id%5 WHEN 1 THEN '.csv' WHEN 2 THEN '.csv.gz' WHEN 4 THEN '.json' ELSE '.PARQUET' END) AS key,
    CASE WHEN event_id%50=0 THEN cast(10 AS bigint) WHEN event_id%77=0 THEN cast(11811160064 AS bigint) ELSE cast(floor(value*100000) AS bigint) END AS size
"""

METRIC_COLUMNS = r"""
    ts AS ts,
    'pipeline' AS namespace,
    event_type AS metric,
    cast(user_id%5 AS int) AS dim,
    value AS value
"""
