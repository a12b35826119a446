"""Metric series per period and threshold alarms over them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATISTICS = {"Sum": F.sum, "Average": F.avg, "Maximum": F.max, "Minimum": F.min, "SampleCount": F.count}


def _period_start(ts: str, seconds: Column | int) -> Column:
    step = F.lit(seconds) if isinstance(seconds, int) else seconds
    epoch = F.unix_timestamp(ts)
    return epoch - F.pmod(epoch, step.cast("long"))


def metric_rollup(metrics: DataFrame, stat: str = "Average", period: int = 300) -> DataFrame:
    """One statistic per namespace, metric, dimension and period of ``period`` seconds."""
    return metrics.groupBy(
        "namespace",
        "metric",
        "dim",
        F.timestamp_seconds(_period_start("ts", period)).cast("timestamp_ntz").alias("period_start"),
    ).agg(STATISTICS[stat]("value").alias("value"))


@dataclass(frozen=True)
class AlarmRule:
    name: str
    metric: str
    stat: str
    period: int  # seconds
    comparison: str  # '>', '>=', '<' or '<='
    threshold: float
    periods: int = 1
    missing: str = "notBreaching"  # or 'breaching'
    namespace: str = "pipeline"


# Statistic, period, comparison, threshold, consecutive periods, missing data.
ALARM_RULES = (
    AlarmRule("job-failure", "failed_tasks", "Sum", 300, ">=", 1.0),
    AlarmRule("function-errors", "function_errors", "Sum", 300, ">", 5.0),
    AlarmRule("data-freshness", "freshness_hours", "Maximum", 3600, ">", 24.0, 1, "breaching"),
    AlarmRule("workflow-failure", "failed_executions", "Sum", 300, ">=", 1.0),
    AlarmRule("daily-cost", "estimated_daily_cost", "Maximum", 86400, ">", 10.0),
    AlarmRule("slow-queries", "query_duration_ms", "Maximum", 300, ">", 300000.0, 2),
    AlarmRule("storage-size", "bucket_bytes", "Average", 86400, ">", 100.0 * 1024**3),
)


def metric_alarms(metrics: DataFrame, rules: tuple[AlarmRule, ...] = ALARM_RULES) -> DataFrame:
    """State of every rule, dimension and period: ALARM after enough breaching periods in a row.

    Periods without data are filled in between the first and the last period of all metrics and
    judged by the rule's policy. A series exists where a rule's metric was seen at least once.
    """
    spark = metrics.sparkSession
    book = spark.createDataFrame(
        [
            (r.name, r.namespace, r.metric, r.stat, r.period, r.comparison, r.threshold, r.periods, r.missing)
            for r in rules
        ],
        "rule string, namespace string, metric string, stat string, period long, comparison string,"
        " threshold double, periods int, missing string",
    )
    # The rule book is a literal list: joining it multiplies a point by the rules on its metric.
    judged = metrics.join(F.broadcast(book), ["namespace", "metric"])
    rolled = (
        judged.groupBy("rule", "dim", _period_start("ts", F.col("period")).alias("at"))
        .agg(*[f("value").alias(f"v_{name}") for name, f in STATISTICS.items()])
        .join(F.broadcast(book), "rule")
        .withColumn(
            "value",
            F.coalesce(
                *[F.when(F.col("stat") == s, F.col(f"v_{s}").cast("double")) for s in STATISTICS]
            ),
        )
        .select("rule", "dim", "at", "value")
    )
    span = metrics.agg(
        F.struct(F.unix_timestamp(F.min("ts")).alias("lo"), F.unix_timestamp(F.max("ts")).alias("hi"))
    ).scalar()
    step = F.col("period")
    series = rolled.select("rule", "dim").distinct().join(F.broadcast(book), "rule")
    grid = series.withColumn(
        "at",
        F.explode(F.sequence(span["lo"] - F.pmod(span["lo"], step), span["hi"], step)),
    )
    over = (
        F.when(F.col("comparison") == ">", F.col("value") > F.col("threshold"))
        .when(F.col("comparison") == ">=", F.col("value") >= F.col("threshold"))
        .when(F.col("comparison") == "<", F.col("value") < F.col("threshold"))
        .when(F.col("comparison") == "<=", F.col("value") <= F.col("threshold"))
    )
    filled = grid.join(rolled, ["rule", "dim", "at"], "left").withColumn(
        "breaching", F.coalesce(over, F.col("missing") == "breaching")
    )
    # Length of the current run of breaching periods: count since the last period that was fine.
    line = Window.partitionBy("rule", "dim").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    runs = filled.withColumn("_run", F.sum((~F.col("breaching")).cast("int")).over(line))
    within = (
        Window.partitionBy("rule", "dim", "_run").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    )
    streak = F.sum(F.col("breaching").cast("int")).over(within)
    return runs.withColumn("_streak", streak).select(
        "rule",
        "dim",
        F.timestamp_seconds("at").cast("timestamp_ntz").alias("period_start"),
        "value",
        "breaching",
        F.when(F.col("_streak") >= F.col("periods"), "ALARM").otherwise("OK").alias("state"),
    )


def data_freshness(records: DataFrame, ts: str, as_of=None, max_hours: float = 24) -> DataFrame:
    """Hours since the newest record; more than ``max_hours`` (or no record) is stale."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of)
    now = now.cast("timestamp_ntz")
    newest = records.agg(F.max(ts).cast("timestamp_ntz").alias("newest"))
    hours = F.timestamp_diff("SECOND", F.col("newest"), now) / 3600.0
    return newest.withColumn("hours_since", hours).withColumn(
        "stale", F.coalesce(F.col("hours_since") > max_hours, F.lit(True))
    )
