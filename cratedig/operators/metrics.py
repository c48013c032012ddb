"""Time-bucketed metrics: roll-ups, hourly reports, ratios and retention."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from cratedig.functions.times import ago, at, day_of, fixed, safe_ratio, trunc_hour, trunc_to
from cratedig.operators.ordered import exact_percentile, newest_per_key

METRIC_RECORDS = "array<struct<metric_name:string,metric_value:double,tags:map<string,string>,timestamp:string>>"

# How long each table is kept, in days.
RETENTION_DAYS = {"raw_metrics": 14, "hourly": 90, "daily": 365, "events": 30}
# Metric names that describe queue work.
WORK_METRICS = ("worker_batch", "queue_processing")


def metrics_from_json(raw: DataFrame, column: str = "payload") -> DataFrame:
    """JSON arrays of metric records to typed rows."""
    records = F.from_json(F.col(column), METRIC_RECORDS)
    rows = raw.select(F.explode_outer(records).alias("r")).filter(F.col("r").isNotNull())
    return rows.select("r.*").select(
        "metric_name",
        "metric_value",
        "tags",
        F.col("timestamp").try_cast("timestamp_ntz").alias("ts"),
    )


def _stats(value: str = "metric_value"):
    return [
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.avg(value).alias("avg_value"),
        F.sum(value).alias("sum_value"),
        F.count(F.lit(1)).alias("count_value"),
    ]


UNITS = {"hourly": "hour", "daily": "day", "weekly": "week"}


def rollup(metrics: DataFrame, period: str, dimensions: list[str], value: str = "metric_value") -> DataFrame:
    """All periods at once: one row per (metric, dimensions, period start).

    ``dimensions`` may be plain columns or one map column.
    """
    return (
        metrics.withColumn("period_start", trunc_to(UNITS[period], F.col("ts")))
        .groupBy("metric_name", "period_start", *dimensions)
        .agg(*_stats(value))
        .withColumn("period", F.lit(period))
    )


def last_full_period(as_of: str, period: str) -> tuple[datetime, datetime]:
    """[start, end) of the last period that is complete at ``as_of``."""
    now = datetime.fromisoformat(str(as_of))
    if period == "hourly":
        end = now.replace(minute=0, second=0, microsecond=0)
        return end - timedelta(hours=1), end
    midnight = now.replace(hour=0, minute=0, second=0, microsecond=0)
    if period == "daily":
        return midnight - timedelta(days=1), midnight
    monday = midnight - timedelta(days=midnight.weekday())
    return monday - timedelta(days=7), monday


def rollup_period(metrics: DataFrame, period: str, dimensions: list[str], as_of: str) -> DataFrame:
    """The last full hour, day or week only; the time filter reaches the scan."""
    start, end = last_full_period(as_of, period)
    part = metrics.filter((F.col("ts") >= at(str(start))) & (F.col("ts") < at(str(end))))
    return rollup(part, period, dimensions)


def write_rollup(rollups: DataFrame, path: str) -> None:
    """Replaces exactly the periods present in ``rollups``."""
    (
        rollups.repartition("period", "period_start").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("period", "period_start")
        .parquet(path)
    )


def tag(tags: Column, key: str, dtype: str | None = None) -> Column:
    """One entry of a tags map, as text or converted; what doesn't convert is null."""
    return tags[key] if dtype is None else tags[key].try_cast(dtype)


def leading_int(text: Column) -> Column:
    """The whole number a text begins with; 0 where there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(text, r"^\s*([+-]?[0-9]+)", 1), F.lit("")).try_cast("bigint"), F.lit(0))


def queue_metrics_hourly(metrics: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Per queue and hour over the last days: batches, outcomes, average time, messages.

    metrics: metric_name, metric_value, ts, tags (map of texts). Counts that are no whole numbers are left out.
    """
    count = lambda key: F.sum(tag(F.col("tags"), key, "int"))
    return (
        metrics.filter((F.col("metric_name") == "queue_processing") & (F.col("ts") > ago(as_of, days=days)))
        .groupBy(tag(F.col("tags"), "queue").alias("queue_name"), trunc_hour(F.col("ts")).alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("total_batches"),
            count("success_count").alias("success_count"),
            count("error_count").alias("error_count"),
            F.avg("metric_value").alias("avg_processing_time_ms"),
            count("batch_size").alias("total_messages_processed"),
        )
    )


def api_metrics_hourly(metrics: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Per API and hour: calls, outcomes, average successful time, exact 95th percentile."""
    calls = metrics.filter(
        (F.col("metric_name") == "api_call") & (F.col("ts") > ago(as_of, days=days))
    ).select(
        tag(F.col("tags"), "api").alias("api_name"), trunc_hour(F.col("ts")).alias("hour"), tag(F.col("tags"), "success").alias("success"), "metric_value"
    )
    keys = ["api_name", "hour"]
    counted = calls.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_calls"),
        F.sum(F.when(F.col("success") == "true", 1).otherwise(0)).alias("success_count"),
        F.sum(F.when(F.col("success") == "false", 1).otherwise(0)).alias("error_count"),
        F.avg(F.when(F.col("success") == "true", F.col("metric_value"))).alias("avg_success_time_ms"),
    )
    p95 = exact_percentile(calls, keys, "metric_value", 0.95, "p95_time_ms")
    return counted.join(p95, keys, "left")


def queue_summary(metrics: DataFrame, as_of, hours: float = 24) -> DataFrame:
    """Per queue over its work metrics: counts, error rate, rounded time, last run."""
    works = F.col("metric_name").contains(WORK_METRICS[0]) | F.col("metric_name").contains(WORK_METRICS[1])
    return (
        metrics.withColumn("queue", tag(F.col("tags"), "queue"))
        .filter((F.col("ts") >= ago(as_of, hours=hours)) & works & (F.col("queue") != ""))
        .groupBy("queue")
        .agg(
            F.count(F.lit(1)).alias("metrics_count"),
            F.sum(leading_int(tag(F.col("tags"), "processed"))).alias("total_processed"),
            F.sum(leading_int(tag(F.col("tags"), "errors"))).alias("total_errors"),
            F.round(F.sum(F.coalesce("metric_value", F.lit(0.0))) / F.count(F.lit(1))).alias("avg_processing_time_ms"),
            F.max("ts").alias("last_run"),
        )
        .withColumn(
            "error_rate",
            F.when(F.col("total_processed") > 0, F.col("total_errors") / F.col("total_processed")).otherwise(F.lit(0.0)),
        )
    )


def metrics_by_name(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("metric_name").agg(F.count(F.lit(1)).alias("metric_count"))


def recent_avg_per_queue(metrics: DataFrame, as_of, hours: float = 1) -> DataFrame:
    """Average processed and failed per batch over the last hours."""
    return (
        metrics.filter(F.col("ts") > ago(as_of, hours=hours))
        .groupBy(tag(F.col("tags"), "queue").alias("queue"))
        .agg(
            F.avg(tag(F.col("tags"), "processed", "double")).alias("avg_processed_per_batch"),
            F.avg(tag(F.col("tags"), "errors", "double")).alias("avg_errors_per_batch"),
        )
    )


def dedup_daily(records: DataFrame) -> DataFrame:
    """Per day, queue and worker: repeats dropped, work done, failures and the last error.

    Input: ts, queue, worker, outcome (deduplicated, processed or failed), ms, error_type, error.
    """

    def n(kind: str) -> Column:
        return F.sum(F.when(F.col("outcome") == kind, 1).otherwise(0))

    done = F.col("outcome") == "processed"
    failed = F.col("outcome") == "failed"
    return records.groupBy(day_of(F.col("ts")).alias("day"), "queue", "worker").agg(
        n("deduplicated").alias("deduplicated"),
        n("processed").alias("processed"),
        F.sum(F.when(done, F.col("ms"))).alias("processing_time_total"),
        F.count(F.when(done, F.col("ms"))).alias("processing_count"),
        n("failed").alias("failures"),
        F.max_by(F.when(failed, F.col("error")), F.when(failed, F.struct("ts", "error"))).alias("last_error"),
    )


def failures_daily(records: DataFrame) -> DataFrame:
    """Per day, queue, worker and error type: number of failures."""
    return (
        records.filter(F.col("outcome") == "failed")
        .groupBy(
            day_of(F.col("ts")).alias("day"), "queue", "worker",
            F.coalesce("error_type", F.lit("unknown_error")).alias("error_type"),
        )
        .agg(F.count(F.lit(1)).alias("failures"))
    )


def operations_daily(ops: DataFrame) -> DataFrame:
    """Per day, queue and operation: successes and failures."""
    return ops.groupBy(day_of(F.col("ts")).alias("day"), "queue", "operation").agg(
        F.sum(F.when(F.col("success"), 1).otherwise(0)).alias("successes"),
        F.sum(F.when(~F.col("success"), 1).otherwise(0)).alias("failures"),
    )


def dedup_rate(records: DataFrame) -> DataFrame:
    """Repeats dropped as a percentage of messages processed, per queue; 0 when none were."""
    n = {k: F.sum(F.when(F.col("outcome") == k, 1).otherwise(0)) for k in ("deduplicated", "processed")}
    return (
        records.groupBy("queue")
        .agg(n["deduplicated"].alias("deduplicated"), n["processed"].alias("processed"))
        .withColumn("dedup_rate", safe_ratio(F.col("deduplicated") * 100, F.col("processed"), 0.0))
    )


def last_operations(ops: DataFrame, n: int = 100) -> DataFrame:
    """The newest n operations of each queue and kind."""
    return newest_per_key(ops, ["queue", "operation"], [F.desc("ts"), F.desc("event_id")], n)


def call_log_summary(calls: DataFrame, latency: str, ts: str) -> DataFrame:
    """Requests, average latency and requests per second over the log's own span."""
    span = (F.unix_micros(F.max(ts).cast("timestamp")) - F.unix_micros(F.min(ts).cast("timestamp"))) / 1_000_000.0
    return calls.agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.avg(latency).alias("average_latency_ms"),
        safe_ratio(F.count(F.lit(1)), span).alias("requests_per_second"),
    )


def worker_liveness(heartbeats: DataFrame, as_of, minutes: int = 15) -> DataFrame:
    """Newest heartbeat and status per worker; workers silent for longer are left out."""
    return (
        heartbeats.filter(F.col("ts") >= ago(as_of, minutes=minutes))
        .groupBy("worker")
        .agg(F.max("ts").alias("last_seen"), F.max_by("status", F.struct("ts", "status")).alias("status"))
    )


def retention(df: DataFrame, kind: str, as_of, column: str = "ts") -> DataFrame:
    """Rows of a table that are still kept under the policy."""
    return df.filter(F.col(column) >= ago(as_of, days=RETENTION_DAYS[kind]))


def purge_events(events: DataFrame, as_of, days: int = 30, column: str = "created_at"):
    """(kept, count of dropped): both from a pushed-down time filter."""
    edge = ago(as_of, days=days)
    kept = events.filter(F.col(column) >= edge)
    dropped = events.filter(F.col(column) < edge).agg(F.count(F.lit(1)).alias("deleted_count"))
    return kept, dropped


def per_hour_text(rate: Column) -> Column:
    return F.concat(fixed(rate, 1), F.lit(" msgs/hour"))
