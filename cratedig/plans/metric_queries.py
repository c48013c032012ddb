"""Metric, roll-up and rate queries over the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cratedig.functions import times
from cratedig.operators import audits, metrics, queues
from cratedig.operators.ordered import exact_percentile
from cratedig.plans.registry import query
from cratedig.sources import dated, testbed as tb
from cratedig.sources.testbed import EVENTS_AS_OF

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
STATS_SQL = """round(min(metric_value), 6) AS min_value, round(max(metric_value), 6) AS max_value,
 round(avg(metric_value), 6) AS avg_value, round(sum(metric_value), 6) AS sum_value, count(*) AS count_value"""


# What the reports read are raw tags: texts, some of which are no numbers.
TAGGED = """tagged AS (SELECT metric_name, metric_value, date_trunc('second', ts)::TIMESTAMP AS ts, queue, success, error_count,
  CASE WHEN event_id % 11 <> 0 THEN batch_size END AS size_tag, batch_size - error_count AS success_count,
  CASE WHEN event_id % 13 = 0 THEN 0 ELSE batch_size END AS whole, CASE WHEN event_id % 13 <> 0 AND event_id % 7 <> 0 THEN batch_size END AS number
  FROM work_metrics)"""


def _tagged(s, d):
    """Work metrics as they arrive: JSON records with a tags object, unpacked again."""
    i, text = F.col("event_id"), lambda c: F.col(c).cast("string")
    tags = F.create_map(
        F.lit("queue"), F.col("queue"), F.lit("api"), F.col("queue"), F.lit("success"), text("success"),
        F.lit("batch_size"), F.when(i % 11 == 0, "n/a").otherwise(text("batch_size")),
        F.lit("success_count"), (F.col("batch_size") - F.col("error_count")).cast("string"),
        F.lit("error_count"), text("error_count"), F.lit("errors"), text("error_count"),
        F.lit("processed"), F.when(i % 13 == 0, "many").when(i % 7 == 0, F.concat(text("batch_size"), F.lit(" rows"))).otherwise(text("batch_size")),
    )
    record = F.struct("metric_name", "metric_value", tags.alias("tags"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"))
    return metrics.metrics_from_json(tb.work_metrics(s, d).select(F.to_json(F.array(record)).alias("payload")))


def _rollup(name: str, period: str, unit: str):
    @query(name, "work_metrics", f"""SELECT metric_name, date_trunc('{unit}', ts)::TIMESTAMP AS period_start, queue, {STATS_SQL},
      '{period}' AS period FROM work_metrics GROUP BY 1, 2, 3""")
    def _(s, d):
        return metrics.rollup(tb.work_metrics(s, d), period, ["queue"])


_rollup("rollup_hourly", "hourly", "hour")
_rollup("rollup_daily", "daily", "day")
_rollup("rollup_weekly", "weekly", "week")


@query("rollup_last_day", "work_metrics", f"""SELECT metric_name, TIMESTAMP '2024-01-30 00:00:00' AS period_start, queue, {STATS_SQL},
  'daily' AS period FROM work_metrics WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00' GROUP BY 1, 2, 3""")
def _(s, d):
    return metrics.rollup_period(tb.work_metrics(s, d), "daily", ["queue"], EVENTS_AS_OF)


@query("rollup_by_tags", "work_metrics", """SELECT metric_name, date_trunc('day', ts)::TIMESTAMP AS period_start,
  queue AS tag_queue, CASE WHEN success THEN 'true' ELSE 'false' END AS tag_success,
  round(sum(metric_value), 6) AS sum_value, count(*) AS count_value
  FROM work_metrics GROUP BY 1, 2, 3, 4""")
def _(s, d):
    """Grouping by the whole tag map, as the stored metrics carry it."""
    tags = F.create_map(F.lit("queue"), F.col("queue"), F.lit("success"), F.col("success").cast("string"))
    rows = metrics.rollup(tb.work_metrics(s, d).withColumn("tags", tags), "daily", ["tags"])
    return rows.select(
        "metric_name", "period_start", F.col("tags")["queue"].alias("tag_queue"),
        F.col("tags")["success"].alias("tag_success"), "sum_value", "count_value",
    )


@query("queue_metrics_hourly", "work_metrics", f"""WITH {TAGGED} SELECT queue AS queue_name, date_trunc('hour', ts)::TIMESTAMP AS hour, count(*) AS total_batches,
  CAST(sum(success_count) AS BIGINT) AS success_count, CAST(sum(error_count) AS BIGINT) AS error_count,
  round(avg(metric_value), 6) AS avg_processing_time_ms, CAST(sum(size_tag) AS BIGINT) AS total_messages_processed
  FROM tagged WHERE metric_name = 'queue_processing' AND ts > {NOW} - INTERVAL 7 DAY GROUP BY 1, 2""")
def _(s, d):
    return metrics.queue_metrics_hourly(_tagged(s, d), EVENTS_AS_OF)


@query("api_metrics_hourly", "work_metrics", f"""WITH {TAGGED} SELECT queue AS api_name, date_trunc('hour', ts)::TIMESTAMP AS hour, count(*) AS total_calls,
  CAST(sum(CASE WHEN success THEN 1 ELSE 0 END) AS BIGINT) AS success_count,
  CAST(sum(CASE WHEN NOT success THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
  round(avg(CASE WHEN success THEN metric_value END), 6) AS avg_success_time_ms,
  round(quantile_cont(metric_value, 0.95), 6) AS p95_time_ms
  FROM tagged WHERE metric_name = 'api_call' AND ts > {NOW} - INTERVAL 7 DAY GROUP BY 1, 2""")
def _(s, d):
    return metrics.api_metrics_hourly(_tagged(s, d), EVENTS_AS_OF)


@query("api_percentiles", "work_metrics", """SELECT metric_name, queue, round(quantile_cont(metric_value, 0.95), 6) AS p95
  FROM work_metrics GROUP BY 1, 2""")
def _(s, d):
    return exact_percentile(tb.work_metrics(s, d), ["metric_name", "queue"], "metric_value", 0.95, "p95")


SUMMARY_SQL = f"""WITH {TAGGED} SELECT queue, count(*) AS metrics_count, CAST(sum(whole) AS BIGINT) AS total_processed,
  CAST(sum(error_count) AS BIGINT) AS total_errors, round(round(sum(metric_value) / count(*)), 6) AS avg_processing_time_ms,
  max(ts) AS last_run, CASE WHEN sum(whole) > 0 THEN round(sum(error_count)::DOUBLE / sum(whole), 6) ELSE 0.0::DOUBLE END AS error_rate
  FROM tagged WHERE metric_name = 'queue_processing' AND ts >= {NOW} - INTERVAL 240 HOUR GROUP BY 1"""


@query("queue_summary", "work_metrics", SUMMARY_SQL)
def _(s, d):
    return metrics.queue_summary(_tagged(s, d), EVENTS_AS_OF, 240)


@query("metrics_by_name", "work_metrics", "SELECT metric_name, count(*) AS metric_count FROM work_metrics GROUP BY 1")
def _(s, d):
    return metrics.metrics_by_name(tb.work_metrics(s, d))


@query("recent_avg_per_queue", "work_metrics", f"""WITH {TAGGED} SELECT queue, round(avg(number), 6) AS avg_processed_per_batch,
  round(avg(error_count), 6) AS avg_errors_per_batch FROM tagged WHERE ts > {NOW} - INTERVAL 30 HOUR GROUP BY 1""")
def _(s, d):
    return metrics.recent_avg_per_queue(_tagged(s, d), EVENTS_AS_OF, 30)


@query("metrics_from_json", "work_metrics", """SELECT metric_name, round(metric_value, 6) AS metric_value, queue,
  date_trunc('second', ts)::TIMESTAMP AS ts FROM work_metrics""")
def _(s, d):
    """Metric records packed in JSON arrays of one hour and queue part, then unpacked again."""
    m = tb.work_metrics(s, d)
    record = F.struct(
        "metric_name", "metric_value", F.create_map(F.lit("queue"), F.col("queue")).alias("tags"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
    )
    raw = m.select(F.to_json(F.array(record)).alias("payload"))
    out = metrics.metrics_from_json(raw)
    return out.select("metric_name", "metric_value", F.col("tags")["queue"].alias("queue"), "ts")


RECORDS_SQL = """rec AS (SELECT ts, event_id, queue, concat('w', CAST(event_id % 3 AS VARCHAR)) AS worker,
  CASE WHEN NOT success THEN 'failed' WHEN event_id % 4 = 0 THEN 'deduplicated' ELSE 'processed' END AS outcome,
  CAST(batch_size AS BIGINT) AS ms, concat('type_', CAST(error_count AS VARCHAR)) AS error_type,
  concat('err ', CAST(event_id AS VARCHAR)) AS error FROM work_metrics)"""


def _records(s, d):
    e = F.col("event_id")
    return tb.work_metrics(s, d).select(
        "ts", "event_id", "queue",
        F.concat(F.lit("w"), (e % 3).cast("string")).alias("worker"),
        F.when(~F.col("success"), "failed").when(e % 4 == 0, "deduplicated").otherwise("processed").alias("outcome"),
        F.col("batch_size").cast("bigint").alias("ms"),
        F.concat(F.lit("type_"), F.col("error_count").cast("string")).alias("error_type"),
        F.concat(F.lit("err "), e.cast("string")).alias("error"),
    )


@query("dedup_daily", "work_metrics", f"""WITH {RECORDS_SQL} SELECT CAST(ts AS DATE) AS day, queue, worker,
  count(*) FILTER (outcome = 'deduplicated') AS deduplicated, count(*) FILTER (outcome = 'processed') AS processed,
  CAST(sum(ms) FILTER (outcome = 'processed') AS BIGINT) AS processing_time_total,
  count(ms) FILTER (outcome = 'processed') AS processing_count, count(*) FILTER (outcome = 'failed') AS failures,
  arg_max(error, event_id) FILTER (outcome = 'failed') AS last_error FROM rec GROUP BY 1, 2, 3""")
def _(s, d):
    return metrics.dedup_daily(_records(s, d))


@query("dedup_daily_failures", "work_metrics", f"""WITH {RECORDS_SQL} SELECT CAST(ts AS DATE) AS day, queue, worker, error_type,
  count(*) AS failures FROM rec WHERE outcome = 'failed' GROUP BY 1, 2, 3, 4""")
def _(s, d):
    return metrics.failures_daily(_records(s, d))


@query("dedup_daily_operations", "work_metrics", """SELECT CAST(ts AS DATE) AS day, queue, metric_name AS operation,
  count(*) FILTER (success) AS successes, count(*) FILTER (NOT success) AS failures FROM work_metrics GROUP BY 1, 2, 3""")
def _(s, d):
    return metrics.operations_daily(tb.work_metrics(s, d).withColumnRenamed("metric_name", "operation"))


@query("dedup_rate", "work_metrics", f"""WITH {RECORDS_SQL} SELECT queue, count(*) FILTER (outcome = 'deduplicated') AS deduplicated,
  count(*) FILTER (outcome = 'processed') AS processed,
  round(CASE WHEN count(*) FILTER (outcome = 'processed') > 0
    THEN (count(*) FILTER (outcome = 'deduplicated') * 100)::DOUBLE / count(*) FILTER (outcome = 'processed') ELSE 0 END, 6) AS dedup_rate
  FROM rec GROUP BY 1""")
def _(s, d):
    return metrics.dedup_rate(_records(s, d))


@query("last_n_per_key", "work_metrics", """SELECT queue, operation, event_id FROM (SELECT queue, metric_name AS operation, event_id,
  row_number() OVER (PARTITION BY queue, metric_name ORDER BY ts DESC, event_id DESC) AS rn FROM work_metrics) WHERE rn <= 100""")
def _(s, d):
    ops = tb.work_metrics(s, d).withColumnRenamed("metric_name", "operation")
    return metrics.last_operations(ops, 100).select("queue", "operation", "event_id")


@query("call_log_summary", "work_metrics", """SELECT count(*) AS total_requests, round(avg(metric_value), 6) AS average_latency_ms,
  round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE), 6) AS requests_per_second FROM work_metrics""")
def _(s, d):
    return metrics.call_log_summary(tb.work_metrics(s, d), "metric_value", "ts")


@query("worker_liveness", "work_metrics", f"""SELECT queue AS worker, max(ts) AS last_seen,
  arg_max(CASE WHEN success THEN 'healthy' ELSE 'critical' END, event_id) AS status
  FROM work_metrics WHERE ts >= {NOW} - INTERVAL 1450 MINUTE GROUP BY 1""")
def _(s, d):
    beats = tb.work_metrics(s, d).select(
        F.col("queue").alias("worker"), "ts", F.when(F.col("success"), "healthy").otherwise("critical").alias("status")
    )
    return metrics.worker_liveness(beats, EVENTS_AS_OF, 1450)


@query("trunc_hour", "work_metrics", "SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, count(*) AS n FROM work_metrics GROUP BY 1")
def _(s, d):
    return tb.work_metrics(s, d).groupBy(times.trunc_hour(F.col("ts")).alias("hour")).agg(F.count(F.lit(1)).alias("n"))


@query("day_of", "work_metrics", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM work_metrics GROUP BY 1")
def _(s, d):
    return tb.work_metrics(s, d).groupBy(times.day_of(F.col("ts")).alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("safe_ratio", "work_metrics", """SELECT event_id, round(error_count::DOUBLE / nullif(batch_size, 0), 6) AS ratio,
  round(coalesce(error_count::DOUBLE / nullif(batch_size, 0), 0), 6) AS ratio_or_zero FROM work_metrics""")
def _(s, d):
    a, b = F.col("error_count"), F.col("batch_size")
    return tb.work_metrics(s, d).select(
        "event_id", times.safe_ratio(a, b).alias("ratio"), times.safe_ratio(a, b, 0.0).alias("ratio_or_zero")
    )


@query("retention", "work_metrics", f"""SELECT event_id, metric_name, ts FROM work_metrics WHERE ts >= {NOW} - INTERVAL 14 DAY""")
def _(s, d):
    return metrics.retention(tb.work_metrics(s, d), "raw_metrics", EVENTS_AS_OF).select("event_id", "metric_name", "ts")


@query("retention_by_partition", "work_metrics", f"""SELECT event_id, metric_name, ts FROM work_metrics WHERE ts >= date_trunc('day', {NOW} - INTERVAL 14 DAY)""")
def _(s, d):
    """A table stored by day, whose expired days are dropped as partitions."""
    store = dated.DatedTable(s, f"kept_metrics_{uuid.uuid4().hex}", "ts")
    store.append(tb.work_metrics(s, d).select("event_id", "metric_name", "ts"))
    store.expire(EVENTS_AS_OF, 14)
    return store.read()


@query("purge_by_partition", "work_metrics", f"""SELECT CAST(date_trunc('day', ts) AS DATE) AS day, count(*) AS dropped FROM work_metrics WHERE ts < date_trunc('day', {NOW} - INTERVAL 14 DAY) GROUP BY 1""")
def _(s, d):
    """Rows dropped with each expired day, counted on the dropped side alone."""
    store = dated.DatedTable(s, f"purged_metrics_{uuid.uuid4().hex}", "ts")
    store.append(tb.work_metrics(s, d).select("event_id", "metric_name", "ts"))
    return store.expire(EVENTS_AS_OF, 14)


@query("scaling_recommendations", "work_metrics messages", f"""WITH s AS ({SUMMARY_SQL}),
st AS (SELECT concat('q', CAST(user_id % 3 * 3 AS VARCHAR)) AS queue_name, count(*) AS depth FROM messages GROUP BY 1),
reg AS (SELECT queue_name FROM st UNION SELECT queue FROM s),
j AS (SELECT reg.queue_name, coalesce(depth, 0) AS depth, s.*, total_processed / 240.0::DOUBLE AS rate FROM reg LEFT JOIN st USING (queue_name) LEFT JOIN s ON s.queue = reg.queue_name),
k AS (SELECT *, CASE WHEN rate > 0 THEN depth / rate ELSE 0.0 END AS wait FROM j),
c AS (SELECT *, CASE WHEN metrics_count IS NULL THEN 'unknown' WHEN depth = 0 THEN 'empty' WHEN wait < 1 THEN 'optimal' WHEN wait < 4 THEN 'acceptable'
  WHEN wait < 24 THEN 'attention' ELSE 'critical' END AS kind FROM k)
SELECT queue_name, CASE kind WHEN 'empty' THEN 'optimal' ELSE kind END AS status,
 CASE kind WHEN 'unknown' THEN 'Insufficient metrics data' WHEN 'empty' THEN 'Queue empty, no scaling needed'
  WHEN 'optimal' THEN 'Queue will be processed within an hour, no scaling needed' WHEN 'acceptable' THEN 'Queue backlog is moderate'
  WHEN 'attention' THEN 'Consider increasing worker frequency or batch size' ELSE 'Significant backlog detected' END AS message,
 CASE kind WHEN 'optimal' THEN concat(printf('%.0f', round(wait * 60, 0)), ' minutes') WHEN 'acceptable' THEN concat(printf('%.1f', round(wait, 1)), ' hours')
  WHEN 'attention' THEN concat(printf('%.1f', round(wait, 1)), ' hours') WHEN 'critical' THEN concat(printf('%.1f', round(wait / 24, 1)), ' days') END AS estimated_time_to_empty,
 CASE kind WHEN 'attention' THEN 'Increase worker batch size or reduce worker interval'
  WHEN 'critical' THEN 'Deploy additional worker instances or increase batch size significantly' END AS suggestion,
 CASE WHEN kind <> 'unknown' THEN depth END AS current_depth,
 CASE WHEN kind <> 'unknown' THEN concat(printf('%.1f', round(rate, 1)), ' msgs/hour') END AS processing_rate,
 CASE WHEN kind <> 'unknown' THEN concat(printf('%.1f', round(error_rate * 100, 1)), '%') END AS error_rate FROM c""")
def _(s, d):
    named = tb.messages(s, d).withColumn(
        "queue_name", F.concat(F.lit("q"), (F.col("user_id") % 3 * 3).cast("string"))
    )
    status = queues.queue_status(named)
    summary = metrics.queue_summary(_tagged(s, d), EVENTS_AS_OF, 240)
    registry = named.select("queue_name").union(summary.select("queue")).distinct()
    return queues.scaling_recommendations(registry, status, summary, 240)


@query("rate_audit_fixed", "work_metrics", """SELECT queue, time_bucket(INTERVAL 1 HOUR, ts)::TIMESTAMP AS window_start, count(*) AS calls
  FROM work_metrics GROUP BY 1, 2 HAVING count(*) > 4 + 1""")
def _(s, d):
    return audits.rate_audit_fixed(tb.work_metrics(s, d), "queue", 4, 3600, burst=1)


@query("rate_audit_sliding", "work_metrics", """SELECT event_id, queue, calls_in_window FROM (SELECT event_id, queue,
  count(*) OVER (PARTITION BY queue ORDER BY ts RANGE BETWEEN INTERVAL 30 MINUTE PRECEDING AND CURRENT ROW) AS calls_in_window
  FROM work_metrics) WHERE calls_in_window > 3""")
def _(s, d):
    calls = tb.work_metrics(s, d).select("event_id", "queue", "ts")
    return audits.rate_audit_sliding(calls, "queue", 3, 1800).select("event_id", "queue", "calls_in_window")


STREAK_SQL = """runs AS (SELECT queue, ts, event_id, success,
  sum(CASE WHEN success THEN 1 ELSE 0 END) OVER (PARTITION BY queue ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM work_metrics)"""


@query("failure_streaks", "work_metrics", f"""WITH {STREAK_SQL} SELECT queue, count(*) AS failures, min(ts) AS started_at, max(ts) AS ended_at,
  count(*) >= 5 AS is_outage FROM runs WHERE NOT success GROUP BY queue, run""")
def _(s, d):
    return audits.failure_streaks(tb.work_metrics(s, d), "queue")


@query("service_status", "work_metrics", """WITH ok AS (SELECT queue, max(event_id) FILTER (success) AS ok FROM work_metrics GROUP BY 1)
SELECT queue, max(ts) FILTER (success) AS last_success, max(ts) FILTER (NOT success) AS last_failure,
  count(*) FILTER (NOT success AND event_id > ok) AS open_failures,
  CASE WHEN count(*) FILTER (NOT success AND event_id > ok) >= 5 THEN 'open' ELSE 'closed' END AS circuit
  FROM work_metrics JOIN ok USING (queue) GROUP BY 1""")
def _(s, d):
    return audits.service_status(tb.work_metrics(s, d), "queue")


@query("adaptive_failure_rate", "work_metrics", """SELECT queue, count(*) AS calls, count(*) FILTER (NOT success) AS failures,
  round(count(*) FILTER (NOT success)::DOUBLE / count(*), 6) AS failure_rate, count(*) FILTER (NOT success)::DOUBLE / count(*) > 0.5 AS reduce,
  time_bucket(INTERVAL 60 SECOND, ts)::TIMESTAMP AS window_start FROM work_metrics GROUP BY queue, window_start""")
def _(s, d):
    return audits.adaptive_failure_rate(tb.work_metrics(s, d), "queue")
