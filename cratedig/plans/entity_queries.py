"""Entity-state, worker-issue and health queries over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cratedig.functions import errors, formats, times
from cratedig.operators import audits, entities, health, ordered
from cratedig.plans.registry import query
from cratedig.sources import queue_files, testbed as tb
from cratedig.sources.testbed import EVENTS_AS_OF

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
ST = "entity_status"


def _status(s, d):
    return entities.latest_entity_state(tb.entity_events(s, d))


def _locks(s, d):
    """One lock per entity, with its last event as heartbeat."""
    last = tb.entity_events(s, d).groupBy("entity_type", "entity_id").agg(
        F.max("ts").alias("last_heartbeat"), F.max("event_id").alias("n")
    )
    return last.select(
        "entity_type", "entity_id", F.concat(F.lit("w"), (F.col("n") % 5).cast("string")).alias("worker_id"), "last_heartbeat"
    )


@query("latest_entity_state", ST, "SELECT * FROM entity_status")
def _(s, d):
    return _status(s, d)


@query("latest_entity_is_in_state", ST, """SELECT DISTINCT e.entity_type, e.entity_id + 5 AS entity_id, coalesce(st.state IN ('COMPLETED', 'PENDING'), false) AS in_state
  FROM entity_events e LEFT JOIN entity_status st ON st.entity_type = e.entity_type AND st.entity_id = e.entity_id + 5""")
def _(s, d):
    wanted = tb.entity_events(s, d).select("entity_type", (F.col("entity_id") + 5).alias("entity_id")).distinct()
    return entities.is_in_state(wanted, _status(s, d), ("COMPLETED", "PENDING"))


@query("latest_per_key", "entity_events", "SELECT entity_type, arg_max(entity_id, event_id) AS entity_id, max(event_id) AS event_id FROM entity_events GROUP BY 1")
def _(s, d):
    rows = tb.entity_events(s, d).select("entity_type", "entity_id", "event_id", "ts")
    return ordered.newest_per_key(rows, ["entity_type"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query("processing_stats", ST, f"""SELECT entity_type, count(*) AS total_count, count(*) FILTER (state = 'PENDING') AS pending_count,
  count(*) FILTER (state = 'IN_PROGRESS') AS in_progress_count, count(*) FILTER (state = 'COMPLETED') AS completed_count,
  count(*) FILTER (state = 'FAILED') AS failed_count, count(*) FILTER (state = 'DEAD_LETTER') AS dead_lettered_count,
  count(*) FILTER (state = 'IN_PROGRESS' AND last_processed_at < {NOW} - INTERVAL 30 MINUTE) AS stalled_count FROM entity_status GROUP BY 1""")
def _(s, d):
    return entities.processing_stats(_status(s, d), EVENTS_AS_OF)


@query("stats_left_stalled", ST, f"""SELECT entity_type, count(*) AS total_count, coalesce(n, 0) AS stalled_count FROM entity_status LEFT JOIN
  (SELECT entity_type, count(*) AS n FROM entity_status WHERE state = 'IN_PROGRESS' AND last_processed_at < {NOW} - INTERVAL 30 MINUTE GROUP BY 1) USING (entity_type)
  GROUP BY entity_type, n""")
def _(s, d):
    return entities.stats_left_stalled(_status(s, d), EVENTS_AS_OF)


@query("find_inconsistent_states", ST, f"""SELECT entity_type, entity_id, state AS db_state, last_processed_at,
  round((epoch_us({NOW}) - epoch_us(last_processed_at)) / 60000000.0::DOUBLE, 9) AS minutes_since_update FROM entity_status
  WHERE state IN ('IN_PROGRESS', 'PENDING') AND last_processed_at < {NOW} - INTERVAL 1800 MINUTE""", digits=9)
def _(s, d):
    return entities.find_inconsistent_states(_status(s, d), EVENTS_AS_OF, 1800)


@query("stuck_entities", ST, f"SELECT * FROM entity_status WHERE state = 'IN_PROGRESS' AND last_processed_at < {NOW} - INTERVAL 30 MINUTE")
def _(s, d):
    return entities.stuck_entities(_status(s, d), EVENTS_AS_OF, 30)


LOCK_SQL = """locks AS (SELECT entity_type, entity_id, concat('w', CAST(max(event_id) % 5 AS VARCHAR)) AS worker_id, max(ts) AS last_heartbeat FROM entity_events GROUP BY 1, 2)"""


@query("stale_locks", "entity_events", f"""WITH {LOCK_SQL} SELECT entity_type, entity_id, worker_id,
  round((epoch_us({NOW}) - epoch_us(last_heartbeat)) / 1000000.0::DOUBLE, 6) AS stale_seconds FROM locks WHERE last_heartbeat < {NOW} - INTERVAL 100000 SECOND""")
def _(s, d):
    return entities.stale_locks(_locks(s, d), EVENTS_AS_OF, 100000)


RESET = f"state IN ('COMPLETED', 'FAILED') AND last_processed_at < {NOW} - INTERVAL 1500 MINUTE"


@query("reset_entity_states", ST, f"""SELECT entity_type, entity_id, state AS previous_state, 'PENDING' AS state, {NOW} AS reset_at FROM entity_status WHERE {RESET}""")
def _(s, d):
    return entities.reset_entity_states(_status(s, d), EVENTS_AS_OF, 1500)[1]


@query("reset_entity_states_table", ST, f"""SELECT entity_type, entity_id, CASE WHEN {RESET} THEN 'PENDING' ELSE state END AS state,
  CASE WHEN {RESET} THEN {NOW} ELSE last_processed_at END AS last_processed_at, attempts FROM entity_status""")
def _(s, d):
    return entities.reset_entity_states(_status(s, d), EVENTS_AS_OF, 1500)[0]


ACTIONS_SQL = f"""act AS (SELECT entity_type, entity_id, 'IN_PROGRESS' AS state, 'lock_deleted' AS action FROM locks WHERE last_heartbeat < {NOW} - INTERVAL 1500 MINUTE
  UNION ALL SELECT entity_type, entity_id, 'PENDING', 'status_reset' FROM entity_status WHERE state = 'IN_PROGRESS' AND last_processed_at < {NOW} - INTERVAL 1500 MINUTE)"""


@query("maintenance_actions", ST, f"WITH {LOCK_SQL}, {ACTIONS_SQL} SELECT * FROM act")
def _(s, d):
    return entities.maintenance_actions(_locks(s, d), _status(s, d), EVENTS_AS_OF, 1500)


@query("cleanup_stale", ST, f"WITH {LOCK_SQL}, {ACTIONS_SQL} SELECT count(*) FILTER (action = 'lock_deleted') AS deleted_locks, count(*) FILTER (action = 'status_reset') AS reset_statuses FROM act")
def _(s, d):
    return entities.cleanup_stale(_locks(s, d), _status(s, d), EVENTS_AS_OF, 1500)["counts"]


@query("cleanup_stale_status", ST, f"""SELECT entity_type, entity_id, CASE WHEN state = 'IN_PROGRESS' AND last_processed_at < {NOW} - INTERVAL 1500 MINUTE THEN 'PENDING' ELSE state END AS state FROM entity_status""")
def _(s, d):
    out = entities.cleanup_stale(_locks(s, d), _status(s, d), EVENTS_AS_OF, 1500)["status"]
    return out.select("entity_type", "entity_id", "state")


@query("check_operation", "entity_events", """WITH op AS (SELECT entity_type, entity_id, concat('op', CAST(event_id % 4 AS VARCHAR)) AS operation_id, state FROM entity_events)
SELECT DISTINCT entity_type, entity_id, operation_id, (entity_type, entity_id, operation_id) IN (SELECT (entity_type, entity_id, operation_id) FROM op WHERE state = 'COMPLETED') AS completed FROM op""")
def _(s, d):
    ops = tb.entity_events(s, d).select(
        "entity_type", "entity_id", F.concat(F.lit("op"), (F.col("event_id") % 4).cast("string")).alias("operation_id"), "state"
    )
    return entities.check_operation(ops.drop("state").distinct(), ops)


def _cache(s, d):
    """A cache that missed the last two days, and every fifth entity."""
    early = tb.entity_events(s, d).filter(F.col("ts") < F.lit("2024-01-29 00:00:00").cast("timestamp_ntz"))
    return entities.latest_entity_state(early).filter(F.col("entity_id") % 5 != 0)


@query("reconcile_states", ST, """WITH c AS (SELECT entity_type, entity_id, arg_max(state, event_id) AS state FROM entity_events
  WHERE ts < TIMESTAMP '2024-01-29 00:00:00' AND entity_id % 5 <> 0 GROUP BY 1, 2)
SELECT e.entity_type, e.entity_id, e.state AS db_state, c.state AS cache_state FROM entity_status e LEFT JOIN c USING (entity_type, entity_id)
  WHERE e.state IS DISTINCT FROM c.state""")
def _(s, d):
    return entities.reconcile_states(_status(s, d), _cache(s, d))[0]


@query("state_transition_audit", "entity_events", """WITH p AS (SELECT *, lag(state) OVER (PARTITION BY entity_type, entity_id ORDER BY ts, event_id) AS previous_state FROM entity_events)
SELECT event_id, entity_type, entity_id, ts, state, previous_state, previous_state IS NULL OR (previous_state, state) IN (('PENDING', 'IN_PROGRESS'), ('PENDING', 'FAILED'),
  ('IN_PROGRESS', 'COMPLETED'), ('IN_PROGRESS', 'FAILED'), ('IN_PROGRESS', 'PENDING'), ('IN_PROGRESS', 'DEAD_LETTER'), ('COMPLETED', 'PENDING'),
  ('FAILED', 'PENDING'), ('FAILED', 'DEAD_LETTER'), ('DEAD_LETTER', 'PENDING')) AS valid FROM p""")
def _(s, d):
    return audits.state_transition_audit(tb.entity_events(s, d))


@query("array_any", "entity_events", "SELECT event_id, state IN ('COMPLETED', 'FAILED') AS hit FROM entity_events")
def _(s, d):
    return tb.entity_events(s, d).select("event_id", formats.array_any(F.col("state"), ["COMPLETED", "FAILED"]).alias("hit"))


@query("minutes_since", "entity_events", f"SELECT event_id, round((epoch_us({NOW}) - epoch_us(ts)) / 60000000.0::DOUBLE, 9) AS minutes FROM entity_events", digits=9)
def _(s, d):
    return tb.entity_events(s, d).select("event_id", times.minutes_since(F.col("ts"), EVENTS_AS_OF).alias("minutes"))


@query("hours_since", "entity_events", f"SELECT event_id, round((epoch_us({NOW}) - epoch_us(ts)) / 3600000000.0::DOUBLE, 10) AS hours FROM entity_events", digits=10)
def _(s, d):
    return tb.entity_events(s, d).select("event_id", times.hours_since(F.col("ts"), EVENTS_AS_OF).alias("hours"))


# --- issues and errors -----------------------------------------------------

@query("worker_issue_stats", "worker_issues", """SELECT worker_name, issue_type, count(*) AS issue_count, count(*) FILTER (resolved) AS resolved_count,
  count(*) FILTER (NOT resolved) AS unresolved_count, max(created_at) AS latest_issue, arg_max(message, event_id) AS latest_message FROM worker_issues GROUP BY 1, 2""")
def _(s, d):
    return health.worker_issue_stats(tb.worker_issues(s, d))


@query("worker_issue_summary", "worker_issues", f"""WITH n AS (SELECT * FROM worker_issues WHERE created_at >= {NOW} - INTERVAL 240 HOUR ORDER BY created_at DESC, event_id DESC LIMIT 100)
SELECT 'worker' AS "grouping", worker_name AS name, count(*) AS issue_count FROM n GROUP BY 2 UNION ALL SELECT 'type', issue_type, count(*) FROM n GROUP BY 2""")
def _(s, d):
    return health.worker_issue_summary(tb.worker_issues(s, d), EVENTS_AS_OF, 240, 100)


CAT_SQL = """cat AS (SELECT event_id, ts, concat('T', CAST(user_id % 4 AS VARCHAR)) AS entity_type, user_id AS entity_id, concat('op', CAST(user_id % 3 AS VARCHAR)) AS operation,
  CASE event_id % 8 WHEN 0 THEN 'spotify api rate limit hit' WHEN 1 THEN 'genius unauthorized' WHEN 2 THEN 'database timeout' WHEN 3 THEN 'invalid artist'
   WHEN 4 THEN 'bad request' WHEN 5 THEN 'internal error' WHEN 6 THEN 'spotify: not found' ELSE 'boom' END AS message,
  CASE event_id % 8 WHEN 0 THEN 'TRANSIENT_RATE_LIMIT' WHEN 1 THEN 'PERMANENT_AUTH' WHEN 2 THEN 'TRANSIENT_TIMEOUT' WHEN 3 THEN 'PERMANENT_VALIDATION'
   WHEN 4 THEN 'PERMANENT_BAD_REQUEST' WHEN 5 THEN 'SYSTEM' WHEN 6 THEN 'PERMANENT_NOT_FOUND' ELSE 'UNKNOWN' END AS category FROM events)"""
# texts behind CAT_SQL, by event_id % 8
ERROR_TEXTS = [
    "spotify api rate limit hit", "genius unauthorized", "database timeout", "invalid artist",
    "bad request", "internal error", "spotify: not found", "boom",
]


def _errors(s, d):
    e = F.col("event_id")
    message = F.element_at(F.array(*[F.lit(t) for t in ERROR_TEXTS]), (e % 8 + 1).cast("int"))
    return tb.table(s, d, "events").select(
        e, "ts", F.concat(F.lit("T"), (F.col("user_id") % 4).cast("string")).alias("entity_type"),
        F.col("user_id").alias("entity_id"), F.concat(F.lit("op"), (F.col("user_id") % 3).cast("string")).alias("operation"),
        message.alias("message"),
    ).withColumn("category", errors.classify_error(F.col("message")))


@query("classify_error", "", f"WITH {CAT_SQL} SELECT event_id, message, category FROM cat")
def _(s, d):
    return _errors(s, d).select("event_id", "message", "category")


@query("classify_error_simple", "", f"""WITH {CAT_SQL} SELECT event_id, CASE WHEN event_id % 8 IN (0, 2) THEN 'TRANSIENT' WHEN event_id % 8 IN (1, 3, 6) THEN 'PERMANENT' ELSE 'UNKNOWN' END AS kind FROM cat""")
def _(s, d):
    return _errors(s, d).select("event_id", errors.classify_error_simple(F.col("message")).alias("kind"))


@query("is_retriable", "", f"WITH {CAT_SQL} SELECT event_id, category IN ('TRANSIENT_RATE_LIMIT', 'TRANSIENT_TIMEOUT', 'UNKNOWN') AS retriable FROM cat")
def _(s, d):
    return _errors(s, d).select("event_id", errors.is_retriable(F.col("category")).alias("retriable"))


@query("error_counts", "", f"WITH {CAT_SQL} SELECT operation, category, count(*) AS errors FROM cat WHERE ts > {NOW} - INTERVAL 240 HOUR GROUP BY 1, 2")
def _(s, d):
    return audits.error_counts(_errors(s, d), EVENTS_AS_OF, 240)


@query("error_counts_recent", "", f"""WITH {CAT_SQL} SELECT event_id, entity_type, entity_id, category FROM (SELECT *, row_number() OVER (PARTITION BY entity_type, entity_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM cat WHERE ts > {NOW} - INTERVAL 720 HOUR) WHERE rn <= 3""")
def _(s, d):
    return audits.recent_errors(_errors(s, d), EVENTS_AS_OF, 3, 720).select("event_id", "entity_type", "entity_id", "category")


POLICY_SQL = """pol(category, max_retries, base_delay_ms, max_delay_ms, jitter_factor, timeout_ms) AS (VALUES ('TRANSIENT_RATE_LIMIT', 7, 1000, 60000, 0.1::DOUBLE, 3000),
 ('PERMANENT_AUTH', 0, 0, 0, 0.0, 3000), ('TRANSIENT_TIMEOUT', 3, 500, 5000, 0.2, 8000), ('PERMANENT_VALIDATION', 0, 0, 0, 0.0, 3000), ('PERMANENT_BAD_REQUEST', 0, 0, 0, 0.0, 3000),
 ('SYSTEM', 1, 1000, 3000, 0.1, 10000), ('PERMANENT_NOT_FOUND', 0, 0, 0, 0.0, 3000), ('UNKNOWN', 2, 500, 5000, 0.3, 5000))"""


@query("retry_policy_join", "", f"WITH {CAT_SQL}, {POLICY_SQL} SELECT event_id, category, max_retries, base_delay_ms, max_delay_ms, jitter_factor, timeout_ms FROM cat JOIN pol USING (category)")
def _(s, d):
    return errors.retry_policy_join(_errors(s, d).select("event_id", "category"))


@query("retry_delay_ms", "", f"""WITH {CAT_SQL}, {POLICY_SQL} SELECT event_id, greatest(base_delay_ms::DOUBLE, least(base_delay_ms * pow(2, event_id % 10), max_delay_ms)) AS delay_ms FROM cat JOIN pol USING (category)""")
def _(s, d):
    rows = errors.retry_policy_join(_errors(s, d).select("event_id", "category"))
    delay = errors.retry_delay_ms(F.col("event_id") % 10, F.col("base_delay_ms"), F.col("max_delay_ms"))
    return rows.select("event_id", delay.alias("delay_ms"))


@query("dead_letter_record", "", f"""WITH {CAT_SQL} SELECT event_id, operation AS original_queue, CAST(event_id AS VARCHAR) AS original_message_id, message AS error_message,
  'QUEUEError' AS error_name, category AS error_category, category IN ('TRANSIENT_RATE_LIMIT', 'TRANSIENT_TIMEOUT', 'UNKNOWN') AS retriable, event_id % 5 AS attempts FROM cat""")
def _(s, d):
    record = errors.dead_letter_record(
        F.col("message"), F.col("operation"), F.col("event_id"), F.col("message"), F.col("category"),
        F.col("event_id") % 5, F.col("ts"),
    )
    return _errors(s, d).select("event_id", record.alias("r")).select(
        "event_id", "r.original_queue", "r.original_message_id", F.col("r.error.message").alias("error_message"),
        F.col("r.error.name").alias("error_name"), F.col("r.error.category").alias("error_category"),
        "r.error.retriable", "r.context.attempts",
    )


@query("emit_issue", "worker_issues", "SELECT worker_name, issue_type, 'error' AS severity, message, false AS resolved, created_at FROM worker_issues")
def _(s, d):
    rows = queue_files.emit_issue(
        tb.worker_issues(s, d), F.col("worker_name"), F.col("issue_type"), F.col("message"), F.col("created_at"), F.lit("error")
    )
    return rows.select("worker_name", "issue_type", "severity", "message", "resolved", "created_at")


@query("emit_event", "worker_issues", """SELECT 'stale_entity_cleanup' AS event_type, concat('{"worker":"', worker_name, '","id":', CAST(event_id AS VARCHAR), '}') AS details, created_at FROM worker_issues""")
def _(s, d):
    details = F.to_json(F.struct(F.col("worker_name").alias("worker"), F.col("event_id").alias("id")))
    return queue_files.emit_event(tb.worker_issues(s, d), F.lit("stale_entity_cleanup"), details, F.col("created_at"))


@query("purge_events", "worker_issues", f"SELECT event_id, created_at FROM worker_issues WHERE created_at >= {NOW} - INTERVAL 12 DAY")
def _(s, d):
    from cratedig.operators.metrics import purge_events

    return purge_events(tb.worker_issues(s, d).select("event_id", "created_at"), EVENTS_AS_OF, 12)[0]


@query("purge_events_count", "worker_issues", f"SELECT count(*) AS deleted_count FROM worker_issues WHERE created_at < {NOW} - INTERVAL 12 DAY")
def _(s, d):
    from cratedig.operators.metrics import purge_events

    return purge_events(tb.worker_issues(s, d), EVENTS_AS_OF, 12)[1]


# --- health ----------------------------------------------------------------

HEALTH = "messages worker_issues entity_status"


@query("system_health", HEALTH, f"""WITH q AS (SELECT queue_name, count(*) FILTER (vt < {NOW}) AS stuck FROM messages GROUP BY 1),
a AS (SELECT count(*) AS queues_checked, count(*) FILTER (stuck > 0) AS queues_with_issues, CAST(sum(stuck) AS BIGINT) AS total_stuck_messages FROM q),
b AS (SELECT count(*) AS entities_checked, count(*) FILTER (state = 'IN_PROGRESS' AND last_processed_at < {NOW} - INTERVAL 30 MINUTE) AS stuck_entities,
  count(*) FILTER (state = 'FAILED') AS failed_entities FROM entity_status WHERE last_processed_at > {NOW} - INTERVAL 24 HOUR),
c AS (SELECT count(*) AS total_issues, count(DISTINCT worker_name) AS workers_with_issues, max(created_at) AS latest_issue_time FROM worker_issues WHERE NOT resolved),
l AS (SELECT *, CASE WHEN total_stuck_messages > 10 THEN 'critical' WHEN total_stuck_messages > 0 THEN 'warning' ELSE 'healthy' END AS queue_status,
  CASE WHEN stuck_entities > 5 OR failed_entities > 10 THEN 'critical' WHEN stuck_entities > 0 OR failed_entities > 0 THEN 'warning' ELSE 'healthy' END AS processing_status,
  CASE WHEN total_issues > 5 THEN 'critical' WHEN total_issues > 0 THEN 'warning' ELSE 'healthy' END AS worker_status FROM a, b, c)
SELECT *, CASE WHEN 'critical' IN (queue_status, processing_status, worker_status) THEN 'critical' WHEN 'warning' IN (queue_status, processing_status, worker_status) THEN 'warning'
  ELSE 'healthy' END AS overall_status FROM l""")
def _(s, d):
    return health.system_health(tb.messages(s, d), _status(s, d), tb.worker_issues(s, d), EVENTS_AS_OF)


@query("system_health_doc", HEALTH, f"""WITH q AS (SELECT queue_name, count(*) FILTER (vt < {NOW} - INTERVAL 10 MINUTE) AS stuck FROM messages GROUP BY 1),
a AS (SELECT count(*) AS total_queues, count(*) FILTER (stuck > 0) AS queues_with_stuck_messages, CAST(sum(stuck) AS BIGINT) AS total_stuck_messages FROM q),
b AS (SELECT count(*) FILTER (state = 'IN_PROGRESS') AS entities_in_progress, count(*) FILTER (state = 'IN_PROGRESS' AND last_processed_at < {NOW} - INTERVAL 30 MINUTE) AS entities_stalled,
  count(*) FILTER (state = 'FAILED') AS entities_failed, count(*) FILTER (state = 'DEAD_LETTER') AS entities_dead_lettered FROM entity_status),
w AS (SELECT worker_name, issue_type, count(*) FILTER (NOT resolved) AS open, max(created_at) AS latest FROM worker_issues GROUP BY 1, 2),
c AS (SELECT CAST(sum(open) AS BIGINT) AS total_unresolved_issues, count(DISTINCT worker_name) AS workers_with_issues, max(latest) AS latest_issue_time,
  CAST(coalesce(sum(open) FILTER (latest > {NOW} - INTERVAL 1 HOUR), 0) AS BIGINT) AS recent_unresolved FROM w)
SELECT *, CASE WHEN total_stuck_messages > 10 OR entities_stalled > 10 OR recent_unresolved > 5 THEN 'unhealthy'
  WHEN total_stuck_messages > 0 OR entities_stalled > 0 OR recent_unresolved > 0 THEN 'warning' ELSE 'healthy' END AS overall_status FROM a, b, c""")
def _(s, d):
    return health.system_health_doc(tb.messages(s, d), _status(s, d), tb.worker_issues(s, d), EVENTS_AS_OF)


@query("system_health_details", HEALTH, f"""WITH q AS (SELECT queue_name, count(*) AS n, count(*) FILTER (vt < {NOW} - INTERVAL 10 MINUTE) AS stuck FROM messages GROUP BY 1),
p AS (SELECT entity_type, count(*) FILTER (state = 'IN_PROGRESS') AS a, count(*) FILTER (state = 'IN_PROGRESS' AND last_processed_at < {NOW} - INTERVAL 30 MINUTE) AS b, count(*) FILTER (state = 'FAILED') AS c FROM entity_status GROUP BY 1)
SELECT 'queues' AS component, queue_name AS item, 'total_messages' AS measure, n AS value FROM q UNION ALL SELECT 'queues', queue_name, 'stuck_messages', stuck FROM q
UNION ALL SELECT 'processing', entity_type, 'in_progress_count', a FROM p UNION ALL SELECT 'processing', entity_type, 'stalled_count', b FROM p UNION ALL SELECT 'processing', entity_type, 'failed_count', c FROM p
UNION ALL SELECT 'worker_issues', concat(worker_name, '/', issue_type), 'unresolved_count', count(*) FILTER (NOT resolved) FROM worker_issues GROUP BY worker_name, issue_type""")
def _(s, d):
    return health.health_details(tb.messages(s, d), _status(s, d), tb.worker_issues(s, d), EVENTS_AS_OF)


@query("operator_health", HEALTH + " work_metrics", f"""WITH {LOCK_SQL}, ok AS (SELECT queue, max(event_id) FILTER (success) AS ok FROM work_metrics GROUP BY 1)
SELECT 'stale_locks' AS "check", 'all' AS item, count(*) AS problems FROM locks WHERE last_heartbeat < {NOW} - INTERVAL 3600 SECOND
UNION ALL SELECT 'stuck_entities', 'all', count(*) FROM entity_status WHERE state = 'IN_PROGRESS' AND last_processed_at < {NOW} - INTERVAL 30 MINUTE
UNION ALL SELECT 'stuck_messages', queue_name, count(*) FILTER (vt < {NOW} - INTERVAL 15 MINUTE) FROM messages GROUP BY 2
UNION ALL SELECT 'open_failures', queue, count(*) FILTER (NOT success AND event_id > ok) FROM work_metrics JOIN ok USING (queue) GROUP BY 2""")
def _(s, d):
    return health.operator_health(
        _locks(s, d), _status(s, d), tb.messages(s, d), tb.work_metrics(s, d), "queue", EVENTS_AS_OF
    )
