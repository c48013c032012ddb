"""Queue, dead-letter and repeat-detection queries over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cratedig.functions import bodies, errors, text
from cratedig.operators import dedup, dlq, metrics, queues, upsert
from cratedig.plans.registry import query
from cratedig.sources import queue_files, testbed as tb
from cratedig.sources.testbed import EVENTS_AS_OF

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
MSG = ["msg_id", "queue_name", "enqueued_at", "read_ct", "vt", "message"]
MSG_SQL = "msg_id, queue_name, enqueued_at, read_ct, vt, message"
STUCK_SQL = f"vt IS NOT NULL AND vt < {NOW} - INTERVAL 20000 MINUTE"
STUCK_MIN = 20000


def _messages(s, d):
    return tb.messages(s, d).select(*MSG)


@query("visible_messages", "messages", f"""SELECT {MSG_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY queue_name ORDER BY msg_id) AS rn
  FROM messages WHERE vt IS NULL) WHERE rn <= 10""")
def _(s, d):
    return queues.visible_messages(_messages(s, d), 10)


@query("next_batch", "messages", f"SELECT {MSG_SQL} FROM messages WHERE queue_name = 'view' AND vt IS NULL ORDER BY msg_id LIMIT 10")
def _(s, d):
    return queues.next_batch(_messages(s, d), "view", 10)


@query("inspect_messages", "messages", f"SELECT {MSG_SQL} FROM messages WHERE queue_name = 'click' AND vt IS NULL ORDER BY enqueued_at DESC, msg_id DESC LIMIT 10")
def _(s, d):
    return queues.inspect_messages(_messages(s, d), "click", 10)


@query("read_recent", "work_metrics", f"SELECT event_id, metric_name, round(metric_value, 6) AS metric_value, ts FROM work_metrics WHERE ts >= {NOW} - INTERVAL 30 HOUR")
def _(s, d):
    return queues.read_recent(tb.work_metrics(s, d), EVENTS_AS_OF, 30).select("event_id", "metric_name", "metric_value", "ts")


@query("recent_n", "worker_issues", "SELECT event_id, worker_name, created_at FROM worker_issues ORDER BY created_at DESC, event_id DESC LIMIT 10")
def _(s, d):
    return queues.recent_n(tb.worker_issues(s, d).select("event_id", "worker_name", "created_at"), 10)


@query("queue_name_norm", "messages", """SELECT msg_id, queue_name FROM messages""")
def _(s, d):
    n = F.col("msg_id") % 3
    stored = F.concat(F.when(n == 0, "pgmq.").when(n == 1, "q_").otherwise(""), F.col("queue_name"))
    return _messages(s, d).select("msg_id", queues.queue_name_norm(stored).alias("queue_name"))


@query("list_stuck_messages", "messages", f"""SELECT queue_name, CAST(msg_id AS VARCHAR) AS msg_id, message, vt AS locked_since, read_ct AS read_count,
  round((epoch_us({NOW}) - epoch_us(vt)) / 60000000.0::DOUBLE, 9) AS minutes_locked FROM messages WHERE {STUCK_SQL}""", digits=9)
def _(s, d):
    return queues.list_stuck_messages(_messages(s, d), EVENTS_AS_OF, STUCK_MIN)


@query("reset_stuck_messages", "messages", f"SELECT msg_id, queue_name, enqueued_at, read_ct, CASE WHEN {STUCK_SQL} THEN NULL ELSE vt END AS vt, message FROM messages")
def _(s, d):
    return queues.reset_stuck_messages(_messages(s, d), EVENTS_AS_OF, STUCK_MIN)


@query("reset_all_stuck", "messages", f"SELECT queue_name, count(*) AS messages_reset FROM messages WHERE {STUCK_SQL} GROUP BY 1")
def _(s, d):
    return queues.reset_all_stuck(_messages(s, d), EVENTS_AS_OF, STUCK_MIN)


REQUEUE_SQL = f"""top AS (SELECT queue_name, max(msg_id) AS top FROM messages GROUP BY 1),
st AS (SELECT m.*, top + row_number() OVER (PARTITION BY queue_name ORDER BY msg_id) AS new_id FROM messages m JOIN top USING (queue_name) WHERE {STUCK_SQL})"""


@query("requeue_stuck", "messages", f"""WITH {REQUEUE_SQL} SELECT {MSG_SQL} FROM messages WHERE NOT ({STUCK_SQL})
  UNION ALL SELECT new_id, queue_name, {NOW}, 0, NULL, message FROM st""")
def _(s, d):
    return queues.requeue_stuck(_messages(s, d), EVENTS_AS_OF, STUCK_MIN)[0]


@query("requeue_stuck_report", "messages", f"WITH {REQUEUE_SQL} SELECT queue_name, msg_id AS old_msg_id, new_id AS new_msg_id FROM st")
def _(s, d):
    return queues.requeue_stuck(_messages(s, d), EVENTS_AS_OF, STUCK_MIN)[1]


# ids asked about: every event asks for a shifted id in its own queue
ASKED_SQL = "asked AS (SELECT DISTINCT event_type AS queue_name, CAST(event_id * 2 AS VARCHAR) AS message_id FROM events)"


def _asked(s, d):
    return tb.table(s, d, "events").select(
        F.col("event_type").alias("queue_name"), (F.col("event_id") * 2).cast("string").alias("message_id")
    ).distinct()


@query("message_exists", "messages", f"""WITH {ASKED_SQL} SELECT queue_name, message_id,
  (queue_name, message_id) IN (SELECT (queue_name, CAST(msg_id AS VARCHAR)) FROM messages) AS found FROM asked""")
def _(s, d):
    return queues.message_exists(_asked(s, d), _messages(s, d))


@query("delete_messages", "messages", f"""WITH {ASKED_SQL} SELECT {MSG_SQL} FROM messages
  WHERE (queue_name, CAST(msg_id AS VARCHAR)) NOT IN (SELECT (queue_name, message_id) FROM asked)""")
def _(s, d):
    return queues.delete_messages(_messages(s, d), _asked(s, d))


@query("is_retryable", "messages", "SELECT msg_id, read_ct < 3 AS retryable FROM messages")
def _(s, d):
    return _messages(s, d).select("msg_id", queues.is_retryable(F.col("read_ct"), 3).alias("retryable"))


@query("at_max_retries", "messages", "SELECT queue_name, read_ct >= 3 AS spent, count(*) AS n FROM messages GROUP BY 1, 2")
def _(s, d):
    spent = queues.at_max_retries(F.col("read_ct"), 3).alias("spent")
    return _messages(s, d).groupBy("queue_name", spent).agg(F.count(F.lit(1)).alias("n"))


@query("stream_retry_count", "messages", "SELECT msg_id, read_ct + 1 AS read_ct FROM messages WHERE read_ct < 3")
def _(s, d):
    """Messages given back for another try carry one more read."""
    return _messages(s, d).filter(queues.is_retryable(F.col("read_ct"), 3)).select(
        "msg_id", (F.col("read_ct") + 1).alias("read_ct")
    )


@query("queue_status", "messages", "SELECT queue_name, count(*) AS message_count, min(enqueued_at) AS oldest_message FROM messages GROUP BY 1")
def _(s, d):
    return queues.queue_status(_messages(s, d))


@query("queue_monitor", "messages", f"""SELECT queue_name, count(*) AS total_messages, count(*) FILTER (vt < {NOW}) AS stuck_messages,
  CAST(NULL AS BIGINT) AS messages_fixed, {NOW} AS last_check_time FROM messages GROUP BY 1""")
def _(s, d):
    return queues.queue_monitor(_messages(s, d), EVENTS_AS_OF)


def _monitor_events(s, d):
    """Each purchase event stands for one monitor report about a queue."""
    e = F.col("event_id")
    details = F.to_json(F.struct(
        F.concat(F.lit("queue"), (F.col("user_id") % 6).cast("string")).alias("queue_name"),
        (e % 97).alias("totalMessagesInQueues"), (e % 11).alias("totalStuckMessages"),
        (e % 5).cast("string").alias("messagesFixed"), (e % 7).alias("messagesReset"),
    ))
    return tb.table(s, d, "events").filter(F.col("event_type") == "purchase").select(
        F.lit("queue_monitor").alias("event_type"), details.alias("details"), F.col("ts").alias("created_at"), e
    )


MONITOR_SQL = f"""mon AS (SELECT concat('queue', CAST(user_id % 6 AS VARCHAR)) AS queue_name, event_id, ts FROM events
  WHERE event_type = 'purchase' AND ts > {NOW} - INTERVAL 240 HOUR)"""


@query("queue_monitor_events", "", f"""WITH {MONITOR_SQL} SELECT queue_name, max(event_id % 97) AS total_messages, max(event_id % 11) AS stuck_messages,
  max(event_id % 5) AS messages_fixed, max(ts) AS last_check_time FROM mon GROUP BY 1""")
def _(s, d):
    return queues.queue_monitor_events(_monitor_events(s, d), EVENTS_AS_OF, 240)


@query("queue_monitor_doc", "messages", """WITH mon AS (SELECT event_type AS queue_name, event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-30 00:00:00'),
reg AS (SELECT DISTINCT queue_name FROM messages),
f AS (SELECT queue_name, count(*) AS total, count(*) FILTER (vt IS NOT NULL AND vt < TIMESTAMP '2024-01-30 23:50:00') AS stuck FROM messages GROUP BY 1),
n AS (SELECT queue_name, max(ts) AS last_check_time, arg_max(event_id % 7, event_id) AS fixed FROM mon GROUP BY 1)
SELECT queue_name, coalesce(total, 0) AS total_messages, coalesce(stuck, 0) AS stuck_messages, last_check_time, coalesce(fixed, 0) AS messages_fixed
FROM reg LEFT JOIN f USING (queue_name) LEFT JOIN n USING (queue_name)""")
def _(s, d):
    e = F.col("event_id")
    details = F.to_json(F.struct(F.col("event_type").alias("queue_name"), (e % 7).alias("messagesReset")))
    events = tb.table(s, d, "events").select(
        F.lit("queue_monitor").alias("event_type"), details.alias("details"), F.col("ts").alias("created_at")
    )
    return queues.queue_monitor_doc(tb.queue_registry(s, d), _messages(s, d), events, EVENTS_AS_OF)


@query("diagnose_queues", "messages", f"""SELECT queue_name, count(*) AS total_messages, count(vt) AS in_progress_messages,
  count(*) FILTER (vt IS NOT NULL AND vt < {NOW} - INTERVAL 10 MINUTE) AS stuck_messages,
  round(coalesce(max((epoch_us({NOW}) - epoch_us(vt)) / 60000000.0::DOUBLE), 0), 9) AS oldest_message_age_minutes FROM messages GROUP BY 1""", digits=9)
def _(s, d):
    return queues.diagnose_queues(_messages(s, d), EVENTS_AS_OF)


@query("registry_left_queue_status", "messages", """SELECT r.queue_name, coalesce(n, 0) AS message_count, oldest AS oldest_message
  FROM (SELECT DISTINCT queue_name FROM messages UNION SELECT DISTINCT concat('unused_', queue_name) FROM messages) r LEFT JOIN
  (SELECT queue_name, count(*) AS n, min(enqueued_at) AS oldest FROM messages GROUP BY 1) USING (queue_name)""")
def _(s, d):
    registry = tb.queue_registry(s, d)
    unused = registry.select(F.concat(F.lit("unused_"), "queue_name").alias("queue_name"))
    return queues.registry_left_queue_status(registry.unionByName(unused), _messages(s, d))


@query("all_queue_snapshots", "messages", f"SELECT {MSG_SQL} FROM messages ")
def _(s, d):
    m = _messages(s, d)
    kinds = ("view", "click", "error", "purchase", "signup")
    parts = {f"q_{q}": m.filter(F.col("queue_name") == q).drop("queue_name") for q in kinds}
    return queues.all_queue_snapshots(parts).select(*MSG)


# workers are named after queue stems, some with wildcard characters in the queue name
WORKERS_SQL = """iss AS (SELECT event_id, concat('Worker_', upper(event_type), '_', CAST(user_id % 3 AS VARCHAR)) AS worker_name, event_id % 2 = 0 AS resolved, ts AS created_at FROM events),
reg AS (SELECT DISTINCT event_type AS queue_name FROM events UNION SELECT DISTINCT concat(substr(event_type, 1, 2), '_', substr(event_type, 4, 20)) FROM events UNION SELECT DISTINCT concat('no_', event_type) FROM events)"""
LIKE_SQL = f"""cnt AS (SELECT reg.queue_name, count(iss.event_id) AS recent_issues_count FROM reg LEFT JOIN iss ON iss.worker_name ILIKE concat('%', reg.queue_name, '%')
  AND NOT iss.resolved AND iss.created_at > {NOW} - INTERVAL 48 HOUR GROUP BY 1)"""


def _workers(s, d):
    e = tb.table(s, d, "events")
    issues = e.select(
        "event_id",
        F.concat(F.lit("Worker_"), F.upper("event_type"), F.lit("_"), (F.col("user_id") % 3).cast("string")).alias("worker_name"),
        (F.col("event_id") % 2 == 0).alias("resolved"),
        F.col("ts").alias("created_at"),
    )
    t = F.col("event_type")
    names = F.array(t, F.concat(F.substring(t, 1, 2), F.lit("_"), F.substring(t, 4, 20)), F.concat(F.lit("no_"), t))
    return e.select(F.explode(names).alias("queue_name")).distinct(), issues


@query("issues_like_queue", "", f"WITH {WORKERS_SQL}, {LIKE_SQL} SELECT * FROM cnt")
def _(s, d):
    registry, issues = _workers(s, d)
    return queues.issues_like_queue(registry, issues, EVENTS_AS_OF, 48)


@query("active_queue_monitoring", "messages work_metrics", f"""WITH {WORKERS_SQL}, iss1 AS (SELECT * FROM iss WHERE NOT resolved AND created_at > {NOW} - INTERVAL 1 HOUR),
cnt AS (SELECT reg.queue_name, count(iss1.event_id) AS n FROM reg LEFT JOIN iss1 ON iss1.worker_name ILIKE concat('%', reg.queue_name, '%') GROUP BY 1),
st AS (SELECT queue_name, count(*) AS n, min(enqueued_at) AS oldest FROM messages GROUP BY 1),
av AS (SELECT event_type AS queue_name, avg(batch_size) AS ap, avg(error_count) AS ae FROM work_metrics JOIN events USING (event_id) WHERE work_metrics.ts > {NOW} - INTERVAL 60 HOUR GROUP BY 1)
SELECT reg.queue_name, coalesce(st.n, 0) AS message_count, st.oldest AS oldest_message, round(ap, 6) AS avg_processed_per_batch, round(ae, 6) AS avg_errors_per_batch,
 cnt.n AS recent_issues_count, CASE WHEN coalesce(st.n, 0) = 0 THEN 'empty' WHEN st.n > 1000 THEN 'high' WHEN st.n > 100 THEN 'medium' ELSE 'normal' END AS queue_load,
 CASE WHEN ap IS NULL THEN NULL WHEN ae / nullif(ap, 0) > 0.2 THEN 'high' WHEN ae / nullif(ap, 0) > 0.05 THEN 'medium' ELSE 'normal' END AS error_rate_status,
 CASE WHEN st.oldest IS NULL THEN NULL WHEN st.oldest < {NOW} - INTERVAL 1 DAY THEN 'stale' ELSE 'normal' END AS age_status
FROM reg LEFT JOIN st USING (queue_name) LEFT JOIN av USING (queue_name) LEFT JOIN cnt USING (queue_name)""")
def _(s, d):
    registry, issues = _workers(s, d)
    m = tb.messages(s, d)
    e = F.col("event_id")
    tags = F.create_map(
        F.lit("queue"), F.col("event_type"), F.lit("processed"), (e % 20).cast("string"), F.lit("errors"), (e % 3).cast("string")
    )
    recent = metrics.recent_avg_per_queue(tb.table(s, d, "events").select("ts", tags.alias("tags")), EVENTS_AS_OF, 60).withColumnRenamed("queue", "queue_name")
    return queues.active_queue_monitoring(registry, m, recent, issues, EVENTS_AS_OF)


@query("register_queue", "messages", f"""WITH old AS (SELECT DISTINCT queue_name, concat('Old ', queue_name) AS display_name, 'old text' AS description FROM messages),
nw AS (SELECT DISTINCT CASE WHEN queue_name = 'view' THEN 'brand_new' ELSE queue_name END AS queue_name,
  CASE WHEN queue_name IN ('click', 'view') THEN NULL ELSE concat('New ', queue_name) END AS display_name FROM messages WHERE queue_name <> 'error')
SELECT queue_name, coalesce(nw.display_name, old.display_name, queue_name) AS display_name, old.description AS description,
  true AS active, CASE WHEN old.queue_name IS NOT NULL AND nw.queue_name IS NOT NULL THEN {NOW} WHEN old.queue_name IS NOT NULL THEN TIMESTAMP '2024-01-01 00:00:00' END AS updated_at
FROM old FULL JOIN nw USING (queue_name)""")
def _(s, d):
    base = tb.queue_registry(s, d)
    q = F.col("queue_name")
    old = base.select(
        q, F.concat(F.lit("Old "), q).alias("display_name"), F.lit("old text").alias("description"),
        F.lit(True).alias("active"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"),
    )
    new = base.filter(q != "error").select(
        F.when(q == "view", "brand_new").otherwise(q).alias("queue_name"),
        F.when(~q.isin("click", "view"), F.concat(F.lit("New "), q)).alias("display_name"),
        F.lit(None).cast("string").alias("description"),
        F.lit(True).alias("active"),
    )
    return upsert.register_queue(old, new, EVENTS_AS_OF)


@query("batch_ids", "tracks", """SELECT batch, min(track_id) AS first_id, max(track_id) AS last_id, count(*) AS n FROM
  (SELECT track_id, (row_number() OVER (ORDER BY track_id) - 1) // 50 AS batch FROM tracks) GROUP BY 1""")
def _(s, d):
    rows = queues.batch_ids(tb.tracks(s, d), "track_id", 50)
    return rows.select("batch", F.array_min("ids").alias("first_id"), F.array_max("ids").alias("last_id"), "n")


@query("discovery_job_ids", "albums", """SELECT batch, min(artist_id) AS first_id, max(artist_id) AS last_id, count(*) AS n FROM
  (SELECT artist_id, (row_number() OVER (ORDER BY artist_id) - 1) // 1000 AS batch FROM (SELECT DISTINCT artist_id FROM albums)) GROUP BY 1""")
def _(s, d):
    rows = queues.discovery_job_ids(tb.albums(s, d), "artist_id", 1000)
    return rows.select("batch", F.array_min("ids").alias("first_id"), F.array_max("ids").alias("last_id"), "n")


@query("album_discovery_status", "messages albums", """SELECT (SELECT count(*) FROM messages WHERE queue_name = 'view') AS total_enqueued,
  (SELECT count(*) FROM albums) AS total_processed, (SELECT count(DISTINCT user_id) FROM messages WHERE queue_name = 'view') AS artist_count,
  (SELECT count(*) FROM messages WHERE queue_name = 'view') - (SELECT count(*) FROM albums) AS pending""")
def _(s, d):
    asked = tb.messages(s, d).filter(F.col("queue_name") == "view").select(F.col("user_id").alias("artist_id"))
    return queues.album_discovery_status(asked, tb.albums(s, d))


# --- repeats ---------------------------------------------------------------

SEEN_SQL = f"""seen AS (SELECT concat('dedup:', event_type, ':', CAST(user_id AS VARCHAR)) AS dedup_key, ts AS first_seen_at, ts + INTERVAL 2 DAY AS expires_at FROM events),
msg AS (SELECT event_id AS msg_id, concat('dedup:', event_type, ':', CAST(user_id AS VARCHAR)) AS dedup_key FROM events)"""


def _seen(s, d):
    e = tb.table(s, d, "events")
    key = F.concat(F.lit("dedup:"), F.col("event_type"), F.lit(":"), F.col("user_id").cast("string")).alias("dedup_key")
    seen = e.select(
        key, F.col("ts").alias("first_seen_at"), (F.col("ts") + F.expr("INTERVAL 2 DAYS")).alias("expires_at")
    )
    return seen, e.select(F.col("event_id").alias("msg_id"), key)


@query("dedup_anti", "", f"WITH {SEEN_SQL} SELECT * FROM msg WHERE dedup_key NOT IN (SELECT dedup_key FROM seen WHERE expires_at > {NOW})")
def _(s, d):
    seen, msg = _seen(s, d)
    return dedup.dedup_anti(msg, seen, EVENTS_AS_OF)


@query("dedup_anti_texts", "", "SELECT md5(text) AS text_key, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def _(s, d):
    """First document of each distinct whole text."""
    docs = tb.table(s, d, "documents").select(F.md5("text").alias("text_key"), "doc_id")
    return dedup.first_of_key(docs, "text_key", "doc_id", keep_unkeyed=False)


@query("batch_check_duplicates", "", f"""WITH {SEEN_SQL} SELECT dedup_key, dedup_key IN (SELECT dedup_key FROM seen WHERE expires_at > {NOW}) AS is_duplicate
  FROM (SELECT DISTINCT dedup_key FROM msg)""")
def _(s, d):
    seen, msg = _seen(s, d)
    return dedup.batch_check_duplicates(msg.select("dedup_key").distinct(), seen, EVENTS_AS_OF)


@query("dedup_db_fallback", "entity_events entity_status", f"""WITH {SEEN_SQL},
k AS (SELECT dedup_key, min(first_seen_at) AS seen_at FROM seen WHERE expires_at > {NOW} GROUP BY 1),
m AS (SELECT event_id AS msg_id, concat('dedup:', event_type, ':', CAST(user_id AS VARCHAR)) AS dedup_key, concat('T', CAST(user_id % 4 AS VARCHAR)) AS entity_type, user_id AS entity_id FROM events)
SELECT m.msg_id, m.dedup_key, m.entity_type, m.entity_id, CASE WHEN k.dedup_key IS NOT NULL THEN 'redis' WHEN st.state = 'COMPLETED' THEN 'database' END AS source,
  k.dedup_key IS NOT NULL OR coalesce(st.state = 'COMPLETED', false) AS is_duplicate,
  CASE WHEN k.dedup_key IS NOT NULL THEN seen_at WHEN st.state = 'COMPLETED' THEN st.last_processed_at END AS original_time
FROM m LEFT JOIN k USING (dedup_key) LEFT JOIN entity_status st ON st.entity_type = m.entity_type AND st.entity_id = m.entity_id""")
def _(s, d):
    from cratedig.operators.entities import latest_entity_state

    seen, _ = _seen(s, d)
    e = tb.table(s, d, "events")
    msg = e.select(
        F.col("event_id").alias("msg_id"),
        F.concat(F.lit("dedup:"), F.col("event_type"), F.lit(":"), F.col("user_id").cast("string")).alias("dedup_key"),
        F.concat(F.lit("T"), (F.col("user_id") % 4).cast("string")).alias("entity_type"),
        F.col("user_id").alias("entity_id"),
    )
    status = latest_entity_state(tb.entity_events(s, d))
    return dedup.dedup_db_fallback(msg, seen, status, EVENTS_AS_OF)


@query("expire_dedup_keys", "", f"""WITH {SEEN_SQL} SELECT dedup_key, first_seen_at, expires_at FROM seen
  WHERE NOT (regexp_matches(dedup_key, '^dedup:view:1.*$') AND first_seen_at < {NOW} - INTERVAL 864000 SECOND)""")
def _(s, d):
    return dedup.expire_dedup_keys(_seen(s, d)[0], EVENTS_AS_OF, "view", "1*", 864000)


@query("dedup_key_census", "", """WITH k AS (SELECT CASE event_id % 3 WHEN 0 THEN concat('dedup:', event_type, ':', CAST(user_id AS VARCHAR))
  WHEN 1 THEN concat('enqueued:track_discovery:track:', CAST(user_id AS VARCHAR)) ELSE 'plain' END AS key FROM events)
SELECT CASE WHEN instr(key, ':') = 0 THEN key ELSE concat(split_part(key, ':', 1), ':', split_part(key, ':', 2)) END AS key_group, count(*) AS keys,
  count(*) FILTER (contains(key, 'track_discovery:track:')) AS old_format_keys FROM k GROUP BY 1""")
def _(s, d):
    n, u = F.col("event_id") % 3, F.col("user_id").cast("string")
    key = (
        F.when(n == 0, F.concat(F.lit("dedup:"), F.col("event_type"), F.lit(":"), u))
        .when(n == 1, F.concat(F.lit("enqueued:track_discovery:track:"), u))
        .otherwise("plain")
    )
    return dedup.dedup_key_census(tb.table(s, d, "events").select(key.alias("dedup_key")))


# --- dead letters ----------------------------------------------------------

def _split(s, d):
    n = F.get_json_object("message", "$.k").cast("int")
    ok = n >= 10
    why = F.concat(F.lit("Invalid message format: k="), n.cast("string"))
    return dlq.dlq_split(_messages(s, d), EVENTS_AS_OF, ok, why, 4)


K_SQL = "CAST(json_extract_string(message, '$.k') AS INT)"
DEAD_SQL = f"""d AS (SELECT *, {K_SQL} AS k FROM messages),
dead AS (SELECT concat(queue_name, '_dlq') AS queue_name, queue_name AS source_queue, msg_id, enqueued_at, read_ct, vt, message,
  CASE WHEN k < 10 THEN concat('Invalid message format: k=', CAST(k AS VARCHAR)) ELSE concat('Max retries reached: ', CAST(read_ct AS VARCHAR)) END AS failure_reason
  FROM d WHERE k < 10 OR read_ct >= 4)"""


@query("dlq_split_good", "messages", f"WITH {DEAD_SQL} SELECT {MSG_SQL} FROM d WHERE k >= 10 AND read_ct < 4")
def _(s, d):
    return _split(s, d)[0]


@query("dlq_add_metadata", "messages", f"WITH {DEAD_SQL} SELECT queue_name, source_queue, CAST(msg_id AS VARCHAR) AS original_message_id, {NOW} AS moved_at, failure_reason, message FROM dead")
def _(s, d):
    return _split(s, d)[1].select(
        "queue_name", "dlq_metadata.source_queue", "dlq_metadata.original_message_id", "dlq_metadata.moved_at",
        "dlq_metadata.failure_reason", "message",
    )


@query("dlq_list", "messages", f"WITH {DEAD_SQL} SELECT queue_name, source_queue, CAST(msg_id AS VARCHAR) AS message_id, {NOW} AS moved_at, failure_reason, message FROM dead WHERE queue_name = 'click_dlq'")
def _(s, d):
    return dlq.dlq_list(_split(s, d)[1], "click_dlq")


@query("dlq_messages", "messages", f"WITH {DEAD_SQL} SELECT queue_name, source_queue, CAST(msg_id AS VARCHAR) AS message_id, {NOW} AS moved_at, failure_reason, message FROM dead")
def _(s, d):
    return dlq.dlq_list(_split(s, d)[1])


@query("dlq_strip_metadata", "messages", f"WITH {DEAD_SQL} SELECT source_queue AS queue_name, queue_name AS reprocessed_from_dlq, CAST(msg_id AS VARCHAR) AS original_message_id, {NOW} AS reprocessed_at FROM dead")
def _(s, d):
    m = "reprocessing_metadata"
    return dlq.dlq_strip_metadata(_split(s, d)[1], EVENTS_AS_OF).select(
        "queue_name", f"{m}.reprocessed_from_dlq", f"{m}.original_message_id", f"{m}.reprocessed_at"
    )


@query("dlq_reprocess", "messages", f"""WITH {DEAD_SQL} SELECT msg_id, source_queue AS queue_name, {NOW} AS enqueued_at, 0 AS read_ct, CAST(NULL AS TIMESTAMP) AS vt,
  CASE WHEN msg_id % 2 = 0 THEN '{{"fixed":true}}' ELSE message END AS message FROM dead""")
def _(s, d):
    dead = _split(s, d)[1]
    fixes = dead.filter(F.col("msg_id") % 2 == 0).select("queue_name", "msg_id", F.lit('{"fixed":true}').alias("new_body"))
    return dlq.dlq_reprocess(dead, EVENTS_AS_OF, fixes).select(*MSG)


@query("dlq_purge", "messages", f"""WITH {DEAD_SQL}, v AS (SELECT queue_name, msg_id FROM dead WHERE enqueued_at < {NOW} - INTERVAL 20 DAY ORDER BY enqueued_at, msg_id LIMIT 200)
  SELECT queue_name, msg_id, enqueued_at FROM dead WHERE (queue_name, msg_id) NOT IN (SELECT (queue_name, msg_id) FROM v)""")
def _(s, d):
    return dlq.dlq_purge(_split(s, d)[1], EVENTS_AS_OF, 20, 200)[0].select("queue_name", "msg_id", "enqueued_at")


# --- message bodies --------------------------------------------------------

@query("extract_message_id", "messages", """SELECT msg_id, CAST(msg_id AS VARCHAR) AS found FROM messages""")
def _(s, d):
    i, n = F.col("msg_id"), F.col("msg_id") % 5
    body = (
        F.when(n == 0, bodies.json_build(id=i)).when(n == 1, bodies.json_build(msg_id=i))
        .when(n == 2, bodies.json_build(msgId=i)).when(n == 3, bodies.json_build(messageId=i))
        .otherwise(bodies.json_build(message=F.struct(i.alias("id"))))
    )
    return _messages(s, d).select("msg_id", bodies.extract_message_id(body).alias("found"))


@query("parse_body", "messages", f"SELECT msg_id, {K_SQL} AS k FROM messages")
def _(s, d):
    """Bodies in five wrappings, all unwrapped to the same object."""
    b, n = F.col("message"), F.col("msg_id") % 5
    inner = F.from_json(b, "k int")
    body = (
        F.when(n == 0, b)
        .when(n == 1, bodies.json_build(message=b))
        .when(n == 2, bodies.json_build(message=inner, msg_id=F.col("msg_id")))
        .when(n == 3, bodies.json_build(message=F.struct(inner.alias("message"))))
        .otherwise(bodies.json_build(message=bodies.json_build(message=b)))
    )
    parsed = bodies.parse_body(body)
    return _messages(s, d).select("msg_id", bodies.json_get(parsed, "$.k", "int").alias("k"))


@query("json_get", "messages", f"SELECT msg_id, {K_SQL} AS k, json_extract_string(message, '$.missing') AS missing FROM messages")
def _(s, d):
    b = F.col("message")
    return _messages(s, d).select("msg_id", bodies.json_get(b, "$.k", "int").alias("k"), bodies.json_get(b, "$.missing").alias("missing"))


@query("json_has_key", "messages", f"""SELECT msg_id, {K_SQL} % 3 <> 0 AS has_own, {K_SQL} % 5 = 0 AS has_x, msg_id % 2 = 0 AS has_null_key FROM messages""")
def _(s, d):
    """Keys that depend on each message's number; one body is no object."""
    k = F.get_json_object("message", "$.k").cast("int")
    own = F.when(k % 3 == 0, F.lit("[1]")).otherwise(F.concat(F.lit('{"own":'), k.cast("string"), F.lit("}")))
    x = F.when(k % 5 == 0, F.lit('{"y":1,"x":{"y":2}}')).otherwise(F.lit('{"y":{"x":1}}'))
    with_null = F.when(F.col("msg_id") % 2 == 0, F.lit('{"a":null}')).otherwise(F.lit('{"b":1}'))
    return _messages(s, d).select(
        "msg_id", bodies.json_has_key(own, "own").alias("has_own"), bodies.json_has_key(x, "x").alias("has_x"),
        bodies.json_has_key(with_null, "a").alias("has_null_key"),
    )


@query("idempotency_key", "messages", f"""SELECT msg_id, CASE WHEN msg_id % 2 = 0 THEN concat(queue_name, ':own', CAST(msg_id AS VARCHAR))
  ELSE concat(queue_name, ':', sha256(concat('{{"k":"', CAST({K_SQL} AS VARCHAR), '"}}'))) END AS idempotency_key FROM messages""")
def _(s, d):
    own = bodies.json_build(_idempotencyKey=F.concat(F.lit("own"), F.col("msg_id").cast("string")))
    body = F.when(F.col("msg_id") % 2 == 0, own).otherwise(F.col("message"))
    return _messages(s, d).select("msg_id", bodies.idempotency_key(F.col("queue_name"), body).alias("idempotency_key"))


@query("coalesce_aliases", "messages", """SELECT msg_id, CASE msg_id % 5 WHEN 0 THEN '0' WHEN 4 THEN concat('u', CAST(user_id AS VARCHAR)) ELSE concat('alt', CAST(user_id AS VARCHAR)) END AS artist_id,
  CASE WHEN msg_id % 3 = 0 THEN 'Unknown Artist' ELSE concat('au', CAST(user_id AS VARCHAR)) END AS artist_name,
  CASE WHEN msg_id % 2 = 0 THEN msg_id % 50 ELSE 0 END AS "offset" FROM messages""")
def _(s, d):
    """The text "0" is an id; the number 0, false and empty text give way to the next spelling."""
    user, i = F.col("user_id").cast("string"), F.col("msg_id")
    first = F.when(i % 5 == 0, '"0"').when(i % 5 == 1, "0").when(i % 5 == 2, '""').when(i % 5 == 3, "false").otherwise(F.concat(F.lit('"u'), user, F.lit('"')))
    name = F.when(i % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("au"), user))
    name_key = F.when(i % 2 == 0, "artistName").otherwise("artist_name")
    offset = F.when(i % 2 == 0, F.concat(F.lit(',"offset":'), (i % 50).cast("string"))).otherwise("")
    body = F.concat(F.lit('{"artistId":'), first, F.lit(',"artist_id":"alt'), user, F.lit('","'), name_key, F.lit('":"'), name, F.lit('"'), offset, F.lit("}"))
    got = bodies.coalesce_aliases(body, "album_discovery")
    rows = tb.messages(s, d).select("msg_id", got.alias("m"))
    return rows.select("msg_id", "m.artist_id", "m.artist_name", "m.offset")


@query("is_validation_failure", "messages", f"""SELECT msg_id, {K_SQL} < 30 AS is_contract_failure FROM messages""")
def _(s, d):
    k = F.get_json_object("message", "$.k").cast("int")
    error = (
        F.when(k < 10, "Invalid message format: []").when(k < 20, "artistName: Required")
        .when(k < 30, "Missing required field: albumId").otherwise("boom")
    )
    return _messages(s, d).select("msg_id", errors.is_validation_failure(error).alias("is_contract_failure"))


@query("dedup_key_for", "messages", """SELECT msg_id, concat('album_discovery:artist:', CAST(user_id AS VARCHAR), ':offset:', CAST(msg_id % 50 AS VARCHAR)) AS albums_key,
  concat('album_discovery:album:', CAST(user_id AS VARCHAR)) AS album_key, concat('track_discovery:album:', CAST(user_id AS VARCHAR), ':offset:0') AS tracks_key,
  concat('track:', CAST(user_id AS VARCHAR)) AS track_key, concat('producer:', CAST(user_id AS VARCHAR)) AS producer_key FROM messages""")
def _(s, d):
    u = F.col("user_id")
    return tb.messages(s, d).select(
        "msg_id",
        text.dedup_key_for("artist_albums", u, F.col("msg_id") % 50).alias("albums_key"),
        text.dedup_key_for("album", u).alias("album_key"),
        text.dedup_key_for("album_tracks", u, F.lit(0)).alias("tracks_key"),
        text.dedup_key_for("track", u).alias("track_key"),
        text.dedup_key_for("producer", u).alias("producer_key"),
    )


@query("record_problem_message", "messages", f"""SELECT queue_name, CAST(msg_id AS VARCHAR) AS message_id, concat('{{', CAST(user_id AS VARCHAR)) AS message_body,
  'invalid_format' AS error_type, {NOW} AS created_at FROM messages WHERE msg_id % 10 = 0""")
def _(s, d):
    body = F.when(F.col("msg_id") % 10 == 0, F.concat(F.lit("{"), F.col("user_id").cast("string"))).otherwise(F.col("message"))
    rows = tb.messages(s, d).withColumn("message", body)
    _, problems = queue_files.record_problem_message(rows, F.lit(EVENTS_AS_OF).cast("timestamp_ntz"))
    return problems.select("queue_name", "message_id", "message_body", "error_type", "created_at")


@query("problem_messages_list", "messages", f"""SELECT queue_name, CAST(msg_id AS VARCHAR) AS message_id, enqueued_at AS created_at FROM messages
  WHERE CAST(json_extract_string(message, '$.k') AS INT) < 10 AND queue_name = 'view' ORDER BY enqueued_at DESC, CAST(msg_id AS VARCHAR) DESC LIMIT 50""")
def _(s, d):
    problems = _messages(s, d).filter(bodies.json_get(F.col("message"), "$.k", "int") < 10).select(
        "queue_name", F.col("msg_id").cast("string").alias("message_id"), F.col("enqueued_at").alias("created_at")
    )
    return queues.problem_messages_list(problems, "view", 50)
