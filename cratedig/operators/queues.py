"""Reports and repairs on queue snapshots.

A snapshot has msg_id, queue_name, enqueued_at, read_ct, vt (read until, or
null) and message. A message is stuck when its vt lies in the past.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cratedig.functions.times import ago, at, fixed, minutes_since, safe_ratio, slice_of
from cratedig.operators.metrics import per_hour_text
from cratedig.operators.ordered import newest_per_key, row_numbers

# The stages' queues in order.
STAGE_QUEUES = [
    "artist_discovery",
    "album_discovery",
    "track_discovery",
    "producer_identification",
    "social_enrichment",
]
MSG_SLICE = 100_000


def queue_name_norm(c: Column) -> Column:
    """Queue name without its storage prefix."""
    return F.regexp_replace(c, r"^(pgmq\.|q_)", "")


def is_stuck(as_of, minutes: float = 10, vt: str = "vt") -> Column:
    c = F.col(vt)
    return c.isNotNull() & (c < ago(as_of, seconds=minutes * 60))


def visible_messages(messages: DataFrame, n: int = 10) -> DataFrame:
    """What a read of n messages from every queue would return: unread, oldest id first."""
    return newest_per_key(messages.filter(F.col("vt").isNull()), ["queue_name"], [F.col("msg_id")], n)


def next_batch(messages: DataFrame, queue: str, n: int = 10) -> DataFrame:
    """The first n unread messages of one queue."""
    unread = messages.filter((F.col("queue_name") == queue) & F.col("vt").isNull())
    return unread.orderBy("msg_id").limit(n)


def inspect_messages(messages: DataFrame, queue: str, n: int = 10, include_hidden: bool = False) -> DataFrame:
    """Newest n messages of a queue."""
    rows = messages.filter(F.col("queue_name") == queue)
    if not include_hidden:
        rows = rows.filter(F.col("vt").isNull())
    return rows.orderBy(F.desc("enqueued_at"), F.desc("msg_id")).limit(n)


def read_recent(df: DataFrame, as_of, hours: float, column: str = "ts", tie: str = "event_id") -> DataFrame:
    return df.filter(F.col(column) >= ago(as_of, hours=hours)).orderBy(F.desc(column), F.desc(tie))


def recent_n(df: DataFrame, n: int = 10, column: str = "created_at", tie: str = "event_id") -> DataFrame:
    return df.orderBy(F.desc(column), F.desc(tie)).limit(n)


def problem_messages_list(problems: DataFrame, queue: str | None = None, n: int = 50) -> DataFrame:
    if queue is not None:
        problems = problems.filter(F.col("queue_name") == queue)
    return problems.orderBy(F.desc("created_at"), F.desc("message_id")).limit(n)


def list_stuck_messages(messages: DataFrame, as_of, minutes: float = 10, queue: str | None = None) -> DataFrame:
    rows = messages if queue is None else messages.filter(F.col("queue_name") == queue)
    return (
        rows.filter(is_stuck(as_of, minutes))
        .select(
            "queue_name",
            F.col("msg_id").cast("string").alias("msg_id"),
            "message",
            F.col("vt").alias("locked_since"),
            F.col("read_ct").alias("read_count"),
            minutes_since(F.col("vt"), as_of).alias("minutes_locked"),
        )
        .orderBy("locked_since", "msg_id")
    )


def reset_stuck_messages(messages: DataFrame, as_of, minutes: float = 10) -> DataFrame:
    """The snapshot with stuck messages readable again."""
    return messages.withColumn("vt", F.when(~is_stuck(as_of, minutes), F.col("vt")))


def reset_message(messages: DataFrame, msg_ids: DataFrame) -> DataFrame:
    """Makes the given messages readable again."""
    ids = msg_ids.select(F.col("msg_id").alias("_id")).distinct()
    marked = messages.join(ids.withColumn("_hit", F.lit(True)), messages.msg_id == ids._id, "left")
    return marked.withColumn("vt", F.when(F.col("_hit").isNull(), F.col("vt"))).drop("_id", "_hit")


def reset_all_stuck(messages: DataFrame, as_of, minutes: float = 10) -> DataFrame:
    """Number of messages a reset frees, for queues that have any."""
    return messages.filter(is_stuck(as_of, minutes)).groupBy("queue_name").agg(
        F.count(F.lit(1)).alias("messages_reset")
    )


def requeue_stuck(messages: DataFrame, as_of, minutes: float = 10) -> tuple[DataFrame, DataFrame]:
    """(new snapshot, report): stuck messages leave and come back under new ids.

    New ids follow the largest old id of the queue in the order of the old ids.
    """
    test = is_stuck(as_of, minutes)
    top = messages.groupBy("queue_name").agg(F.max("msg_id").alias("_top"))
    numbered = row_numbers(
        messages.filter(test), ["queue_name"], ["msg_id"], F.floor(F.col("msg_id") / MSG_SLICE), "_rn"
    )
    moved = (
        numbered.join(top, "queue_name")
        .withColumn("old_msg_id", F.col("msg_id"))
        .withColumn("msg_id", F.col("_top") + F.col("_rn"))
        .drop("_top", "_rn")
    )
    fresh = (
        moved.withColumn("vt", F.lit(None).cast("timestamp_ntz"))
        .withColumn("read_ct", F.lit(0))
        .withColumn("enqueued_at", at(as_of))
    )
    rest = messages.filter(~test)
    report = moved.select("queue_name", "old_msg_id", F.col("msg_id").alias("new_msg_id"))
    return rest.unionByName(fresh.drop("old_msg_id")), report


def message_exists(ids: DataFrame, messages: DataFrame) -> DataFrame:
    """Adds ``found`` to (queue_name, message_id) rows; ids compare as text."""
    known = messages.select("queue_name", F.col("msg_id").cast("string").alias("message_id")).distinct()
    return ids.join(known.withColumn("_f", F.lit(True)), ["queue_name", "message_id"], "left").select(
        "queue_name", "message_id", F.coalesce("_f", F.lit(False)).alias("found")
    )


def delete_messages(messages: DataFrame, ids: DataFrame) -> DataFrame:
    """The snapshot without the given (queue_name, message_id) rows; ids compare as text."""
    gone = ids.select("queue_name", F.col("message_id").alias("_id"))
    return (
        messages.withColumn("_id", F.col("msg_id").cast("string"))
        .join(gone, ["queue_name", "_id"], "left_anti")
        .drop("_id")
    )


def is_retryable(read_ct: Column, max_retries: int = 3) -> Column:
    return F.coalesce(read_ct, F.lit(0)) < max_retries


def at_max_retries(read_ct: Column, max_retries: int = 3) -> Column:
    return ~is_retryable(read_ct, max_retries)


# --- reports ---------------------------------------------------------------

def queue_status(messages: DataFrame) -> DataFrame:
    return messages.groupBy("queue_name").agg(
        F.count(F.lit(1)).alias("message_count"), F.min("enqueued_at").alias("oldest_message")
    )


def queue_monitor(messages: DataFrame, as_of) -> DataFrame:
    """Totals and messages past their read time, from the snapshot."""
    stuck = F.col("vt") < at(as_of)
    return messages.groupBy("queue_name").agg(
        F.count(F.lit(1)).alias("total_messages"), F.count(F.when(stuck, 1)).alias("stuck_messages")
    ).withColumn("messages_fixed", F.lit(None).cast("bigint")).withColumn("last_check_time", at(as_of))


def queue_monitor_events(events: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """The same from monitor events: highest reported figures of the last day.

    ``events``: event_type, details (JSON), created_at.
    """

    def top(key: str) -> Column:
        return F.max(F.get_json_object("details", f"$.{key}").try_cast("bigint"))

    return (
        events.filter((F.col("event_type") == "queue_monitor") & (F.col("created_at") > ago(as_of, hours=hours)))
        .groupBy(F.get_json_object("details", "$.queue_name").alias("queue_name"))
        .agg(
            top("totalMessagesInQueues").alias("total_messages"),
            top("totalStuckMessages").alias("stuck_messages"),
            top("messagesFixed").alias("messages_fixed"),
            F.max("created_at").alias("last_check_time"),
        )
    )


def queue_monitor_doc(registry: DataFrame, messages: DataFrame, events: DataFrame, as_of) -> DataFrame:
    """Registered queues with their figures and the newest reported reset."""
    figures = diagnose_queues(messages, as_of).select("queue_name", "total_messages", "stuck_messages")
    reset = F.get_json_object("details", "$.messagesReset").try_cast("bigint")
    newest = (
        events.filter((F.col("event_type") == "queue_monitor") & (F.col("created_at") > ago(as_of, hours=24)))
        .groupBy(F.get_json_object("details", "$.queue_name").alias("queue_name"))
        .agg(
            F.max("created_at").alias("last_check_time"),
            F.max_by(reset, F.struct("created_at", reset.alias("r"))).alias("messages_fixed"),
        )
    )
    return (
        registry.select("queue_name")
        .join(figures, "queue_name", "left")
        .join(newest, "queue_name", "left")
        .fillna(0, ["total_messages", "stuck_messages", "messages_fixed"])
    )


def diagnose_queues(messages: DataFrame, as_of, minutes: float = 10) -> DataFrame:
    """Per queue: total, being read, stuck, age of the oldest lock in minutes."""
    age = F.when(F.col("vt").isNotNull(), minutes_since(F.col("vt"), as_of))
    return messages.groupBy("queue_name").agg(
        F.count(F.lit(1)).alias("total_messages"),
        F.count("vt").alias("in_progress_messages"),
        F.count(F.when(is_stuck(as_of, minutes), 1)).alias("stuck_messages"),
        F.coalesce(F.max(age), F.lit(0.0)).alias("oldest_message_age_minutes"),
    )


def registry_left_queue_status(registry: DataFrame, messages: DataFrame) -> DataFrame:
    """Active queues with depth and oldest message, empty ones included."""
    active = registry.filter(F.col("active")) if "active" in registry.columns else registry
    return active.join(queue_status(messages), "queue_name", "left").fillna(0, ["message_count"])


def all_queue_snapshots(snapshots: dict[str, DataFrame]) -> DataFrame:
    """One table of all queues' messages with the queue's name as a column."""
    parts = [df.withColumn("queue_name", queue_name_norm(F.lit(name))) for name, df in snapshots.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


ANCHOR = 12


def issues_like_queue(registry: DataFrame, issues: DataFrame, as_of, hours: float = 1) -> DataFrame:
    """Open recent issues per queue whose worker name contains the queue name.

    The pattern match is not run on all pairs. Issues are first counted per
    worker name; each name offers its short substrings as join keys, each queue
    the start of its longest part without wildcards, and the full pattern is
    tested on the pairs that meet. A part that is empty meets every worker,
    since then the pattern may match any of them.
    """
    counted = (
        issues.filter((F.col("created_at") > ago(as_of, hours=hours)) & ~F.col("resolved"))
        .groupBy("worker_name")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    name = F.lower("worker_name")
    starts = F.sequence(F.lit(1), F.greatest(F.length(name), F.lit(1)))
    lengths = F.sequence(F.lit(0), F.lit(ANCHOR))
    pieces = F.array_distinct(
        F.flatten(F.transform(starts, lambda i: F.transform(lengths, lambda k: F.substring(name, i, k))))
    )
    offered = counted.select("worker_name", "_n", F.explode_outer(pieces).alias("_key"))
    parts = F.split(F.lower("queue_name"), r"[_%\\]", -1)
    longest = F.element_at(F.array_sort(F.transform(parts, lambda p: F.struct((-F.length(p)).alias("k"), p.alias("p")))), 1)["p"]
    wanted = registry.select("queue_name", F.substring(longest, 1, ANCHOR).alias("_key"))
    hits = (
        wanted.join(offered, "_key")
        .filter(F.expr("worker_name ILIKE concat('%', queue_name, '%')"))
        .groupBy("queue_name")
        .agg(F.sum("_n").alias("recent_issues_count"))
    )
    return registry.select("queue_name").join(hits, "queue_name", "left").fillna(0, ["recent_issues_count"])


def active_queue_monitoring(registry, messages, recent, issues, as_of) -> DataFrame:
    """Active queues classed by load, error rate and age.

    ``recent`` is the per-queue average of the last hour (queue_name,
    avg_processed_per_batch, avg_errors_per_batch).
    """
    n = F.col("message_count")
    ratio = safe_ratio(F.col("avg_errors_per_batch"), F.col("avg_processed_per_batch"))
    return (
        registry_left_queue_status(registry, messages)
        .join(recent, "queue_name", "left")
        .join(issues_like_queue(registry, issues, as_of), "queue_name", "left")
        .withColumn(
            "queue_load",
            F.when(n == 0, "empty").when(n > 1000, "high").when(n > 100, "medium").otherwise("normal"),
        )
        .withColumn(
            "error_rate_status",
            F.when(F.col("avg_processed_per_batch").isNull(), None)
            .when(ratio > 0.2, "high")
            .when(ratio > 0.05, "medium")
            .otherwise("normal"),
        )
        .withColumn(
            "age_status",
            F.when(F.col("oldest_message").isNull(), None)
            .when(F.col("oldest_message") < ago(as_of, days=1), "stale")
            .otherwise("normal"),
        )
        .orderBy(F.desc("message_count"), "queue_name")
    )


# Recommendation texts.
ADVICE = {
    "unknown": "Insufficient metrics data",
    "empty": "Queue empty, no scaling needed",
    "optimal": "Queue will be processed within an hour, no scaling needed",
    "acceptable": "Queue backlog is moderate",
    "attention": "Consider increasing worker frequency or batch size",
    "critical": "Significant backlog detected",
}
SUGGESTIONS = {
    "attention": "Increase worker batch size or reduce worker interval",
    "critical": "Deploy additional worker instances or increase batch size significantly",
}


def scaling_recommendations(registry: DataFrame, status: DataFrame, summary: DataFrame, hours: float = 6) -> DataFrame:
    """Backlog against recent rate, per queue, with advice.

    ``summary`` is the queue summary of the last ``hours``. A rate of zero
    counts as nothing to wait for.
    """
    rows = (
        registry.select("queue_name")
        .join(status, "queue_name", "left")
        .join(summary.withColumnRenamed("queue", "queue_name"), "queue_name", "left")
        .fillna(0, ["message_count"])
        .withColumn("rate", F.col("total_processed") / F.lit(float(hours)))
    )
    wait = F.when(F.col("rate") > 0, F.col("message_count") / F.col("rate")).otherwise(F.lit(0.0))
    kind = (
        F.when(F.col("metrics_count").isNull(), "unknown")
        .when(F.col("message_count") == 0, "empty")
        .when(F.col("wait") < 1, "optimal")
        .when(F.col("wait") < 4, "acceptable")
        .when(F.col("wait") < 24, "attention")
        .otherwise("critical")
    )
    k = F.col("kind")
    message = F.lit(None).cast("string")
    for name, text in ADVICE.items():
        message = F.when(k == name, F.lit(text)).otherwise(message)
    eta = (
        F.when(k == "optimal", F.concat(fixed(F.col("wait") * 60, 0), F.lit(" minutes")))
        .when(k.isin("acceptable", "attention"), F.concat(fixed(F.col("wait"), 1), F.lit(" hours")))
        .when(k == "critical", F.concat(fixed(F.col("wait") / 24, 1), F.lit(" days")))
    )
    suggestion = F.when(k == "attention", SUGGESTIONS["attention"]).when(k == "critical", SUGGESTIONS["critical"])
    seen = k != "unknown"
    return rows.withColumn("wait", wait).withColumn("kind", kind).select(
        "queue_name",
        F.when(k == "empty", "optimal").otherwise(k).alias("status"),
        message.alias("message"),
        eta.alias("estimated_time_to_empty"),
        suggestion.alias("suggestion"),
        F.when(seen, F.col("message_count")).alias("current_depth"),
        F.when(seen, per_hour_text(F.col("rate"))).alias("processing_rate"),
        F.when(seen, F.concat(fixed(F.col("error_rate") * 100, 1), F.lit("%"))).alias("error_rate"),
    )


def batch_ids(df: DataFrame, id_col: str, size: int, slice_: Column | None = None) -> DataFrame:
    """Ids in request batches of exactly ``size`` (the last one may be shorter).

    Ids are numbered in slice order; for numbers the default slices keep
    numeric order, for text they are hash slices.
    """
    numeric = dict(df.dtypes)[id_col] in ("bigint", "int")
    if slice_ is None:
        slice_ = F.floor(F.col(id_col) / MSG_SLICE) if numeric else F.substring(F.md5(F.col(id_col)), 1, 4)
    numbered = row_numbers(df.select(id_col), [], [id_col], slice_, "_rn")
    return (
        numbered.withColumn("batch", F.floor((F.col("_rn") - 1) / size))
        .groupBy("batch")
        .agg(F.array_sort(F.collect_list(id_col)).alias("ids"), F.count(F.lit(1)).alias("n"))
    )


def discovery_job_ids(df: DataFrame, id_col: str, chunk: int = 1000) -> DataFrame:
    """Distinct ids as arrays of bounded length."""
    return batch_ids(df.select(id_col).filter(F.col(id_col).isNotNull()).distinct(), id_col, chunk)


def album_discovery_status(enqueued: DataFrame, albums: DataFrame) -> DataFrame:
    """One row: enqueued, processed, pending, and how many artists were asked for.

    The ids themselves come from ``discovery_job_ids``; there may be too many for one row.
    """
    asked = enqueued.agg(F.count(F.lit(1)).alias("total_enqueued"))
    artists = enqueued.select("artist_id").distinct().agg(F.count("artist_id").alias("artist_count"))
    done = albums.agg(F.count(F.lit(1)).alias("total_processed"))
    row = (
        asked.unionByName(artists, allowMissingColumns=True)
        .unionByName(done, allowMissingColumns=True)
        .agg(*[F.max(c).alias(c) for c in ("total_enqueued", "total_processed", "artist_count")])
    )
    return row.withColumn("pending", F.col("total_enqueued") - F.col("total_processed"))


def hour_slice(column: str) -> Column:
    return slice_of(F.col(column), 3600)
