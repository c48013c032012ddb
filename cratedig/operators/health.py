"""Health summaries over queue snapshots, entity states and worker issues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cratedig.functions.times import ago
from cratedig.operators.audits import service_status
from cratedig.operators.entities import processing_stats, stale_locks, stuck_entities
from cratedig.operators.queues import diagnose_queues, is_stuck, queue_monitor

# Thresholds of the health levels.
STUCK_MESSAGES_CRITICAL = 10
STUCK_ENTITIES_CRITICAL = 5
FAILED_ENTITIES_CRITICAL = 10
WORKER_ISSUES_CRITICAL = 5
STALLED_UNHEALTHY = 10


def worker_issue_stats(issues: DataFrame) -> DataFrame:
    """Per worker and type: total, resolved, open, latest time and its message."""
    resolved = F.col("resolved")
    return issues.groupBy("worker_name", "issue_type").agg(
        F.count(F.lit(1)).alias("issue_count"),
        F.count(F.when(resolved, 1)).alias("resolved_count"),
        F.count(F.when(~resolved, 1)).alias("unresolved_count"),
        F.max("created_at").alias("latest_issue"),
        F.max_by("message", F.struct("created_at", "event_id")).alias("latest_message"),
    )


def worker_issue_summary(issues: DataFrame, as_of, hours: float = 24, limit: int = 100) -> DataFrame:
    """Newest issues counted by worker and by type: (grouping, name, issue_count)."""
    newest = (
        issues.filter(F.col("created_at") >= ago(as_of, hours=hours))
        .orderBy(F.desc("created_at"), F.desc("event_id"))
        .limit(limit)
    )

    def by(column: str, label: str) -> DataFrame:
        return (
            newest.groupBy(F.col(column).alias("name"))
            .agg(F.count(F.lit(1)).alias("issue_count"))
            .select(F.lit(label).alias("grouping"), "name", "issue_count")
        )

    return by("worker_name", "worker").unionByName(by("issue_type", "type"))


def _level(critical: Column, warning: Column) -> Column:
    return F.when(critical, "critical").when(warning, "warning").otherwise("healthy")


def _one_row(*parts: DataFrame) -> DataFrame:
    """Joins one-row frames side by side without a join: padded union, then max."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])


def system_health(messages: DataFrame, status: DataFrame, issues: DataFrame, as_of) -> DataFrame:
    """One row: queue, processing and worker health with figures, and the worst of them."""
    queues = queue_monitor(messages, as_of).agg(
        F.count(F.lit(1)).alias("queues_checked"),
        F.coalesce(F.sum((F.col("stuck_messages") > 0).cast("long")), F.lit(0)).alias("queues_with_issues"),
        F.coalesce(F.sum("stuck_messages"), F.lit(0)).alias("total_stuck_messages"),
    )
    touched = F.col("updated_at") if "updated_at" in status.columns else F.col("last_processed_at")
    entities = status.filter(touched > ago(as_of, hours=24)).agg(
        F.count(F.lit(1)).alias("entities_checked"),
        F.count(
            F.when((F.col("state") == "IN_PROGRESS") & (F.col("last_processed_at") < ago(as_of, minutes=30)), 1)
        ).alias("stuck_entities"),
        F.count(F.when(F.col("state") == "FAILED", 1)).alias("failed_entities"),
    )
    by_worker = (
        issues.filter(~F.col("resolved"))
        .groupBy("worker_name")
        .agg(F.count(F.lit(1)).alias("n"), F.max("created_at").alias("latest"))
    )
    workers = by_worker.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_issues"),
        F.count(F.lit(1)).alias("workers_with_issues"),
        F.max("latest").alias("latest_issue_time"),
    )
    stuck, failed = F.col("stuck_entities"), F.col("failed_entities")
    levels = ["queue_status", "processing_status", "worker_status"]
    worst = F.when(F.array_contains(F.array(*levels), "critical"), "critical").when(
        F.array_contains(F.array(*levels), "warning"), "warning"
    )
    return (
        _one_row(queues, entities, workers)
        .withColumn(
            "queue_status",
            _level(F.col("total_stuck_messages") > STUCK_MESSAGES_CRITICAL, F.col("total_stuck_messages") > 0),
        )
        .withColumn(
            "processing_status",
            _level(
                (stuck > STUCK_ENTITIES_CRITICAL) | (failed > FAILED_ENTITIES_CRITICAL), (stuck > 0) | (failed > 0)
            ),
        )
        .withColumn("worker_status", _level(F.col("total_issues") > WORKER_ISSUES_CRITICAL, F.col("total_issues") > 0))
        .withColumn("overall_status", worst.otherwise("healthy"))
    )


def system_health_doc(messages: DataFrame, status: DataFrame, issues: DataFrame, as_of) -> DataFrame:
    """One row with the totals and a three-level overall status."""
    queues = diagnose_queues(messages, as_of).agg(
        F.count(F.lit(1)).alias("total_queues"),
        F.coalesce(F.sum((F.col("stuck_messages") > 0).cast("long")), F.lit(0)).alias("queues_with_stuck_messages"),
        F.coalesce(F.sum("stuck_messages"), F.lit(0)).alias("total_stuck_messages"),
    )
    entities = processing_stats(status, as_of).agg(
        *[
            F.coalesce(F.sum(f"{c}_count"), F.lit(0)).alias(f"entities_{c}")
            for c in ("in_progress", "stalled", "failed", "dead_lettered")
        ]
    )
    stats = worker_issue_stats(issues)
    fresh = F.col("latest_issue") > ago(as_of, hours=1)
    per_worker = stats.groupBy("worker_name").agg(
        F.sum("unresolved_count").alias("open"),
        F.sum(F.when(fresh, F.col("unresolved_count")).otherwise(0)).alias("fresh"),
        F.max("latest_issue").alias("latest"),
    )
    workers = per_worker.agg(
        F.coalesce(F.sum("open"), F.lit(0)).alias("total_unresolved_issues"),
        F.count(F.lit(1)).alias("workers_with_issues"),
        F.max("latest").alias("latest_issue_time"),
        F.coalesce(F.sum("fresh"), F.lit(0)).alias("recent_unresolved"),
    )
    stuck, stalled, recent = F.col("total_stuck_messages"), F.col("entities_stalled"), F.col("recent_unresolved")
    overall = (
        F.when(
            (stuck > STUCK_MESSAGES_CRITICAL) | (stalled > STALLED_UNHEALTHY) | (recent > WORKER_ISSUES_CRITICAL),
            "unhealthy",
        )
        .when((stuck > 0) | (stalled > 0) | (recent > 0), "warning")
        .otherwise("healthy")
    )
    return _one_row(queues, entities, workers).withColumn("overall_status", overall)


def health_details(messages: DataFrame, status: DataFrame, issues: DataFrame, as_of) -> DataFrame:
    """The per-item figures behind the summary, one row per figure: (component, item, measure, value)."""

    def long(df: DataFrame, component: str, item: Column, measures: list[str]) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("long").alias("value")) for m in measures])
        return df.select(F.lit(component).alias("component"), item.alias("item"), F.inline(pairs))

    return (
        long(diagnose_queues(messages, as_of), "queues", F.col("queue_name"), ["total_messages", "stuck_messages"])
        .unionByName(
            long(
                processing_stats(status, as_of),
                "processing",
                F.col("entity_type"),
                ["in_progress_count", "stalled_count", "failed_count"],
            )
        )
        .unionByName(
            long(
                worker_issue_stats(issues),
                "worker_issues",
                F.concat_ws("/", "worker_name", "issue_type"),
                ["unresolved_count"],
            )
        )
    )


def operator_health(locks: DataFrame, status: DataFrame, messages: DataFrame, calls: DataFrame, service: str, as_of) -> DataFrame:
    """(check, item, problems): stale locks, stuck entities, stuck messages per queue, services with open failures."""

    def total(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("problems")).select(
            F.lit(name).alias("check"), F.lit("all").alias("item"), "problems"
        )

    per_queue = messages.groupBy("queue_name").agg(F.count(F.when(is_stuck(as_of, 15), 1)).alias("problems"))
    services = service_status(calls, service)
    return (
        total(stale_locks(locks, as_of, 3600), "stale_locks")
        .unionByName(total(stuck_entities(status, as_of, 30), "stuck_entities"))
        .unionByName(
            per_queue.select(F.lit("stuck_messages").alias("check"), F.col("queue_name").alias("item"), "problems")
        )
        .unionByName(
            services.select(
                F.lit("open_failures").alias("check"), F.col(service).alias("item"), F.col("open_failures").alias("problems")
            )
        )
    )
