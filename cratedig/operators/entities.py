"""Processing state of entities: reports, resets, audits of the current state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cratedig.functions.times import ago, at, minutes_since, seconds_since

STATES = ("PENDING", "IN_PROGRESS", "COMPLETED", "FAILED", "DEAD_LETTER")
KEY = ["entity_type", "entity_id"]


def latest_entity_state(events: DataFrame) -> DataFrame:
    """Current state per entity: the state of its last event, its time and the number of events."""
    order = F.struct("ts", "event_id")
    return events.groupBy(*KEY).agg(
        F.max_by("state", order).alias("state"),
        F.max("ts").alias("last_processed_at"),
        F.count(F.lit(1)).alias("attempts"),
    )


def is_in_state(wanted: DataFrame, status: DataFrame, states=("COMPLETED",)) -> DataFrame:
    """Adds ``in_state`` to (entity_type, entity_id) rows; unknown entities are not."""
    hit = status.filter(F.col("state").isin(list(states))).select(*KEY, F.lit(True).alias("_hit"))
    return wanted.join(hit, KEY, "left").withColumn("in_state", F.coalesce("_hit", F.lit(False))).drop("_hit")


def _quiet(as_of, minutes: float) -> Column:
    return F.col("last_processed_at") < ago(as_of, seconds=minutes * 60)


def find_inconsistent_states(status: DataFrame, as_of, minutes: float = 60, entity_type: str | None = None) -> DataFrame:
    """Entities still waiting or in work that have not moved for a while."""
    rows = status if entity_type is None else status.filter(F.col("entity_type") == entity_type)
    return (
        rows.filter(_quiet(as_of, minutes) & F.col("state").isin("IN_PROGRESS", "PENDING"))
        .select(
            *KEY,
            F.col("state").alias("db_state"),
            "last_processed_at",
            minutes_since(F.col("last_processed_at"), as_of).alias("minutes_since_update"),
        )
        .orderBy("last_processed_at", *KEY)
    )


def stuck_entities(status: DataFrame, as_of, minutes: float = 30, limit: int | None = None) -> DataFrame:
    rows = status.filter((F.col("state") == "IN_PROGRESS") & _quiet(as_of, minutes))
    return rows if limit is None else rows.orderBy("last_processed_at", *KEY).limit(limit)


def stale_locks(locks: DataFrame, as_of, seconds: float = 300) -> DataFrame:
    """Locks whose heartbeat is too old, with how old it is."""
    return (
        locks.filter(F.col("last_heartbeat") < ago(as_of, seconds=seconds))
        .withColumn("stale_seconds", seconds_since(F.col("last_heartbeat"), as_of))
        .drop("last_heartbeat")
    )


def processing_stats(status: DataFrame, as_of) -> DataFrame:
    """Per entity type: entities per state and those in work for over half an hour."""

    def n(test: Column) -> Column:
        return F.count(F.when(test, 1))

    state = F.col("state")
    dead = F.col("dead_lettered") if "dead_lettered" in status.columns else state == "DEAD_LETTER"
    return status.groupBy("entity_type").agg(
        F.count(F.lit(1)).alias("total_count"),
        n(state == "PENDING").alias("pending_count"),
        n(state == "IN_PROGRESS").alias("in_progress_count"),
        n(state == "COMPLETED").alias("completed_count"),
        n(state == "FAILED").alias("failed_count"),
        n(dead).alias("dead_lettered_count"),
        n((state == "IN_PROGRESS") & _quiet(as_of, 30)).alias("stalled_count"),
    )


def stats_left_stalled(status: DataFrame, as_of) -> DataFrame:
    """Totals per type beside the stalled ones, zero where there are none."""
    total = status.groupBy("entity_type").agg(F.count(F.lit(1)).alias("total_count"))
    stalled = stuck_entities(status, as_of).groupBy("entity_type").agg(F.count(F.lit(1)).alias("stalled_count"))
    return total.join(stalled, "entity_type", "left").fillna(0, ["stalled_count"])


def reset_entity_states(
    status: DataFrame, as_of, minutes: float = 60, entity_type: str | None = None, target_states=("COMPLETED", "FAILED")
) -> tuple[DataFrame, DataFrame]:
    """(new status, change log): old entities in the target states go back to waiting."""
    hit = F.col("state").isin(list(target_states)) & _quiet(as_of, minutes)
    if entity_type is not None:
        hit = hit & (F.col("entity_type") == entity_type)
    changed = status.filter(hit).select(
        *KEY,
        F.col("state").alias("previous_state"),
        F.lit("PENDING").alias("state"),
        at(as_of).alias("reset_at"),
    )
    fresh = status.withColumn("_hit", F.coalesce(hit, F.lit(False)))
    fresh = (
        fresh.withColumn("state", F.when(F.col("_hit"), "PENDING").otherwise(F.col("state")))
        .withColumn("last_processed_at", F.when(F.col("_hit"), at(as_of)).otherwise(F.col("last_processed_at")))
        .drop("_hit")
    )
    return fresh, changed


def maintenance_actions(locks: DataFrame, status: DataFrame, as_of, minutes: float = 60) -> DataFrame:
    """What a clean-up does, as one log: locks to delete and entities to reset."""
    dropped = locks.filter(F.col("last_heartbeat") < ago(as_of, minutes=minutes)).select(
        *KEY, F.lit("IN_PROGRESS").alias("state"), F.lit("lock_deleted").alias("action")
    )
    reset = stuck_entities(status, as_of, minutes).select(
        *KEY, F.lit("PENDING").alias("state"), F.lit("status_reset").alias("action")
    )
    return dropped.unionByName(reset)


def cleanup_stale(locks: DataFrame, status: DataFrame, as_of, minutes: float = 60) -> dict[str, DataFrame]:
    """New locks, new status, the action log and its counts."""
    kept = locks.filter(F.col("last_heartbeat") >= ago(as_of, minutes=minutes))
    fresh, _ = reset_entity_states(status, as_of, minutes, None, ("IN_PROGRESS",))
    actions = maintenance_actions(locks, status, as_of, minutes)
    counts = actions.agg(
        F.count(F.when(F.col("action") == "lock_deleted", 1)).alias("deleted_locks"),
        F.count(F.when(F.col("action") == "status_reset", 1)).alias("reset_statuses"),
    )
    return {"locks": kept, "status": fresh, "actions": actions, "counts": counts}


def check_operation(wanted: DataFrame, operations: DataFrame) -> DataFrame:
    """Adds ``completed``: whether (entity, operation_id) has been completed."""
    keys = [*KEY, "operation_id"]
    done = operations.filter(F.col("state") == "COMPLETED").select(*keys).distinct()
    return (
        wanted.join(done.withColumn("_d", F.lit(True)), keys, "left")
        .withColumn("completed", F.coalesce("_d", F.lit(False)))
        .drop("_d")
    )


def reconcile_states(status: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(mismatches, corrected cache rows): a missing cache row is a mismatch too."""
    both = status.select(*KEY, F.col("state").alias("db_state")).join(
        cache.select(*KEY, F.col("state").alias("cache_state")), KEY, "left"
    )
    off = both.filter(~F.col("db_state").eqNullSafe(F.col("cache_state")))
    return off, off.select(*KEY, F.col("db_state").alias("state"), F.col("cache_state").alias("previous_cache_state"))
