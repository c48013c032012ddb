"""Order-dependent checks over event logs: transitions, rates, failure runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cratedig.functions.times import ago, micros, slice_of
from cratedig.operators.ordered import newest_per_key, previous, running_sum, trailing_count

# Allowed state changes.
TRANSITIONS = {
    "PENDING": ["IN_PROGRESS", "FAILED"],
    "IN_PROGRESS": ["COMPLETED", "FAILED", "PENDING", "DEAD_LETTER"],
    "COMPLETED": ["PENDING"],
    "FAILED": ["PENDING", "DEAD_LETTER"],
    "DEAD_LETTER": ["PENDING"],
}
# Call limits as (api, endpoint, calls, seconds).
CALL_LIMITS = [
    ("spotify", "default", 100, 30),
    ("spotify", "search", 30, 30),
    ("genius", "default", 25, 5),
]
OUTAGE_FAILURES = 5
REDUCE_ABOVE = 0.5


def is_valid_transition(old: Column, new: Column) -> Column:
    """Any state may come first; after that only the allowed changes."""
    allowed = [(old == state) & new.isin(nexts) for state, nexts in TRANSITIONS.items()]
    return old.isNull() | F.coalesce(reduce(lambda a, b: a | b, allowed), F.lit(False))


def state_transition_audit(events: DataFrame, slice_seconds: int = 600) -> DataFrame:
    """Every event with the entity's state before it and whether the change is allowed."""
    keys = ["entity_type", "entity_id"]
    with_old = previous(
        events, keys, ["ts", "event_id"], "state", slice_of(F.col("ts"), slice_seconds), "previous_state"
    )
    return with_old.withColumn("valid", is_valid_transition(F.col("previous_state"), F.col("state")))


def rate_audit_fixed(calls: DataFrame, api: str, limit: int, seconds: int, burst: int = 0, ts: str = "ts") -> DataFrame:
    """Fixed windows with more calls than the limit plus burst."""
    return (
        calls.groupBy(api, F.window(F.col(ts).cast("timestamp"), f"{seconds} seconds").alias("w"))
        .agg(F.count(F.lit(1)).alias("calls"))
        .filter(F.col("calls") > limit + burst)
        .select(api, F.col("w.start").cast("timestamp_ntz").alias("window_start"), "calls")
    )


def rate_audit_sliding(
    calls: DataFrame, api: str, limit: int, seconds: int, ts: str = "ts", slice_seconds: int | None = None
) -> DataFrame:
    """Calls that exceed the limit within the window that ends at them."""
    counted = trailing_count(
        calls, [api], micros(F.col(ts)), seconds, slice_seconds or max(10 * seconds, 600), "calls_in_window"
    )
    return counted.filter(F.col("calls_in_window") > limit)


def failure_streaks(calls: DataFrame, service: str, ts: str = "ts", tie: str = "event_id", slice_seconds: int = 600) -> DataFrame:
    """Runs of consecutive failures per service; five or more are an outage.

    Failures between the same two successes share the running success count.
    """
    counted = running_sum(
        calls.select(service, ts, tie, "success"),
        [service],
        [ts, tie],
        F.col("success").cast("int"),
        slice_of(F.col(ts), slice_seconds),
        "_run",
    )
    return (
        counted.filter(~F.col("success"))
        .groupBy(service, "_run")
        .agg(F.count(F.lit(1)).alias("failures"), F.min(ts).alias("started_at"), F.max(ts).alias("ended_at"))
        .withColumn("is_outage", F.col("failures") >= OUTAGE_FAILURES)
        .drop("_run")
    )


def service_status(calls: DataFrame, service: str, ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """Last success, last failure, and failures since the last success, per service."""
    at = F.struct(ts, tie)
    last_ok = F.max(F.when(F.col("success"), at))
    marks = calls.groupBy(service).agg(last_ok.alias("_ok"), F.max(F.when(~F.col("success"), at)).alias("_bad"))
    marks = marks.select(
        service, "_ok", F.col(f"_ok.{ts}").alias("last_success"), F.col(f"_bad.{ts}").alias("last_failure")
    )
    open_failures = (
        calls.filter(~F.col("success"))
        .withColumn("_at", at)
        .join(marks.select(service, "_ok"), service)
        .filter(F.col("_ok").isNull() | (F.col("_at") > F.col("_ok")))
        .groupBy(service)
        .agg(F.count(F.lit(1)).alias("open_failures"))
    )
    state = F.when(F.col("open_failures") >= OUTAGE_FAILURES, "open").otherwise("closed")
    return (
        marks.drop("_ok")
        .join(open_failures, service, "left")
        .fillna(0, ["open_failures"])
        .withColumn("circuit", state)
    )


def adaptive_failure_rate(calls: DataFrame, service: str, seconds: int = 60, ts: str = "ts") -> DataFrame:
    """Failure rate per window; above one half the call rate should be reduced."""
    failed = F.count(F.when(~F.col("success"), 1))
    return (
        calls.groupBy(service, F.window(F.col(ts).cast("timestamp"), f"{seconds} seconds").alias("w"))
        .agg(F.count(F.lit(1)).alias("calls"), failed.alias("failures"))
        .withColumn("failure_rate", F.col("failures") / F.col("calls"))
        .withColumn("reduce", F.col("failure_rate") > REDUCE_ABOVE)
        .withColumn("window_start", F.col("w.start").cast("timestamp_ntz"))
        .drop("w")
    )


def error_counts(errors: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Errors per operation and category over the last hours."""
    return (
        errors.filter(F.col("ts") > ago(as_of, hours=hours))
        .groupBy("operation", "category")
        .agg(F.count(F.lit(1)).alias("errors"))
    )


def recent_errors(errors: DataFrame, as_of, n: int = 10, hours: int = 24) -> DataFrame:
    """The newest n errors of each entity."""
    fresh = errors.filter(F.col("ts") > ago(as_of, hours=hours))
    return newest_per_key(fresh, ["entity_type", "entity_id"], [F.desc("ts"), F.desc("event_id")], n)
