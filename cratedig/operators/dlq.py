"""Dead-letter handling on message tables. Metadata is a typed column beside the body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cratedig.functions.times import ago, at
from cratedig.operators.queues import at_max_retries

META = "dlq_metadata"
REMETA = "reprocessing_metadata"


def dlq_add_metadata(messages: DataFrame, reason: Column, as_of, custom: Column | None = None) -> DataFrame:
    """Moves messages to ``<queue>_dlq`` and notes where they came from and why."""
    meta = F.struct(
        F.col("queue_name").alias("source_queue"),
        F.col("msg_id").cast("string").alias("original_message_id"),
        at(as_of).alias("moved_at"),
        reason.alias("failure_reason"),
        (F.lit(None).cast("string") if custom is None else custom).alias("custom_metadata"),
    )
    return messages.withColumn(META, meta).withColumn("queue_name", F.concat("queue_name", F.lit("_dlq")))


def dlq_strip_metadata(dead: DataFrame, as_of) -> DataFrame:
    """Takes the dead-letter note off and notes the reprocessing instead."""
    note = F.struct(
        F.col("queue_name").alias("reprocessed_from_dlq"),
        F.col("msg_id").cast("string").alias("original_message_id"),
        at(as_of).alias("reprocessed_at"),
    )
    return (
        dead.withColumn(REMETA, note)
        .withColumn("queue_name", F.col(f"{META}.source_queue"))
        .drop(META)
    )


def dlq_split(
    messages: DataFrame, as_of, valid: Column | None = None, error: Column | None = None, max_retries: int = 3
) -> tuple[DataFrame, DataFrame]:
    """(good, dead): broken messages and those tried too often leave with a reason."""
    spent = at_max_retries(F.col("read_ct"), max_retries)
    ok = F.lit(True) if valid is None else F.coalesce(valid, F.lit(False))
    dead = ~ok | spent
    why = F.when(~ok, F.coalesce(error, F.lit("Invalid message format")) if error is not None else F.lit("Invalid message format"))
    why = why.otherwise(F.concat(F.lit("Max retries reached: "), F.col("read_ct").cast("string")))
    return messages.filter(~dead), dlq_add_metadata(messages.filter(dead), why, as_of)


def dlq_list(messages: DataFrame, queue: str | None = None) -> DataFrame:
    """Dead letters with source, reason and time, newest first."""
    rows = messages.filter(F.col("queue_name").endswith("_dlq") & F.col(META).isNotNull())
    if queue is not None:
        rows = rows.filter(F.col("queue_name") == queue)
    return rows.select(
        "queue_name",
        F.col(f"{META}.source_queue").alias("source_queue"),
        F.col("msg_id").cast("string").alias("message_id"),
        F.col(f"{META}.moved_at").alias("moved_at"),
        F.col(f"{META}.failure_reason").alias("failure_reason"),
        "message",
    ).orderBy(F.desc("moved_at"), F.desc("message_id"))


def dlq_reprocess(dead: DataFrame, as_of, overrides: DataFrame | None = None) -> DataFrame:
    """Dead letters back to their source queue as new unread messages.

    ``overrides`` (queue_name, msg_id, new_body) replaces bodies.
    """
    rows = dead
    if overrides is not None:
        rows = (
            rows.join(overrides, ["queue_name", "msg_id"], "left")
            .withColumn("message", F.coalesce("new_body", "message"))
            .drop("new_body")
        )
    return (
        dlq_strip_metadata(rows, as_of)
        .withColumn("read_ct", F.lit(0))
        .withColumn("vt", F.lit(None).cast("timestamp_ntz"))
        .withColumn("enqueued_at", at(as_of))
    )


def dlq_purge(dead: DataFrame, as_of, days: int = 30, max_messages: int = 1000) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): the oldest dead letters past the age limit, at most ``max_messages``."""
    victims = (
        dead.filter(F.col("enqueued_at") < ago(as_of, days=days))
        .orderBy("enqueued_at", "msg_id")
        .limit(max_messages)
    )
    kept = dead.join(victims.select("queue_name", "msg_id"), ["queue_name", "msg_id"], "left_anti")
    return kept, victims
