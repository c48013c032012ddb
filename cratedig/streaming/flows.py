"""Structured Streaming twins of the queue work."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from cratedig.functions.bodies import parse_body
from cratedig.operators.dedup import dedup_ttl
from cratedig.operators.dlq import dlq_add_metadata, dlq_reprocess
from cratedig.operators.queues import at_max_retries
from cratedig.plans.stages import Stage
from cratedig.sources.tables import read_or_empty


def stream_rollup(metrics: DataFrame, dimensions: list[str], width: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """Tumbling aggregates; a window is emitted once the watermark has passed it."""
    return (
        metrics.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", lateness)
        .groupBy("metric_name", *dimensions, F.window("ts", width).alias("w"))
        .agg(
            F.min("metric_value").alias("min_value"),
            F.max("metric_value").alias("max_value"),
            F.avg("metric_value").alias("avg_value"),
            F.sum("metric_value").alias("sum_value"),
            F.count(F.lit(1)).alias("count_value"),
        )
        .select("metric_name", *dimensions, F.col("w.start").alias("period_start"), F.col("w.end").alias("period_end"),
                "min_value", "max_value", "avg_value", "sum_value", "count_value")
    )


def stream_quantiles(
    metrics: DataFrame, dimensions: list[str], quantiles: dict[str, float], width: str = "1 hour", lateness: str = "10 minutes", accuracy: int = 10_000
) -> DataFrame:
    """Tumbling windows with quantiles of ``metric_value``; a window is emitted once the watermark has passed it.

    The state of a window is a mergeable summary of bounded size: a quantile's rank is off by at most count / accuracy, so
    windows of fewer rows than ``accuracy`` are exact. Each quantile is a value that occurs.
    """
    aggs = [F.percentile_approx("metric_value", q, accuracy).alias(name) for name, q in quantiles.items()]
    return (
        metrics.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", lateness)
        .groupBy("metric_name", *dimensions, F.window("ts", width).alias("w"))
        .agg(F.count(F.lit(1)).alias("count_value"), *aggs)
        .select("metric_name", *dimensions, F.col("w.start").alias("period_start"), F.col("w.end").alias("period_end"), "count_value", *quantiles)
    )


def stream_value_counts(metrics: DataFrame, dimensions: list[str], width: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """How often each ``metric_value`` occurs in a tumbling window; emitted once the watermark has passed the window.

    The state has a row for each value, spread over all tasks; exact quantiles follow from ``exact_quantiles_of_counts``.
    """
    return (
        metrics.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", lateness)
        .groupBy("metric_name", *dimensions, "metric_value", F.window("ts", width).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("metric_name", *dimensions, F.col("w.start").alias("period_start"), F.col("w.end").alias("period_end"), "metric_value", "n")
    )


def split_outcomes(messages: DataFrame, valid: Column, error: Column, max_retries: int = 3) -> DataFrame:
    """Adds ``failure_reason``: null for messages that go on."""
    reason = F.when(~F.coalesce(valid, F.lit(False)), F.coalesce(error, F.lit("Invalid message format"))).when(
        at_max_retries(F.col("read_ct"), max_retries),
        F.concat(F.lit("Max retries reached: "), F.col("read_ct").cast("string")),
    )
    return messages.withColumn("failure_reason", reason)


def _write(df: DataFrame, path: str, batch_id: int) -> None:
    """One folder per micro-batch, replaced when the batch is run again."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def stream_dlq_split(
    messages: DataFrame, valid: Column, error: Column, out: str, checkpoint: str, as_of, max_retries: int = 3
):
    """Starts a query that writes good messages to ``out/good`` and the rest to ``out/dead``."""

    def each(batch: DataFrame, batch_id: int) -> None:
        tagged = split_outcomes(batch, valid, error, max_retries).persist()
        try:
            _write(tagged.filter(F.col("failure_reason").isNull()).drop("failure_reason"), f"{out}/good", batch_id)
            dead = tagged.filter(F.col("failure_reason").isNotNull())
            _write(dlq_add_metadata(dead, F.col("failure_reason"), as_of).drop("failure_reason"), f"{out}/dead", batch_id)
        finally:
            tagged.unpersist()

    return _available(messages.writeStream.foreachBatch(each), checkpoint)


def stream_dlq_reprocess(dead: DataFrame, overrides: Callable[[], DataFrame], out: str, checkpoint: str, as_of):
    """Starts a query that sends dead letters back to their queues, written under ``out``.

    ``overrides`` gives the table of new bodies (queue_name, msg_id, new_body); it is asked for in each micro-batch, so an
    override that was added meanwhile takes effect in the next one.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        _write(dlq_reprocess(batch, as_of, overrides()), out, batch_id)

    return _available(dead.writeStream.foreachBatch(each), checkpoint)


def _available(writer, checkpoint: str):
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def earlier_batches(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    """What earlier micro-batches wrote under ``path``."""
    return read_or_empty(spark, path, schema, "batch_id bigint").filter(F.col("batch_id") < batch_id).drop("batch_id")


SEEN = "dedup_key string, first_seen_at timestamp, expires_at timestamp"


def stream_stage(stage: Stage, messages: DataFrame, out: str, checkpoint: str, as_of, max_retries: int = 3):
    """Starts one stage over a message stream.

    Per micro-batch: unwrap the bodies, check them, drop repeats within the
    batch and against earlier ones, hand the rest to the stage, and write under
    ``out``: next (messages for the next queue), dead, seen (keys) and metrics
    (one row of counts, observed in the passes that write). A batch that is run again replaces its own output.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        started = time.time()
        spark = batch.sparkSession
        body = parse_body(F.col("message"))
        checked = batch.withColumn("body", body).withColumn("errors", stage.check(F.col("body")))
        checked = checked.withColumn("dedup_key", stage.dedup_key(F.col("body")))
        valid = F.col("body").isNotNull() & (F.size("errors") == 0)
        error = F.concat(F.lit("Invalid message format: "), F.array_join("errors", "; "))
        received, passed, refused = Observation(), Observation(), Observation()
        count = F.count(F.lit(1)).alias("n")
        tagged = split_outcomes(checked, valid, error, max_retries).persist()
        try:
            good = tagged.filter(F.col("failure_reason").isNull())
            seen = earlier_batches(spark, f"{out}/seen", batch_id, SEEN)
            oldest = tagged.observe(received, count).agg(F.min(F.when(F.col("failure_reason").isNull(), F.col("enqueued_at")))).first()[0]
            if oldest is not None:
                seen = seen.filter(F.col("expires_at") > F.lit(oldest))
            fresh = dedup_ttl(good, stage.ttl_seconds, seen)
            fresh = fresh.persist()
            try:
                _write(stage.handle(fresh), f"{out}/next", batch_id)
                dead = tagged.filter(F.col("failure_reason").isNotNull()).drop("body", "errors", "dedup_key")
                _write(
                    dlq_add_metadata(dead.observe(refused, count), F.col("failure_reason"), as_of).drop("failure_reason"), f"{out}/dead", batch_id
                )
                until = F.col("enqueued_at") + F.make_dt_interval(
                    F.lit(0), F.lit(0), F.lit(0), F.lit(stage.ttl_seconds).cast("decimal(18,6)")
                )
                keys = fresh.observe(passed, count).filter(F.col("dedup_key").isNotNull()).select(
                    "dedup_key", F.col("enqueued_at").alias("first_seen_at"), until.alias("expires_at")
                )
                _write(keys, f"{out}/seen", batch_id)
                row = counted(spark, received.get["n"], refused.get["n"], passed.get["n"])
                _write(emit_batch_metric(row, stage.queue, time.time() - started), f"{out}/metrics", batch_id)
            finally:
                fresh.unpersist()
        finally:
            tagged.unpersist()

    return _available(messages.writeStream.foreachBatch(each), checkpoint)


def counted(spark: SparkSession, received: int, errors: int, processed: int) -> DataFrame:
    """The counts of a batch, as observed while it was written, as a row for ``emit_batch_metric``."""
    return spark.createDataFrame([(received, errors, processed)], "received bigint, errors bigint, processed bigint")


def emit_batch_metric(counts: DataFrame, queue: str, seconds: float) -> DataFrame:
    """The metric row of a batch from its counts (received, errors, processed)."""
    return counts.select(
        F.lit("worker_batch").alias("metric_name"),
        F.lit(queue).alias("queue"),
        F.lit(float(seconds * 1000)).alias("metric_value"),
        "processed",
        "errors",
        (F.col("received") - F.col("errors") - F.col("processed")).alias("duplicates"),
    )


def run_to_table(stream: DataFrame, out: str, checkpoint: str, schema=None) -> DataFrame:
    """Drains a stream into Parquet and reads the result back."""
    query = _available(stream.writeStream.format("parquet").option("path", out).outputMode("append"), checkpoint)
    query.awaitTermination()
    return stream.sparkSession.read.schema(schema or stream.schema).parquet(out)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Everything the micro-batches wrote under ``path``."""
    return spark.read.parquet(path).drop("batch_id")


