"""Queues as folders of JSON lines, one folder per queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cratedig import schemas
from cratedig.functions.bodies import parse_body

# Full microseconds; the JSON default keeps milliseconds only.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


#: Messages in a file at most.
FILE_MESSAGES = 1000


def source_queue(
    spark: SparkSession, path: str, queue: str, max_batch: int | None = None, streaming: bool = False,
    archive: str | None = None, file_messages: int = FILE_MESSAGES,
) -> DataFrame:
    """Messages of one queue, at most ``max_batch`` of them at a time.

    A batch holds the oldest by id. A stream takes as many files in a step as hold no more than ``max_batch`` messages, in
    the order they were written, given that ``sink_enqueue`` put at most ``file_messages`` in each. With ``archive``, files
    that a stream has done with are moved there, so that the folder doesn't grow for ever.
    """
    where = f"{path}/queue_name={queue}"
    schema = ", ".join(f for f in schemas.QUEUE_MESSAGE.split(", ") if not f.startswith("queue_name"))
    if streaming:
        reader = spark.readStream.schema(schema).option("timestampFormat", TIME_FORMAT)
        if max_batch:
            if max_batch < file_messages:
                raise ValueError(f"a file may hold {file_messages} messages, more than the {max_batch} asked for at a time")
            reader = reader.option("maxFilesPerTrigger", max_batch // file_messages)
        if archive:
            reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
        rows = reader.json(where)
    else:
        rows = spark.read.schema(schema).option("timestampFormat", TIME_FORMAT).json(where)
        if max_batch:
            rows = rows.orderBy("msg_id").limit(max_batch)
    return rows.withColumn("queue_name", F.lit(queue))


def as_messages(df: DataFrame, queue: Column, body: Column, msg_id: Column, enqueued_at: Column) -> DataFrame:
    """Rows in the stored message shape."""
    return df.select(
        msg_id.cast("bigint").alias("msg_id"),
        queue.alias("queue_name"),
        enqueued_at.cast("timestamp").alias("enqueued_at"),
        F.lit(None).cast("timestamp").alias("vt"),
        F.lit(0).alias("read_ct"),
        body.alias("message"),
    )


def sink_enqueue(messages: DataFrame, path: str, file_messages: int = FILE_MESSAGES) -> None:
    """Appends messages to their queues in files of at most ``file_messages``, each a range of ids in order."""
    dealt = messages.repartitionByRange("queue_name", "msg_id").sortWithinPartitions("queue_name", "msg_id")
    dealt.write.mode("append").option("maxRecordsPerFile", file_messages).option("timestampFormat", TIME_FORMAT).partitionBy("queue_name").json(path)


def sink_enqueue_stream(messages: DataFrame, path: str, checkpoint: str):
    """The same for a stream; returns the started query."""
    return (
        messages.writeStream.format("json")
        .partitionBy("queue_name")
        .option("timestampFormat", TIME_FORMAT)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def emit_issue(df: DataFrame, worker: Column, issue_type: Column, message: Column, at: Column, severity: Column, details: Column | None = None) -> DataFrame:
    """Rows of the worker-issue log."""
    return df.select(
        worker.alias("worker_name"),
        issue_type.alias("issue_type"),
        severity.alias("severity"),
        message.alias("message"),
        (F.lit(None).cast("string") if details is None else details).alias("details"),
        F.lit(False).alias("resolved"),
        at.alias("created_at"),
    )


def emit_event(df: DataFrame, event_type: Column, details: Column, at: Column) -> DataFrame:
    """Rows of the monitoring-event log."""
    return df.select(event_type.alias("event_type"), details.alias("details"), at.alias("created_at"))


def record_problem_message(messages: DataFrame, at: Column) -> tuple[DataFrame, DataFrame]:
    """(parsed, problems): bodies that cannot be parsed go to the problem table.

    Each side is a filter of the same rows, so none is lost or doubled.
    """
    tried = messages.withColumn("body", parse_body(F.col("message")))
    problems = tried.filter(F.col("body").isNull()).select(
        "queue_name",
        F.col("msg_id").cast("string").alias("message_id"),
        F.col("message").alias("message_body"),
        F.lit("invalid_format").alias("error_type"),
        F.lit("Message body is not a JSON object").alias("error_details"),
        at.alias("created_at"),
        F.lit(False).alias("resolved"),
    )
    return tried.filter(F.col("body").isNotNull()), problems
