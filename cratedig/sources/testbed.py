"""The catalog and log tables, derived from the star-schema test tables.

Each function reads one or two base tables and gives one table of the data
model; Catalyst prunes what a job does not use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CATALOG_AS_OF = "2001-08-02 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# Rows beside those of the base tables, made from customers by the last digit of their key; their ids lie far beyond the keys.
# 1: an artist without albums, 2: with an album without tracks, 3: with a track without credits. 4: a track of an unknown
# album, 5: a credit of an unknown track and producer, 6: an album of an unknown artist.
BEYOND = 1_000_000_000


def _beside(spark: SparkSession, sf_dir: str, *digits: int) -> DataFrame:
    digit = F.col("c_custkey") % 10
    return table(spark, sf_dir, "customer").filter(digit.isin(*digits)).withColumn("id", F.col("c_custkey") + digit * BEYOND)


def artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = table(spark, sf_dir, "customer").withColumn("id", F.col("c_custkey"))
    key = F.col("id")
    return every.unionByName(_beside(spark, sf_dir, 1, 2, 3).withColumn("c_name", F.concat("c_name", F.lit(" again")))).select(
        key.alias("artist_id"),
        F.col("c_name").alias("name"),
        (key % 101).cast("int").alias("popularity"),
        F.col("c_mktsegment").alias("genre"),
        F.when(key % 5 == 0, _ts("2001-08-01 23:30:00"))
        .when(key % 5 == 1, _ts("2001-08-01 12:00:00"))
        .otherwise(_ts("2001-07-20 00:00:00"))
        .alias("created_at"),
    )


def albums(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("artist_id"), F.col("o_orderdate").alias("day"))
    more = _beside(spark, sf_dir, 2, 3, 6).select("id", F.col("id").alias("artist_id"), _ts("2001-07-01 00:00:00").cast(orders.schema["day"].dataType).alias("day"))
    key = F.col("id")
    return orders.unionByName(more).select(
        key.alias("album_id"),
        "artist_id",
        F.col("day").cast("date").alias("release_date"),
        F.col("day").alias("updated_at"),
        F.when(key % 4 != 0, (key % 8).cast("int")).alias("total_tracks"),
    )


def _by(key: str, lines: DataFrame, more: DataFrame) -> DataFrame:
    """Lines and the rows beside them, dealt out by an id: grouping by it and other columns and joining on it need no other shuffle."""
    return lines.unionByName(more).repartition(key)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("track_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))


def tracks(spark: SparkSession, sf_dir: str, names: bool = False, by: str = "track_id") -> DataFrame:
    """Tracks, dealt out by track or album id; ``names`` adds the song name, which needs the part table."""
    lines, song = _lines(spark, sf_dir), []
    if names:
        lines = lines.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        song = [F.col("p_name").alias("name")]
    lines = lines.select("track_id", F.col("l_orderkey").alias("album_id"), *song, F.col("l_quantity").cast("int").alias("popularity"), F.col("l_shipdate").alias("updated_at"))
    more = _beside(spark, sf_dir, 3, 4).select(
        (F.col("id") * 10 + 1).alias("track_id"), F.col("id").alias("album_id"), *([F.lit("beside").alias("name")] if names else []),
        F.lit(7).alias("popularity"), _ts("2001-07-02 00:00:00").cast(lines.schema["updated_at"].dataType).alias("updated_at"),
    )
    return _by(by, lines, more).groupBy("track_id", "album_id").agg(
        *([F.min("name").alias("name")] if names else []), F.max("popularity").alias("popularity"), F.max("updated_at").alias("updated_at")
    )


def producers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("producer_id"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_suppkey") % 20 == 0, _ts("2001-07-01 00:00:00")).alias("enriched_at"),
    )


def track_producers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).select(
        "track_id", F.col("l_suppkey").alias("producer_id"), (1 - F.col("l_discount")).alias("confidence"), F.col("l_returnflag").alias("source"),
        F.col("l_shipdate").alias("created_at"),
    )
    more = _beside(spark, sf_dir, 5).select(
        (F.col("id") * 10 + 1).alias("track_id"), F.col("id").alias("producer_id"), F.lit(0.5).cast(lines.schema["confidence"].dataType).alias("confidence"),
        F.lit("X").alias("source"), _ts("2001-07-03 00:00:00").cast(lines.schema["created_at"].dataType).alias("created_at"),
    )
    return _by("track_id", lines, more).groupBy("track_id", "producer_id").agg(
        F.max("confidence").alias("confidence"), F.min("source").alias("source"), F.min("created_at").alias("created_at")
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("msg_id"),
        F.col("event_type").alias("queue_name"),
        F.col("ts").alias("enqueued_at"),
        (F.col("event_id") % 5).cast("int").alias("read_ct"),
        F.when(F.col("event_id") % 3 == 0, F.col("ts")).alias("vt"),
        "user_id",
        "value",
        F.col("props").alias("message"),
    )


def queue_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir).select("queue_name").distinct()


def work_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        key,
        F.when(F.col("event_type").isin("click", "purchase"), "queue_processing")
        .otherwise("api_call")
        .alias("metric_name"),
        F.col("value").alias("metric_value"),
        "ts",
        F.concat(F.lit("q"), (F.col("user_id") % 5).cast("string")).alias("queue"),
        (F.col("event_type") != "error").alias("success"),
        (key % 20).cast("int").alias("batch_size"),
        (key % 3).cast("int").alias("error_count"),
    )


def entity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("T"), (F.col("user_id") % 4).cast("string")).alias("entity_type"),
        F.col("user_id").alias("entity_id"),
        "ts",
        F.when(kind == "signup", "PENDING")
        .when(kind == "view", "IN_PROGRESS")
        .when(kind == "purchase", "COMPLETED")
        .when(kind == "error", "FAILED")
        .otherwise("DEAD_LETTER")
        .alias("state"),
    )


def worker_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == "error")
        .select(
            "event_id",
            F.concat(F.lit("worker_"), (F.col("user_id") % 5).cast("string")).alias("worker_name"),
            F.concat(F.lit("type_"), (F.col("event_id") % 3).cast("string")).alias("issue_type"),
            F.col("props").alias("message"),
            (F.col("event_id") % 2 == 0).alias("resolved"),
            F.col("ts").alias("created_at"),
        )
    )
