"""The five stages as streaming queries, linked by queue folders.

Each stage is a query of its own with its own checkpoint. It reads one queue's folder,
drops keys that passed within the TTL, does the stage's work, merges the rows into the
stored catalog and writes the next queue's messages. Nothing but these folders passes
from one stage to another, so stages can run together, one after another, or stop between
any two steps:

    queues/queue_name=<queue>/sender=<stage>/batch=<n>   messages to a queue
    unknown/<queue>/batch_id=<n>                         ids of tracks that are asked for and not stored
    passed/<queue>/batch_id=<n>                          good messages whose key hasn't passed before, as far as the stage reads them
    seen/<queue>/batch_id=<n>                            their keys
    found/<queue>/batch_id=<n>                           rows a micro-batch found, without ids that follow from their keys
    dead/<queue>/batch_id=<n>                            messages it refused, with the reason
    metrics/<queue>/batch_id=<n>                         its counts
    catalog/<table>                                      the stored tables

A micro-batch that is run again replaces its own folders and merges the same rows once
more, which changes nothing; messages that it sends twice are repeats to the next stage.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from cratedig import schemas
from cratedig.functions.bodies import first_of
from cratedig.functions.formats import packed, unpacked
from cratedig.functions.times import at
from cratedig.operators import upsert
from cratedig.operators.dedup import dedup_ttl
from cratedig.plans import stages
from cratedig.session import shuffles_freed
from cratedig.sources import tables
from cratedig.sources.queue_files import TIME_FORMAT
from cratedig.streaming.flows import SEEN, counted, earlier_batches, emit_batch_metric, read_batches

MESSAGE = "msg_id string, dedup_key string, enqueued_at timestamp, message string"
TTL = stages.TTL_SECONDS["between_stages"]
BUCKETS = 16


@dataclass(frozen=True)
class Chain:
    """Where the linked stages keep their folders, the API responses, and the time that stamps rows."""

    spark: SparkSession
    root: str
    responses: dict[str, DataFrame]
    as_of: str

    def table(self, name: str) -> DataFrame:
        return tables.read_table(self.spark, f"{self.root}/catalog/{name}", CATALOG[name])

    def merge(self, name: str, rows: DataFrame, keys: list[str], how: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        tables.upsert_into(self.spark, f"{self.root}/catalog/{name}", CATALOG[name], rows, keys, how, BUCKETS)

    def stored(self, name: str, rows: DataFrame, key: str) -> DataFrame:
        """The stored rows of a table that a micro-batch touched."""
        return self.table(name).join(rows.select(key).distinct(), key, "left_semi")


CATALOG = {
    "artists": schemas.ARTISTS,
    "albums": schemas.ALBUMS,
    "tracks": schemas.TRACKS,
    "producers": schemas.PRODUCERS,
    "track_producers": schemas.TRACK_PRODUCERS,
}


def send(spark: SparkSession, root: str, messages: DataFrame, as_of, sender: str = "outside", batch: int = 0) -> None:
    """Writes messages (queue_name, dedup_key, message) of one queue or several; the same sender and batch replace each other."""
    rows = messages.select(
        "queue_name", F.xxhash64("queue_name", "dedup_key", "message").cast("string").alias("msg_id"), "dedup_key",
        at(as_of).cast("timestamp").alias("enqueued_at"), "message", F.lit(sender).alias("sender"), F.lit(batch).alias("batch"),
    )
    (
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("timestampFormat", TIME_FORMAT).option("compression", "gzip")
        .partitionBy("queue_name", "sender", "batch").json(f"{root}/queues")
    )


# --- what each stage does with a micro-batch: rows it finds, then what it stores and the messages that follow --------------

def _artists(c: Chain, messages: DataFrame) -> DataFrame:
    return stages.artist_stage(messages, c.responses["artist_search"]).drop("name_matches", "artist_id")


def _store_artists(c: Chain, found: DataFrame) -> DataFrame:
    c.merge("artists", found, ["spotify_id"], lambda old, new: upsert.upsert_artists(old, new, c.as_of))
    return stages.fan_out_artist_to_album(c.stored("artists", found, "spotify_id"))


def _albums(c: Chain, messages: DataFrame) -> DataFrame:
    return stages.album_stage(messages, c.responses["album_pages"]).drop("album_id")


def _store_albums(c: Chain, found: DataFrame) -> DataFrame:
    c.merge("albums", found, ["spotify_id"], lambda old, new: upsert.upsert_albums(old, new, c.as_of))
    return stages.fan_out_album_to_track(c.stored("albums", found, "spotify_id"))


def _tracks(c: Chain, messages: DataFrame) -> DataFrame:
    return stages.track_stage(messages, c.responses["track_pages"]).drop("track_id")


def _store_tracks(c: Chain, found: DataFrame) -> DataFrame:
    c.merge("tracks", found, ["spotify_id"], lambda old, new: upsert.upsert_tracks(old, new, c.as_of))
    return stages.fan_out_track_to_producer(c.stored("tracks", found, "spotify_id"))


def _credits(c: Chain, messages: DataFrame) -> DataFrame:
    return stages.producer_stage(messages, c.table("tracks"), c.responses["song_search"], c.responses["song_details"])


def _store_credits(c: Chain, found: DataFrame) -> DataFrame:
    """New producers, then links to the stored ones; a producer keeps the spelling that came first."""
    c.merge("producers", upsert.new_producers(found), ["normalized_name"], lambda old, new: upsert.upsert_producers(old, new, c.as_of, "insert"))
    named = c.stored("producers", found, "normalized_name")
    linked = found.join(named.select("normalized_name", "producer_id"), "normalized_name").select("track_id", "producer_id", "confidence", "source", "position")
    c.merge("track_producers", linked, ["track_id", "producer_id"], lambda old, new: upsert.link_track_producers(old, new, c.as_of))
    return stages.fan_out_producer_to_social(named)


def _asked_producers(c: Chain, messages: DataFrame) -> DataFrame:
    asked = messages.select(stages.first_of(F.col("message"), "producerId").alias("producer_id")).distinct()
    return upsert.enrich_producers(c.table("producers").join(asked, "producer_id", "left_semi"), c.as_of)


def _store_enriched(c: Chain, found: DataFrame) -> None:
    def replaced(old: DataFrame, new: DataFrame) -> DataFrame:
        return old.join(new.select("normalized_name"), "normalized_name", "left_anti").unionByName(new, allowMissingColumns=True)

    c.merge("producers", found, ["normalized_name"], replaced)


STAGES: dict[str, tuple[Callable[[Chain, DataFrame], DataFrame], Callable[[Chain, DataFrame], DataFrame | None]]] = {
    "artist_discovery": (_artists, _store_artists),
    "album_discovery": (_albums, _store_albums),
    "track_discovery": (_tracks, _store_tracks),
    "producer_identification": (_credits, _store_credits),
    "social_enrichment": (_asked_producers, _store_enriched),
}


def start(c: Chain, queue: str, max_files: int | None = None) -> StreamingQuery:
    """Starts one stage over what its queue holds now; it goes on from its checkpoint and stops when that is done."""
    find, store = STAGES[queue]
    reader = c.spark.readStream.schema(MESSAGE).option("timestampFormat", TIME_FORMAT).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def put(df: DataFrame, part: str, batch_id: int, mode: str = "overwrite") -> DataFrame:
        path = f"{c.root}/{part}/{queue}/batch_id={batch_id}"
        df.write.mode(mode).option("compression", "zstd").parquet(path)
        return c.spark.read.schema(df.schema).parquet(path)

    def each(batch: DataFrame, batch_id: int) -> None:
        began = time.time()
        received, passed, refused, unheard = Observation(), Observation(), Observation(), Observation()
        count = F.count(F.lit(1)).alias("n")
        judged = stages.judged(batch.withColumn("queue_name", F.lit(queue)), queue)
        kept = F.when(F.col("failure_reason").isNull(), stages.bare(F.col("message"), queue)).otherwise(F.col("message"))
        given = judged.observe(received, count).withColumn("message", kept).persist()
        try:
            dead = given.filter("failure_reason IS NOT NULL").select("queue_name", "dedup_key", "message", "failure_reason")
            put(dead.observe(refused, count), "dead", batch_id)
            good = given.filter("failure_reason IS NULL").drop("failure_reason")
            if queue == "producer_identification":  # few tracks are unknown: they are sent to the messages, not messages to all tracks
                unknown = put(stages.unknown_tracks(good, c.table("tracks")), "unknown", batch_id)
                asked = packed(first_of(F.col("message"), "trackId", "track_id"))
                lost = judged.filter("failure_reason IS NULL").withColumn("track_id", asked).join(unknown, "track_id", "left_semi")
                why = F.concat(F.lit("Track not found with ID: "), unpacked(F.col("track_id"))).alias("failure_reason")
                put(lost.select("queue_name", "dedup_key", "message", why).observe(unheard, count), "dead", batch_id, "append")
                good = good.withColumn("track_id", asked).join(unknown, "track_id", "left_anti").drop("track_id")
            seen = earlier_batches(c.spark, f"{c.root}/seen/{queue}", batch_id, SEEN)
            fresh = put(dedup_ttl(good, TTL, seen).observe(passed, count), "passed", batch_id)
        finally:
            given.unpersist()
        until = (F.col("enqueued_at") + F.expr(f"INTERVAL {TTL} SECONDS")).alias("expires_at")
        put(fresh.filter("dedup_key IS NOT NULL").select("dedup_key", F.col("enqueued_at").alias("first_seen_at"), until), "seen", batch_id)
        follow = store(c, put(find(c, fresh), "found", batch_id))
        if follow is not None:
            send(c.spark, c.root, follow, c.as_of, queue, batch_id)
        errors = refused.get["n"] + (unheard.get["n"] if queue == "producer_identification" else 0)
        row = counted(c.spark, received.get["n"], errors, passed.get["n"])
        put(emit_batch_metric(row, queue, time.time() - began), "metrics", batch_id)

    rows = reader.json(f"{c.root}/queues/queue_name={queue}")
    return rows.writeStream.foreachBatch(each).option("checkpointLocation", f"{c.root}/checkpoints/{queue}").queryName(f"{queue}-{hash(c.root) & 0xFFFFFF}").trigger(availableNow=True).start()


def drain(c: Chain, queues: list[str] | None = None, max_files: dict[str, int] | None = None) -> int:
    """Runs the stages in order until no queue has anything new; returns the number of micro-batches that had messages.

    A queue whose folder isn't there yet has had no messages. A stage that fails raises, and a later call goes on.
    """
    total = 0
    while True:
        worked = 0
        for queue in queues or STAGES:
            if not _exists(c.spark, f"{c.root}/queues/queue_name={queue}"):
                continue
            with shuffles_freed(c.spark):
                query = start(c, queue, (max_files or {}).get(queue))
                query.awaitTermination()
            worked += sum(p["numInputRows"] > 0 for p in query.recentProgress)
        total += worked
        if not worked:
            return total


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, for any file system that Spark reads."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def catalog(c: Chain) -> dict[str, DataFrame]:
    """The stored tables, and the refused messages of all stages as ``dead``."""
    dead = [read_batches(c.spark, f"{c.root}/dead/{q}") for q in STAGES if _exists(c.spark, f"{c.root}/dead/{q}")]
    out = {name: c.table(name) for name in CATALOG}
    for more in dead:
        out["dead"] = out["dead"].unionByName(more) if "dead" in out else more
    return out
