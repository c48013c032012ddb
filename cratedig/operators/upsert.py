"""Keyed inserts and updates as joins, with explicit conflict rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cratedig.functions.bodies import json_merge
from cratedig.functions.formats import packed, unpacked
from cratedig.functions.text import normalize_producer_name, normalize_track_name, social_links
from cratedig.functions.times import at
from cratedig.operators.ordered import newest_per_key
from cratedig.session import shuffles_freed

DEFAULT_CONFIDENCE = 0.8
CREDIT_SOURCE = "genius"


def natural_id(*parts: Column) -> Column:
    """A row id derived from its natural key, so that reruns agree."""
    return F.sha2(F.concat_ws("|", *parts), 256)


def last_of_key(batch: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The last row of each key in the given order; settles repeats inside one batch."""
    return newest_per_key(batch, keys, [F.desc(c) for c in order])


def _meet(target: DataFrame, batch: DataFrame, keys: Sequence[str]):
    """Full outer join of the two sides under ``o`` and ``n``; keys are unique on both."""
    old = target.select(F.struct(*target.columns).alias("o"), *keys)
    new = batch.select(F.struct(*batch.columns).alias("n"), *keys)
    return old.join(new, list(keys), "full_outer")


def _overwritten(columns: Sequence[str], given: Sequence[str], keys: Sequence[str], as_of, keep: Sequence[str]) -> list[Column]:
    """The columns of a stored table from a row that was stored, ``o``, and one that is new, ``n``; either may be null."""
    is_new, was = F.col("n").isNotNull(), F.col("o").isNotNull()
    cols = []
    for c in columns:
        if c in keys:
            cols.append(F.col(c))
        elif c == "created_at":
            cols.append(F.when(was, F.col("o.created_at")).otherwise(at(as_of)).alias(c))
        elif c == "updated_at":
            cols.append(F.when(is_new, at(as_of)).otherwise(F.col("o.updated_at")).alias(c))
        elif c in keep and c in given:
            cols.append(F.when(was, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c))
        elif c in given:
            cols.append(F.when(is_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        else:
            cols.append(F.col(f"o.{c}").alias(c))
    return cols


def upsert_overwrite(target: DataFrame, batch: DataFrame, keys: Sequence[str], as_of, keep: Sequence[str] = ()) -> DataFrame:
    """New rows replace every mapped column; created_at is kept, updated_at is set.

    ``batch`` has one row per key and the target's columns but the time stamps.
    Columns in ``keep`` (ids other tables refer to) are set once and stay.
    """
    return _meet(target, batch, keys).select(*_overwritten(target.columns, batch.columns, keys, as_of, keep))


def upsert_artists(artists: DataFrame, batch: DataFrame, as_of) -> DataFrame:
    return upsert_overwrite(artists, _with_id(batch, "artist_id"), ["spotify_id"], as_of, keep=["artist_id"])


def upsert_albums(albums: DataFrame, batch: DataFrame, as_of) -> DataFrame:
    return upsert_overwrite(albums, _with_id(batch, "album_id"), ["spotify_id"], as_of, keep=["album_id"])


def upsert_tracks(tracks: DataFrame, batch: DataFrame, as_of) -> DataFrame:
    return upsert_overwrite(tracks, _with_id(batch, "track_id"), ["spotify_id"], as_of, keep=["track_id"])


def _with_id(batch: DataFrame, id_col: str) -> DataFrame:
    return batch if id_col in batch.columns else batch.withColumn(id_col, natural_id(F.col("spotify_id")))


def upsert_producers(producers: DataFrame, batch: DataFrame, as_of, mode: str = "merge") -> DataFrame:
    """Producers by normalized name.

    ``merge``: given values win over stored ones, metadata keys are merged, and
    a handle marks the producer as enriched. ``insert``: stored rows stay as
    they are. ``overwrite``: given columns replace stored ones.
    """
    keys = ["normalized_name"]
    if "producer_id" not in batch.columns:
        batch = batch.withColumn("producer_id", natural_id(F.col("normalized_name")))
    if mode == "overwrite":
        return upsert_overwrite(producers, batch, keys, as_of, keep=["producer_id"])
    if mode == "insert":
        return insert_if_absent(producers, batch, keys, as_of)
    is_new, was = F.col("n").isNotNull(), F.col("o").isNotNull()
    cols = []
    for c in producers.columns:
        if c in keys:
            cols.append(F.col(c))
        elif c == "producer_id":
            cols.append(F.coalesce(F.col("o.producer_id"), F.col("n.producer_id")).alias(c))
        elif c == "created_at":
            cols.append(F.when(was, F.col("o.created_at")).otherwise(at(as_of)).alias(c))
        elif c == "updated_at":
            cols.append(F.when(is_new, at(as_of)).otherwise(F.col("o.updated_at")).alias(c))
        elif c == "metadata" and c in batch.columns:
            merged = F.when(F.col("n.metadata").isNotNull(), json_merge(F.col("o.metadata"), F.col("n.metadata")))
            cols.append(merged.otherwise(F.col("o.metadata")).alias(c))
        elif c == "enriched_at" and "instagram_handle" in batch.columns:
            got = was & F.col("n.instagram_handle").isNotNull()
            cols.append(F.when(got, at(as_of)).otherwise(F.col("o.enriched_at")).alias(c))
        elif c in batch.columns:
            cols.append(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c))
        else:
            cols.append(F.col(f"o.{c}").alias(c))
    return _meet(producers, batch, keys).select(*cols)


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str], as_of) -> DataFrame:
    """Stored rows are untouched; only unknown keys are added."""
    fresh = batch.join(target.select(*keys), list(keys), "left_anti")
    for c in ("created_at", "updated_at"):
        if c in target.columns:
            fresh = fresh.withColumn(c, at(as_of))
    fresh = fresh.select(*[c for c in target.columns if c in fresh.columns])
    return target.unionByName(fresh, allowMissingColumns=True)


def link_track_producers(links: DataFrame, credits: DataFrame, as_of, on_conflict: str = "ignore") -> DataFrame:
    """Adds (track, producer) links; each pair is stored once.

    credits: track_id, producer_id, confidence, source, position. ``ignore``
    keeps the first credit and any stored link, with one fixed source name;
    ``update`` lets the last credit win and keeps its own source.
    """
    keys = ["track_id", "producer_id"]
    texts = [c for c, kind in links.select(*keys).dtypes if kind == "string"]  # packed as long as they are shuffled
    links, credits = (df.withColumns({c: packed(F.col(c)) for c in texts}) for df in (links, credits))
    given = credits.withColumn(
        "confidence", F.coalesce("confidence", F.lit(DEFAULT_CONFIDENCE)).cast("decimal(5,4)")
    )
    if on_conflict == "ignore":
        one = newest_per_key(given, keys, [F.col("position"), F.desc("confidence"), F.col("source")])
        merged = insert_if_absent(links, one.withColumn("source", F.lit(CREDIT_SOURCE)).drop("position"), keys, as_of)
    else:
        one = newest_per_key(given, keys, [F.desc("position"), F.col("confidence"), F.col("source")])
        merged = upsert_overwrite(links, one.drop("position"), keys, as_of)
    return merged.withColumns({c: unpacked(F.col(c)) for c in texts})


def representative_track(tracks: DataFrame, *order: str) -> DataFrame:
    """The first track per (artist, normalized name); tracks: artist_id, track_id, name."""
    named = tracks.withColumn("normalized_name", normalize_track_name(F.col("name")))
    first = newest_per_key(named, ["artist_id", "normalized_name"], [F.col(c) for c in order])
    return first.select("artist_id", "normalized_name", F.col("track_id").alias("representative_track_id"))


def upsert_normalized_tracks(stored: DataFrame, tracks: DataFrame, as_of, *order: str) -> DataFrame:
    """Adds songs not known yet; a stored representative stays."""
    return insert_if_absent(
        stored, representative_track(tracks, *order), ["artist_id", "normalized_name"], as_of
    )


TRACK_BATCH = (
    "array<struct<spotify_id:string,name:string,duration_ms:int,popularity:int,spotify_preview_url:string,"
    "metadata:map<string,string>>>"
)


def process_track_batch(batches: DataFrame, tracks: DataFrame, normalized: DataFrame, as_of, folder: str, at_once: bool = False) -> dict[str, DataFrame]:
    """Track arrays with their album and artist into tracks and songs, with a result list.

    batches: tracks_json, album_id, artist_id, batch_id. A track given twice
    keeps its last values and the album it came with first; a stored track keeps
    its id and album. A song keeps its first track. Results show the kept ids.
    The arrays are parsed once. Their rows are dealt out by spotify_id: there each meets its stored track and learns whether it is the
    last of its id. ``at_once`` stores this under ``folder``, for all three results to read; else each result deals out what it
    needs of the parsed rows, which are stored instead. Ids of one length and start are slow to sort as text, so they are
    sorted by their hash first; stored tracks, one for each id, are looked up by hash join.
    """

    def written(df: DataFrame, name: str) -> DataFrame:
        with shuffles_freed(df.sparkSession):
            df.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    rows = batches.select(
        "batch_id",
        "album_id",
        "artist_id",
        F.posexplode_outer(F.from_json("tracks_json", TRACK_BATCH)).alias("position", "t"),
    ).filter(F.col("t").isNotNull()).select("batch_id", "album_id", "artist_id", "position", "t.*")
    if not at_once:
        rows = written(rows, "rows")
    id_rows = Window.partitionBy("_h", "spotify_id").orderBy(F.desc("batch_id"), F.desc("position"))
    every = id_rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    new = F.struct(F.col("_album").alias("album_id"), "name", "duration_ms", "popularity", F.col("spotify_preview_url").alias("preview_url"), "metadata")
    turns = (
        rows.repartition("spotify_id").withColumn("_h", F.xxhash64("spotify_id"))
        .withColumns({"_last": F.row_number().over(id_rows) == 1, "_album": F.last("album_id").over(every)})
        .select("spotify_id", "batch_id", "position", "artist_id", "_last", new.alias("n"))
    )
    old = tracks.select("spotify_id", F.struct(*tracks.columns).alias("o")).hint("shuffle_hash")
    once = F.coalesce("_last", F.lit(True))  # of a stored track's rows, or of none
    met = turns.join(old, "spotify_id", "full_outer").select(
        "spotify_id", "batch_id", "position", "artist_id", "n", once.alias("_once"), F.col("o.track_id").alias("_kept"), F.when(once, F.col("o")).alias("o"),
    )
    if at_once:
        met = written(met, "met")
    made = natural_id(F.col("spotify_id"))
    given = ["track_id", *met.schema["n"].dataType.names]
    stored = met.filter("_once").withColumn("n", F.when(F.col("n").isNotNull(), F.struct(made.alias("track_id"), "n.*"))).select(
        *_overwritten(tracks.columns, given, ["spotify_id"], as_of, ["track_id", "album_id"])
    )
    kept = met.filter("n IS NOT NULL").select("batch_id", "position", "artist_id", "spotify_id", "_kept", "n.name")
    track_id = F.coalesce("_kept", made).alias("track_id")
    first = representative_track(kept.withColumn("track_id", F.struct("_kept", "spotify_id")), "batch_id", "position")
    first = first.select("artist_id", "normalized_name", "representative_track_id.*")
    songs = insert_if_absent(
        normalized, first.withColumn("representative_track_id", track_id), ["artist_id", "normalized_name"], as_of
    )
    results = kept.select("batch_id", "position", track_id, "name", "spotify_id")
    return {"tracks": stored, "normalized_tracks": songs, "results": results}


def credit_rows(songs: DataFrame, credits: str = "credits") -> DataFrame:
    """Exploded credits with position and producer key: track_id, position, name, confidence, source."""
    return (
        songs.select("track_id", F.posexplode_outer(credits).alias("position", "c"))
        .filter(F.col("c").isNotNull())
        .select("track_id", "position", "c.name", "c.confidence", "c.source")
        .withColumn("normalized_name", normalize_producer_name(F.col("name")))
    )


def new_producers(credits: DataFrame) -> DataFrame:
    """One row per normalized name: the spelling credited first."""
    one = newest_per_key(credits, ["normalized_name"], [F.col("track_id"), F.col("position")])
    return one.select("normalized_name", "name", natural_id(F.col("normalized_name")).alias("producer_id"))


def enrich_producers(producers: DataFrame, as_of) -> DataFrame:
    """Gives producers without links their links and marks them enriched."""
    stored = "social_links" in producers.columns
    todo = F.col("social_links").isNull() if stored else F.col("enriched_at").isNull()
    out = producers.withColumn("_todo", todo)
    links = F.when(F.col("_todo"), social_links(F.col("name")))
    out = out.withColumn("social_links", F.coalesce("social_links", links) if stored else links)
    for c in ("enriched_at", "updated_at"):
        if c in producers.columns:
            out = out.withColumn(c, F.when(F.col("_todo"), at(as_of)).otherwise(F.col(c)))
    return out.drop("_todo")


def register_queue(registry: DataFrame, given: DataFrame, as_of) -> DataFrame:
    """Queues by name; a missing display name or description keeps the stored one."""
    rows = _meet(registry, given, ["queue_name"])
    is_new = F.col("n").isNotNull()
    was = F.col("o").isNotNull()
    return rows.select(
        "queue_name",
        F.coalesce("n.display_name", "o.display_name", "queue_name").alias("display_name"),
        F.coalesce("n.description", "o.description").alias("description"),
        F.when(is_new, F.coalesce(F.col("n.active"), F.lit(True))).otherwise(F.col("o.active")).alias("active"),
        F.when(is_new & was, at(as_of)).otherwise(F.col("o.updated_at")).alias("updated_at"),
    )


