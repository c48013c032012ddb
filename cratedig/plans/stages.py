"""The five linking stages as table-to-table steps, and the messages between them.

A stage takes messages and the API responses they asked for, and gives catalog
rows and the next stage's messages. Responses are inputs: nothing here calls
a network.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cratedig import schemas
from cratedig.functions.bind import let
from cratedig.functions.bodies import coalesce_aliases, first_of, is_object, json_build
from cratedig.functions.formats import packed, unpacked
from cratedig.functions.text import dedup_key_for, extract_producers
from cratedig.operators import upsert
from cratedig.operators.dedup import first_of_key
from cratedig.operators.validate import validate_message_zod, validate_queue_message
from cratedig.session import shuffles_freed
from cratedig.sources import payloads

# How long a key of each kind blocks repeats, in seconds.
TTL_SECONDS = {"default": 86400, "between_stages": 86400 * 7, "entity": 86400 * 30}


@dataclass(frozen=True)
class Stage:
    """What a queue accepts and how its repeats are recognised."""

    queue: str
    check: Callable[[Column], Column]  # body -> array of error texts, empty when valid
    dedup_key: Callable[[Column], Column]  # body -> key
    ttl_seconds: int
    handle: Callable[[DataFrame], DataFrame]  # good messages -> rows for the next queue


def _message(df: DataFrame, queue: str, key: Column, body: Column) -> DataFrame:
    return df.select(F.lit(queue).alias("queue_name"), key.alias("dedup_key"), body.alias("message"))


# --- seeds -----------------------------------------------------------------

def seed_artist_discovery(names: DataFrame) -> DataFrame:
    """One request per artist name; names: artist_name."""
    name = F.col("artist_name")
    return _message(names, "artist_discovery", dedup_key_for("artist_name", name), json_build(artistName=name))


def seed_album_discovery(artists: DataFrame) -> DataFrame:
    """One request per artist and offset; artists: artist_id, spotify_id, artist_name, offset."""
    body = json_build(
        spotifyId=F.col("spotify_id"), artistId=F.col("artist_id"), artistName=F.col("artist_name"), offset=F.col("offset")
    )
    return _message(artists, "album_discovery", dedup_key_for("seed_artist_albums", F.col("artist_id"), F.col("offset")), body)


def seed_bulk_artist_discovery(artists: DataFrame, genre: str, min_popularity: int = 50, limit: int = 20) -> DataFrame:
    """Requests for the most popular artists of a genre."""
    has = F.array_contains("genres", genre) if "genres" in artists.columns else F.col("genre") == genre
    top = (
        artists.filter(has & (F.col("popularity") >= min_popularity))
        .orderBy(F.desc("popularity"), "artist_id")
        .limit(limit)
    )
    return seed_artist_discovery(top.select(F.col("name").alias("artist_name")))


# --- messages from one stage to the next ------------------------------------

def fan_out_artist_to_album(artists: DataFrame) -> DataFrame:
    body = json_build(spotifyId=F.col("spotify_id"), artistName=F.col("name"), artistId=F.col("artist_id"))
    return _message(artists, "album_discovery", dedup_key_for("artist_albums", F.col("spotify_id"), F.lit(0)), body)


def fan_out_album_to_track(albums: DataFrame) -> DataFrame:
    body = json_build(
        albumId=F.col("album_id"),
        albumName=F.col("name"),
        spotifyId=F.col("spotify_id"),
        artistId=F.col("artist_id"),
        offset=F.lit(0),
        totalTracks=F.when(F.col("total_tracks") > 0, F.col("total_tracks")).otherwise(F.lit(50)),
    )
    return _message(albums, "track_discovery", dedup_key_for("album_tracks", F.col("spotify_id"), F.lit(0)), body)


def fan_out_track_to_producer(tracks: DataFrame) -> DataFrame:
    fields = {"trackId": F.col("track_id"), "trackName": F.col("name"), "trackSpotifyId": F.col("spotify_id")}
    if "artist_id" in tracks.columns:
        fields["artistId"] = F.col("artist_id")
    fields["albumId"] = F.col("album_id")
    return _message(tracks, "producer_identification", dedup_key_for("producer", F.col("spotify_id")), json_build(**fields))


def fan_out_producer_to_social(producers: DataFrame) -> DataFrame:
    body = json_build(producerId=F.col("producer_id"), producerName=F.col("name"))
    return _message(producers, "social_enrichment", dedup_key_for("enrichment", F.col("producer_id")), body)


# --- stages -----------------------------------------------------------------

def distinct_requests(messages: DataFrame, *asked: Column) -> DataFrame:
    """What one message per key asks for; which of several equal requests is kept does not matter, but it is fixed.

    Without a key all stay. Only the key and what is asked for are shuffled, not the message; a request that lacks
    any of it is none, and hides no other of its key. A filter on what is asked for would read each message once more, so it
    stands behind a generator.
    """
    wanted = messages.select("dedup_key", F.inline_outer(F.array(F.struct(*asked))))
    names = wanted.columns[1:]
    for name in names:
        wanted = wanted.filter(F.col(name).isNotNull())
    return first_of_key(wanted, "dedup_key", *names).select(*names)


def judged(messages: DataFrame, queue: str, tracks: DataFrame | None = None) -> DataFrame:
    """Adds ``failure_reason`` to the messages of a stage: null for those it can work on.

    The stage's own step leaves out exactly the others. ``tracks`` are the known ones, for the credit stage.
    """
    body = F.col("message")
    empty = F.when(F.coalesce(~is_object(body), F.lit(True)), F.lit("Invalid message format: message body is empty or null"))
    missing = lambda c, name: F.when(c.isNull(), F.lit(f"Missing required field: {name} must be provided"))
    if queue == "artist_discovery":
        why = F.when(first_of(body, "artistName").isNull(), F.lit("Missing artistName in message"))
    elif queue == "album_discovery":
        m = coalesce_aliases(body, queue)
        of = F.concat(F.lit("Missing required field: artistId must be provided for artist "), m["artist_name"], F.lit(" ("), m["spotify_id"], F.lit(")"))
        why = F.coalesce(missing(m["spotify_id"], "spotifyId"), F.when(m["artist_id"].isNull(), of))
    elif queue == "track_discovery":
        m = coalesce_aliases(body, queue)
        why = F.coalesce(missing(m["album_spotify_id"], "albumSpotifyId"), missing(m["album_id"], "albumId"))
    elif queue == "producer_identification":
        why = missing(first_of(body, "trackId", "track_id"), "trackId")
    elif queue == "social_enrichment":
        why = F.lit(None).cast("string")
    else:
        raise ValueError(f"no rules for {queue}")
    tagged = messages.withColumn("failure_reason", F.coalesce(empty, why))
    if tracks is None:
        return tagged
    asked = tagged.withColumn("_track", packed(first_of(body, "trackId", "track_id")))
    known = tracks.select(packed(F.col("track_id")).alias("_track")).distinct().withColumn("_known", F.lit(True))
    lost = F.when(F.col("_known").isNull(), F.concat(F.lit("Track not found with ID: "), unpacked(F.col("_track"))))
    return asked.join(known, "_track", "left").withColumn("failure_reason", F.coalesce("failure_reason", lost)).drop("_track", "_known")


def bare(body: Column, queue: str) -> Column:
    """The message with only what its stage asks for, which the stage's step reads from it alike."""
    if queue == "artist_discovery":
        return json_build(artistName=first_of(body, "artistName"))
    if queue == "album_discovery":
        m = coalesce_aliases(body, queue)
        return json_build(spotifyId=m["spotify_id"], artistId=m["artist_id"])
    if queue == "track_discovery":
        m = coalesce_aliases(body, queue)
        return json_build(spotifyId=m["album_spotify_id"], albumId=m["album_id"])
    if queue == "producer_identification":
        return json_build(trackId=first_of(body, "trackId", "track_id"))
    if queue == "social_enrichment":
        return json_build(producerId=first_of(body, "producerId"))
    raise ValueError(f"no rules for {queue}")


def unknown_tracks(messages: DataFrame, tracks: DataFrame) -> DataFrame:
    """The track ids (packed) that messages ask for and the table hasn't got."""
    asked = messages.select(packed(first_of(F.col("message"), "trackId", "track_id")).alias("track_id"))
    known = tracks.select(packed(F.col("track_id")).alias("track_id"))
    return asked.filter(F.col("track_id").isNotNull()).join(known, "track_id", "left_anti").distinct()


def refused(messages: DataFrame, queue: str, tracks: DataFrame | None = None) -> DataFrame:
    """The messages a stage cannot work on, with the reason: queue_name, dedup_key, message, failure_reason."""
    found = judged(messages, queue, tracks).filter(F.col("failure_reason").isNotNull())
    return found.select("queue_name", "dedup_key", "message", "failure_reason")


def _all_but(df: DataFrame, key: str) -> list[str]:
    """Every other column, so that rows of a key that differ at all have a fixed order."""
    return [c for c, kind in df.dtypes if c != key and not kind.startswith("map")]


def _listed_last(found: DataFrame, id_col: str) -> DataFrame:
    """One row per listed thing. Its id is a long digest of the spotify_id and is made after the shuffle instead of carried through it."""
    kept = found.drop(id_col)
    return upsert.last_of_key(kept, ["spotify_id"], *_all_but(kept, "spotify_id")).withColumn(id_col, upsert.natural_id(F.col("spotify_id")))


def artist_stage(messages: DataFrame, searches: DataFrame) -> DataFrame:
    """Artists found for the requested names; searches: artist_name, payload."""
    asked = distinct_requests(messages, first_of(F.col("message"), "artistName").alias("artist_name"))
    return _listed_last(payloads.ingest_artist_search(asked.join(searches, "artist_name")), "artist_id")


def album_stage(messages: DataFrame, pages: DataFrame) -> DataFrame:
    """Albums listed for the requested artists; pages: spotify_id, payload."""
    m = coalesce_aliases(F.col("message"), "album_discovery")
    known = distinct_requests(messages, m["spotify_id"].alias("spotify_id"), let(m["artist_id"], packed).alias("artist_id"))
    listed = _listed_last(payloads.ingest_album_pages(pages.join(known, "spotify_id")), "album_id")
    return listed.withColumn("artist_id", unpacked(F.col("artist_id")))


def track_stage(messages: DataFrame, pages: DataFrame) -> DataFrame:
    """Tracks listed for the requested albums; pages: spotify_id, payload."""
    m = coalesce_aliases(F.col("message"), "track_discovery")
    known = distinct_requests(messages, m["album_spotify_id"].alias("spotify_id"), let(m["album_id"], packed).alias("album_id"))
    listed = _listed_last(payloads.ingest_track_pages(pages.join(known, "spotify_id")), "track_id")
    return listed.withColumn("album_id", unpacked(F.col("album_id")))


def asked_tracks(messages: DataFrame, tracks: DataFrame) -> DataFrame:
    """The requested, known tracks: track_id (packed), track_spotify_id."""
    asked = distinct_requests(messages, let(first_of(F.col("message"), "trackId", "track_id"), packed).alias("track_id"))
    known = tracks.select(packed(F.col("track_id")).alias("track_id"), F.col("spotify_id").alias("track_spotify_id"))
    return known.join(asked, "track_id", "left_semi")


def credit_stage(asked: DataFrame, searches: DataFrame, details: DataFrame) -> DataFrame:
    """Credits of the tracks that ``asked_tracks`` gave; searches: track_spotify_id, payload; details: payload."""
    songs = payloads.ingest_song_details(searches.join(asked, "track_spotify_id"), details)
    return upsert.credit_rows(songs.withColumn("credits", extract_producers(F.col("song")))).withColumn("track_id", unpacked(F.col("track_id")))


def producer_stage(messages: DataFrame, tracks: DataFrame, searches: DataFrame, details: DataFrame) -> DataFrame:
    """Credits of the requested, known tracks; searches: track_spotify_id, payload; details: payload."""
    return credit_stage(asked_tracks(messages, tracks), searches, details)


def social_stage(messages: DataFrame, producers: DataFrame, as_of) -> DataFrame:
    """Producers with links for those asked about; the others as they are."""
    asked = distinct_requests(messages, first_of(F.col("message"), "producerId").alias("producer_id")).distinct()
    return upsert.enrich_producers(producers.join(asked, "producer_id", "left_semi"), as_of).unionByName(
        producers.join(asked, "producer_id", "left_anti"), allowMissingColumns=True
    )


def stored(df: DataFrame, path: str) -> DataFrame:
    """Writes a stage's table and reads it back: the next stage starts from files, not from a long lineage or kept shuffles."""
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_chain(
    spark: SparkSession,
    seeds: DataFrame,
    responses: dict[str, DataFrame],
    as_of: str,
    folder: str,
    more: dict[str, DataFrame] | None = None,
    with_dead: bool = False,
) -> dict[str, DataFrame]:
    """All five stages over an empty catalog; every stage's result is a table under ``folder``.

    responses: artist_search, album_pages, track_pages, song_search, song_details. ``more`` adds messages from elsewhere
    to a queue. Messages that a stage refuses are the table ``dead``, if that is wanted.
    """

    def empty(schema: str) -> DataFrame:
        return spark.createDataFrame([], schema).limit(0)  # known to be empty, so merging with it is no join

    more, sent = more or {}, {}

    def asked(queue: str, made: DataFrame) -> DataFrame:
        sent[queue] = made
        return made.unionByName(more[queue]) if queue in more else made

    found = artist_stage(asked("artist_discovery", seeds), responses["artist_search"]).drop("name_matches")
    artists = stored(upsert.upsert_artists(empty(schemas.ARTISTS), found, as_of), f"{folder}/artists")
    found = album_stage(asked("album_discovery", fan_out_artist_to_album(artists)), responses["album_pages"])
    albums = stored(upsert.upsert_albums(empty(schemas.ALBUMS), found, as_of), f"{folder}/albums")
    found = track_stage(asked("track_discovery", fan_out_album_to_track(albums)), responses["track_pages"])
    tracks = stored(upsert.upsert_tracks(empty(schemas.TRACKS), found, as_of), f"{folder}/tracks")
    wanted = stored(asked_tracks(asked("producer_identification", fan_out_track_to_producer(tracks)), tracks), f"{folder}/asked_tracks")
    credits = stored(credit_stage(wanted, responses["song_search"], responses["song_details"]), f"{folder}/credits")
    made = {}
    if with_dead:
        # Messages made from the stored tracks ask for stored tracks; only those from elsewhere are looked up.
        parts = [refused(m, queue) for queue, m in sent.items()]
        parts += [refused(m, queue, tracks if queue == "producer_identification" else None) for queue, m in more.items() if queue in sent]
        made["dead"] = stored(reduce(DataFrame.unionByName, parts), f"{folder}/dead")
    named = stored(
        upsert.upsert_producers(empty(schemas.PRODUCERS), upsert.new_producers(credits), as_of, "insert"),
        f"{folder}/new_producers",
    )
    linked = credits.join(named.select("normalized_name", "producer_id"), "normalized_name").select(
        "track_id", "producer_id", "confidence", "source", "position"
    )
    links = stored(
        upsert.link_track_producers(empty(schemas.TRACK_PRODUCERS), linked, as_of), f"{folder}/track_producers"
    )
    producers = stored(social_stage(fan_out_producer_to_social(named), named, as_of), f"{folder}/producers")
    return {"artists": artists, "albums": albums, "tracks": tracks, "producers": producers, "track_producers": links} | made


# --- queue contracts for streaming ------------------------------------------

def contract_stage(queue: str, key: Callable[[Column], Column], handle: Callable[[DataFrame], DataFrame]) -> Stage:
    """A stage checked by the typed contract of its queue."""
    return Stage(queue, lambda body: validate_message_zod(body, queue), key, TTL_SECONDS["between_stages"], handle)


def required_field_stage(queue: str, key: Callable[[Column], Column], handle: Callable[[DataFrame], DataFrame]) -> Stage:
    """A stage checked only for the field its queue needs."""

    def check(body: Column) -> Column:
        verdict = validate_queue_message(F.lit(queue), body)
        return F.when(verdict["valid"], F.array().cast("array<string>")).otherwise(F.array(verdict["error"]))

    return Stage(queue, check, key, TTL_SECONDS["default"], handle)

