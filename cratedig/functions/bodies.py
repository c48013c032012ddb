"""Expressions over JSON message bodies kept as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cratedig.functions.bind import let

MAX_WRAPPERS = 3


def json_get(body: Column, path: str, dtype: str | None = None) -> Column:
    """Text at a path, or a typed value (null when it does not convert)."""
    got = F.get_json_object(body, path)
    return got if dtype is None else got.try_cast(dtype)


def is_object(body: Column) -> Column:
    return F.json_object_keys(body).isNotNull()


def json_has_key(body: Column, key: str) -> Column:
    """True when the object has the key, even with a null value."""
    return F.coalesce(F.array_contains(F.json_object_keys(body), key), F.lit(False))


def json_build(**fields: Column) -> Column:
    """One JSON object from named columns; null fields are left out."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]))


def json_merge(old: Column, new: Column) -> Column:
    """``old`` with the keys of ``new`` replaced or added, on string maps."""
    empty = F.create_map().cast("map<string,string>")
    new = F.coalesce(new, empty)
    kept = F.map_filter(F.coalesce(old, empty), lambda k, _: ~F.map_contains_key(new, k))
    return F.map_concat(kept, new)


FALSY_TEXT = r"^(-?0(\.0+)?([eE][+-]?[0-9]+)?|false)$"


def given_field(body: Column, name: str) -> Column:
    """A field's text; null for what a truthiness test would skip: missing, empty text, the number zero, false.

    The texts "0" and "false" are values. Only where a field reads like zero or
    false is the body parsed again, for the kind of the value.
    """
    got = F.get_json_object(body, f"$.{name}")
    typed = lambda kind: F.from_json(body, f"`{name}` {kind}")[name]
    falsy = F.coalesce(typed("double") == 0, F.lit(False)) | F.coalesce(~typed("boolean"), F.lit(False))
    return F.when(F.when(got.rlike(FALSY_TEXT), ~falsy).otherwise(got != ""), got)


def _unquote(body: Column) -> Column:
    return F.when(F.ltrim(body).startswith('"'), F.get_json_object(body, "$")).otherwise(body)


def parse_body(body: Column) -> Column:
    """The innermost message object as JSON text; null when it cannot be parsed.

    A body may be an object, JSON text of an object, or either of them under a
    ``message`` key. A wrapper that holds nothing else is taken off again, up
    to a fixed depth.
    """
    now = let(_unquote(body), _unwrap)
    for _ in range(MAX_WRAPPERS - 1):
        now = let(now, _unwrap_single)
    return let(now, lambda b: F.when(is_object(b), b))


def _unwrap(body: Column) -> Column:
    """What the object has under ``message``, else the object."""
    inner = F.get_json_object(body, "$.message")
    return F.when(json_has_key(body, "message"), F.coalesce(inner, body)).otherwise(body)


def _unwrap_single(body: Column) -> Column:
    """The same, but only when there is nothing else in it."""
    only = F.array(F.lit("message"))
    return F.when(F.json_object_keys(body) == only, F.coalesce(F.get_json_object(body, "$.message"), body)).otherwise(body)


def extract_message_id(body: Column) -> Column:
    """First id-like field, outer level before the wrapped one."""
    outer = [F.get_json_object(body, f"$.{k}") for k in ("id", "msg_id", "msgId", "messageId")]
    nested = [F.get_json_object(body, f"$.message.{k}") for k in ("id", "msg_id")]
    return F.coalesce(*outer, *nested)


def first_of(body: Column, *names: str, default: str | None = None) -> Column:
    """First non-empty of several field spellings."""
    picks = [given_field(body, n) for n in names]
    if default is not None:
        picks.append(F.lit(default))
    return F.coalesce(*picks)


def coalesce_aliases(body: Column, stage: str) -> Column:
    """Canonical fields of one stage's message, as a struct."""
    offset = F.coalesce(F.get_json_object(body, "$.offset").try_cast("int"), F.lit(0)).alias("offset")
    if stage == "album_discovery":
        return F.struct(
            first_of(body, "spotifyId", "artistSpotifyId", "artist_spotify_id").alias("spotify_id"),
            first_of(body, "artistName", "artist_name", default="Unknown Artist").alias("artist_name"),
            first_of(body, "artistId", "artist_id").alias("artist_id"),
            offset,
        )
    if stage == "track_discovery":
        return F.struct(
            first_of(body, "spotifyId", "albumSpotifyId").alias("album_spotify_id"),
            first_of(body, "albumName", default="Unknown Album").alias("album_name"),
            first_of(body, "albumId").alias("album_id"),
            first_of(body, "artistId").alias("artist_id"),
            offset,
        )
    if stage == "producer_identification":
        return F.struct(
            first_of(body, "trackId", "track_id").alias("track_id"),
            first_of(body, "trackName", "track_name").alias("track_name"),
            first_of(body, "artistName", "artist_name").alias("artist_name"),
        )
    raise ValueError(f"no field aliases for {stage}")


def idempotency_key(queue: Column, body: Column) -> Column:
    """The message's own key, else the queue and a digest of the canonical body."""
    inner = F.get_json_object(body, "$.message")
    own = F.coalesce(given_field(body, "_idempotencyKey"), given_field(inner, "_idempotencyKey"))
    return F.concat(queue, F.lit(":"), F.coalesce(own, F.sha2(canonical(body), 256)))


def canonical(body: Column) -> Column:
    """Body text with its top-level keys in sorted order; whatever does not parse stays as is."""
    pairs = F.from_json(body, "map<string,string>")
    ordered = F.map_from_entries(F.array_sort(F.map_entries(pairs)))
    return F.coalesce(F.to_json(ordered), body)


def track_operation_key(body: Column) -> Column:
    """Operation key of a credit lookup: one per track."""
    track = first_of(body, "trackId", "track_id")
    fallback = F.concat(
        F.lit("producer-identification:"), F.length(body).cast("string"), F.lit(":"), F.substring(body, 1, 40)
    )
    return F.coalesce(
        first_of(body, "idempotencyKey"),
        F.concat(F.lit("track:"), track, F.lit(":producer-identification")),
        fallback,
    )
