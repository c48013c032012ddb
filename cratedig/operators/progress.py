"""How far each artist has come through the stages, and what is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cratedig.functions.times import ago, at, fixed, hours_since, human_eta, pct_completion
from cratedig.operators.ordered import share_of_total

# Stages in order with their progress, and the constants of the rules.
STATUS_PROGRESS = [
    ("no_albums", 0.0),
    ("no_tracks", 0.25),
    ("no_producers", 0.5),
    ("tracks_incomplete", 0.75),
    ("complete", 1.0),
]
EXPECTED_TRACKS_PER_ALBUM = 10
COMPLETE_SHARE = 0.9


def artist_stats(artists, albums, tracks, track_producers, producers, extra_max: bool = False) -> DataFrame:
    """Per artist: albums, tracks and distinct producers, zeros included.

    Every level is counted on its own key before it meets the next one.
    ``extra_max`` adds the latest update per level.
    """
    by_album = tracks.groupBy("album_id").agg(
        F.count(F.lit(1)).alias("n"), *([F.max("updated_at").alias("track_updated")] if extra_max else [])
    )
    album_cols = ["album_id", "artist_id"] + (["updated_at"] if extra_max else [])
    owned = (
        albums.select(*album_cols)
        .join(by_album, "album_id", "left")
        .groupBy("artist_id")
        .agg(
            F.count(F.lit(1)).alias("albums_count"),
            F.sum(F.coalesce("n", F.lit(0))).alias("tracks_count"),
            *(
                [F.max("updated_at").alias("album_updated"), F.max("track_updated").alias("track_updated")]
                if extra_max
                else []
            ),
        )
    )
    met = artist_producers(albums, tracks, track_producers, producers)
    counted = met.groupBy("artist_id").agg(F.count(F.lit(1)).alias("producers_count"))
    return (
        artists.join(owned, "artist_id", "left")
        .join(counted, "artist_id", "left")
        .fillna(0, ["albums_count", "tracks_count", "producers_count"])
    )


def artist_producers(albums, tracks, track_producers, producers) -> DataFrame:
    """Distinct (artist_id, producer_id) over existing producers."""
    return (
        track_producers.select("track_id", "producer_id")
        .join(producers.select("producer_id"), "producer_id", "left_semi")
        .join(tracks.select("track_id", "album_id"), "track_id")
        .select("album_id", "producer_id")
        .distinct()
        .join(albums.select("album_id", "artist_id"), "album_id")
        .select("artist_id", "producer_id")
        .distinct()
    )


def status_of(albums: Column, tracks: Column, producers: Column, expected: Column | None = None) -> Column:
    status = (
        F.when(albums == 0, "no_albums").when(tracks == 0, "no_tracks").when(producers == 0, "no_producers")
    )
    if expected is not None:
        status = status.when(tracks < expected * COMPLETE_SHARE, "tracks_incomplete")
    return status.otherwise("complete")


def progress_of(status: Column) -> Column:
    value = F.lit(None).cast("double")
    for name, share in STATUS_PROGRESS:
        value = F.when(status == name, F.lit(share)).otherwise(value)
    return value


def status_rank(status: Column) -> Column:
    return (
        F.when(status == "no_albums", 1).when(status == "no_tracks", 2).when(status == "no_producers", 3).otherwise(4)
    )


def artist_progress(artists, albums, tracks, track_producers, producers, artist_id=None) -> DataFrame:
    """Counts, expectations, five-way status and completion of one artist or of all."""
    if artist_id is not None:
        artists = artists.filter(F.col("artist_id") == artist_id)
        albums = albums.filter(F.col("artist_id") == artist_id)
    expected = albums.groupBy("artist_id").agg(
        F.sum(F.coalesce("total_tracks", F.lit(EXPECTED_TRACKS_PER_ALBUM))).alias("tracks_expected")
    )
    if "total_albums" not in artists.columns:
        artists = artists.withColumn("total_albums", F.lit(0))
    base = artist_stats(
        artists.select("artist_id", "name", F.coalesce("total_albums", F.lit(0)).alias("albums_expected")),
        albums, tracks, track_producers, producers,
    )
    status = status_of(
        F.col("albums_count"), F.col("tracks_count"), F.col("producers_count"), F.col("tracks_expected")
    )
    return (
        base.join(expected, "artist_id", "left")
        .fillna(0, ["tracks_expected"])
        .withColumn("status", status)
        .select(
            "artist_id",
            F.col("name").alias("artist_name"),
            "status",
            progress_of(F.col("status")).alias("progress"),
            "albums_count",
            "albums_expected",
            pct_completion(F.col("albums_count"), F.col("albums_expected")).alias("albums_completion"),
            "tracks_count",
            "tracks_expected",
            pct_completion(F.col("tracks_count"), F.col("tracks_expected")).alias("tracks_completion"),
            "producers_count",
        )
    )


def with_status(stats: DataFrame) -> DataFrame:
    status = status_of(F.col("albums_count"), F.col("tracks_count"), F.col("producers_count"))
    return stats.withColumn("status", status).withColumn("progress", progress_of(F.col("status")))


def optional_filters(df: DataFrame, status=None, progress_min=None, progress_max=None) -> DataFrame:
    """Each condition applies only when its argument is given."""
    if status is not None:
        df = df.filter(F.col("status") == status)
    if progress_min is not None:
        df = df.filter(F.col("progress") >= progress_min)
    if progress_max is not None:
        df = df.filter(F.col("progress") <= progress_max)
    return df


def status_ordering(df: DataFrame, name: str = "artist_name", *tie_break: str) -> DataFrame:
    return df.orderBy(status_rank(F.col("status")), name, *tie_break)


def artists_progress_list(
    artists, albums, tracks, track_producers, producers, status=None, limit=100, progress_min=None, progress_max=None
) -> DataFrame:
    rows = with_status(artist_stats(artists.select("artist_id", "name"), albums, tracks, track_producers, producers))
    rows = optional_filters(rows, status, progress_min, progress_max).select(
        "artist_id",
        F.col("name").alias("artist_name"),
        "status",
        "progress",
        "albums_count",
        "tracks_count",
        "producers_count",
    )
    ordered = status_ordering(rows, "artist_name", "artist_id")
    return ordered if limit is None else ordered.limit(limit)


def status_summary(artists, albums, tracks, track_producers, producers) -> DataFrame:
    """Artists per status with their share; the counts have at most four rows."""
    rows = with_status(artist_stats(artists.select("artist_id"), albums, tracks, track_producers, producers))
    counts = rows.groupBy("status").agg(F.count(F.lit(1)).alias("artist_count"))
    return share_of_total(counts, "artist_count", "percentage", few_rows=True).orderBy(status_rank(F.col("status")))


def estimate_completion(artists, albums, tracks, track_producers, producers, as_of) -> DataFrame:
    """One row: totals, what is left, recent rate and the estimated time to finish."""
    rows = with_status(artist_stats(artists.select("artist_id"), albums, tracks, track_producers, producers))
    totals = rows.agg(
        F.count(F.lit(1)).alias("artists_total"),
        F.coalesce(F.sum((F.col("status") == "complete").cast("long")), F.lit(0)).alias("artists_complete"),
    )
    recent = (
        artists.filter(F.col("created_at") >= ago(as_of, hours=24))
        .select("created_at", "artist_id")
        .orderBy(F.desc("created_at"), "artist_id")
        .limit(100)
        .agg(F.count(F.lit(1)).alias("recent_n"), F.min("created_at").alias("recent_from"))
    )
    both = totals.unionByName(recent, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("artists_total", "artists_complete", "recent_n", "recent_from")]
    )
    span = hours_since(F.col("recent_from"), as_of)
    rate = F.when(F.col("recent_from").isNull(), F.lit(None)).when(span < 1, F.lit(1.0)).otherwise(
        F.try_divide(F.col("recent_n").cast("double"), span)
    )
    left = F.col("artists_total") - F.col("artists_complete")
    return (
        both.withColumn("artists_remaining", left)
        .withColumn("rate", rate)
        .withColumn("hours", F.when(F.col("rate") > 0, F.col("artists_remaining") / F.col("rate")))
        .select(
            "artists_total",
            "artists_complete",
            "artists_remaining",
            F.when(
                F.col("artists_total") > 0, F.round(F.col("artists_complete") / F.col("artists_total") * 100, 2)
            )
            .otherwise(F.lit(0.0))
            .alias("completion_percentage"),
            F.concat(fixed(F.col("rate"), 2), F.lit(" artists/hour")).alias("processing_rate"),
            human_eta(F.col("hours")).alias("estimated_completion_time"),
        )
    )


def find_stalled_artists(artists, albums, tracks, track_producers, producers, as_of, hours: float = 24) -> DataFrame:
    """Unfinished artists, at least an hour old, whose last reached stage has not moved."""
    cols = ["artist_id", "name", "created_at"]
    touched = "updated_at" if "updated_at" in artists.columns else "created_at"
    old = artists.filter(F.col("created_at") < ago(as_of, hours=1)).select(
        *cols, F.col(touched).alias("artist_updated")
    )
    stats = artist_stats(old, albums, tracks, track_producers, producers, extra_max=True)
    stage = (
        F.when(F.col("albums_count") == 0, "albums")
        .when(F.col("tracks_count") == 0, "tracks")
        .when(F.col("producers_count") == 0, "producers")
        .otherwise("complete")
    )
    last = (
        F.when(F.col("stage") == "albums", F.col("artist_updated"))
        .when(F.col("stage") == "tracks", F.coalesce("album_updated", "artist_updated"))
        .otherwise(F.coalesce("track_updated", "album_updated", "artist_updated"))
    )
    return (
        stats.withColumn("stage", stage)
        .filter(F.col("stage") != "complete")
        .withColumn("last_update", last)
        .withColumn("stalled_hours", hours_since(F.col("last_update"), at(as_of)))
        .filter(F.col("stalled_hours") >= hours)
        .select("artist_id", F.col("name").alias("artist_name"), "stage", "stalled_hours", "last_update")
        .orderBy(F.desc("stalled_hours"), "stage", "artist_id")
    )
