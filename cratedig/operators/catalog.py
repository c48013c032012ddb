"""Reports over the linked catalog.

Table arguments carry at least these columns, with unique ids:
artists(artist_id, name), albums(album_id, artist_id), tracks(track_id, album_id),
producers(producer_id, name), track_producers(track_id, producer_id).

Counts are taken level by level before each join. That replaces several
distinct counts over a fan-out join, and it means a hot parent (one album with
a third of all tracks) is reduced to one row before it is shuffled for a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cratedig.operators.skew import left_fanout


# --- chains ---------------------------------------------------------------

def catalog_chain_inner(producers, track_producers, tracks, albums, artists) -> DataFrame:
    """One row per credit whose whole chain exists."""
    return (
        track_producers.select("track_id", "producer_id")
        .join(tracks.select("track_id", "album_id", "popularity"), "track_id")
        .join(albums.select("album_id", "artist_id"), "album_id")
        .join(artists.select("artist_id", F.col("name").alias("artist_name")), "artist_id")
        .join(producers.select("producer_id", F.col("name").alias("producer_name")), "producer_id")
    )


def catalog_chain_left(artists, albums, tracks, track_producers, producers) -> DataFrame:
    """Every artist with whatever of the chain below it exists.

    Built from the links upwards: the credits of a track, the tracks of an
    album, the albums of an artist, keeping childless parents at each level.
    """
    linked = track_producers.select("track_id", F.col("producer_id").alias("_p")).join(
        producers.select(F.col("producer_id").alias("_p"), "producer_id"), "_p", "left"
    )
    under_track = left_fanout(tracks.select("track_id", "album_id"), linked.drop("_p"), "track_id", track_producers)
    under_album = left_fanout(albums.select("album_id", "artist_id"), under_track, "album_id", tracks)
    return left_fanout(artists.select("artist_id", F.col("name").alias("artist_name")), under_album, "artist_id", albums)


def producer_chain_left(producers, track_producers, tracks, albums, artists) -> DataFrame:
    """Every producer with whatever of the chain up to the artist exists."""
    credited = left_fanout(
        producers.select("producer_id", F.col("name").alias("producer_name")),
        track_producers.select("track_id", "producer_id"),
        "producer_id",
    )
    return (
        credited.join(tracks.select("track_id", "album_id"), "track_id", "left")
        .join(albums.select("album_id", F.col("artist_id").alias("_a")), "album_id", "left")
        .join(artists.select(F.col("artist_id").alias("_a"), "artist_id"), "_a", "left")
        .drop("_a")
    )


# --- popularity and collaboration ----------------------------------------

def _credits_by_artist(track_producers, tracks, albums, artists) -> DataFrame:
    """(producer_id, artist_id) with distinct tracks, and popularity sums over credit rows.

    Credits are counted where their track's join needs them, in one shuffle.
    """
    credits = track_producers.repartition("track_id").groupBy("producer_id", "track_id").agg(F.count(F.lit(1)).alias("n"))
    placed = (
        credits.join(tracks.select("track_id", "album_id", "popularity"), "track_id")
        .withColumn("rated", F.when(F.col("popularity").isNotNull(), F.col("n")).otherwise(F.lit(0)))
        .groupBy("producer_id", "album_id")
        .agg(
            F.count(F.lit(1)).alias("tracks"),
            F.sum(F.col("popularity") * F.col("n")).alias("pop_sum"),
            F.sum("rated").alias("pop_n"),
        )
    )
    return (
        placed.join(albums.select("album_id", "artist_id"), "album_id")
        .groupBy("producer_id", "artist_id")
        .agg(F.sum("tracks").alias("tracks"), F.sum("pop_sum").alias("pop_sum"), F.sum("pop_n").alias("pop_n"))
        .join(artists.select("artist_id"), "artist_id", "left_semi")
    )


def producer_popularity(producers, track_producers, tracks, albums, artists) -> DataFrame:
    """Per producer: distinct tracks, distinct artists, average popularity over credits."""
    per = (
        _credits_by_artist(track_producers, tracks, albums, artists)
        .groupBy("producer_id")
        .agg(
            F.sum("tracks").alias("track_count"),
            F.count(F.lit(1)).alias("artist_count"),
            F.try_divide(F.sum("pop_sum").cast("double"), F.sum("pop_n").cast("double")).alias(
                "avg_track_popularity"
            ),
        )
    )
    return producers.select("producer_id", "name").join(per, "producer_id")


def producer_collaborations(track_producers, tracks, albums, artists, producer_id) -> DataFrame:
    """Artists a producer worked with and on how many tracks, most first."""
    mine = track_producers.filter(F.col("producer_id") == producer_id).select("track_id").distinct()
    per = (
        mine.join(tracks.select("track_id", "album_id"), "track_id")
        .groupBy("album_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(albums.select("album_id", "artist_id"), "album_id")
        .groupBy("artist_id")
        .agg(F.sum("n").alias("track_count"))
    )
    return (
        per.join(artists.select("artist_id", F.col("name").alias("artist_name")), "artist_id")
        .select("artist_id", "artist_name", "track_count")
        .orderBy(F.desc("track_count"), "artist_id")
    )


def search_by_name(df: DataFrame, term: str, column: str = "name", substring: bool = True) -> DataFrame:
    """Case-insensitive match; wildcards in the term keep their meaning."""
    return df.filter(F.col(column).ilike(f"%{term}%" if substring else term))


def search_producers(producers, track_producers, tracks, albums, artists, term: str, limit: int | None = None) -> DataFrame:
    """Producers whose name or normalized name matches, with track and artist counts."""
    hit = F.col("name").ilike(f"%{term}%")
    if "normalized_name" in producers.columns:
        hit = hit | F.col("normalized_name").ilike(f"%{term}%")
    found = producers.filter(hit)
    links = (
        track_producers.join(found.select("producer_id"), "producer_id", "left_semi")
        .select("producer_id", "track_id")
        .distinct()
    )
    by_album = (
        links.join(tracks.select("track_id", "album_id"), "track_id", "left")
        .groupBy("producer_id", "album_id")
        .agg(F.count("track_id").alias("n"))
    )
    by_artist = (
        by_album.join(albums.select("album_id", F.col("artist_id").alias("_a")), "album_id", "left")
        .groupBy("producer_id", "_a")
        .agg(F.sum("n").alias("n"))
    )
    counted = (
        by_artist.join(artists.select(F.col("artist_id").alias("_a"), "artist_id"), "_a", "left")
        .groupBy("producer_id")
        .agg(F.sum("n").alias("track_count"), F.count("artist_id").alias("artist_count"))
    )
    out = (
        found.join(counted, "producer_id", "left")
        .fillna(0, ["track_count", "artist_count"])
        .orderBy(F.desc("track_count"), F.desc("artist_count"), "name", "producer_id")
    )
    return out if limit is None else out.limit(limit)


def related_producers(track_producers, tracks, albums, producers, artist_ids: DataFrame, track_ids: DataFrame) -> DataFrame:
    """Producers, never enriched, of the given tracks and of the other tracks of the given artists.

    One row per producer with its enrichment message key.
    """
    wanted = tracks_given_or_related(tracks, albums, artist_ids, track_ids)
    linked = track_producers.join(wanted, "track_id", "left_semi").select("producer_id").distinct()
    return (
        producers.filter(F.col("enriched_at").isNull())
        .join(linked, "producer_id", "left_semi")
        .select(
            "producer_id",
            F.col("name").alias("producer_name"),
            F.lit(5).alias("priority"),
            F.concat(F.lit("social_enrichment:"), F.col("producer_id").cast("string")).alias("idempotency_key"),
        )
    )


def tracks_excluding(tracks, albums, artist_ids: DataFrame, track_ids: DataFrame) -> DataFrame:
    """Track ids of the given artists, without the given tracks."""
    return _tracks_of(tracks, albums, artist_ids).join(track_ids, "track_id", "left_anti")


def _tracks_of(tracks, albums, artist_ids: DataFrame) -> DataFrame:
    owned = albums.join(artist_ids, "artist_id", "left_semi").select("album_id")
    return tracks.select("track_id", "album_id").join(owned, "album_id", "left_semi").select("track_id")


def tracks_given_or_related(tracks, albums, artist_ids: DataFrame, track_ids: DataFrame) -> DataFrame:
    """Each of the given tracks and of the artists' tracks once; those that are both need not be taken out before."""
    return track_ids.select("track_id").union(_tracks_of(tracks, albums, artist_ids)).distinct()


def track_producers_lookup(track_producers, producers) -> DataFrame:
    return track_producers.join(producers.select("producer_id", "name"), "producer_id")


def track_must_exist(messages: DataFrame, tracks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(known, unknown): messages split by whether their track is in the catalog."""
    ids = tracks.select("track_id")
    unknown = messages.join(ids, "track_id", "left_anti").withColumn(
        "error", F.concat(F.lit("Track not found with ID: "), F.col("track_id").cast("string"))
    )
    return messages.join(ids, "track_id", "left_semi"), unknown


def fill_missing_names(messages, tracks, albums, artists) -> DataFrame:
    """Completes track and artist names from the catalog.

    ``error`` says why a row still cannot be used: the track is unknown and was
    needed, or a name is still missing.
    """
    filled = (
        messages.join(
            tracks.select("track_id", F.col("name").alias("_track"), "album_id", F.lit(True).alias("_known")),
            "track_id",
            "left",
        )
        .join(albums.select("album_id", "artist_id"), "album_id", "left")
        .join(artists.select("artist_id", F.col("name").alias("_artist")), "artist_id", "left")
    )
    given_track, given_artist = _given("track_name"), _given("artist_name")
    needed = given_track.isNull() | given_artist.isNull()
    track, artist = F.coalesce(given_track, "_track"), F.coalesce(given_artist, "_artist")
    error = F.when(
        needed & F.col("_known").isNull(), F.lit("PERMANENT_NOT_FOUND")
    ).when(track.isNull() | artist.isNull(), F.lit("PERMANENT_INVALID_INPUT"))
    return (
        filled.withColumn("error", error)
        .withColumn("track_name", track)
        .withColumn("artist_name", artist)
        .select(*messages.columns, "error")
    )


def _given(name: str) -> Column:
    return F.when(F.col(name) != "", F.col(name))


# --- catalog checks --------------------------------------------------------

def fk_orphans(albums, tracks, track_producers, artists, producers) -> DataFrame:
    """Rows whose parent is missing: (relation, child_id, parent_id). Ids become text only once they are found missing."""

    def missing(relation, child, child_id, fk, parent, pk):
        lost = child.select(*dict.fromkeys([child_id, fk])).join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")
        return lost.select(
            F.lit(relation).alias("relation"),
            F.col(child_id).cast("string").alias("child_id"),
            F.col(fk).cast("string").alias("parent_id"),
        )

    return (
        missing("albums.artist_id", albums, "album_id", "artist_id", artists, "artist_id")
        .unionByName(missing("tracks.album_id", tracks, "track_id", "album_id", albums, "album_id"))
        .unionByName(missing("track_producers.track_id", track_producers, "track_id", "track_id", tracks, "track_id"))
        .unionByName(
            missing("track_producers.producer_id", track_producers, "track_id", "producer_id", producers, "producer_id")
        )
    )


def table_counts(**tables: DataFrame) -> DataFrame:
    """(table_name, row_count), one row per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# Stage order and the warning texts of the gap check.
STAGE_GAPS = [
    ("artists", "albums", "Artists exist but no albums found - potential issue with album discovery"),
    ("albums", "tracks", "Albums exist but no tracks found - potential issue with track discovery"),
    ("tracks", "producers", "Tracks exist but no producers found - potential issue with producer identification"),
]


def gap_check(counts: DataFrame) -> DataFrame:
    """Parent stage filled but child stage empty: (parent, child, status, issue)."""

    def of(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("table_name") == name, F.col("row_count"))), F.lit(0))

    names = ["artists", "albums", "tracks", "producers"]
    wide = counts.agg(*[of(n).alias(n) for n in names])
    rows = []
    for parent, child, text in STAGE_GAPS:
        gap = (F.col(parent) > 0) & (F.col(child) == 0)
        rows.append(
            F.struct(
                F.lit(parent).alias("parent"),
                F.lit(child).alias("child"),
                F.when(gap, "warning").otherwise("healthy").alias("status"),
                F.when(gap, F.lit(text)).alias("issue"),
            )
        )
    return wide.select(F.inline(F.array(*rows)))


def top_n_popular(artists, n: int = 20) -> DataFrame:
    return artists.orderBy(F.desc("popularity"), "artist_id").limit(n)
