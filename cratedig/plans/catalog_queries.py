"""Catalog and progress queries over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cratedig.functions import text, times
from cratedig.operators import catalog, progress, ordered
from cratedig.plans.registry import query
from cratedig.sources import testbed as tb
from cratedig.sources.testbed import CATALOG_AS_OF

CHAIN = "artists albums tracks track_producers producers"


def _down(s, d):
    """artists, albums, tracks, track_producers, producers"""
    return tb.artists(s, d), tb.albums(s, d), tb.tracks(s, d), tb.track_producers(s, d), tb.producers(s, d)


def _up(s, d):
    return tuple(reversed(_down(s, d)))


STATS = """stats AS (SELECT a.artist_id, a.name AS artist_name, a.created_at,
  COUNT(DISTINCT al.album_id) AS albums_count, COUNT(DISTINCT t.track_id) AS tracks_count,
  COUNT(DISTINCT p.producer_id) AS producers_count, MAX(al.updated_at) AS album_updated,
  MAX(t.updated_at) AS track_updated
  FROM artists a LEFT JOIN albums al ON a.artist_id = al.artist_id LEFT JOIN tracks t ON al.album_id = t.album_id
  LEFT JOIN track_producers tp ON t.track_id = tp.track_id LEFT JOIN producers p ON tp.producer_id = p.producer_id
  GROUP BY 1, 2, 3),
status AS (SELECT *, CASE WHEN albums_count = 0 THEN 'no_albums' WHEN tracks_count = 0 THEN 'no_tracks'
  WHEN producers_count = 0 THEN 'no_producers' ELSE 'complete' END AS status,
  CASE WHEN albums_count = 0 THEN 0.0::DOUBLE WHEN tracks_count = 0 THEN 0.25::DOUBLE
  WHEN producers_count = 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS progress FROM stats)"""


@query("catalog_chain_inner", CHAIN, """
SELECT tp.track_id, tp.producer_id, al.album_id, a.artist_id, t.popularity, a.name AS artist_name, p.name AS producer_name
FROM producers p JOIN track_producers tp ON p.producer_id = tp.producer_id JOIN tracks t ON tp.track_id = t.track_id
JOIN albums al ON t.album_id = al.album_id JOIN artists a ON al.artist_id = a.artist_id""")
def _(s, d):
    return catalog.catalog_chain_inner(*_up_inner(s, d))


def _up_inner(s, d):
    a, al, t, tp, p = _down(s, d)
    return p, tp, t, al, a


@query("catalog_chain_left", CHAIN, """
SELECT a.artist_id, a.name AS artist_name, al.album_id, t.track_id, p.producer_id
FROM artists a LEFT JOIN albums al ON a.artist_id = al.artist_id LEFT JOIN tracks t ON al.album_id = t.album_id
LEFT JOIN track_producers tp ON t.track_id = tp.track_id LEFT JOIN producers p ON tp.producer_id = p.producer_id""")
def _(s, d):
    return catalog.catalog_chain_left(*_down(s, d))


@query("producer_chain_left", CHAIN, """
SELECT p.producer_id, p.name AS producer_name, tp.track_id, t.album_id, a.artist_id
FROM producers p LEFT JOIN track_producers tp ON p.producer_id = tp.producer_id
LEFT JOIN tracks t ON tp.track_id = t.track_id LEFT JOIN albums al ON t.album_id = al.album_id
LEFT JOIN artists a ON al.artist_id = a.artist_id""")
def _(s, d):
    # the SQL shows the track's album id even when that album is unknown
    p, tp, t, al, a = _up_inner(s, d)
    return catalog.producer_chain_left(p, tp, t, al, a)


@query("producer_popularity", CHAIN, """
SELECT p.producer_id, p.name, COUNT(DISTINCT tp.track_id) AS track_count, COUNT(DISTINCT a.artist_id) AS artist_count,
  round(AVG(t.popularity), 6) AS avg_track_popularity
FROM producers p JOIN track_producers tp ON p.producer_id = tp.producer_id JOIN tracks t ON tp.track_id = t.track_id
JOIN albums al ON t.album_id = al.album_id JOIN artists a ON al.artist_id = a.artist_id GROUP BY 1, 2""")
def flagship(s, d):
    return catalog.producer_popularity(*_up_inner(s, d))


@query("producer_collaborations", CHAIN, """
SELECT a.artist_id, a.name AS artist_name, COUNT(DISTINCT t.track_id) AS track_count
FROM producers p JOIN track_producers tp ON p.producer_id = tp.producer_id JOIN tracks t ON tp.track_id = t.track_id
JOIN albums al ON t.album_id = al.album_id JOIN artists a ON al.artist_id = a.artist_id
WHERE p.producer_id = 10 GROUP BY 1, 2 ORDER BY 3 DESC, 1""")
def _(s, d):
    a, al, t, tp, _p = _down(s, d)
    return catalog.producer_collaborations(tp, t, al, a, 10)


@query("search_producers", CHAIN, """
SELECT p.producer_id, p.name, COUNT(DISTINCT tp.track_id) AS track_count, COUNT(DISTINCT a.artist_id) AS artist_count
FROM producers p LEFT JOIN track_producers tp ON p.producer_id = tp.producer_id
LEFT JOIN tracks t ON tp.track_id = t.track_id LEFT JOIN albums al ON t.album_id = al.album_id
LEFT JOIN artists a ON al.artist_id = a.artist_id WHERE p.name ILIKE '%r#0000000%' GROUP BY 1, 2""")
def _(s, d):
    p, tp, t, al, a = _up_inner(s, d)
    return catalog.search_producers(p.select("producer_id", "name"), tp, t, al, a, "R#0000000")


@query("artist_stats", CHAIN, f"""WITH {STATS}
SELECT artist_id, artist_name AS name, albums_count, tracks_count, producers_count FROM stats""")
def _(s, d):
    a, *rest = _down(s, d)
    return progress.artist_stats(a.select("artist_id", "name"), *rest)


PROGRESS_SQL = """WITH al AS (SELECT artist_id, count(*) AS n, sum(coalesce(total_tracks, 10)) AS expected FROM albums GROUP BY 1),
tr AS (SELECT artist_id, count(*) AS n FROM tracks JOIN albums USING (album_id) GROUP BY 1),
pr AS (SELECT artist_id, count(DISTINCT producer_id) AS n FROM producers JOIN track_producers USING (producer_id)
  JOIN tracks USING (track_id) JOIN albums USING (album_id) GROUP BY 1),
m AS (SELECT a.artist_id, a.name AS artist_name, coalesce(al.n, 0) AS ac, coalesce(tr.n, 0) AS tc, coalesce(pr.n, 0) AS pc,
  CAST(coalesce(al.expected, 0) AS BIGINT) AS te
  FROM artists a LEFT JOIN al USING (artist_id) LEFT JOIN tr USING (artist_id) LEFT JOIN pr USING (artist_id))
SELECT artist_id, artist_name, CASE WHEN ac = 0 THEN 'no_albums' WHEN tc = 0 THEN 'no_tracks' WHEN pc = 0 THEN 'no_producers'
  WHEN tc < te * 0.9::DOUBLE THEN 'tracks_incomplete' ELSE 'complete' END AS status,
  CASE WHEN ac = 0 THEN 0.0::DOUBLE WHEN tc = 0 THEN 0.25::DOUBLE WHEN pc = 0 THEN 0.5::DOUBLE
  WHEN tc < te * 0.9::DOUBLE THEN 0.75::DOUBLE ELSE 1.0::DOUBLE END AS progress,
  ac AS albums_count, 0::BIGINT AS albums_expected, 100.0::DOUBLE AS albums_completion, tc AS tracks_count, te AS tracks_expected,
  CASE WHEN te > 0 THEN round_even(tc::DOUBLE / te * 100, 0) ELSE 100.0 END::DOUBLE AS tracks_completion, pc AS producers_count
FROM m"""


@query("artist_progress", CHAIN, PROGRESS_SQL)
def _(s, d):
    return progress.artist_progress(*_down(s, d))


@query("pct_completion", CHAIN, f"SELECT artist_id, tracks_count, tracks_expected, tracks_completion FROM ({PROGRESS_SQL})")
def _(s, d):
    al, t = tb.albums(s, d), tb.tracks(s, d)
    want = al.groupBy("artist_id").agg(F.sum(F.coalesce("total_tracks", F.lit(10))).alias("tracks_expected"))
    have = (
        t.groupBy("album_id").agg(F.count(F.lit(1)).alias("n"))
        .join(al.select("album_id", "artist_id"), "album_id")
        .groupBy("artist_id").agg(F.sum("n").alias("tracks_count"))
    )
    return (
        tb.artists(s, d).select("artist_id").join(have, "artist_id", "left").join(want, "artist_id", "left")
        .fillna(0)
        .withColumn("tracks_completion", times.pct_completion(F.col("tracks_count"), F.col("tracks_expected")))
    )


@query("artists_progress_list", CHAIN, f"""WITH {STATS}
SELECT artist_id, artist_name, status, progress, albums_count, tracks_count, producers_count FROM status
ORDER BY CASE status WHEN 'no_albums' THEN 1 WHEN 'no_tracks' THEN 2 WHEN 'no_producers' THEN 3 ELSE 4 END,
  artist_name, artist_id LIMIT 100""")
def _(s, d):
    return progress.artists_progress_list(*_down(s, d))


@query("optional_filters", CHAIN, f"""WITH {STATS}
SELECT artist_id, status, progress FROM status WHERE progress >= 0.25 AND progress <= 0.5""")
def _(s, d):
    a, *rest = _down(s, d)
    rows = progress.with_status(progress.artist_stats(a.select("artist_id"), *rest))
    return progress.optional_filters(rows, None, 0.25, 0.5).select("artist_id", "status", "progress")


@query("status_ordering", CHAIN, f"""WITH {STATS}
SELECT artist_id, artist_name, status FROM status""")
def _(s, d):
    a, *rest = _down(s, d)
    rows = progress.with_status(
        progress.artist_stats(a.select("artist_id", F.col("name").alias("artist_name")), *rest)
    ).select("artist_id", "artist_name", "status")
    return progress.status_ordering(rows, "artist_name", "artist_id")


SUMMARY = f"""WITH {STATS}, c AS (SELECT status, count(*) AS artist_count FROM status GROUP BY 1)
SELECT status, artist_count, round(artist_count::DOUBLE / NULLIF(SUM(artist_count) OVER (), 0) * 100, 2)::DOUBLE AS percentage FROM c"""


@query("catalog_status_summary", CHAIN, SUMMARY)
def _(s, d):
    return progress.status_summary(*_down(s, d))


@query("pct_of_total", "artists", """SELECT genre, count(*) AS artist_count,
  round(count(*)::DOUBLE / sum(count(*)) OVER () * 100, 2)::DOUBLE AS pct FROM artists GROUP BY 1""")
def _(s, d):
    counts = tb.artists(s, d).groupBy("genre").agg(F.count(F.lit(1)).alias("artist_count"))
    return ordered.share_of_total(counts, "artist_count", "pct")


@query("estimate_completion", CHAIN, f"""WITH {STATS},
tot AS (SELECT count(*) AS total, sum(CASE WHEN status = 'complete' THEN 1 ELSE 0 END) AS done FROM status),
rec AS (SELECT created_at FROM artists WHERE created_at >= TIMESTAMP '2001-08-01 00:00:00' ORDER BY created_at DESC LIMIT 100),
r AS (SELECT CASE WHEN count(*) = 0 THEN NULL WHEN TIMESTAMP '2001-08-02 00:00:00' - min(created_at) < INTERVAL 1 HOUR THEN 1.0
  ELSE count(*) / (epoch(TIMESTAMP '2001-08-02 00:00:00') - epoch(min(created_at))) * 3600.0 END AS rate FROM rec),
x AS (SELECT CAST(total AS BIGINT) AS total, CAST(done AS BIGINT) AS done, rate::DOUBLE AS rate, (total - done) / rate::DOUBLE AS h FROM tot, r)
SELECT total AS artists_total, done AS artists_complete, total - done AS artists_remaining,
  round(done::DOUBLE / total * 100, 2)::DOUBLE AS completion_percentage,
  concat(printf('%.2f', round(rate, 2)), ' artists/hour') AS processing_rate,
  CASE WHEN h IS NULL THEN 'Cannot estimate' WHEN h < 1 THEN concat(printf('%.0f', round(h * 60, 0)), ' minutes')
    WHEN h < 24 THEN concat(printf('%.1f', round(h, 1)), ' hours') ELSE concat(printf('%.1f', round(h / 24, 1)), ' days') END
    AS estimated_completion_time FROM x""")
def _(s, d):
    return progress.estimate_completion(*_down(s, d), CATALOG_AS_OF)


@query("human_eta", CHAIN, """SELECT album_id, CASE WHEN h < 1 THEN concat(printf('%.0f', round(h * 60, 0)), ' minutes')
  WHEN h < 24 THEN concat(printf('%.1f', round(h, 1)), ' hours') ELSE concat(printf('%.1f', round(h / 24, 1)), ' days') END AS eta
  FROM (SELECT album_id, (album_id % 700) / 16.0::DOUBLE AS h FROM albums)""")
def _(s, d):
    return tb.albums(s, d).select("album_id", times.human_eta((F.col("album_id") % 700) / F.lit(16.0)).alias("eta"))


@query("find_stalled_artists", CHAIN, f"""WITH {STATS},
st AS (SELECT artist_id, artist_name, CASE WHEN albums_count = 0 THEN 'albums' WHEN tracks_count = 0 THEN 'tracks'
    WHEN producers_count = 0 THEN 'producers' ELSE 'complete' END AS stage, created_at, album_updated, track_updated
  FROM stats WHERE created_at < TIMESTAMP '2001-08-01 23:00:00'),
l AS (SELECT *, CASE stage WHEN 'albums' THEN created_at WHEN 'tracks' THEN coalesce(album_updated, created_at)
    ELSE coalesce(track_updated, album_updated, created_at) END AS last_update FROM st WHERE stage <> 'complete')
SELECT artist_id, artist_name, stage,
  round((epoch_us(TIMESTAMP '2001-08-02 00:00:00') - epoch_us(last_update)) / 3600000000.0::DOUBLE, 6) AS stalled_hours, last_update
FROM l WHERE (epoch_us(TIMESTAMP '2001-08-02 00:00:00') - epoch_us(last_update)) / 3600000000.0::DOUBLE >= 24""")
def _(s, d):
    return progress.find_stalled_artists(*_down(s, d), CATALOG_AS_OF)


@query("fk_orphans", CHAIN, """
SELECT 'albums.artist_id' AS relation, CAST(album_id AS VARCHAR) AS child_id, CAST(artist_id AS VARCHAR) AS parent_id
  FROM albums WHERE artist_id NOT IN (SELECT artist_id FROM artists)
UNION ALL SELECT 'tracks.album_id', CAST(track_id AS VARCHAR), CAST(album_id AS VARCHAR) FROM tracks
  WHERE album_id NOT IN (SELECT album_id FROM albums)
UNION ALL SELECT 'track_producers.track_id', CAST(track_id AS VARCHAR), CAST(track_id AS VARCHAR) FROM track_producers
  WHERE track_id NOT IN (SELECT track_id FROM tracks)
UNION ALL SELECT 'track_producers.producer_id', CAST(track_id AS VARCHAR), CAST(producer_id AS VARCHAR) FROM track_producers
  WHERE producer_id NOT IN (SELECT producer_id FROM producers)""")
def _(s, d):
    a, al, t, tp, p = _down(s, d)
    return catalog.fk_orphans(al, t, tp, a, p)


GIVEN_SQL = """given_artists AS (SELECT DISTINCT artist_id FROM artists WHERE genre = 'BUILDING'),
given_tracks AS (SELECT track_id FROM tracks WHERE popularity >= 49),
others AS (SELECT track_id FROM tracks t JOIN albums al USING (album_id) JOIN given_artists g ON g.artist_id = al.artist_id
  WHERE NOT EXISTS (SELECT 1 FROM given_tracks x WHERE x.track_id = t.track_id))"""


def _given(s, d):
    artists = tb.artists(s, d).filter(F.col("genre") == "BUILDING").select("artist_id")
    tracks = tb.tracks(s, d).filter(F.col("popularity") >= 49).select("track_id")
    return artists, tracks


@query("tracks_excluding", CHAIN, f"WITH {GIVEN_SQL} SELECT track_id FROM others")
def _(s, d):
    return catalog.tracks_excluding(tb.tracks(s, d), tb.albums(s, d), *_given(s, d))


@query("tracks_given_or_related", CHAIN, f"WITH {GIVEN_SQL} SELECT track_id FROM given_tracks UNION SELECT track_id FROM others")
def _(s, d):
    return catalog.tracks_given_or_related(tb.tracks(s, d), tb.albums(s, d), *_given(s, d))


@query("related_producers", CHAIN, f"""WITH {GIVEN_SQL}
SELECT DISTINCT p.producer_id, p.name AS producer_name, 5::BIGINT AS priority,
  concat('social_enrichment:', CAST(p.producer_id AS VARCHAR)) AS idempotency_key
FROM producers p JOIN track_producers tp USING (producer_id)
WHERE p.enriched_at IS NULL AND tp.track_id IN (SELECT track_id FROM given_tracks UNION SELECT track_id FROM others)""")
def _(s, d):
    return catalog.related_producers(
        tb.track_producers(s, d), tb.tracks(s, d), tb.albums(s, d), tb.producers(s, d), *_given(s, d)
    )


@query("track_producers_lookup", CHAIN, """SELECT track_id, producer_id, round(confidence, 6) AS confidence, source, created_at, name
FROM track_producers JOIN producers USING (producer_id)""")
def _(s, d):
    return catalog.track_producers_lookup(tb.track_producers(s, d), tb.producers(s, d))


# Messages about tracks: every event asks about one track id, some of them unknown.
ASK_SQL = """ask AS (SELECT event_id AS msg_id, (event_id % 20000) * 10 + user_id % 9 AS track_id,
  CASE WHEN event_id % 2 = 0 THEN concat('song ', CAST(event_id % 7 AS VARCHAR)) END AS track_name,
  CASE WHEN event_id % 4 = 0 THEN 'somebody' WHEN event_id % 4 = 1 THEN '' END AS artist_name FROM events)"""


def _asks(s, d):
    e, u = F.col("event_id"), F.col("user_id")
    return tb.table(s, d, "events").select(
        e.alias("msg_id"),
        ((e % 20000) * 10 + u % 9).alias("track_id"),
        F.when(e % 2 == 0, F.concat(F.lit("song "), (e % 7).cast("string"))).alias("track_name"),
        F.when(e % 4 == 0, "somebody").when(e % 4 == 1, "").alias("artist_name"),
    )


@query("track_must_exist", "tracks", f"""WITH {ASK_SQL} SELECT msg_id, track_id,
  CASE WHEN track_id IN (SELECT track_id FROM tracks) THEN NULL
  ELSE concat('Track not found with ID: ', CAST(track_id AS VARCHAR)) END AS error FROM ask""")
def _(s, d):
    known, unknown = catalog.track_must_exist(_asks(s, d).select("msg_id", "track_id"), tb.tracks(s, d))
    return known.unionByName(unknown, allowMissingColumns=True)


@query("fill_missing_names", "artists albums tracks", f"""WITH {ASK_SQL},
j AS (SELECT msg_id, ask.track_id, nullif(ask.track_name, '') AS tn, nullif(ask.artist_name, '') AS an,
  t.track_id AS known, t.name AS tname, a.name AS aname
  FROM ask LEFT JOIN tracks t ON ask.track_id = t.track_id LEFT JOIN albums al ON t.album_id = al.album_id
  LEFT JOIN artists a ON al.artist_id = a.artist_id)
SELECT msg_id, track_id, coalesce(tn, tname) AS track_name, coalesce(an, aname) AS artist_name,
  CASE WHEN (tn IS NULL OR an IS NULL) AND known IS NULL THEN 'PERMANENT_NOT_FOUND'
    WHEN coalesce(tn, tname) IS NULL OR coalesce(an, aname) IS NULL THEN 'PERMANENT_INVALID_INPUT' END AS error FROM j""")
def _(s, d):
    return catalog.fill_missing_names(_asks(s, d), tb.tracks(s, d, names=True), tb.albums(s, d), tb.artists(s, d))


COUNT_SQL = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in CHAIN.split())


def _counts(s, d):
    a, al, t, tp, p = _down(s, d)
    return catalog.table_counts(artists=a, albums=al, tracks=t, track_producers=tp, producers=p)


@query("catalog_counts", CHAIN, COUNT_SQL)
def _(s, d):
    return _counts(s, d)


@query("catalog_gap_check", CHAIN, """
SELECT 'artists' AS parent, 'albums' AS child,
  CASE WHEN (SELECT count(*) FROM artists) > 0 AND (SELECT count(*) FROM albums) = 0 THEN 'warning' ELSE 'healthy' END AS status,
  CASE WHEN (SELECT count(*) FROM artists) > 0 AND (SELECT count(*) FROM albums) = 0
    THEN 'Artists exist but no albums found - potential issue with album discovery' END AS issue
UNION ALL SELECT 'albums', 'tracks',
  CASE WHEN (SELECT count(*) FROM albums) > 0 AND (SELECT count(*) FROM tracks) = 0 THEN 'warning' ELSE 'healthy' END,
  CASE WHEN (SELECT count(*) FROM albums) > 0 AND (SELECT count(*) FROM tracks) = 0
    THEN 'Albums exist but no tracks found - potential issue with track discovery' END
UNION ALL SELECT 'tracks', 'producers',
  CASE WHEN (SELECT count(*) FROM tracks) > 0 AND (SELECT count(*) FROM producers) = 0 THEN 'warning' ELSE 'healthy' END,
  CASE WHEN (SELECT count(*) FROM tracks) > 0 AND (SELECT count(*) FROM producers) = 0
    THEN 'Tracks exist but no producers found - potential issue with producer identification' END""")
def _(s, d):
    return catalog.gap_check(_counts(s, d))


@query("top_n_popular", "artists", """SELECT artist_id, name, popularity FROM artists ORDER BY popularity DESC, artist_id LIMIT 20""")
def _(s, d):
    return catalog.top_n_popular(tb.artists(s, d).select("artist_id", "name", "popularity"), 20)


@query("search_by_name", "artists", "SELECT artist_id, name FROM artists WHERE name ILIKE '%MER#00000001%'")
def _(s, d):
    return catalog.search_by_name(tb.artists(s, d).select("artist_id", "name"), "mEr#00000001")
