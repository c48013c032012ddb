"""What jobs shuffle and hold: counts of steps in their plans, so that figures follow the input."""

import re

import pytest
from pyspark.sql import functions as F

from cratedig import schemas
from cratedig.operators import catalog, upsert
from cratedig.plans import catalogue
from cratedig.session import SMALL_TASKS, ensure_small_tasks
from cratedig.sources import testbed as tb

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are for tables too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.unset(key)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


def wanted(spark):
    tracks = tb.tracks(spark, SF)
    return tracks, tb.albums(spark, SF), tb.artists(spark, SF).filter("genre = 'BUILDING'").select("artist_id"), tracks.filter("popularity >= 49").select("track_id")


def test_given_or_related_tracks_take_no_anti_join(no_broadcast):
    df = catalog.tracks_given_or_related(*wanted(no_broadcast))
    assert "LeftAnti" not in plan(df) and shuffles(df) <= 9
    rows = [r.track_id for r in df.collect()]
    assert len(rows) == len(set(rows))


def test_small_tasks_keep_what_the_session_sets(spark):
    other = spark.newSession()
    for key in SMALL_TASKS:
        other.conf.unset(key)
    ensure_small_tasks(other)
    assert {k: other.conf.get(k) for k in SMALL_TASKS} == SMALL_TASKS
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    other.conf.set(key, "3m")
    assert ensure_small_tasks(other).conf.get(key) == "3m"


def test_files_are_dealt_out_in_small_pieces(spark):
    """A task that deals out rows holds its piece of the file, so pieces may not grow with the files."""
    key = "spark.sql.files.minPartitionNum"
    spark.conf.set(key, "1")
    try:
        file = "/root/testdata/sf0.1/lineitem.parquet"
        assert ensure_small_tasks(spark).read.parquet(*[file] * 4).rdd.getNumPartitions() == 4
    finally:
        spark.conf.unset(key)


def test_chain_left_shuffles_credits_and_tracks_once_by_track(no_broadcast):
    s = no_broadcast
    assert shuffles(tb.tracks(s, SF).join(tb.track_producers(s, SF), "track_id")) == 2
    df = catalog.catalog_chain_left(tb.artists(s, SF), tb.albums(s, SF), tb.tracks(s, SF), tb.track_producers(s, SF), tb.producers(s, SF))
    assert "hashpartitioning(track_id" in plan(df)


def test_related_producers_join_credits_where_they_lie(no_broadcast):
    s = no_broadcast
    tracks, albums, artists, given = wanted(s)
    df = catalog.related_producers(tb.track_producers(s, SF), tracks, albums, tb.producers(s, SF), artists, given)
    assert "LeftAnti" not in plan(df) and shuffles(df) <= 12


def test_track_batches_derive_their_tables_once(spark):
    """Batches, stored tracks and stored songs come from one written table, not from the base tables again for each use."""
    df = catalogue.QUERIES["process_track_batch"](spark, SF)
    assert not [f for f in df.inputFiles() if "lineitem" in f or "orders" in f or "part.parquet" in f]


def test_track_batch_looks_stored_tracks_up_without_sorting_ids(no_broadcast, tmp_path):
    s = no_broadcast
    batches = s.createDataFrame([(1, '[{"spotify_id":"s1","name":"A"}]', "al", "ar")], "batch_id int, tracks_json string, album_id string, artist_id string")
    out = upsert.process_track_batch(
        batches, s.createDataFrame([], schemas.TRACKS), s.createDataFrame([], schemas.NORMALIZED_TRACKS), "2024-01-01", str(tmp_path)
    )
    for part in ("tracks", "results"):
        assert "ShuffledHashJoin" in plan(out[part]) and "SortMergeJoin" not in plan(out[part])


def test_track_batch_deals_its_rows_out_once_for_all_results(no_broadcast, tmp_path):
    s = no_broadcast
    body = '[{"spotify_id":"s1","name":"A","popularity":1},{"spotify_id":"s2","name":"B"},{"spotify_id":"s1","name":"A2"}]'
    batches = s.createDataFrame([(1, body, "al", "ar"), (2, '[{"spotify_id":"s1","name":"A3"}]', "al2", "ar")], "batch_id int, tracks_json string, album_id string, artist_id string")
    stored = s.createDataFrame([("old", "s2", "al0", 5), ("rest", "s3", "al0", 7)], "track_id string, spotify_id string, album_id string, popularity int")
    tracks = stored.select(*[c if c in stored.columns else F.lit(None).cast(t).alias(c) for c, t in s.createDataFrame([], schemas.TRACKS).dtypes])
    songs = s.createDataFrame([], schemas.NORMALIZED_TRACKS).limit(0)
    out, again = (upsert.process_track_batch(batches, tracks, songs, "2024-01-01", str(tmp_path / str(at_once)), at_once=at_once) for at_once in (True, False))
    assert shuffles(out["tracks"]) == shuffles(out["results"]) == 0 and shuffles(out["normalized_tracks"]) == 1
    for part in out:
        assert sorted(map(str, out[part].collect())) == sorted(map(str, again[part].collect()))
    got = {r.spotify_id: (r.name, r.album_id, r.popularity, r.created_at is None) for r in out["tracks"].collect()}
    assert got == {"s1": ("A3", "al", None, False), "s2": ("B", "al0", None, True), "s3": (None, "al0", 7, True)}
    assert out["results"].filter("spotify_id = 's2'").first().track_id == "old" and out["results"].count() == 4


def test_orphans_shuffle_ids_as_numbers(no_broadcast):
    s = no_broadcast
    df = catalog.fk_orphans(tb.albums(s, SF), tb.tracks(s, SF), tb.track_producers(s, SF), tb.artists(s, SF), tb.producers(s, SF))
    lines = plan(df).splitlines()
    under_exchange = [lines[i + 1] for i, line in enumerate(lines[:-1]) if "Exchange hashpartitioning" in line]
    assert under_exchange and not any("as string" in line for line in under_exchange)
