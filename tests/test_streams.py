"""Streams against plain walks: repeats, first results, retries, and the linked stages."""

import json
import random
import uuid
from datetime import datetime, timedelta

import pytest

from cratedig.operators import dlq
from cratedig.operators.catalog import producer_popularity
from cratedig.plans import stages
from cratedig.sources import dated, queue_files
from cratedig.streaming import flows, linked, stateful
from pyspark.sql import functions as F

START = datetime(2024, 1, 1)
DAY = timedelta(days=1)


def in_lots(spark, tmp_path, rows, schema, make, lots=4):
    """The result of a stream that gets the rows in lots, and is started anew for each."""
    size = -(-len(rows) // lots)
    for i in range(lots):
        spark.createDataFrame(rows[i * size : (i + 1) * size], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        made = make(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
        out = flows.run_to_table(made, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    return out.collect()


def log(n, keys, hours, seed):
    rng, at = random.Random(seed), START
    for i in range(n):
        at += timedelta(seconds=rng.randrange(1, hours * 7200))
        yield i, rng.choice(keys), at


def test_repeats_within_the_ttl(spark, tmp_path):
    rows = [(i, k, at) for i, k, at in log(150, "abcdef", 3, 1)]
    want, until = [], {}
    for i, k, at in rows:
        if at >= until.get(k, START):
            want.append(i)
            until[k] = at + DAY
    got = in_lots(spark, tmp_path, rows, "msg_id bigint, dedup_key string, enqueued_at timestamp_ntz", lambda e: stateful.stream_dedup_ttl(e, "dedup_key", 86400))
    assert sorted(r.msg_id for r in got) == want and 0 < len(want) < len(rows)
    assert all(r.enqueued_at == rows[r.msg_id][2] for r in got)


def test_first_results_resume_and_expire(spark, tmp_path):
    stored = [("a", "old", START - timedelta(hours=20)), ("b", "older", START - timedelta(hours=50)), ("b", "oldest", START - timedelta(hours=60)), ("z", "unused", START)]
    results = {"a": (stored[0][2] + DAY, "old"), "b": (stored[1][2] + DAY, "older")}
    rows, want = [], []
    for i, k, at in log(120, "abcd", 2, 2):
        rows.append((k, i, at, f"r{i}"))
        known = k in results and at < results[k][0]
        if not known:
            results[k] = (at + DAY, f"r{i}")
        want.append((i, results[k][1], known))
    given = spark.createDataFrame(stored, "operation_id string, result string, stored_at timestamp_ntz")
    got = in_lots(
        spark, tmp_path, rows, "operation_id string, event_id bigint, ts timestamp_ntz, result string", lambda e: stateful.stream_idempotent_result(e, 86400, given)
    )
    assert sorted((r.event_id, r.result, r.replayed) for r in got) == want
    assert {"old"} < {r for _, r, known in want if known}


def test_retries_come_back_when_due(spark, tmp_path):
    """Attempts up to the last watermark; a message that is on hold and given again isn't tried twice."""
    delays = [3600, 7200, 14400]
    rows = [(i, "q", at, 0, f"m{i}", [True] * (i % 5) + [False]) for i, _, at in log(60, "x", 1, 3)]
    rows += [(1000, "q", rows[-1][2] + timedelta(seconds=1), 0, "null outcome", [None, False])]
    end, want = rows[-1][2], []
    for i, _, at, read_ct, _, fails in rows:
        while True:
            failed = fails[read_ct] is not False
            want.append((i, at, read_ct, "done" if not failed else "retry" if read_ct < 3 else "dead"))
            if not failed or read_ct == 3:
                break
            at, read_ct = at + timedelta(seconds=delays[read_ct]), read_ct + 1
            if at > end:
                break
    schema = "msg_id bigint, queue_name string, enqueued_at timestamp_ntz, read_ct int, message string, fails array<boolean>"
    got = in_lots(spark, tmp_path, rows, schema, lambda e: stateful.stream_retries(e, F.col("fails"), delays))
    assert sorted((r.msg_id, r.attempt_at, r.read_ct, r.outcome) for r in got) == sorted(want)
    assert {w[3] for w in want} == {"done", "retry", "dead"} and all(r.message for r in got)


# --- linked stages ------------------------------------------------------------------------------------

def responses(spark):
    """Three artists with two albums of two tracks; each track has a producer of its album and one of all."""
    searches, albums, tracks, songs, details = [], [], [], [], []
    for a in range(3):
        searches.append((f"Artist {a}", json.dumps({"artists": {"items": [{"id": f"ar{a}", "name": f"Artist {a}", "popularity": 5}]}})))
        for b in range(2):
            album = {"id": f"al{a}{b}", "name": "Al", "release_date": "2020-01-01", "album_type": "album", "total_tracks": 2}
            albums.append((f"ar{a}", json.dumps({"items": [album]})))
            items = [{"id": f"tr{a}{b}{t}", "name": f"Song {t}", "duration_ms": 1, "track_number": t, "explicit": False} for t in range(2)]
            tracks.append((f"al{a}{b}", json.dumps({"items": items})))
            for t in range(2):
                song = a * 100 + b * 10 + t
                songs.append((f"tr{a}{b}{t}", json.dumps({"hits": [{"result": {"id": song}}]})))
                who = [{"id": 1, "name": "Everywhere"}, {"id": 10 + a * 2 + b, "name": f"Maker {a}{b}"}]
                details.append((json.dumps({"id": song, "title": "t", "producer_artists": who}),))
    make = spark.createDataFrame
    return {
        "artist_search": make(searches, "artist_name string, payload string"),
        "album_pages": make(albums, "spotify_id string, payload string"),
        "track_pages": make(tracks, "spotify_id string, payload string"),
        "song_search": make(songs, "track_spotify_id string, payload string"),
        "song_details": make(details, "payload string"),
    }


def seeds(spark, names):
    return stages.seed_artist_discovery(spark.createDataFrame([(n,) for n in names], "artist_name string"))


def summary(got):
    popular = producer_popularity(got["producers"], got["track_producers"], got["tracks"], got["albums"], got["artists"])
    links = {r.name: r.social_links is not None for r in got["producers"].collect()}
    return sorted((r["name"], r["track_count"], r["artist_count"], links[r["name"]]) for r in popular.collect())


BAD = [("artist_discovery", "k1", '{"artistName":""}'), ("artist_discovery", "k2", "[]")]
WANT = sorted([("Everywhere", 12, 3, True), *((f"Maker {a}{b}", 2, 1, True) for a in range(3) for b in range(2))])


def test_linked_stages_equal_the_batch_chain_after_stops_and_failures(spark, tmp_path, monkeypatch):
    bad = spark.createDataFrame(BAD, "queue_name string, dedup_key string, message string")
    batch = stages.stage_chain(spark, seeds(spark, ["Artist 0", "Artist 1", "Artist 2"]), responses(spark), "2024-01-01", str(tmp_path / "batch"), {"artist_discovery": bad}, with_dead=True)
    assert summary(batch) == WANT
    chain = linked.Chain(spark, str(tmp_path / "linked"), responses(spark), "2024-01-01")
    assert linked.drain(chain) == 0  # no queue yet
    linked.send(spark, chain.root, seeds(spark, ["Artist 0"]).unionByName(bad), "2024-01-01")
    linked.drain(chain, ["artist_discovery", "album_discovery"])  # stops between two stages
    assert chain.table("albums").count() == 2 and chain.table("tracks").count() == 0
    linked.send(spark, chain.root, seeds(spark, ["Artist 1", "Artist 2", "Artist 0"]), "2024-01-01", batch=1)
    find, store = linked.STAGES["album_discovery"]

    def fails(c, found):
        linked.send(c.spark, c.root, store(c, found), c.as_of, "album_discovery", 99)  # sent already, under another name even
        raise ValueError("lost")

    monkeypatch.setitem(linked.STAGES, "album_discovery", (find, fails))
    with pytest.raises(Exception, match="lost"):
        linked.drain(chain)
    monkeypatch.setitem(linked.STAGES, "album_discovery", (find, store))
    linked.drain(chain)
    got = linked.catalog(chain)
    assert summary(got) == WANT
    dead = lambda x: sorted((r.dedup_key, r.failure_reason) for r in x["dead"].collect())
    assert dead(got) == dead(batch) and len(dead(got)) == 2
    # repeats of what passed change nothing, and are counted by the pass that writes
    linked.send(spark, chain.root, seeds(spark, ["Artist 2"]), "2024-01-01", batch=2)
    assert linked.drain(chain) == 1 and summary(linked.catalog(chain)) == WANT
    counts = flows.read_batches(spark, f"{chain.root}/metrics/artist_discovery").groupBy().sum("processed", "errors", "duplicates").first()
    assert tuple(counts) == (3, 2, 2)


def test_a_request_for_an_unknown_track_is_refused_whole_and_others_pass_bare(spark, tmp_path):
    chain = linked.Chain(spark, str(tmp_path / "linked"), responses(spark), "2024-01-01")
    linked.send(spark, chain.root, seeds(spark, ["Artist 0"]), "2024-01-01")
    linked.drain(chain)
    body = '{"trackId":"none","note":"kept"}'
    linked.send(spark, chain.root, spark.createDataFrame([("producer_identification", "k", body)], "queue_name string, dedup_key string, message string"), "2024-01-01", batch=1)
    linked.drain(chain, ["producer_identification"])
    dead = flows.read_batches(spark, f"{chain.root}/dead/producer_identification").collect()
    assert [(r.dedup_key, r.message, r.failure_reason) for r in dead] == [("k", body, "Track not found with ID: none")]
    counts = flows.read_batches(spark, f"{chain.root}/metrics/producer_identification").groupBy().sum("processed", "errors", "duplicates").first()
    passed = flows.read_batches(spark, f"{chain.root}/passed/producer_identification")
    assert tuple(counts) == (chain.table("tracks").count(), 1, 0)
    assert passed.filter("json_object_keys(message) <> array('trackId')").count() == 0 and passed.count() == counts[0]


# --- queues, retention, dead letters -----------------------------------------------------------------------------

def messages(spark, first, n):
    rows = [(i, "view", START + timedelta(minutes=i), None, 0, f'{{"k":{i}}}') for i in range(first, first + n)]
    return spark.createDataFrame(rows, "msg_id bigint, queue_name string, enqueued_at timestamp, vt timestamp, read_ct int, message string")


def test_micro_batches_hold_at_most_so_many_messages_and_files_are_archived(spark, tmp_path):
    queue_files.sink_enqueue(messages(spark, 0, 95), str(tmp_path / "q"), file_messages=10)
    got, sizes = [], []

    def each(batch, _):
        rows = [r.msg_id for r in batch.collect()]
        sizes.append(len(rows))
        got.extend(rows)

    def run():
        stream = queue_files.source_queue(spark, str(tmp_path / "q"), "view", 30, streaming=True, archive=str(tmp_path / "done"), file_messages=10)
        stream.writeStream.foreachBatch(each).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()

    run()
    assert sorted(got) == list(range(95)) and max(sizes) <= 30 and len(sizes) >= 4
    queue_files.sink_enqueue(messages(spark, 95, 5), str(tmp_path / "q"), file_messages=10)
    run()
    run()
    assert sorted(got) == list(range(100))  # nothing twice, though files are gone
    assert list((tmp_path / "done").rglob("*.json"))
    assert [r.msg_id for r in queue_files.source_queue(spark, str(tmp_path / "q"), "view", 3).collect()] == sorted(r.msg_id for r in queue_files.source_queue(spark, str(tmp_path / "q"), "view").collect())[:3]
    with pytest.raises(ValueError, match="a file may hold"):
        queue_files.source_queue(spark, str(tmp_path / "q"), "view", 3, streaming=True)


def test_expired_days_go_without_touching_other_files(spark):
    rows = spark.createDataFrame([(i, START + i * timedelta(hours=8)) for i in range(60)], "id bigint, ts timestamp_ntz")
    store = dated.DatedTable(spark, f"dated_{uuid.uuid4().hex}", "ts")
    store.append(rows)
    before = {r[0] for r in store.read().select(F.input_file_name()).distinct().collect()}
    gone = store.expire("2024-01-15 12:00:00", 7)
    edge = datetime(2024, 1, 8)
    assert {r.day: r.dropped for r in gone.collect()} == {(START + i * DAY).date(): 3 for i in range(7)}
    kept = store.read()
    assert sorted(r.id for r in kept.collect()) == [i for i in range(60) if START + i * timedelta(hours=8) >= edge]
    after = {r[0] for r in kept.select(F.input_file_name()).distinct().collect()}
    assert after < before and store.expire("2024-01-15 12:00:00", 7).count() == 0
    spark.sql(f"DROP TABLE {store.name}")


def test_an_override_takes_effect_in_the_next_batch(spark, tmp_path):
    schema = "msg_id bigint, queue_name string, enqueued_at timestamp_ntz, vt timestamp_ntz, read_ct int, message string"
    dead = spark.createDataFrame([(i, "view", START, None, 4, "{bad") for i in range(4)], schema)
    dead = dlq.dlq_add_metadata(dead, F.lit("broken"), "2024-01-02")
    given = spark.createDataFrame([("view_dlq", 0, '{"new":0}')], "queue_name string, msg_id bigint, new_body string")
    given.write.parquet(str(tmp_path / "overrides"))

    def run(ids):
        dead.filter(F.col("msg_id").isin(ids)).coalesce(1).write.mode("append").parquet(str(tmp_path / "dead"))
        stream = spark.readStream.schema(dead.schema).parquet(str(tmp_path / "dead"))
        flows.stream_dlq_reprocess(stream, lambda: spark.read.schema(given.schema).parquet(str(tmp_path / "overrides")), str(tmp_path / "out"), str(tmp_path / "cp"), "2024-01-03").awaitTermination()

    run([0, 1])
    spark.createDataFrame([("view_dlq", 2, '{"new":2}')], given.schema).write.mode("append").parquet(str(tmp_path / "overrides"))
    run([2, 3])
    got = {r.msg_id: (r.message, r.queue_name, r.read_ct) for r in flows.read_batches(spark, str(tmp_path / "out")).collect()}
    assert got == {0: ('{"new":0}', "view", 0), 1: ("{bad", "view", 0), 2: ('{"new":2}', "view", 0), 3: ("{bad", "view", 0)}
