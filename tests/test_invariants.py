"""Properties: repeats change nothing, splits lose nothing, order of input does not matter, and
order-dependent operators agree with a plain walk over small logs with one hot key."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cratedig.functions.times import slice_of
from cratedig.operators import audits, dedup, dlq, ordered, queues, upsert
from cratedig.plans import stages
from cratedig.sources import queue_files, tables, testbed as tb
from cratedig.streaming import flows, stateful

SF = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)


def log(n=600, seed=3, keys=4):
    """(key, id, ts, ok): two thirds of the rows belong to one key; times cluster and tie."""
    rnd = random.Random(seed)
    at, rows = START, []
    for i in range(n):
        at += timedelta(seconds=rnd.choice([0, 1, 5, 60, 900, 4000]))
        key = "hot" if rnd.random() < 0.66 else f"k{rnd.randrange(keys)}"
        rows.append((key, i, at, rnd.random() < 0.6))
    return rows


@pytest.fixture(scope="module")
def events(spark):
    rows = log()
    random.Random(9).shuffle(rows)
    return spark.createDataFrame(rows, "k string, event_id bigint, ts timestamp_ntz, success boolean")


def by_key():
    out = {}
    for row in log():
        out.setdefault(row[0], []).append(row)
    return out


@pytest.mark.parametrize("width", [60, 3600, 10**7])
def test_running_sum(spark, events, width):
    got = ordered.running_sum(events, ["k"], ["ts", "event_id"], F.col("success").cast("int"), slice_of(F.col("ts"), width), "n")
    want = {}
    for rows in by_key().values():
        total = 0
        for _, i, _, ok in rows:
            total += ok
            want[i] = total
    assert {r.event_id: r.n for r in got.collect()} == want


def test_previous(spark, events):
    got = ordered.previous(events, ["k"], ["ts", "event_id"], "event_id", slice_of(F.col("ts"), 1000), "p")
    want = {}
    for rows in by_key().values():
        last = None
        for row in rows:
            want[row[1]] = last
            last = row[1]
    assert {r.event_id: r.p for r in got.collect()} == want


@pytest.mark.parametrize("span, width", [(60, 60), (1000, 3600)])
def test_trailing_count(spark, events, span, width):
    got = ordered.trailing_count(events, ["k"], F.unix_micros(F.col("ts").cast("timestamp")), span, width, "n")
    want = {}
    for rows in by_key().values():
        for _, i, at, _ in rows:
            want[i] = sum(at - timedelta(seconds=span) <= x[2] <= at for x in rows)
    assert {r.event_id: r.n for r in got.collect()} == want
    with pytest.raises(ValueError):
        ordered.trailing_count(events, ["k"], F.lit(0), 10, 5, "n")


def test_percentile(spark, events):
    rows = events.withColumn("v", (F.col("event_id") % 37) / 7.0)
    want = {r.k: r.p for r in rows.groupBy("k").agg(F.percentile("v", 0.95).alias("p")).collect()}
    for width in (0.01, 1.0, 1000.0):
        got = ordered.exact_percentile(rows, ["k"], "v", 0.95, "p", width)
        assert {r.k: round(r.p, 9) for r in got.collect()} == {k: round(v, 9) for k, v in want.items()}


def test_failure_streaks(spark, events):
    got = sorted((r.k, r.failures, r.is_outage) for r in audits.failure_streaks(events, "k").collect())
    want = []
    for key, rows in by_key().items():
        run = 0
        for _, _, _, ok in [*rows, (key, 0, 0, True)]:
            if ok and run:
                want.append((key, run, run >= 5))
            run = 0 if ok else run + 1
    assert got == sorted(want)


@pytest.mark.parametrize("ttl", [1, 3600, 10**8])
def test_dedup_ttl(spark, events, ttl):
    got = dedup.dedup_ttl(events, ttl, key="k", ts="ts", tie="event_id")
    want = []
    for rows in by_key().values():
        until = None
        for _, i, at, _ in rows:
            if until is None or at >= until:
                want.append(i)
                until = at + timedelta(seconds=ttl)
    assert sorted(r.event_id for r in got.collect()) == sorted(want)


def test_dedup_ttl_with_stored_keys(spark, events):
    edge = START + timedelta(hours=30)
    seen = spark.createDataFrame([("hot", edge)], "k string, expires_at timestamp_ntz")
    rows = events.unionByName(
        spark.createDataFrame([(None, 9001, START, True), (None, 9002, START, True)], events.schema)
    )
    got = dedup.dedup_ttl(rows, 10**8, seen, "k", "ts", "event_id").collect()
    assert sorted(r.event_id for r in got if r.k is None) == [9001, 9002]
    hot = [r.ts for r in got if r.k == "hot"]
    assert hot == [min(x[2] for x in by_key()["hot"] if x[2] >= edge)]


def test_batches_are_exact(spark):
    ids = spark.range(0, 1_000_000, 7919).select("id")
    rows = queues.batch_ids(ids, "id", 20).orderBy("batch").collect()
    assert [x for r in rows for x in r.ids] == list(range(0, 1_000_000, 7919))
    assert all(r.n == 20 for r in rows[:-1])
    texts = queues.batch_ids(ids.select(F.concat(F.lit("x"), "id").alias("t")), "t", 50).collect()
    assert sum(r.n for r in texts) == ids.count() and max(r.n for r in texts) == 50


def test_queue_name_patterns(spark):
    workers = ["ArtistDiscoveryWorker", "artist_discovery_2", "artistXdiscovery", "abc", "a" * 40, ""]
    names = ["artist_discovery", "ARTIST", "_", "__", "b%c", "zzz", "a" * 30, "no", ""]
    now = "2024-01-02 00:00:00"
    issues = spark.createDataFrame(
        [(w, False, datetime(2024, 1, 1, 23, 30)) for w in workers for _ in range(3)], "worker_name string, resolved boolean, created_at timestamp_ntz"
    )
    registry = spark.createDataFrame([(n,) for n in names], "queue_name string")
    got = {r.queue_name: r.recent_issues_count for r in queues.issues_like_queue(registry, issues, now).collect()}

    def like(pattern, value):
        import re

        body = "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern)
        return re.fullmatch(f".*{body}.*", value, re.I | re.S) is not None

    assert got == {n: 3 * sum(like(n, w) for w in workers) for n in names}


# --- upserts -------------------------------------------------------------------

def _tracks(spark):
    rows = tb.tracks(spark, SF, names=True)
    sid = F.col("track_id").cast("string")
    return rows.select(sid.alias("track_id"), sid.alias("spotify_id"), F.col("album_id").cast("string").alias("album_id"), "name", "popularity")


def test_upsert_twice_is_once(spark):
    from cratedig import schemas

    batch = _tracks(spark)
    once = upsert.upsert_tracks(spark.createDataFrame([], schemas.TRACKS), batch, "2024-01-01")
    twice = upsert.upsert_tracks(once, batch, "2024-01-01")
    once, twice = (df.withColumn("metadata", F.to_json("metadata")) for df in (once, twice))
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_last_of_batch_wins_whatever_the_order(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, at int, v string")
        assert sorted(tuple(r) for r in upsert.last_of_key(df, ["k"], "at").collect()) == [("a", 2, "y"), ("b", 1, "z")]


def test_producer_modes(spark):
    from cratedig import schemas

    stored = spark.createDataFrame(
        [("1", "a", "A", None, None, "h", None, {"x": "1"}, None, None, None, None)], schemas.PRODUCERS
    )
    batch = spark.createDataFrame([("a", "New", None, {"y": "2"}), ("b", "B", "hb", None)], "normalized_name string, name string, instagram_handle string, metadata map<string,string>")
    merged = {r.normalized_name: r for r in upsert.upsert_producers(stored, batch, "2024-01-01").collect()}
    assert merged["a"].name == "New" and merged["a"].instagram_handle == "h"
    assert merged["a"].metadata == {"x": "1", "y": "2"} and merged["a"].enriched_at is None
    # a new producer is only inserted, not marked as enriched
    assert merged["b"].enriched_at is None and merged["b"].producer_id is not None
    kept = {r.normalized_name: r.name for r in upsert.upsert_producers(stored, batch, "2024-01-01", "insert").collect()}
    assert kept == {"a": "A", "b": "B"}
    over = {r.normalized_name: r.instagram_handle for r in upsert.upsert_producers(stored, batch, "2024-01-01", "overwrite").collect()}
    assert over == {"a": None, "b": "hb"}


def test_bucketed_table(spark, tmp_path):
    schema = "k bigint, v string"
    path = str(tmp_path / "t")

    def merge(old, new):
        return upsert.upsert_overwrite(old, new, ["k"], "2024-01-01")

    first = spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    assert tables.read_table(spark, path, schema).count() == 0
    tables.upsert_into(spark, path, schema, first, ["k"], merge, 8)
    second = spark.createDataFrame([(5, "b"), (200, "b")], schema)
    for _ in range(2):
        tables.upsert_into(spark, path, schema, second, ["k"], merge, 8)
    got = {r.k: r.v for r in tables.read_table(spark, path, schema).collect()}
    assert len(got) == 101 and got[5] == got[200] == "b" and got[6] == "a"
    tables.upsert_into(spark, path, schema, second.limit(0), ["k"], merge, 8)
    assert tables.read_table(spark, path, schema).count() == 101


def test_process_track_batch(spark, tmp_path):
    from cratedig import schemas

    body = '[{"spotify_id":"s1","name":"Song"},{"spotify_id":"s2","name":"SONG!"},{"spotify_id":"s1","name":"Song 2"}]'
    rows = spark.createDataFrame([(1, body, "al", "ar")], "batch_id int, tracks_json string, album_id string, artist_id string")
    out = upsert.process_track_batch(
        rows, spark.createDataFrame([], schemas.TRACKS), spark.createDataFrame([], schemas.NORMALIZED_TRACKS), "2024-01-01", str(tmp_path)
    )
    assert {r.spotify_id: r.name for r in out["tracks"].collect()} == {"s1": "Song 2", "s2": "SONG!"}
    songs = {r.normalized_name: r.representative_track_id for r in out["normalized_tracks"].collect()}
    ids = {r.spotify_id: r.track_id for r in out["tracks"].collect()}
    assert songs == {"song": ids["s1"], "song2": ids["s1"]}
    assert [r.position for r in out["results"].orderBy("position").collect()] == [0, 1, 2]


def test_only_a_missing_path_reads_as_empty(spark, tmp_path):
    from pyspark.errors import AnalysisException

    from cratedig.sources.tables import read_or_empty

    assert read_or_empty(spark, str(tmp_path / "none"), "a int", "b int").columns == ["a", "b"]
    with pytest.raises(AnalysisException):
        read_or_empty(spark, str(tmp_path / "none"), "a no_such_type", "b int").count()


# --- splits and queues ------------------------------------------------------------

def test_split_keeps_every_message(spark):
    m = tb.messages(spark, SF)
    good, dead = dlq.dlq_split(m, "2024-01-31", F.col("value") > 20, None, 3)
    assert good.count() + dead.count() == m.count()
    back = dlq.dlq_reprocess(dead, "2024-01-31")
    assert back.filter(F.col("queue_name").endswith("_dlq")).count() == 0
    assert back.filter("vt is not null or read_ct <> 0").count() == 0
    kept, dropped = dlq.dlq_purge(dead, "2024-01-31", 10, 50)
    assert dropped.count() == 50 and kept.count() == dead.count() - 50


def test_requeue_keeps_every_message(spark):
    m = tb.messages(spark, SF)
    fresh, report = queues.requeue_stuck(m, "2024-01-31", 10)
    assert fresh.count() == m.count() and fresh.select("queue_name", "msg_id").distinct().count() == m.count()
    assert report.count() == m.filter("vt is not null").count()
    assert queues.reset_stuck_messages(m, "2024-01-31", 0).filter("vt is not null").count() == 0


def test_problem_split(spark):
    m = spark.createDataFrame([(1, "q", "{}"), (2, "q", "x"), (3, "q", None)], "msg_id bigint, queue_name string, message string")
    good, bad = queue_files.record_problem_message(m, F.lit(None).cast("timestamp"))
    assert [r.msg_id for r in good.collect()] == [1]
    assert sorted(r.message_id for r in bad.collect()) == ["2", "3"]


# --- streams ----------------------------------------------------------------------

def _files(spark, path, df, parts, key="event_id"):
    """The rows cut into ``parts`` files in the order of their ids."""
    n = df.count()
    for i in range(parts):
        piece = df.filter((F.col(key) >= i * n // parts) & (F.col(key) < (i + 1) * n // parts))
        piece.coalesce(1).write.mode("append").parquet(path)


def test_first_result_replayed_across_batches(spark, tmp_path):
    df = spark.createDataFrame(
        [(f"op{i % 3}", i, START + timedelta(minutes=i), f"r{i}") for i in range(12)],
        "operation_id string, event_id bigint, ts timestamp_ntz, result string",
    )
    _files(spark, str(tmp_path / "in"), df, 4)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = flows.run_to_table(stateful.stream_idempotent_result(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = sorted((r.event_id, r.result, r.replayed) for r in out.collect())
    assert got == [(i, f"r{i % 3}", i >= 3) for i in range(12)]
    assert sorted((r.event_id, r.result, r.replayed) for r in stateful.idempotent_result(df).collect()) == got


def test_stage_over_several_batches(spark, tmp_path):
    from cratedig.functions.bodies import first_of

    rows = [(i, "album_discovery", START + timedelta(hours=i), 0, '{"artistId":"%d"}' % (i % 4) if i % 5 else "{bad") for i in range(60)]
    df = spark.createDataFrame(rows, "msg_id bigint, queue_name string, enqueued_at timestamp, read_ct int, message string")
    _files(spark, str(tmp_path / "in"), df, 4, "msg_id")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stage = stages.required_field_stage("album_discovery", lambda b: first_of(b, "artistId"), lambda good: good.select("msg_id", "dedup_key"))
    flows.stream_stage(stage, stream, str(tmp_path / "out"), str(tmp_path / "cp"), "2024-02-01").awaitTermination()
    until, want = {}, []
    for i, _, at, _, body in rows:
        key = None if "bad" in body else str(i % 4)
        if key is None:
            continue
        if key not in until or at >= until[key]:
            want.append(i)
            until[key] = at + timedelta(days=1)
    got = flows.read_batches(spark, str(tmp_path / "out" / "next")).collect()
    assert sorted(r.msg_id for r in got) == want
    m = flows.read_batches(spark, str(tmp_path / "out" / "metrics"))
    row = m.agg(F.count("*"), F.sum("processed"), F.sum("errors"), F.sum("duplicates")).first()
    assert tuple(row) == (4, len(want), 12, 60 - 12 - len(want))
    assert flows.read_batches(spark, str(tmp_path / "out" / "dead")).count() == 12


def test_queue_round_trip(spark, tmp_path):
    m = tb.messages(spark, SF)
    rows = queue_files.as_messages(m, F.col("queue_name"), F.col("message"), F.col("msg_id"), F.col("enqueued_at"))
    queue_files.sink_enqueue(rows, str(tmp_path / "q"), file_messages=1)
    one = queue_files.source_queue(spark, str(tmp_path / "q"), "view")
    want = rows.filter(F.col("queue_name") == "view").select(*one.columns)
    assert one.exceptAll(want).count() == 0 and want.exceptAll(one).count() == 0
    stream = queue_files.source_queue(spark, str(tmp_path / "q"), "view", 1, streaming=True, file_messages=1)
    queue_files.sink_enqueue_stream(stream, str(tmp_path / "q2"), str(tmp_path / "cp")).awaitTermination()
    assert queue_files.source_queue(spark, str(tmp_path / "q2"), "view").exceptAll(want).count() == 0
