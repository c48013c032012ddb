"""What the stages shuffle: what messages ask for, not the messages."""

import time

from cratedig import schemas
from cratedig.functions.formats import packed, unpacked
from cratedig.operators import upsert
from cratedig.plans import stages
from cratedig.session import FREED
from pyspark.sql import functions as F

from tests.test_streams import responses, seeds


def test_a_request_is_shuffled_without_its_message_and_a_broken_one_hides_none(spark):
    rows = [("k", '{"trackId":"t1","note":"long"}'), ("k", '{"trackId":"t2"}'), ("k", "[]"), (None, '{"trackId":"t3"}')]
    messages = spark.createDataFrame(rows, "dedup_key string, message string")
    got = stages.distinct_requests(messages, stages.first_of(F.col("message"), "trackId", "track_id").alias("track_id"))
    assert sorted(r.track_id for r in got.collect()) == ["t1", "t3"] and got.columns == ["track_id"]


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark, tmp_path):
    before, setting = shuffle_files(spark), spark.conf.get(FREED, None)
    made = stages.stored(spark.range(10_000).groupBy((F.col("id") % 500).alias("k")).count(), str(tmp_path / "t"))
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert made.count() == 500 and spark.conf.get(FREED, None) == setting


def test_ids_are_packed_and_come_back_as_they_were(spark):
    ids = ["", "7", "é" * 16, "0f" * 32, "0F" * 32, "a" * 63, "f" * 64 + "\n", "\x01" + "a" * 64, None]
    rows = spark.createDataFrame([(i,) for i in ids], "id string").withColumn("p", packed(F.col("id")))
    got = rows.select("id", F.octet_length("p").alias("n"), unpacked(F.col("p")).alias("back")).collect()
    assert [r.back for r in got] == ids and {r.id: r.n for r in got}["0f" * 32] == 33


def test_links_of_text_ids_are_shuffled_packed(spark):
    links = spark.createDataFrame([], schemas.TRACK_PRODUCERS).limit(0)
    rows = [("ab" * 32, "cd" * 32, 0.5, "x", 0), ("ab" * 32, "cd" * 32, 0.9, "y", 1), ("t", "p", None, "x", 0)]
    out = upsert.link_track_producers(links, spark.createDataFrame(rows, "track_id string, producer_id string, confidence double, source string, position int"), "2024-01-01")
    assert sorted((r.track_id, r.producer_id, float(r.confidence)) for r in out.collect()) == [("ab" * 32, "cd" * 32, 0.5), ("t", "p", 0.8)]
    assert out.dtypes[:2] == [("track_id", "string"), ("producer_id", "string")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("unhex") > plan.index("row_number")  # below the window, so packed before the shuffle


def test_only_messages_from_elsewhere_are_looked_up_among_the_tracks(spark, tmp_path, monkeypatch):
    calls, real = [], stages.refused

    def noted(messages, queue, tracks=None):
        calls.append((queue, tracks is not None, messages))
        return real(messages, queue, tracks)

    monkeypatch.setattr(stages, "refused", noted)
    rows = [("k1", '{"trackId":"none"}'), ("k2", "[]")]
    bad = spark.createDataFrame(rows, "dedup_key string, message string").select(F.lit("producer_identification").alias("queue_name"), "*")
    got = stages.stage_chain(spark, seeds(spark, ["Artist 0"]), responses(spark), "2024-01-01", str(tmp_path / "chain"), {"producer_identification": bad}, with_dead=True)
    looked = [(queue, messages.count()) for queue, tracks, messages in calls if tracks]
    assert looked == [("producer_identification", 2)]
    assert {r.dedup_key: r.failure_reason for r in got["dead"].collect()} == {
        "k1": "Track not found with ID: none", "k2": "Invalid message format: message body is empty or null"
    }


def test_requests_read_each_message_once(spark):
    messages = spark.createDataFrame([("k", '{"trackId":"t1"}')], "dedup_key string, message string").repartition(2)
    got = stages.distinct_requests(messages, stages.first_of(F.col("message"), "trackId").alias("track_id"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "get_json_object" in plan and not [line for line in plan.splitlines() if "Filter" in line and "get_json_object" in line]
