"""Keyed state with event-time timers: repeats, first results, and failed messages on hold.

All three keep one small state per key, give it up when the watermark has passed its end, and
so follow the keys that are still open. Keys are dealt into buckets by hash, and a bucket is
what Spark groups by: its open keys are read and written at once, where a call for every key
would cost a thousand times the work on its rows. A key's rows are taken in order of time inside a micro-batch, and
micro-batches in the order they come: a source that reads oldest first makes results the
same however it is cut. Rows later than ``lateness`` are dropped by Spark; choose it by the
source's disorder.

A bucket's open keys and its rows of a micro-batch are held at once; the source's limits and
the number of buckets bound them. A stream keeps the number it was started with.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cratedig.functions.times import micros
from cratedig.session import ROCKSDB, ship_with_jobs

ship_with_jobs(__name__)


def ensure_rocksdb(spark: SparkSession) -> None:
    """Keyed state with several types of values needs the RocksDB store."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, None) != ROCKSDB:
        spark.conf.set(key, ROCKSDB)


def in_event_time(rows: DataFrame, ts: str, lateness: str) -> DataFrame:
    """Rows with a watermark on ``ts`` and their time in microseconds as ``us``."""
    ensure_rocksdb(rows.sparkSession)
    return rows.withColumn(ts, F.col(ts).cast("timestamp")).withColumn("us", micros(F.col(ts))).withWatermark(ts, lateness)


def in_order(rows: Iterator[pd.DataFrame], tie: str) -> pd.DataFrame:
    return pd.concat(list(rows)).sort_values(["us", tie], kind="stable")


#: Groups that keys are dealt into.
BUCKETS = 256
BUCKET = "_bucket"


def by_bucket(rows: DataFrame, key: str, buckets: int) -> GroupedData:
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).groupBy(BUCKET)


class _Until(StatefulProcessor):
    """Base of states that end: a bucket's open keys, each with its end in microseconds and what it holds.

    The state is one row of arrays. The bucket has one timer, for the earliest end.
    """

    value = "keys array<string>, until array<bigint>"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", f"timer bigint, {self.value}")

    def held(self) -> tuple[int | None, dict[object, tuple]]:
        """The timer that is set, and the open keys: key -> (end, ...)."""
        if not self.state.exists():
            return None, {}
        timer, keys, *columns = self.state.get()
        return timer, dict(zip(keys, zip(*columns)))

    def hold(self, was: int | None, now: dict[object, tuple]) -> None:
        """Replaces the state and moves the bucket's timer."""
        timer = min(self.timer(v[0]) for v in now.values()) if now else None
        if was is not None and was != timer:
            self.handle.deleteTimer(was)
        if not now:
            self.state.clear()
            return
        if was != timer:
            self.handle.registerTimer(timer)
        self.state.update((timer, list(now), *map(list, zip(*now.values()))))

    @staticmethod
    def timer(us: int) -> int:
        """Timers are in milliseconds: the first one that isn't before the end."""
        return -(-us // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        _, now = self.held()
        passed = timerValues.getCurrentWatermarkInMs()
        self.hold(None, {k: v for k, v in now.items() if self.timer(v[0]) > passed})  # the timer that fired is taken away by Spark
        yield pd.DataFrame()

    def close(self) -> None:
        pass


class _PassOnce(_Until):
    """A message passes if none of its key passed within the TTL before it."""

    def __init__(self, ttl_us: int, key: str, tie: str, columns: list[str]):
        self.ttl_us, self.key, self.tie, self.columns = ttl_us, key, tie, columns

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = in_order(rows, self.tie)
        timer, now = self.held()
        passes = []
        for k, us in zip(pdf[self.key].tolist(), pdf["us"].tolist()):
            passes.append(k not in now or us >= now[k][0])
            if passes[-1]:
                now[k] = (us + self.ttl_us,)
        self.hold(timer, now)
        yield pdf[passes][self.columns]


def stream_dedup_ttl(messages: DataFrame, key: str, ttl_seconds: int, ts: str = "enqueued_at", tie: str = "msg_id", lateness: str = "0 seconds", buckets: int = BUCKETS) -> DataFrame:
    """Messages that pass when each one that passes blocks its key for the TTL; the exact rule of ``dedup.dedup_ttl``.

    The key's state is the end of its block; a timer clears it when the watermark gets there. Messages without a key
    are not for this operator. (ts, tie) orders a key's messages.
    """
    columns = messages.columns
    schema = ", ".join(f"`{c}` {'timestamp' if c == ts else t}" for c, t in messages.dtypes)
    return by_bucket(in_event_time(messages, ts, lateness), key, buckets).transformWithStateInPandas(
        statefulProcessor=_PassOnce(ttl_seconds * 1_000_000, key, tie, columns), outputStructType=schema, outputMode="append", timeMode="EventTime"
    )


RESULT = "operation_id string, event_id bigint, result string, replayed boolean"


class _FirstResult(_Until):
    """Answers with the stored result until its end; then the next operation's own result is stored."""

    value = "keys array<string>, until array<bigint>, result array<string>"

    def __init__(self, ttl_us: int):
        self.ttl_us = ttl_us

    def handleInitialState(self, key, initialState, timerValues) -> None:
        timer, now = self.held()
        for k, us, result in zip(initialState["operation_id"].tolist(), initialState["us"].tolist(), initialState["result"].tolist()):
            given = (us + self.ttl_us, result)
            now[k] = max(now.get(k, given), given)
        self.hold(timer, now)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = in_order(rows, "event_id")
        timer, now = self.held()
        results, replayed = [], []
        for k, us, result in zip(pdf["operation_id"].tolist(), pdf["us"].tolist(), pdf["result"].tolist()):
            known = k in now and us < now[k][0]
            if not known:
                now[k] = (us + self.ttl_us, result)
            results.append(now[k][1])
            replayed.append(known)
        self.hold(timer, now)
        yield pdf[["operation_id", "event_id"]].assign(result=results, replayed=replayed)


def stream_idempotent_result(operations: DataFrame, ttl_seconds: int = 86400 * 36500, stored: DataFrame | None = None, lateness: str = "0 seconds", buckets: int = BUCKETS) -> DataFrame:
    """Every operation answers with its first result, for the TTL after it; operations: operation_id, event_id, ts, result.

    ``stored`` (operation_id, result, stored_at) are results from before, one per operation (the latest counts): the stream
    starts from them. A timer clears a result when the watermark passes its end.
    """
    initial = None
    if stored is not None:
        initial = by_bucket(stored.select("operation_id", "result", micros(F.col("stored_at")).alias("us")), "operation_id", buckets)
    rows = in_event_time(operations.select("operation_id", "event_id", "ts", "result"), "ts", lateness)
    return by_bucket(rows, "operation_id", buckets).transformWithStateInPandas(
        statefulProcessor=_FirstResult(ttl_seconds * 1_000_000), outputStructType=RESULT, outputMode="append", timeMode="EventTime", initialState=initial
    )


def idempotent_result(operations: DataFrame) -> DataFrame:
    """The same over a finished log, without an end: the first result per operation is a small side, found map-side first."""
    order = F.struct(F.col("ts"), F.col("event_id"))
    first = operations.groupBy("operation_id").agg(
        F.min_by("result", order).alias("first_result"), F.min(order).alias("_at")
    )
    return operations.join(first, "operation_id").select(
        "operation_id",
        "event_id",
        F.col("first_result").alias("result"),
        (F.col("_at.event_id") != F.col("event_id")).alias("replayed"),
    )


ATTEMPT = "msg_id bigint, queue_name string, attempt_at timestamp, read_ct int, outcome string, message string"


class _Retry(_Until):
    """Holds failed messages until their back-off is due; then gives them out again with one more read, or as dead."""

    value = "keys array<bigint>, due array<bigint>, read_ct array<int>, queue_name array<string>, message array<string>, fails array<array<boolean>>"

    def __init__(self, delays_us: list[int]):
        self.delays_us = delays_us

    def attempts(self, out: list[tuple], now: dict[object, tuple], msg_id: int, row: tuple, up_to: int | None) -> None:
        """The attempt at a time, and those after it that are due already; holds the message if another is to come."""
        us, read_ct, queue, message, fails = row
        now.pop(msg_id, None)
        while True:
            failed = read_ct >= len(fails) or fails[read_ct] is None or bool(fails[read_ct])
            outcome = "done" if not failed else "retry" if read_ct < len(self.delays_us) else "dead"
            out.append((msg_id, queue, us, read_ct, outcome, message))
            if outcome != "retry":
                return
            us, read_ct = us + self.delays_us[read_ct], read_ct + 1
            if up_to is None or us > up_to:
                now[msg_id] = (us, read_ct, queue, message, fails)
                return

    @staticmethod
    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in ATTEMPT.split(", ")])
        out["attempt_at"] = pd.to_datetime(out["attempt_at"], unit="us")
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = in_order(rows, "read_ct")
        timer, now = self.held()
        out, tried = [], set()
        columns = [pdf[c].tolist() for c in ("msg_id", "us", "read_ct", "queue_name", "message", "fails")]
        for msg_id, us, read_ct, queue, message, fails in zip(*columns):
            if msg_id in now or msg_id in tried:  # on hold, or given twice: it is not tried twice
                continue
            tried.add(msg_id)
            self.attempts(out, now, msg_id, (us, read_ct, queue, message, [None if x is None else bool(x) for x in fails]), None)
        self.hold(timer, now)
        yield self.frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        _, now = self.held()
        passed, out = timerValues.getCurrentWatermarkInMs(), []
        for msg_id, row in list(now.items()):
            if self.timer(row[0]) <= passed:
                self.attempts(out, now, msg_id, row, passed * 1000)
        self.hold(None, now)
        yield self.frame(out)


def stream_retries(messages: DataFrame, fails: Column, delays_seconds: list[int], ts: str = "enqueued_at", lateness: str = "0 seconds", buckets: int = BUCKETS) -> DataFrame:
    """The attempts of each message: those that fail come back when their back-off is due, with ``read_ct`` one higher.

    messages: msg_id, queue_name, read_ct, message and ``ts``. ``fails`` is an array of booleans: whether the attempt with
    read_ct 0, 1, ... fails; what lies beyond it, or is null, fails. After a failure with read_ct k the message is on hold for
    ``delays_seconds[k]``; without a delay for k it is dead. Rows of ATTEMPT: outcome ``done``, ``retry`` (fails and will come
    back) or ``dead``. An attempt is given out when the watermark has reached it.
    """
    rows = in_event_time(messages, ts, lateness).select("msg_id", "queue_name", ts, "us", "read_ct", "message", fails.alias("fails"))
    return by_bucket(rows, "msg_id", buckets).transformWithStateInPandas(
        statefulProcessor=_Retry([s * 1_000_000 for s in delays_seconds]), outputStructType=ATTEMPT, outputMode="append", timeMode="EventTime"
    )
