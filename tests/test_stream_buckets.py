"""Keyed streams work on buckets of keys: the number of calls into Python doesn't grow with the keys."""

from datetime import datetime, timedelta

import pandas as pd

from cratedig.streaming import stateful


class _Held:
    """One bucket's state and timers, as a processor sees them."""

    def __init__(self):
        self.row, self.timers, self.updates = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.row is not None

    def get(self):
        return self.row

    def update(self, row):
        self.row, self.updates = row, self.updates + 1

    def clear(self):
        self.row = None

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


def test_many_keys_are_one_state_update():
    held, step = _Held(), stateful._PassOnce(1_000_000, "k", "i", ["i"])
    step.init(held)
    pdf = pd.DataFrame({"k": [f"k{i % 500}" for i in range(1000)], "i": range(1000), "us": range(0, 1000_000, 1000)})
    got = pd.concat(step.handleInputRows((0,), iter([pdf]), None))
    assert got["i"].tolist() == list(range(500)) and held.updates == 1 and len(held.timers) == 1


def test_retries_of_a_bucket_come_back_together():
    held, step = _Held(), stateful._Retry([1_000_000])
    step.init(held)
    rows = pd.DataFrame({"msg_id": range(100), "us": 0, "read_ct": 0, "queue_name": "q", "message": "m", "fails": [[i % 2 == 0, True] for i in range(100)]})
    first = pd.concat(step.handleInputRows((0,), iter([rows]), None))
    assert (first["outcome"] == "retry").sum() == 50 and held.timers == {1000} and held.updates == 1
    now = type("Now", (), {"getCurrentWatermarkInMs": lambda self: 5000})()
    late = pd.concat(step.handleExpiredTimer((0,), now, None))
    assert set(late["outcome"]) == {"dead"} and len(late) == 50 and not held.exists()
    assert late["attempt_at"].unique()[0] == pd.Timestamp(datetime(1970, 1, 1) + timedelta(seconds=1))
