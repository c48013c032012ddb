import random

import numpy as np
import pyarrow.parquet as pq

from cratedig.llm import toxicity
from cratedig.llm.queries import QUERIES
from tests.llm import data

SF = "/root/testdata/sf0.01"


def labelled(n=400):
    """Prose in which toxic documents hold one bad sentence; bad words share beginnings."""
    rng = random.Random(1)
    good = [f"w{rng.randrange(300)}" for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 3 == 0
        sentences = [" ".join(rng.choice(good) for _ in range(8)) + "." for _ in range(rng.randrange(2, 8))]
        if toxic:
            sentences.insert(rng.randrange(len(sentences)), f"you zorgl{rng.choice('abcdefgh')}x and {rng.choice(good)}!")
        docs.append((i, " ".join(sentences)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_places(spark):
    docs, labels = labelled()
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    y = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    rows = [r for r in toxicity.scored(d, y).collect() if r.held_out]
    truth = {i: t for i, _, t in labels}
    assert len(rows) > 40 and all(r.held_out == data.held_out(r.doc_id, 5) for r in rows)
    assert np.mean([r.predicted == truth[r.doc_id] for r in rows]) > 0.97
    model = toxicity.fit(*toxicity.sample(d, y, 5, 500, 500))
    found = toxicity.with_scores(d, model).where("score >= 0.5").collect()
    hits = [any("zorgl" in r.text[s.start : s.end] for s in r.offending) for r in found]
    assert np.mean(hits) > 0.95


def test_held_out_labels_are_never_used(spark):
    docs, labels = labelled(200)
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    flipped = [(i, q, 1 - t if data.held_out(i, 5) else t) for i, q, t in labels]
    a, b = (
        sorted(map(tuple, toxicity.scored(d, spark.createDataFrame(y, "doc_id bigint, quality int, toxic int")).collect())) for y in (labels, flipped)
    )
    assert a == b


def test_dirty_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, None), (2, 1, 1), (None, 1, 1), (99, 0, 1)], "doc_id bigint, quality int, toxic int")
    got = toxicity.scored(data.dirty(spark), labels).collect()
    assert len(got) == len(data.dirty_rows()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    none = toxicity.scored(data.dirty(spark), labels.where("false")).collect()
    assert all(r.predicted == 0 and r.score < 0.01 for r in none)
    assert toxicity.scored(data.empty(spark), labels).count() == 0
    model = toxicity.Trained(np.zeros(toxicity.FEATURES), -5.0, 0.0)
    made = toxicity.with_scores(data.dirty(spark), model, "toxicity")
    assert made.columns == [*data.dirty(spark).columns, "toxicity", "offending"]


def test_query(spark):
    truth = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    rows = QUERIES["op4_toxicity"](spark, SF).collect()
    assert len(rows) == len(data.documents(SF))
    clean = [r for r in rows if truth.get(r.doc_id) == 0]
    assert np.mean([r.predicted for r in clean]) < 0.03
    scores = {t: np.median([r.score for r in rows if r.held_out and truth.get(r.doc_id) == t]) for t in (0, 1)}
    assert scores[1] > scores[0]
