import random

import numpy as np
import pyarrow.parquet as pq
import zstandard

from cratedig.llm import common, compression
from cratedig.llm.queries import QUERIES
from pyspark.sql import functions as F
from tests.llm import data

SF = "/root/testdata/sf0.01"


def labelled(n=500):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        w = data.prose(i, rng.randrange(30, 400)).split()
        docs.append((i, " ".join(w) if good else " ".join(f"{x}{rng.choice(['$$$', '&&&', '!!!'])}" for x in w)))
        labels.append((i, int(good), 0))
    return docs, labels


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def plain_score(model, text):
    """The score once more, step by step: sizes from one-piece compressors, the polynomial written out."""
    raw = (text or "").encode()
    sizes = []
    for d in (model.good, model.bad):
        z = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False)
        sizes.append(sum(len(z.compress(raw[i : i + 1024])) for i in range(0, max(1, len(raw)), 1024)))
    g, b = sizes
    x = [(b - g) / (b + g), min((g + b) / 2 / (len(raw) + 20), 0.3), min((g + b) / 2 / (len(raw) + 20), 1.0), np.log(1 + len(raw))]
    x += [x[i] * x[j] for i in range(4) for j in range(i, 4)]
    z = sum(w * (v - c) / s for w, v, c, s in zip(model.weights, x, model.center, model.scale)) + model.weights[-1]
    return len(raw), g, b, 1 / (1 + np.exp(-min(30, max(-30, z))))


def test_scores_equal_a_plain_computation_with_the_same_model(spark):
    docs, labels = labelled()
    docs += [(9000, None), (9001, ""), (9002, data.prose(3, 40_000))]
    d, y = frames(spark, docs, labels)
    model = compression.fit(d, y)
    texts = dict(docs)
    rows = compression.scored(d, y).collect()
    assert len(rows) == len(docs)
    for r in rows:
        size, g, b, score = plain_score(model, texts[r.doc_id])
        assert (r.size, r.good_size, r.bad_size) == (size, g, b) and abs(r.score - score) < 1e-6
        assert r.held_out == data.held_out(r.doc_id, 5) and r.predicted == int(r.score >= 0.3)


def test_held_out_accuracy(spark):
    docs, labels = labelled()
    rows = [r for r in compression.scored(*frames(spark, docs, labels)).collect() if r.held_out]
    truth = {i: q for i, q, _ in labels}
    assert len(rows) > 50 and np.mean([r.predicted == truth[r.doc_id] for r in rows]) > 0.97


def test_query(spark):
    rows = QUERIES["op13_compression_quality"](spark, SF).collect()
    docs = data.documents(SF)
    assert sorted(r.doc_id for r in rows) == sorted(docs) and all(0 <= r.score <= 1 for r in rows)
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95
    # probabilities mean what they say, at both ends
    sure = [labels[r.doc_id] for r in rows if r.doc_id in labels and r.score > 0.9]
    assert np.mean(sure) > 0.97


def test_held_out_labels_are_never_used(spark):
    docs, labels = labelled(300)
    turned = [(i, 1 - q if data.held_out(i, 5) else q, t) for i, q, t in labels]
    a = sorted(map(tuple, compression.scored(*frames(spark, docs, labels)).collect()))
    assert a == sorted(map(tuple, compression.scored(*frames(spark, docs, turned)).collect()))


def test_dirty_empty_and_unlabelled(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, 0), (5, 0), (7, 1), (8, None), (None, 1), (14, 0), (15, 1)], "doc_id bigint, quality int")
    rows = compression.scored(data.dirty(spark), labels).collect()
    assert len(rows) == len(data.dirty_rows()) and all(0 <= r.score <= 1 for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert len(by_id[3]) == 1 and {r.doc_id: r.size for r in rows}[5] == 0
    assert compression.scored(data.empty(spark), labels).count() == 0
    alone = compression.scored(data.dirty(spark), labels.limit(0)).collect()
    assert {r.score for r in alone} == {0.5}
    one_kind = compression.scored(data.dirty(spark), labels.where("quality = 1")).collect()
    assert min(r.score for r in one_kind) > 0.5


def test_pieces_cover_the_text():
    text = data.prose(1, 3000).encode()
    assert b"".join(compression.pieces(text)) == text and max(map(len, compression.pieces(text))) <= compression.PIECE
    assert compression.pieces(b"") == [b""]


def test_hash_cut_keeps_to_its_bound(spark):
    rows = spark.range(20_000).select(F.xxhash64("id").alias("h"))
    have = np.sort([r.h for r in rows.collect()])
    for most in (1, 100, 5000, 20_000, 50_000):
        n = int((have <= common.hash_cut(rows, F.col("h"), most)).sum())
        assert min(most, 20_000) // 2 <= n <= most
    same = spark.range(1000).select(F.lit(5).cast("long").alias("h"))
    assert common.hash_cut(same, F.col("h"), 1) >= 5 > common.hash_cut(same, F.col("h"), 0)
    assert common.hash_cut(rows.limit(0), F.col("h"), 3) == 2**63 - 1
