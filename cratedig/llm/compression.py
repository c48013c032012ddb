"""Quality by compression: which of two dictionaries, of good or of bad text, makes a document smaller.

Two zstandard dictionaries are trained on pieces of documents labelled good and
bad. Every document is cut into pieces and compressed with each; the difference
of the two sizes over their sum tells which kind of text it is like. Logistic
regression on that difference, and on how well the text compresses at all, turns
it into a probability; it is fitted on labelled documents that the dictionaries
haven't seen.

The labelled documents used are a bounded sample, chosen by the hash of their
ids: ``DICTIONARY_DOCS`` of either kind for the dictionaries, of which ``PIECES``
pieces reach the driver, and ``CALIBRATION_DOCS`` of either kind, of which only
measures do. Every document is scored, over its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cratedig import session
from cratedig.llm.common import as_bytes, crc_mod, hash_cut, keep, worker_store

DICTIONARY_DOCS = 4000
CALIBRATION_DOCS = 4000
PIECES = 6000
#: Bytes of a piece, so at most 2 x PIECES x PIECE bytes of text reach the driver.
PIECE = 1024
DICTIONARY_BYTES = 110 << 10
LEVEL = 3
#: Pull of the calibration's weights towards zero.
RIDGE = 1e-3
PREDICTED = 0.3
MEASURES = "size long, good_size long, bad_size long"


@dataclass
class Model:
    """The two dictionaries' bytes and the calibration: means, scales and weights of ``inputs``."""

    good: bytes
    bad: bytes
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray


def pieces(text: bytes) -> list[bytes]:
    """The whole text in pieces of at most PIECE bytes; an empty text is one empty piece."""
    return [text[i : i + PIECE] for i in range(0, len(text), PIECE)] or [b""]


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where there are too few to train one."""
    import zstandard

    whole = b"".join(samples)
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, len(whole) // 8)), samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return whole[:DICTIONARY_BYTES]


def compressor(data: bytes):
    import zstandard

    plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(data), **plain) if len(data) >= 8 else zstandard.ZstdCompressor(**plain)


def measure(text: bytes, good, bad) -> tuple[int, int, int]:
    """Bytes of the text, and of its pieces compressed with either dictionary."""
    cut = pieces(text)
    return len(text), sum(len(good.compress(p)) for p in cut), sum(len(bad.compress(p)) for p in cut)


def inputs(size: np.ndarray, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """What the calibration sees: normalised difference, share left by compression, size, and their products."""
    difference = (bad - good) / np.maximum(good + bad, 1)
    left = np.minimum((good + bad) / 2 / (size + 20), 1.0)
    x = np.stack([difference, np.minimum(left, 0.3), left, np.log1p(size)], axis=1)
    i, j = np.triu_indices(x.shape[1])
    return np.concatenate([x, x[:, i] * x[:, j]], axis=1)


def calibrated(x: np.ndarray, y: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, scales and weights (the last is the constant) of a ridge logistic regression, by Newton steps."""
    center, scale = (x.mean(axis=0), x.std(axis=0) + 1e-9) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    z = np.concatenate([(x - center) / scale, np.ones((len(x), 1))], axis=1)
    w = np.zeros(z.shape[1])
    w[-1] = np.log((y.sum() + 1.0) / ((1 - y).sum() + 1.0))
    if len(y) == 0 or y.min() == y.max():
        return center, scale, w
    pull = np.full(z.shape[1], RIDGE * len(y))
    pull[-1] = 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        v = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((z * v[:, None]).T @ z + np.diag(pull + 1e-9), z.T @ (y - p) - pull * w)
        w = w + step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-6:
            break
    return center, scale, w


def probabilities(model: Model, size: np.ndarray, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    z = (inputs(size, good, bad) - model.center) / model.scale
    return 1 / (1 + np.exp(-np.clip(z @ model.weights[:-1] + model.weights[-1], -30, 30)))


def sampled(labels: DataFrame, label: str, held_out: int, most: dict[str, int]) -> DataFrame:
    """(doc_id, y, part): for either label and each part, ids with the smallest hashes; parts share no id.

    Ids with both labels, null labels, null ids and held-out ids are left out. At most two ids for each unit of ``most``.
    """
    marks = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (crc_mod("doc_id", held_out) != 0))
    marks = marks.groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("m")).where("y = m")
    h = F.xxhash64("doc_id")
    marks = marks.select("doc_id", (F.col("y") > 0).alias("y"), h.alias("h"), F.pmod(F.xxhash64(h), F.lit(len(most))).alias("k"))
    out = []
    for k, (part, n) in enumerate(most.items()):
        for y in (True, False):
            some = marks.where((F.col("y") == y) & (F.col("k") == k))
            out.append(some.where(F.col("h") <= hash_cut(some, F.col("h"), n)).select("doc_id", "y", F.lit(part).alias("part")))
    made = out[0]
    for more in out[1:]:
        made = made.union(more)
    return made


def measured(rows: DataFrame, good: bytes, bad: bytes) -> DataFrame:
    """The columns of ``rows`` but ``data`` (the last one), with MEASURES of it."""
    names = rows.columns[:-1]
    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes[:-1]) + f", {MEASURES}"
    sent = rows.sparkSession.sparkContext.broadcast((good, bad))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = worker_store("compression")
        if store.get("dictionaries") != sent.value:
            store["dictionaries"], store["compressors"] = sent.value, [compressor(x) for x in sent.value]
        for batch in batches:
            found = np.array([measure(x.as_py(), *store["compressors"]) for x in batch.column(len(names))], np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [pa.array(c) for c in found.T], [*names, "size", "good_size", "bad_size"])

    return rows.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", held_out: int = 5, dictionary_docs: int = DICTIONARY_DOCS,
        calibration_docs: int = CALIBRATION_DOCS, n_pieces: int = PIECES) -> Model:
    """The model of labelled documents that are not held out.

    ``doc_id`` may repeat in ``docs``: all its texts are used. Without documents of both kinds every score is the share of
    the label that is there (one half without any).
    """
    chosen = F.broadcast(keep(sampled(labels, label, held_out, {"dictionary": dictionary_docs, "calibration": calibration_docs}), "sample"))
    given = docs.select(F.col("doc_id"), as_bytes().alias("data")).join(chosen, "doc_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for y, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = pieces(data.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([y] * len(own), pa.bool_()), pa.array(own, pa.binary())], ["y", "piece"])

    parts = given.where("part = 'dictionary'").select("y", "data").mapInArrow(cut, "y boolean, piece binary")
    parts = keep(parts.select("y", "piece", F.xxhash64("piece").alias("h")), "pieces")
    made = []
    for y in (True, False):
        some = parts.where(F.col("y") == y)
        few = some.where(F.col("h") <= hash_cut(some, F.col("h"), n_pieces)).groupBy("h").agg(F.min("piece").alias("piece"))
        made.append(dictionary([bytes(r["piece"]) for r in sorted(few.collect(), key=lambda r: r["h"])]))
    seen = measured(given.where("part = 'calibration'").groupBy("doc_id", "y").agg(F.min("data").alias("data")).select("y", "data"), *made)
    rows = sorted(tuple(r) for r in seen.select("size", "good_size", "bad_size", "y").collect())
    table = np.array(rows, np.float64).reshape(-1, 4)
    return Model(*made, *calibrated(inputs(*table[:, :3].T), table[:, 3]))


def scored(docs: DataFrame, labels: DataFrame, label: str = "quality", held_out: int = 5, predicted: float = PREDICTED) -> DataFrame:
    """For documents (doc_id, text): doc_id, held_out, score, predicted, size, good_size, bad_size.

    ``predicted`` is 1 from that score on. Labels of documents whose crc32(doc_id) is divisible by ``held_out`` are never
    used. Null ids are not held out and have no label. A null text counts as empty, and an empty text is scored by the sizes
    of nothing. Repeated rows get equal scores, very long texts are compressed piece by piece, an empty table gives no
    rows; other columns, whatever their names, are not read.
    """
    model = fit(docs, labels, label, held_out)
    out = F.coalesce(crc_mod("doc_id", held_out) == 0, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), out.alias("held_out"), as_bytes().alias("data"))
    sizes = measured(rows, model.good, model.bad)
    sent = docs.sparkSession.sparkContext.broadcast((model.center, model.scale, model.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Model(b"", b"", *sent.value)
        for batch in batches:
            p = probabilities(judge, *(batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in (2, 3, 4)))
            cols = [*batch.columns[:2], pa.array(p), pa.array((p >= predicted).astype(np.int32)), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "score", "predicted", "size", "good_size", "bad_size"])

    return sizes.mapInArrow(run, f"doc_id long, held_out boolean, score double, predicted int, {MEASURES}")


session.ship_with_jobs(__name__)
