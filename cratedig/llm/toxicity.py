"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence's probability is a logistic function of its distinct words' features
(the word and its beginnings, hashed). A document is toxic if any sentence is:
its score is the noisy-or of its sentences, through which the document labels
train the sentence model. The model then tells which sentences are at fault.

Training uses a bounded sample of labelled documents (``TOXIC_SAMPLE`` and
``CLEAN_SAMPLE``), chosen by the hash of their ids. Scoring covers every document.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cratedig import session
from cratedig.llm.common import Recent, bounded, clear_of, crc_mod, worker_store

TOXIC_SAMPLE, CLEAN_SAMPLE = 2500, 5000
FEATURES = 1 << 18
BEGINNINGS = (3, 4, 5, 6)
EPOCHS, RATE, DECAY, BIAS = 100, 0.1, 1e-4, -6.0
#: Features in fewer documents of the sample have no weight.
LEAST_DOCUMENTS = 4
#: Words, and the marks that end a sentence.
TOKEN = re.compile(r"\w+|[.!?\n]+")
CACHED_WORDS = 300_000


def features(word: str) -> list[int]:
    """The whole word and its beginnings that are shorter than it."""
    data = [f"={word}"] + [f"^{word[:n]}" for n in BEGINNINGS if len(word) > n]
    return [zlib.crc32(d.encode("utf-8", "replace")) % FEATURES for d in data]


def sentences(text: str) -> list[tuple[str, int, int]]:
    """Lower-case tokens with the places they come from; marks that end a sentence are tokens too."""
    return [(m[0].lower(), m.start(), m.end()) for m in TOKEN.finditer(text)]


def is_mark(token: str) -> bool:
    return token[0] in ".!?\n"


def laid_out(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, and for each distinct (sentence, word) its sentence and word; the document of each sentence."""
    index: dict[str, int] = {}
    sentence, word, owner = array("q"), array("q"), array("q")
    for doc, text in enumerate(texts):
        owner.append(doc)
        for token in TOKEN.findall(text.lower()):
            if is_mark(token):
                owner.append(doc)
            else:
                sentence.append(len(owner) - 1)
                word.append(index.setdefault(token, len(index)))
    size = max(1, len(index))
    key = np.unique(np.frombuffer(sentence, np.int64) * size + np.frombuffer(word, np.int64)) if index else np.empty(0, np.int64)
    return list(index), key // size, key % size, np.frombuffer(owner, np.int64)


def soft_plus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def noisy_or_mass(z: np.ndarray, owner: np.ndarray, docs: int) -> np.ndarray:
    """-log of the probability that no sentence is toxic, for each document."""
    return np.bincount(owner, soft_plus(z), docs)


class Trained:
    """Feature weights, the sentence bias, and the log-odds at which a document counts as toxic."""

    def __init__(self, weights: np.ndarray, bias: float, threshold: float):
        self.weights, self.bias, self.threshold = weights, bias, threshold


def fit(texts: list[str], toxic: np.ndarray, epochs: int = EPOCHS) -> Trained:
    """Gradient descent (Adam) on the noisy-or likelihood; the threshold is set on every fifth document."""
    if len(texts) == 0 or toxic.min() == toxic.max():
        return Trained(np.zeros(FEATURES), -20.0, 0.0)  # nothing to learn: all scores stay near 0
    words, s, w, owner = laid_out(texts)
    per_word = [features(x) for x in words]
    f_word = np.repeat(np.arange(len(words)), [len(x) for x in per_word])
    used, f = np.unique(np.concatenate([np.array(x) for x in per_word]), return_inverse=True)
    check = np.arange(len(texts)) % 5 == 4
    learn = ~check
    # documents of either kind that hold a feature; the weights start from their log-odds
    many = np.bincount(f_word, minlength=len(words))
    first = np.cumsum(many) - many
    with_toxic, with_clean = np.zeros(len(used), np.int64), np.zeros(len(used), np.int64)
    bounds = np.searchsorted(owner[s], np.arange(len(texts) + 1))
    for i in np.flatnonzero(learn):
        own = np.unique(w[bounds[i] : bounds[i + 1]])
        inside = np.arange(many[own].sum()) - np.repeat(np.cumsum(many[own]) - many[own], many[own])
        (with_toxic if toxic[i] else with_clean)[np.unique(f[np.repeat(first[own], many[own]) + inside])] += 1
    n_toxic, n_clean = max(1, (toxic & learn).sum()), max(1, (~toxic & learn).sum())
    free = with_toxic + with_clean >= LEAST_DOCUMENTS
    start = np.log((with_toxic + 1) / (n_toxic + 2)) - np.log((with_clean + 1) / (n_clean + 2))
    weights = np.append(np.where(free & (start > 1.5), start, 0.0), BIAS)
    rate = np.where(toxic, 0.5 / n_toxic, 0.5 / n_clean) * learn
    m, v = np.zeros_like(weights), np.zeros_like(weights)

    def sentence_logits() -> np.ndarray:
        return np.bincount(s, np.bincount(f_word, weights[f], len(words))[w], len(owner)) + weights[-1]

    for step in range(1, epochs + 1):
        z = sentence_logits()
        mass = noisy_or_mass(z, owner, len(texts))
        slope = np.where(toxic, -1.0 / np.expm1(np.minimum(np.maximum(mass, 1e-9), 50.0)), 1.0) * rate
        g_s = slope[owner] / (1 + np.exp(-z))
        g = np.append(np.bincount(f, np.bincount(w, g_s[s], len(words))[f_word], len(used)), g_s.sum())
        g[:-1] = np.where(free, g[:-1] + DECAY * weights[:-1], 0.0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        weights -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-3)
    odds = log_odds(noisy_or_mass(sentence_logits(), owner, len(texts)))
    held = check if (toxic & check).any() and (~toxic & check).any() else learn
    out = np.zeros(FEATURES)
    out[used] = weights[:-1]
    return Trained(out, float(weights[-1]), best_threshold(odds[held], toxic[held]))


def log_odds(mass: np.ndarray) -> np.ndarray:
    """log(P / (1 - P)) for P = 1 - exp(-mass)."""
    return np.log(np.expm1(np.clip(mass, 1e-12, 700.0)))


def best_threshold(odds: np.ndarray, toxic: np.ndarray) -> float:
    """The middle of the widest gap among cuts with the most documents right."""
    order = np.argsort(odds)
    o, t = odds[order], toxic[order]
    right = np.concatenate([[0], np.cumsum(~t)]) + (t.sum() - np.concatenate([[0], np.cumsum(t)]))
    edges = np.concatenate([[o[0] - 2.0], o, [o[-1] + 2.0]])
    gaps = np.where(right == right.max(), np.diff(edges), -1.0)
    at = int(np.argmax(gaps))
    return float((edges[at] + edges[at + 1]) / 2)


def sample(docs: DataFrame, labels: DataFrame, held_out: int, toxic: int, clean: int) -> tuple[list[str], np.ndarray]:
    """At most ``toxic`` and ``clean`` labelled documents that are not held out, those of smallest id hash."""
    marks = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    pool = docs.where(crc_mod("doc_id", held_out) != 0).select("doc_id", "text").join(marks, "doc_id")
    rows: list = []
    for value, bound in ((1, toxic), (0, clean)):
        some = pool.where((F.col("toxic") > 0) == F.lit(value == 1)).withColumn("text", F.coalesce("text", F.lit("")))
        rows += [(t, value) for t in bounded(some, F.xxhash64("doc_id"), "text", bound)]
    rows.sort(key=lambda r: zlib.crc32(r[0].encode("utf-8", "replace")))
    return [t for t, _ in rows], np.array([y == 1 for _, y in rows], bool)


def with_scores(docs: DataFrame, model: Trained, score: str = "score", sentence_list: str = "offending", text: str = "text") -> DataFrame:
    """The columns of ``docs`` with the document's score (0.5 at the threshold) and its offending sentences.

    ``offending`` lists (start, end, score) of sentences with probability 0.5 or more, as character places, for
    documents that reach 0.5. A null or empty text has one empty sentence, hence the lowest score.
    """
    (data,) = clear_of(docs, "data")
    given = docs.withColumn(data, F.coalesce(F.col(text).cast("string"), F.lit("")))
    found = "array<struct<start:int,end:int,score:double>>"
    schema = docs.withColumn(score, F.lit(0.0)).withColumn(sentence_list, F.lit(None).cast(found)).schema
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, threshold = sent.value
        store = worker_store("toxicity")
        if store.get("model") != (bias, threshold):
            store.clear()
            store["model"], store["cache"] = (bias, threshold), Recent(CACHED_WORDS)

        def weigh(words: list[str]) -> list[float]:
            return [float(weights[features(x)].sum()) for x in words]

        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                part = whole.slice(at, 500)
                texts = part.column(part.num_columns - 1).to_pylist()
                words, s, w, owner = laid_out(texts)
                known = store["cache"].ensure(words, weigh)
                z = np.bincount(s, np.fromiter(map(known.__getitem__, words), float, len(words))[w], len(owner)) + bias
                odds = log_odds(noisy_or_mass(z, owner, len(texts))) - threshold
                places = [offending(t, known, bias) if o >= 0 else [] for t, o in zip(texts, odds)]
                cols = part.columns[:-1] + [
                    pa.array(1 / (1 + np.exp(-odds))),
                    pa.array(places, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))),
                ]
                yield pa.RecordBatch.from_arrays(cols, [*part.schema.names[:-1], score, sentence_list])

    return given.mapInArrow(run, schema)


def offending(text: str, known: dict[str, float], bias: float) -> list[dict]:
    out, seen, start, end = [], set(), 0, 0

    def close() -> None:
        if seen and (z := bias + sum(known.get(x, 0.0) for x in seen)) >= 0:
            out.append({"start": start, "end": end, "score": float(1 / (1 + np.exp(-z)))})

    for token, a, b in sentences(text):
        if is_mark(token):
            close()
            seen = set()
        else:
            if not seen:
                start = a
            seen.add(token)
            end = b
    close()
    return out


def scored(docs: DataFrame, labels: DataFrame, held_out: int = 5, toxic: int = TOXIC_SAMPLE, clean: int = CLEAN_SAMPLE) -> DataFrame:
    """For documents (doc_id, text): doc_id, held_out, score, predicted, n_offending.

    Labels of documents whose crc32(doc_id) is divisible by ``held_out`` are never used. Null ids are not held out;
    repeated rows get equal scores; without labels of both kinds all scores are near 0; an empty table gives no rows.
    """
    model = fit(*sample(docs, labels, held_out, toxic, clean))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.coalesce(crc_mod("doc_id", held_out) == 0, F.lit(False)).alias("held_out"))
    made = with_scores(rows, model)
    return made.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("offending").cast("bigint").alias("n_offending")
    )


session.ship_with_jobs(__name__)
