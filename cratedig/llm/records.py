"""Token ids as length-delimited binary records, with an offset index for reads in any order.

A record file is a run of frames. A frame holds the payload's length (8 bytes),
the masked CRC-32 of these 8 bytes, the payload, the masked CRC-32 of the
payload, and one line feed. All numbers are little-endian. The payload is a
flag byte (1: the id is null, 2: ids take 4 bytes instead of 2), the document id
(8 bytes), the number of token ids (4 bytes) and the token ids.

Files are written by Spark's own writer and commit protocol, so lost executors
and repeated tasks leave no partial files, and any file system Spark knows will do.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cratedig import session
from cratedig.llm.common import Recent, as_bytes, shuffle_parts, worker_store

HEAD, BODY, TAIL = "<QI", "<BqI", "<I"
NULL_ID, WIDE = 1, 2
#: Distinct words in each of the two generations of a Python worker's cache.
CACHED_WORDS = 450_000
#: Texts that are in words at a time, each word an object: more would take as much memory as the cache.
TEXTS_AT_ONCE = 250

#: A word of letters up to U+00FF and then ASCII marks, without apostrophes.
LETTER, MARKS = rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])", rb"[!-&(-/:-@\[-`{-~]*"
PLAIN = re.compile(rb"(%s+)(%s)" % (LETTER, MARKS))
#: The characters by which such a tokenizer writes the bytes it has no printable character for.
UNPRINTABLE = {b: 256 + n for n, b in enumerate([*range(33), *range(127, 161), 173])}
#: How a tokenizer has to prepare texts for its model to be asked for the letters and the marks of such a word at once.
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

INDEX = "shard int, offset long, length long, doc_id long, n_tokens long, tokens_before long, ids_crc32 long"


def masked(crc: int) -> int:
    """Rotated and shifted, so that a checksum over data holding checksums stays sound."""
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, wide: bool) -> bytes:
    body = struct.pack(BODY, (doc_id is None) * NULL_ID | wide * WIDE, doc_id or 0, len(ids) // (4 if wide else 2)) + ids
    size = struct.pack("<Q", len(body))
    return size + struct.pack(TAIL, masked(zlib.crc32(size))) + body + struct.pack(TAIL, masked(zlib.crc32(body)))


def read_frame(data: memoryview, at: int) -> tuple[int | None, np.ndarray, int]:
    """The record at an offset and the offset of the next; raises ValueError when a checksum is wrong."""
    size, crc = struct.unpack_from(HEAD, data, at)
    if masked(zlib.crc32(data[at : at + 8])) != crc:
        raise ValueError(f"damaged length at offset {at}")
    start = at + struct.calcsize(HEAD)
    body = data[start : start + size]
    if len(body) != size or masked(zlib.crc32(body)) != struct.unpack_from(TAIL, data, start + size)[0]:
        raise ValueError(f"damaged record at offset {at}")
    flags, doc_id, n = struct.unpack_from(BODY, body)
    ids = np.frombuffer(body, "<u4" if flags & WIDE else "<u2", n, struct.calcsize(BODY))
    return (None if flags & NULL_ID else doc_id), ids, start + size + struct.calcsize(TAIL) + 1


def cuts_plain_words(settings: dict) -> bool:
    """Whether a plain word is lower-cased, cut into its letters and its marks, and given to the model byte by byte."""
    before = settings["pre_tokenizer"] or {}
    split, level = (before.get("pretokenizers") or [{}, {}])[:2]
    return (
        (settings["normalizer"] or {}).get("normalizers") == NORMALIZER
        and len(before.get("pretokenizers") or ()) == 2
        and split.get("pattern") == {"Regex": CUTS} and split.get("behavior") == "Removed" and split.get("invert") is True
        and level.get("type") == "ByteLevel" and not level.get("add_prefix_space") and not level.get("use_regex")
        and not settings["truncation"] and not settings["padding"]
        # an added token is found inside words, too
        and not any(re.fullmatch(rb"%s*%s" % (LETTER, MARKS), a["content"].encode()) for a in settings["added_tokens"])
    )


def encoder(tokenizer_path: str) -> tuple[Callable[[list[bytes]], list[bytes]], bool]:
    """A function from words to their packed ids, and whether an id takes four bytes.

    Plain words go straight to the library's model where that is the same: preparing a word takes most of the time.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    wide = tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16
    code = "I" if wide else "H"
    model = tokenizer.model.tokenize

    def pack(piece: bytes) -> bytes:
        text = piece.decode().lower()
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(UNPRINTABLE)
        return array(code, [t.id for t in model(text)]).tobytes()

    def whole(words: list[bytes]) -> list[bytes]:
        made = tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        return [array(code, e.ids).tobytes() for e in made]

    def encode(words: list[bytes]) -> list[bytes]:
        out, others = [], []
        for word in words:
            if found := PLAIN.fullmatch(word):
                out.append(pack(found[1]) + marks(found[2]) if found[2] else pack(found[1]))
            else:
                others.append(len(out))
                out.append(b"")
        for at, ids in zip(others, whole([words[i] for i in others])):
            out[at] = ids
        return out

    marks = lru_cache(4096)(pack)
    with open(tokenizer_path, encoding="utf-8") as file:
        return (encode if cuts_plain_words(json.load(file)) else whole), wide


def _word_ids(tokenizer_path: str):
    """The encoder and the cache from word to packed ids of this worker process."""
    held = worker_store("records").get(tokenizer_path)
    if held is None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        held = worker_store("records")[tokenizer_path] = (*encoder(tokenizer_path), Recent(CACHED_WORDS))
    return held


def ids_of(texts: list[bytes], cache: Recent, encode: Callable[[list], list]) -> Iterator[bytes]:
    """The packed ids of each text."""
    split = [t.split() for t in texts]
    known = cache.ensure(set().union(*split), encode)
    return (b"".join(map(known.__getitem__, words)) for words in split)


def frames(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """One frame for each row of (doc_id, data), in the given row order.

    The tokenizer drops white space before it looks at letters, so ids of a text are those of its words
    in turn, and each distinct word is passed to the library once for as long as the cache holds it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, wide, cache = _word_ids(tokenizer_path)
        end = array("I" if wide else "H", [end_id]).tobytes()

        for batch in batches:
            for piece in _slices(batch, TEXTS_AT_ONCE):
                made = ids_of(piece.column(1).to_pylist(), cache, encode)
                out = [frame(doc_id, ids + end, wide) for doc_id, ids in zip(piece.column(0).to_pylist(), made)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    return docs.mapInArrow(run, "frame binary")


def _slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, parts: int | None = None) -> None:
    """Writes one record per row of ``docs`` (doc_id, text) in ascending id order: part files in order, rows in order.

    A null text counts as empty and gets the end id alone. Null ids come last, rows of one id in the order of their
    text's hash, so a much repeated id spreads over files. An empty table gives a folder without records.
    """
    parts = parts or shuffle_parts(docs.sparkSession)
    keys = [F.col("doc_id").asc_nulls_last(), F.col("tie").asc()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes().alias("data"))
    ordered = rows.withColumn("tie", F.xxhash64("data")).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    made = frames(ordered.select("doc_id", "data"), tokenizer_path, end_id)
    made.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", "\n").text(f"{path}/records")


def _shards(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records")
    return files.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("shard"), "content")


def write_index(spark: SparkSession, path: str) -> DataFrame:
    """Reads all records, checks them and writes where each lies: the index for reads in any order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = memoryview(content.as_buffer())
                rows: list[tuple] = []
                at = before = 0
                while at < len(data):
                    doc_id, ids, then = read_frame(data, at)
                    rows.append((shard, at, then - at, doc_id, len(ids), before, zlib.crc32(ids.astype("<u4").tobytes())))
                    before += len(ids)
                    at = then
                    if len(rows) == 10_000 or at >= len(data):
                        cols = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32()] + [pa.int64()] * 6)]
                        yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in INDEX.split(", ")])
                        rows = []

    _shards(spark, path).mapInArrow(run, INDEX).write.mode("overwrite").parquet(f"{path}/index")
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index with ``start``, the number of ids in all records before; sums over files use one row per file."""
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = index.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select("shard", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    return index.join(starts, "shard").withColumn("start", F.col("ahead") + F.col("tokens_before")).drop("ahead")


def read_shuffled(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """All records (doc_id, ids) in an order set by the seed.

    The index decides the order; each file is opened once and its records cut out at the index's offsets.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, offsets, keys in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = memoryview(content.as_buffer())
                for at in range(0, len(offsets), 1000):
                    got = [read_frame(data, o) for o in offsets[at : at + 1000]]
                    cols = [
                        pa.array(keys[at : at + 1000], pa.int64()),
                        pa.array([g[0] for g in got], pa.int64()),
                        pa.array([g[1].astype("<i4") for g in got], pa.list_(pa.int32())),
                    ]
                    yield pa.RecordBatch.from_arrays(cols, ["turn", "doc_id", "ids"])

    index = spark.read.schema(INDEX).parquet(f"{path}/index").withColumn("turn", F.xxhash64("shard", "offset", F.lit(seed)))
    by_file = index.groupBy("shard").agg(F.collect_list(F.struct("offset", "turn")).alias("at"))  # as many as a file holds
    rows = _shards(spark, path).join(by_file, "shard").select("content", "at.offset", "at.turn")
    return rows.mapInArrow(cut, "turn long, doc_id long, ids array<int>").orderBy("turn", "doc_id").drop("turn")



session.ship_with_jobs(__name__)
