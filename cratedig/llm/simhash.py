"""Near copies by SimHash fingerprints and pivot distance tables.

Every distinct fingerprint gets a table row of Hamming distances to fixed
reference fingerprints (pivots). By the triangle inequality two fingerprints
within ``radius`` bits differ by at most ``radius`` in every coordinate, so a
pair with a larger difference anywhere is discarded and only survivors are
compared. So that no pass meets all pairs, rows are dealt by blocks of bits:
with ``blocks`` blocks, two fingerprints within ``radius`` bits agree on some
``blocks - radius`` of them, hence meet in a bucket. Nothing is lost at any size.

A bucket's rows reach a task sorted and in pieces of at most ``PIECE`` rows. A
bucket of one piece is settled there; larger ones are settled by pairs of
pieces, spread over tasks. A task returns a forest of the links it finds, never
all of them, which leaves the components as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cratedig import session
from cratedig.llm.common import as_bytes, clear_of, content_key, keep, shuffle_parts
from cratedig.llm.components import components

BITS, RADIUS, BLOCKS, SHINGLE, SEED = 64, 3, 5, 3, 42
PIVOTS = 24
PIECE = 4096


def pivots(n: int = PIVOTS) -> np.ndarray:
    """The reference fingerprints: a fixed pseudo-random sequence (SplitMix64 from zero)."""
    out, state = [], 0
    for _ in range(n):
        state = (state + 0x9E3779B97F4A7C15) & (2**64 - 1)
        z = state
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & (2**64 - 1)
        out.append(z ^ (z >> 31))
    return np.array(out, np.uint64)


def fingerprint(data: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of a text's word shingles; a text without words has fingerprint zero."""
    from xxhash import xxh64_intdigest

    words = data.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashes = np.array([xxh64_intdigest(b" ".join(words[i : i + shingle]), seed) for i in range(n)], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 15):  # bounded memory for very long texts
        ones += np.unpackbits(hashes[at : at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, name: str, text: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """All columns of ``docs`` and the fingerprint as a long (its 64 bits, signed). A null text counts as empty."""
    (data,) = clear_of(docs, "data")
    given = docs.withColumn(data, as_bytes(text))
    schema = docs.withColumn(name, F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(v.as_py(), shingle, seed) for v in batch.column(batch.num_columns - 1)]
            cols = batch.columns[:-1] + [pa.array(np.array(made, np.uint64).view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, [*batch.schema.names[:-1], name])

    return given.mapInArrow(run, schema)


def bucket_keys(fp: str = "fp", blocks: int = BLOCKS, radius: int = RADIUS) -> Column:
    """One key for each choice of ``blocks - radius`` blocks: the choice's number hashed with the bits of its blocks."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << edges[b + 1]) - (1 << edges[b])) for b in chosen)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.struct(F.lit(number).alias("band"), F.col(fp).bitwiseAND(F.lit(signed)).alias("bits")))
    return F.array(*keys)


def forest(fps: np.ndarray, radius: int = RADIUS, refs: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (smaller, larger) that join the same fingerprints as all links within the radius would.

    Walks the graph of links breadth first. Each visited row is held against the
    rows not yet reached: coordinates of the pivot table first, then bits.
    """
    refs = pivots() if refs is None else refs
    table = np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)
    left = np.argsort(fps.view(np.int64), kind="stable")
    out = []
    while len(left) > 1:
        root, left, queue = left[0], left[1:], [left[0]]
        while queue and len(left):
            at = queue.pop()
            near = np.arange(len(left))
            for c in range(table.shape[1]):
                near = near[np.abs(table[left[near], c] - table[at, c]) <= radius]
                if len(near) == 0:
                    break
            near = near[np.bitwise_count(fps[left[near]] ^ fps[at]) <= radius]
            if len(near):
                found = left[near]
                out.extend((int(fps[root].view(np.int64)), int(v)) for v in fps[found].view(np.int64))
                queue.extend(found)
                left = np.delete(left, near)
    return out


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def links(fps: DataFrame, blocks: int = BLOCKS, radius: int = RADIUS, piece: int = PIECE) -> DataFrame:
    """Links (a, b) among distinct fingerprints (fp) whose components are those of all pairs within the radius."""
    dealt = fps.select("fp", F.explode(bucket_keys("fp", blocks, radius)).alias("k")).select("k.band", "k.bits", "fp")
    sorted_rows = dealt.repartition("band", "bits").sortWithinPartitions("band", "bits", "fp")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of the small buckets; pieces of the larger ones."""
        refs = pivots()
        held: tuple | None = None  # the bucket that is being gathered: key, rows, number of pieces sent
        names = ["a", "b", "band", "bits", "piece", "rows"]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
        found: list[tuple[int, int]] = []
        pieces: list[tuple] = []

        def close(bucket: tuple) -> None:
            (band, bits), rows, sent = bucket
            if sent:
                pieces.append((band, bits, sent, rows.tobytes()))
            elif len(rows) > 1:
                found.extend(forest(rows.view(np.uint64), radius, refs))

        def flush() -> pa.RecordBatch:
            rows = [(a, b, None, None, None, None) for a, b in found] + [(None, None, *p) for p in pieces]
            found.clear()
            pieces.clear()
            cols = list(zip(*rows)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        for batch in batches:
            band, bits, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if len(fp) == 0:
                continue
            turns = np.flatnonzero((band[1:] != band[:-1]) | (bits[1:] != bits[:-1])) + 1
            bounds = np.concatenate([[0], turns, [len(fp)]])
            for s, e in zip(bounds[:-1], bounds[1:]):
                key = (int(band[s]), int(bits[s]))
                if held and held[0] == key:
                    held = (key, np.concatenate([held[1], fp[s:e]]), held[2])
                else:
                    if held:
                        close(held)
                    held = (key, fp[s:e], 0)
                while len(held[1]) > piece:
                    pieces.append((*key, held[2], held[1][:piece].tobytes()))
                    held = (key, held[1][piece:], held[2] + 1)
            if len(found) > 50_000 or len(pieces) > 50:
                yield flush()
        if held:
            close(held)
        yield flush()

    first = keep(sorted_rows.mapInArrow(cut, "a long, b long, band int, bits long, piece int, rows binary"), "buckets")
    small = first.where("a is not null").select("a", "b")
    pieces = first.where("rows is not null").select("band", "bits", "piece", "rows")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = pivots()
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1)):
                both = np.unique(np.frombuffer(x.as_py() + y.as_py(), np.int64))
                yield _pairs(forest(both.view(np.uint64), radius, refs))

    twins = pieces.alias("x").join(pieces.alias("y"), ["band", "bits"]).where("x.piece < y.piece")
    spread = twins.select(F.col("x.rows").alias("x"), F.col("y.rows").alias("y")).repartition(shuffle_parts(fps.sparkSession))
    return small.union(spread.mapInArrow(meet, "a long, b long"))


def near_copies(rows: DataFrame, fp: str = "fp", blocks: int = BLOCKS, radius: int = RADIUS) -> DataFrame:
    """Adds ``root``, the smallest fingerprint (as a signed long) that is linked to the row's through any chain."""
    distinct = keep(rows.select(F.col(fp).alias("fp")).distinct(), "fingerprints")
    roots = components(links(distinct, blocks, radius))
    return rows.join(roots.select(F.col("node").alias(fp), "root"), fp, "left").withColumn("root", F.coalesce("root", fp))


def component_ids(docs: DataFrame, blocks: int = BLOCKS, radius: int = RADIUS) -> DataFrame:
    """For documents (doc_id, text): doc_id, fingerprint (16 hex digits), component_id (smallest id of the component).

    A null or empty text has fingerprint zero and is linked like any other. Rows with a null id take part and get the
    smallest id of their component, null if it has none. Repeated rows stay repeated. An empty table gives no rows.
    """
    rows = keep(with_fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "fp").select("doc_id", "fp"), "fingerprints")
    ids = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = keep(near_copies(ids), "roots")
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    per_fp = rooted.join(lowest, "root").select("fp", "component_id")
    return rows.join(per_fp, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with one document of each component: the one of smallest id (null ids last).

    Of several rows with that id the one of smallest content key stays, once. Only ids and keys of content are written;
    ``docs`` is read again, and rows are taken out by joins on the key, so no group is ever gathered. A row that
    stays and comes more than once in the table is reduced to one by a grouping of such rows alone.
    """
    (key,) = clear_of(docs, "key")
    content = content_key(docs, docs.columns)
    given = docs.select(F.col("doc_id").alias("doc_id"), "text", content.alias("key"))
    rows = keep(with_fingerprints(given, "fp").drop("text"), "fingerprints")
    who = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("key").alias("key"))
    rooted = keep(near_copies(rows.groupBy("fp").agg(F.min(who).alias("who"))), "roots")
    best = rooted.groupBy("root").agg(F.min("who").alias("who")).select(F.col("who.key").alias("key"))
    seen = keep(rows.groupBy("key").agg(F.count(F.lit(1)).alias("times")), "keys")
    stay = keep(best.join(seen, "key"), "stay")
    go = keep(seen.join(stay.where("times = 1"), "key", "left_anti").select(F.col("key").alias(key)), "go")
    several = keep(stay.where("times > 1").select(F.col("key").alias(key)), "several")
    keyed = docs.withColumn(key, content)
    once = keyed.join(several, key, "left_semi").dropDuplicates([key])
    # the rows that go have no bound, so they are never broadcast, whatever their size here
    return keyed.join(go.hint("merge"), key, "left_anti").unionByName(once).select(*docs.columns)


session.ship_with_jobs(__name__)
