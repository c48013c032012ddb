"""Language-model scores from a log-frequency Bloom filter.

Words and neighbouring pairs of the training texts are counted exactly. A filter
holds a pair once for every level up to the quantised logarithm of its count;
asking for level 1, 2, ... until a miss gives the count back, never too low and
rarely too high. Each shard has a region with all of its pairs, those seen once
too; its bits grow with them. Only frequent pairs (``OFTEN``, at most ``MAX_BITS``)
are also in a filter that is sent to every worker. Pairs that this one doesn't hold
are asked for at their shard, once for each block of documents.

Texts are split into words and hashed once: blocks of documents, as numbers of
their words, are a written table from which n-grams are counted, asked for and
scored. Counts travel packed: a task sends each shard one row of sorted hashes and
counts, so the shuffle carries few rows and a shard is merged in numpy. The number
of shards follows the number of tokens, so a shard holds a bounded share of the
n-grams, and a hot word is one entry per task.

Words are identified by 64-bit hashes. The exact unigram base score needs every
word's count, so words need no filter: the counts of the most frequent (at most
``FREQUENT``) are broadcast, the others come from their shard with the answers. The
model takes the quantised logarithm of these counts too.

How much a pair weighs against its second word alone (``PRIORS``) is fitted: each
training document is scored as if it hadn't been counted, and the best weight taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F

from cratedig import session
from cratedig.llm.common import as_bytes, crc_mod, keep

FREQUENT = 1 << 19
MAX_BITS = 1 << 27
#: Pairs with this share of the tokens are frequent, whatever the input's size; there can be no more than 1 / OFTEN.
OFTEN = 2.0**-20
BITS_PER_LEVEL = 12
PROBES = 4
BASE = 1.5
REGIONS = 256
#: Weights of the word's own probability, as counts of the pair's first word, from which one is chosen.
PRIORS = (3.0, 10.0, 30.0, 100.0, 300.0, 1000.0)
#: Tokens for each shard, at most about: what is asked is a row for each block and shard, so shards should be few.
SHARD_TOKENS = 2_000_000
ADD = 0.1
#: Tokens that a task gathers before it sends them on.
FLUSH = 1_500_000
#: Bytes of text whose documents ask the shards together.
BLOCK = 5 << 20
#: Tokens whose scores are computed together.
STEP = 1 << 18
END = np.uint64(0x5BD1E9955BD1E995)
HIST = 256


@dataclass
class Model:
    """What workers need: totals, the frequent words, and the filter of frequent pairs, its regions one after another."""

    tokens: int
    words: int
    frequent: np.ndarray
    frequent_counts: np.ndarray
    least_pair_level: int
    filter: np.ndarray
    region_bits: int


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """44 bits, which is more than the filter tells apart."""
    return mix(first * np.uint64(0x9E3779B97F4A7C15) + (second ^ np.uint64(0xD6E8FEB86659FD93))) >> np.uint64(20)


def packed(x: np.ndarray, width: int) -> bytes:
    """Whole numbers of at most ``width`` bytes: how many, then their bytes in planes, compressed."""
    planes = np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8).T[:width].tobytes()
    return np.array([len(x)], "<u4").tobytes() + pa.compress(planes, codec="zstd", asbytes=True) if len(x) else b""


def unpacked(data: bytes, width: int) -> np.ndarray:
    size = int(np.frombuffer(data[:4], "<u4")[0]) if data else 0
    out = np.zeros((size, 8), np.uint8)
    if size:
        planes = pa.decompress(data[4:], decompressed_size=width * size, codec="zstd", asbytes=True)
        out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, size).T
    return out.view("<u8").reshape(-1)


def packed_pairs(x: np.ndarray) -> bytes:
    """Pair hashes in ascending order, as differences."""
    return packed(np.diff(x, prepend=np.uint64(0)), 6)


def unpacked_pairs(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, 6), dtype=np.uint64)


def shard_of(x: np.ndarray, shards: int) -> np.ndarray:
    return ((x >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)


def level(counts: np.ndarray) -> np.ndarray:
    """Quantised logarithm, 1 for a count of 1."""
    return (np.log(counts) / np.log(BASE) + 1e-9).astype(np.int64) + 1


def level_counts() -> np.ndarray:
    """The count that a level stands for: the middle of the whole numbers it covers."""
    out = [0.0]
    for q in range(1, HIST):
        low, high = np.ceil(BASE ** (q - 1) - 1e-9), np.ceil(BASE**q - 1e-9) - 1
        out.append(float((low + max(low, high)) / 2))
    return np.array(out)


def hashes(words: list[bytes]) -> list[int]:
    from xxhash import xxh64_intdigest

    return [xxh64_intdigest(w) for w in words]


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word hashes of some texts, the tokens as indexes into them (each text ends with END), and text lengths."""
    split = [t.lower().split() for t in texts]
    distinct = list(set().union(*split))
    index = {w: i for i, w in enumerate(distinct)}
    lengths = np.fromiter((len(s) + 1 for s in split), np.int64, len(split))
    ids = np.full(int(lengths.sum()), len(distinct), np.int64)
    inner = np.ones(len(ids), bool)
    inner[np.cumsum(lengths) - 1] = False
    ids[inner] = np.fromiter((index[w] for s in split for w in s), np.int64, int(inner.sum()))
    return np.append(np.array(hashes(distinct), np.uint64), END), ids, lengths


def with_counts(x: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in ascending order and the sum of their counts."""
    order = np.argsort(x, kind="stable")
    x = x[order]
    starts = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.empty(0, np.int64)
    sums = np.diff(np.append(starts, len(x))) if counts is None else np.add.reduceat(counts[order], starts) if len(x) else counts
    return x[starts], sums.astype(np.int64)


def by_shard(x: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that deals values to shards and each shard's bounds in it."""
    at = shard_of(x, shards)
    order = np.argsort(at, kind="stable")
    return order, np.searchsorted(at[order], np.arange(shards + 1))


def batches_of(batches: Iterator[pa.RecordBatch], column: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a few megabytes of text."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(column)).to_numpy(zero_copy_only=False) if batch.num_rows else np.empty(0)
        cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // size)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if b > a:
                yield batch.slice(a, b - a)


PACKED = "shard int, words binary, counts binary, pairs binary, pair_counts binary"
COUNTED = f"{PACKED}, n_tokens long, n_words long, word_levels array<long>, pair_levels array<long>, bits binary"


def region(x: np.ndarray, top: np.ndarray) -> np.ndarray:
    """A filter of n-grams up to their levels, as packed bits, as large as they need."""
    bits = np.zeros(max(64, -(-int(top.sum()) * BITS_PER_LEVEL // 64) * 64), bool)
    put(bits, x, top)
    return np.packbits(bits, bitorder="little")


def put(bits: np.ndarray, x: np.ndarray, top: np.ndarray) -> None:
    for step in range(1, int(top.max(initial=0)) + 1):
        x, top = x[top >= step], top[top >= step]
        for probe in range(PROBES):
            bits[places(x, step, probe, len(bits))] = True


def counted(blocks: DataFrame, shards: int) -> DataFrame:
    """Exact word counts, the region of all pairs (``bits``), and the counts of pairs seen twice or more, from which the
    frequent ones are taken: one row per shard, as a written table.

    ``blocks`` are those of BLOCKS; documents that are held out are not counted.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list = []
        pairs: list = []
        held = 0

        def gathered() -> pa.RecordBatch:
            w, wc = with_counts(np.concatenate([x for x, _ in words]), np.concatenate([c for _, c in words]))
            p, pc = with_counts(np.concatenate(pairs))
            cols = [[], [], [], [], []]
            (wo, wb), (po, pb) = by_shard(w, shards), by_shard(p, shards)
            for s in range(shards):
                a, b = wo[wb[s] : wb[s + 1]], po[pb[s] : pb[s + 1]]
                if len(a) or len(b):
                    for col, v in zip(cols, (s, w[a].tobytes(), wc[a].astype("<u4").tobytes(), packed_pairs(p[b]), packed(pc[b], 4))):
                        col.append(v)
            types = [pa.int32()] + [pa.binary()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [c.split()[0] for c in PACKED.split(", ")])

        for batch in batches:
            for block_words, block_ids, lengths, out in zip(*batch.columns):
                lengths, out = lengths.as_py(), out.as_py()
                known, ids = np.frombuffer(block_words.as_buffer(), "<u8"), unpacked(block_ids.as_py(), 4).astype(np.int64)
                train = np.repeat(~np.array(out, bool), lengths)
                if not train.any():
                    continue
                n = np.bincount(ids[train], minlength=len(known))
                words.append((known[n > 0], n[n > 0]))
                h = known[ids]
                pairs.append(pair_hash(np.concatenate([[END], h[:-1]]), h)[train])
                held += len(pairs[-1])
                if held >= FLUSH:
                    yield gathered()
                    words, pairs, held = [], [], 0
                    pa.default_memory_pool().release_unused()
        if held:
            yield gathered()

    def merge(table: pa.Table) -> pa.Table:
        def column(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(table[name].to_pylist()), kind)

        w, wc = with_counts(column("words", "<u8"), column("counts", "<u4").astype(np.int64))
        pairs = [unpacked_pairs(x) for x in table["pairs"].to_pylist()]
        times = [unpacked(x, 4) for x in table["pair_counts"].to_pylist()]
        p, pc = with_counts(np.concatenate(pairs), np.concatenate(times).astype(np.int64))
        pl = level(pc)
        bits = region(p, pl)
        p, pc, pl = p[pc > 1], pc[pc > 1], pl[pc > 1]
        row = [
            table["shard"][0].as_py(), w.tobytes(), wc.astype("<u8").tobytes(), p.tobytes(), pc.astype("<u8").tobytes(), int(wc.sum()), len(w),
            np.bincount(level(wc), minlength=HIST).tolist(), np.bincount(pl, minlength=HIST).tolist(), bits.tobytes(),
        ]
        longs = pa.list_(pa.int64())
        types = [pa.int32()] + [pa.binary()] * 4 + [pa.int64()] * 2 + [longs] * 2 + [pa.binary()]
        return pa.table([pa.array([v], t) for v, t in zip(row, types)], names=[c.split()[0] for c in COUNTED.split(", ")])

    given = blocks.select("words", "ids", "lengths", "held_out")
    return keep(given.mapInArrow(send, PACKED).groupBy("shard").applyInArrow(merge, COUNTED), "counts")


def _level_sums(shards: DataFrame, column: str) -> np.ndarray:
    """A histogram summed over all shards: at most HIST numbers."""
    rows = shards.select(F.posexplode(column).alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(HIST, np.int64)
    for r in rows:
        out[r["at"]] = r["n"]
    return out


def fitted(shards: DataFrame, n_shards: int, max_bits: int = MAX_BITS, frequent: int = FREQUENT) -> Model:
    """The model from the counted shards. The driver gets totals, at most ``frequent`` words and ``max_bits`` bits."""
    n, v = shards.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    word_levels, pair_levels = (_level_sums(shards, c) for c in ("word_levels", "pair_levels"))
    above = np.cumsum(word_levels[::-1])[::-1]
    q = np.arange(HIST)
    spent = lambda least, hist: int((q * hist)[least:].sum())
    least_word = int(np.argmax(above <= frequent))
    least_pair = max(2, int(level(np.array([max(1.0, n * OFTEN)]))[0]))
    while spent(least_pair, pair_levels) * BITS_PER_LEVEL > max_bits and least_pair < HIST - 1:
        least_pair += 1
    wanted = spent(least_pair, pair_levels) * BITS_PER_LEVEL
    region_bits = max(64, -(-min(max_bits, wanted) // REGIONS // 64) * 64)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w, c in zip(batch.column(0), batch.column(1)):
                w, c = np.frombuffer(w.as_py(), "<u8"), np.frombuffer(c.as_py(), "<u8").astype(np.int64)
                often = level(c) >= least_word
                yield pa.RecordBatch.from_arrays([pa.array([w[often].tobytes()]), pa.array([c[often].astype("<u8").tobytes()])], ["w", "c"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        regions: dict[int, np.ndarray] = {}
        for batch in batches:
            for shard, p, pc in zip(*(c.to_pylist() for c in batch.columns)):
                bits = regions.setdefault(shard % REGIONS, np.zeros(region_bits, bool))
                x, top = np.frombuffer(p, "<u8"), level(np.frombuffer(pc, "<u8").astype(np.int64))
                put(bits, x[top >= least_pair], top[top >= least_pair])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(regions), pa.int32()), pa.array([np.packbits(b, bitorder="little").tobytes() for b in regions.values()], pa.binary())],
            ["region", "bits"],
        )

    def unite(table: pa.Table) -> pa.Table:
        bits = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in table["bits"].to_pylist()])
        return pa.table([table["region"][:1], pa.array([bits.tobytes()])], names=["region", "bits"])

    often = shards.select("words", "counts").mapInArrow(pick, "w binary, c binary").collect()
    h = np.frombuffer(b"".join(r["w"] for r in often), "<u8")
    c = np.frombuffer(b"".join(r["c"] for r in often), "<u8").astype(np.int64)
    order = np.argsort(h)
    made = shards.select("shard", "pairs", "pair_counts").mapInArrow(build, "region int, bits binary")
    whole = np.zeros((REGIONS, region_bits // 8), np.uint8)
    for r in made.groupBy("region").applyInArrow(unite, "region int, bits binary").collect():
        whole[r["region"]] = np.frombuffer(r["bits"], np.uint8)
    return Model(n, v, h[order], c[order], least_pair, whole.reshape(-1), region_bits)


def places(x: np.ndarray, step: int | np.ndarray, probe: int, region_bits: int) -> np.ndarray:
    """Bit of an n-gram's region for a level and a probe."""
    return (mix(x + np.uint64(step * 0x632BE59BD9B4E019 + probe * 0xD1342543DE82EF95 & 2**64 - 1)) % np.uint64(region_bits)).astype(np.int64)


def levels_at(bits: np.ndarray, region_bits: int, x: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """The level of each n-gram in packed bits: probes of rising levels until one misses."""
    out = np.zeros(len(x), np.int64)
    at = np.arange(len(x))
    step = 0
    while len(at):
        step += 1
        for probe in range(PROBES):
            bit = places(x[at], step, probe, region_bits)
            if start is not None:
                bit += start[at]
            at = at[(bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1]
        out[at] = step
        if step == HIST - 1:
            break
    return out


def levels_in(model: Model | SimpleNamespace, x: np.ndarray, n_shards: int) -> np.ndarray:
    """The level of each n-gram in the filter that every worker has."""
    return levels_at(model.filter, model.region_bits, x, (shard_of(x, n_shards) % REGIONS) * model.region_bits)


@dataclass
class Asked:
    """What a block knows by the broadcast model, and what it asks: the words and pairs in the order of their shards."""

    counts: np.ndarray
    word_at: np.ndarray
    word_bounds: np.ndarray
    levels: np.ndarray
    of_token: np.ndarray
    pair_at: np.ndarray
    pair_bounds: np.ndarray
    pairs: np.ndarray


def asked(m: SimpleNamespace, known: np.ndarray, ids: np.ndarray, shards: int) -> Asked:
    """Depends on the block and the model alone, so that answers can be put in place by asking again.

    ``counts`` are of words (0 if rare), ``levels`` of the block's distinct pairs, to which ``of_token`` points.
    """
    at = np.minimum(np.searchsorted(m.frequent, known), max(0, len(m.frequent) - 1))
    often = (m.frequent[at] == known) if len(m.frequent) else np.zeros(len(known), bool)
    counts = np.where(often, m.frequent_counts[at] if len(m.frequent) else 0, 0)
    before = np.concatenate([[len(known) - 1], ids[:-1]])
    pairs, of_token = np.unique(pair_hash(known[before], known[ids]), return_inverse=True)
    levels = levels_in(m, pairs, shards)
    levels[levels < m.least_pair_level] = 0  # the filter has no such pairs
    words, others = np.flatnonzero(~often), np.flatnonzero(levels == 0)
    (wo, wb), (po, pb) = by_shard(known[words], shards), by_shard(pairs[others], shards)
    return Asked(counts, words[wo], wb, levels, of_token, others[po], pb, pairs)


BLOCKS = "block long, words binary, ids binary, lengths array<long>, doc_id array<long>, held_out array<boolean>"
ASKED = "shard int, block long, words binary, pairs binary"
ANSWERS = "block long, shard int, counts binary, levels binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, scores array<double>, unseen array<double>"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents, as rows of BLOCKS, from (data, doc_id, held_out). A longer document is a block of its own."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 33
    longs = pa.list_(pa.int64())
    types = [pa.int64(), pa.binary(), pa.binary(), longs, longs, pa.list_(pa.bool_())]
    for part in batches_of(batches, 0, BLOCK):
        known, ids, lengths = tokens(part.column(0).to_pylist())
        # frequent words get small numbers; END stays the last
        order = np.append(np.argsort(-np.bincount(ids, minlength=len(known))[:-1], kind="stable"), len(known) - 1)
        place = np.empty(len(known), np.int64)
        place[order] = np.arange(len(known))
        known, ids = known[order], place[ids]
        row = [number, known.tobytes(), packed(ids, 4), lengths.tolist(), part.column(1).to_pylist(), part.column(2).to_pylist()]
        number += 1
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], _names(BLOCKS))
        pa.default_memory_pool().release_unused()


def scores(docs: DataFrame, held_out: int = 10, max_bits: int = MAX_BITS, frequent: int = FREQUENT) -> DataFrame:
    """Scores of all documents (doc_id, text) by a model of those whose crc32(doc_id) is not divisible by ``held_out``.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, prior. Null and empty texts are the end token
    alone. A null id counts as training. Rows are scored one by one, repeated ones too; a very long text is a block of its own
    and is held by one task; an empty table gives no rows, and without training texts every word has probability one tenth of
    nothing's count, as the formula says. ``max_bits`` and ``frequent`` bound what is broadcast, not what is known. ``prior``
    is the fitted weight. Other columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    part_of = F.coalesce(crc_mod("doc_id", held_out) == 0, F.lit(False))
    given = docs.select(as_bytes().alias("data"), F.col("doc_id").cast("long").alias("doc_id"), part_of.alias("held_out"))
    blocks = keep(given.mapInArrow(split, BLOCKS), "blocks")
    n_tokens = blocks.select(F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()[0] or 0
    shards = REGIONS * max(1, -(-n_tokens // (REGIONS * SHARD_TOKENS)))
    table = counted(blocks, shards)
    model = fitted(table, shards, max_bits, frequent)
    sent = spark.sparkContext.broadcast(vars(model))  # plain values: workers need no import to read them
    n, v = model.tokens, model.words
    floor = np.log10(n + ADD * (v + 1))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = SimpleNamespace(**sent.value)
        types = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        for batch in batches:
            for block, words, ids in zip(*batch.columns):
                block, known = block.as_py(), np.frombuffer(words.as_buffer(), "<u8")
                a = asked(m, known, unpacked(ids.as_py(), 4).astype(np.int64), shards)
                words, pairs = known[a.word_at], a.pairs[a.pair_at]
                full = np.flatnonzero((np.diff(a.word_bounds) > 0) | (np.diff(a.pair_bounds) > 0)).tolist()
                of_shard = lambda x, b: [x[b[s] : b[s + 1]] for s in full]  # noqa: B023, E731
                parts = [[w.tobytes() for w in of_shard(words, a.word_bounds)], [packed_pairs(x) for x in of_shard(pairs, a.pair_bounds)]]
                cols = [full, [block] * len(full), *parts]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], _names(ASKED))

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        """Counts of words and levels of pairs: all blocks' questions at once, and a row for each block."""
        asked_words = [np.frombuffer(x.as_buffer(), "<u8") for x in left["words"].combine_chunks()]
        asked_pairs = [unpacked_pairs(x.as_py()) for x in left["pairs"].combine_chunks()]
        w, p = (np.concatenate([np.empty(0, np.uint64), *x]) for x in (asked_words, asked_pairs))
        c, top = np.zeros(len(w), "<u8"), np.zeros(len(p), np.uint8)
        if right.num_rows:
            words, counts = (np.frombuffer(right[c][0].as_py(), "<u8") for c in ("words", "counts"))
            bits = np.frombuffer(right["bits"][0].as_py(), np.uint8)
            if len(words):
                at = np.minimum(np.searchsorted(words, w), len(words) - 1)
                c = np.where(words[at] == w, counts[at], np.uint64(0)).astype("<u8")
            top = levels_at(bits, 8 * len(bits), p).astype(np.uint8)
        parts = [[x[b - n : b].tobytes() for b, n in zip(np.cumsum(sizes), sizes)] for x, sizes in ((c, [len(x) for x in asked_words]), (top, [len(x) for x in asked_pairs]))]
        return pa.table([left["block"], left["shard"], *(pa.array(x, pa.binary()) for x in parts)], names=_names(ANSWERS))

    def some_at_a_time(lengths: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Token and document ranges of about STEP tokens, so that few numbers a token are held."""
        ends = np.cumsum(lengths)
        cuts = [0, *(np.flatnonzero(np.diff(ends // STEP)) + 1).tolist(), len(lengths)]
        for c, d in zip(cuts, cuts[1:]):
            if d > c:
                yield int(ends[c] - lengths[c]), int(ends[d - 1]), c, d

    def scored_part(known: np.ndarray, ids: np.ndarray, a: Asked, of_token: np.ndarray, lengths: np.ndarray, held: np.ndarray) -> tuple:
        """Base scores, known tokens, and scores by prior: with the document counted, and as if training documents hadn't been."""
        rows, size = np.repeat(np.arange(len(lengths)), lengths), len(lengths)
        base = np.bincount(rows, (np.log10(a.counts + ADD) - floor)[ids], size)
        n_known = np.bincount(rows, (a.counts > 0)[ids], size).astype(np.int64)
        middle = level_counts()
        single = np.where(a.counts > 0, middle[level(np.maximum(a.counts, 1))], 0.0)
        first, second = single[np.concatenate([[len(known) - 1], ids[:-1]])], single[ids]
        pair = np.minimum(middle[a.levels][of_token], np.minimum(first, second))
        own = (second + ADD) / (n + ADD * (v + 1))
        first = np.maximum(first, pair)
        by_prior = [np.bincount(rows, np.log10((pair + k * own) / (first + k)), size) for k in PRIORS]
        pair = np.maximum(pair - 1, 0.0)
        first = np.maximum(first - 1, pair)
        unseen = [np.where(held, 0.0, np.bincount(rows, np.log10((pair + k * own) / (first + k)), size)) for k in PRIORS]
        return base, n_known, np.stack(by_prior, 1), np.stack(unseen, 1)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        m = SimpleNamespace(**sent.value)
        doubles = pa.list_(pa.float64())
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), doubles, doubles]
        made = [pa.table([pa.array([], t) for t in types], names=_names(SCORES))]
        for _, words, ids, lengths, doc_ids, held in zip(*(left[c].to_pylist() for c in _names(BLOCKS))):
            known, ids, lengths = np.frombuffer(words, "<u8"), unpacked(ids, 4).astype(np.int64), np.array(lengths, np.int64)
            a = asked(m, known, ids, shards)
            for shard, c, top in zip(*(right[x].to_pylist() for x in ("shard", "counts", "levels"))):
                a.counts[a.word_at[a.word_bounds[shard] : a.word_bounds[shard + 1]]] = np.frombuffer(c, "<u8").astype(np.int64)
                a.levels[a.pair_at[a.pair_bounds[shard] : a.pair_bounds[shard + 1]]] = np.frombuffer(top, np.uint8)
            parts = [scored_part(known, ids[a_:b_], a, a.of_token[a_:b_], lengths[c_:d_], np.array(held[c_:d_], bool)) for a_, b_, c_, d_ in some_at_a_time(lengths)]
            base, n_known, by_prior, unseen = (np.concatenate(x) for x in zip(*parts))
            cols = [doc_ids, held, lengths, n_known, base, by_prior.tolist(), unseen.tolist()]
            made.append(pa.table([pa.array(c, t) for c, t in zip(cols, types)], names=_names(SCORES)))
        return pa.concat_tables(made)

    questions = blocks.select("block", "words", "ids").mapInArrow(ask, ASKED)
    answers = questions.groupBy("shard").cogroup(table.select("shard", "words", "counts", "bits").groupBy("shard")).applyInArrow(answer, ANSWERS)
    made = keep(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, SCORES), "scores")
    sums = made.select(*(F.coalesce(F.sum(F.col("unseen")[i]), F.lit(0.0)) for i in range(len(PRIORS)))).first()
    best = max(range(len(PRIORS)), key=lambda i: (sums[i], -i))
    return made.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score",
        F.col("scores")[best].alias("score"), F.lit(PRIORS[best]).alias("prior"),
    )


session.ship_with_jobs(__name__)
