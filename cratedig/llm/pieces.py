"""SentencePiece encoding of merge-type (BPE) models by backtracking, and decoding.

The merge order of such a model is fixed by piece scores, so a sequence of
pieces is the model's own result exactly when every neighbouring pair stays as
it is if the two are merged again on their own. Encoding therefore walks from
left to right over the longest pieces that an Aho-Corasick automaton finds, and
takes the next shorter one where a pair does not hold. Positions from which no
way led on are marked in a bit field and not tried again.

Texts are cut where no piece can cross: a piece has the space mark only at its
start or consists of space marks, so each run of spaces begins a new unit. The
model is checked for that when it is loaded; equal units are encoded once.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cratedig import session
from cratedig.llm.common import Recent, as_bytes, clear_of, worker_store

SPACE = "▁"
#: Distinct units in each of the two generations of a Python worker's cache, and pairs it has checked.
CACHED_UNITS = 250_000
CACHED_PAIRS = 500_000
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6


class Pieces:
    """A merge-type model as lookup tables."""

    def __init__(self, model_path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_path, "rb") as f:
            model.ParseFromString(f.read())
        norm, spec = model.normalizer_spec, model.trainer_spec
        kinds = {p.type for p in model.pieces}
        if spec.model_type != spec.BPE or not spec.byte_fallback or spec.treat_whitespace_as_suffix or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only merge-type models with byte fallback, leading space marks and no user pieces are covered")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or not norm.add_dummy_prefix:
            raise ValueError("only the identity normalization with a leading space is covered")
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte = {}
        for i, p in enumerate(model.pieces):
            if p.type == NORMAL:
                self.score[p.piece], self.id[p.piece] = p.score, i
            elif p.type == BYTE:
                self.byte[int(p.piece[3:5], 16)] = i
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("a piece holds a space mark behind its start")
        self.begin, self.end = spec.bos_id, spec.eos_id
        self.found = ahocorasick.Automaton()
        for p in self.id:
            self.found.add_word(p, (len(p), self.id[p]))
        self.found.make_automaton()
        self.text = {i: p for p, i in self.id.items()}
        self.holds: dict[int, bool] = {}
        self.library = SentencePieceProcessor(model_file=model_path)

    def merged(self, text: str) -> list[str]:
        """Plain merging: the best-scored neighbouring pair first, the leftmost of equals."""
        parts: list[str | None] = list(text)
        ahead = list(range(1, len(parts) + 1))
        back = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = ahead[i]
            if j < len(parts) and (made := parts[i] + parts[j]) in self.score:
                heapq.heappush(heap, (-self.score[made], i, made))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, made = heapq.heappop(heap)
            if parts[i] is None or (j := ahead[i]) >= len(parts) or parts[i] + parts[j] != made:
                continue
            parts[i], parts[j], ahead[i] = made, None, ahead[j]
            if ahead[i] < len(parts):
                back[ahead[i]] = i
            if back[i] >= 0:
                offer(back[i])
            offer(i)
        return [p for p in parts if p is not None]

    def pair_holds(self, left: int, right: int) -> bool:
        """Whether two neighbouring pieces stay as they are when merged again; ``left`` negative: a piece by itself."""
        pair = [self.text[right]] if left < 0 else [self.text[left], self.text[right]]
        if len(self.holds) > CACHED_PAIRS:
            self.holds.clear()
        known = self.holds[left << 20 | right] = self.merged("".join(pair)) == pair
        return known

    def ids(self, unit: str) -> list[int]:
        """The ids of a unit; a character without a piece becomes its bytes."""
        size, holds = len(unit), self.holds
        ways: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]
        for last, way in self.found.iter(unit):
            ways[last - way[0] + 1].append(way)  # longer matches end later: ascending
        failed = bytearray((size >> 3) + 1)
        taken: list[int] = []
        path: list[int] = []  # the choice made at each step; -1: bytes of a character without a piece
        at, here = 0, ways[0]
        choice = len(here) - 1
        while at < size:
            if not here:  # no piece begins here, hence none crosses
                taken.append(-1 - at)
                path.append(-1)
                at += 1
                here = ways[at]
                choice = len(here) - 1
                continue
            before = taken[-1] if taken and path[-1] >= 0 else -1
            while choice >= 0:
                length, way = here[choice]
                then = at + length
                if not failed[then >> 3] >> (then & 7) & 1:
                    if (held := holds.get(before << 20 | way)) is None:
                        held = self.pair_holds(before, way)
                    if held:
                        break
                choice -= 1
            if choice >= 0:
                taken.append(way)
                path.append(choice)
                at = then
                here = ways[at]
                choice = len(here) - 1
            else:
                failed[at >> 3] |= 1 << (at & 7)
                if before < 0:
                    raise ValueError(f"no valid way through {unit!r}")
                at -= len(self.text[taken.pop()])
                here = ways[at]
                choice = path.pop() - 1
        if min(path, default=0) >= 0:
            return taken
        return [i for t in taken for i in ([t] if t >= 0 else map(self.byte.__getitem__, unit[-1 - t].encode("utf-8")))]


def _pieces(model_path: str) -> tuple[Pieces, Recent]:
    held = worker_store("pieces").get(model_path)
    if held is None:
        held = worker_store("pieces")[model_path] = (Pieces(model_path), Recent(CACHED_UNITS))
    return held


def cut(text: str) -> list[str]:
    """The units of a text: words that follow one space, without it; or, where spaces stand together, runs with theirs.

    The model puts one space in front of a text that isn't empty.
    """
    if not text:
        return []
    parts = text.replace(SPACE, " ").split(" ")
    if "" not in parts:
        return parts
    units = re.findall(r" +[^ ]*", " " + text.replace(SPACE, " "))
    return [u[1:] if u[1:2] not in ("", " ") else u for u in units]


def encode(texts: list[str], model_path: str) -> list[array]:
    """The ids of each text, without begin and end ids."""
    pieces, cache = _pieces(model_path)

    def make(units: list[str]) -> Iterator[bytes]:
        for u in units:
            marked = u.replace(" ", SPACE) if u[:1] == " " else SPACE + u
            yield array("I", pieces.ids(marked)).tobytes()

    split = [cut(t) for t in texts]
    known = cache.ensure(set().union(*split), make)
    return [array("i", b"".join(map(known.__getitem__, units))) for units in split]


def with_pieces(docs: DataFrame, model_path: str, text: str = "text", batch: int = 500) -> DataFrame:
    """The columns of ``docs`` other than the text, and ids (array<int>, with begin and end ids) and decoded.

    A null text counts as empty and gets the begin and end ids; its decoding is empty. Invalid UTF-8 is read with
    replacement characters. Repeated rows stay repeated; an empty table gives no rows.
    """
    data, ids, decoded = clear_of(docs, "data", "ids", "decoded")
    rest = [c for c in docs.columns if c != text]
    given = docs.withColumn(data, as_bytes(text)).select(*rest, data)
    schema = docs.select(*rest).withColumn(ids, F.lit(None).cast("array<int>")).withColumn(decoded, F.lit(None).cast("string")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, _ = _pieces(model_path)
        for whole in batches:
            for at in range(0, whole.num_rows, batch):
                part = whole.slice(at, batch)
                texts = [v.decode("utf-8", "replace") for v in part.column(part.num_columns - 1).to_pylist()]
                made = [array("i", [pieces.begin]) + found + array("i", [pieces.end]) for found in encode(texts, model_path)]
                back = [pieces.library.decode(m.tolist()) for m in made]
                offsets = pa.array([0, *_running(made)], pa.int32())
                flat = pa.array(memoryview(b"".join(m.tobytes() for m in made)).cast("i"), pa.int32())
                cols = part.columns[:-1] + [pa.ListArray.from_arrays(offsets, flat), pa.array(back, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, [*part.schema.names[:-1], ids, decoded])

    return given.mapInArrow(run, schema)


def _running(parts: list) -> list[int]:
    total, out = 0, []
    for p in parts:
        total += len(p)
        out.append(total)
    return out


def digests(docs: DataFrame, model_path: str, batch: int = 500) -> DataFrame:
    """For documents (doc_id, text): doc_id, n_tokens (all ids), and SHA-256 of the ids and of the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            ids, decoded = part.column(1), part.column(2)
            starts, flat = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            sums = [hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(starts[:-1], starts[1:])]
            texts = [hashlib.sha256(t.as_py().encode("utf-8")).hexdigest() for t in decoded]
            cols = [part.column(0), pa.array((starts[1:] - starts[:-1]).astype("int64")), pa.array(sums), pa.array(texts)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    made = with_pieces(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), model_path, batch=batch)
    return made.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


session.ship_with_jobs(__name__)
