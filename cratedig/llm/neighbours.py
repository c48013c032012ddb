"""Nearest neighbours of a query set by block matrix products with quantisation bounds.

Vectors are packed into tiles with an int8 copy: ``code * scale``, the norm of
that copy, and the norm of what it leaves out. A query tile and a candidate tile
meet in one cell of a grid. Their int8 product gives every inner product up to a
known error, so a pair stays only if its upper bound reaches the k-th largest
lower bound of its query in the cell. Survivors are computed again from the
original vectors in double precision, and the cells' short lists are merged by
heaps. The result is that of a full search.

Rows are numbered in the order of their ids, so that equal or missing ids don't
matter to the search and ties go to the smaller number; ids are put back at the end.

A cell holds one query tile and one candidate tile, whatever the table's size.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, functions as F

from cratedig import session
from cratedig.llm.common import keep, numbered

QUERY_TILE, TILE = 4096, 8192
#: Query rows multiplied at a time inside a cell.
STRIP = 256

TILES = "tile long, dim int, n int, ids binary, vectors binary"
FOUND = "query_id long, vec_id long, score double"


def usable(vector: str) -> Column:
    """Not null, not zero, without null or non-finite components."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def tiles(rows: DataFrame, size: int) -> DataFrame:
    """Packs (id, v) into rows of at most ``size`` vectors of one dimension, as a written table."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: dict[int, list] = {}

        def out(dim: int) -> pa.RecordBatch:
            nonlocal number
            ids, vectors = (np.concatenate(x) for x in zip(*held.pop(dim)))
            number += 1
            row = [number, dim, len(ids), ids.astype("<i8").tobytes(), vectors.astype("<f8").tobytes()]
            types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], [c.split()[0] for c in TILES.split(", ")])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                for a in range(0, len(at), size):
                    some = at[a : a + size]
                    part = held.setdefault(int(dim), [])
                    if sum(len(i) for i, _ in part) + len(some) > size:
                        yield out(int(dim))
                        part = held.setdefault(int(dim), [])
                    part.append((ids[some], flat[starts[some][:, None] + np.arange(dim)]))
        for dim in list(held):
            yield out(dim)

    return keep(rows.mapInArrow(pack, TILES), "tiles")


def quantised(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, norms of the coded vectors, norms of the rest."""
    scale = np.abs(v).max(axis=1) / 127
    scale[scale == 0] = np.finfo(np.float64).tiny  # below the smallest step of the format
    code = np.rint(v / scale[:, None]).clip(-127, 127)
    coded = code * scale[:, None]
    return code.astype(np.int8), scale, np.linalg.norm(coded, axis=1), np.linalg.norm(v - coded, axis=1)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed from the first component to the last, so equal vectors score equally."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


def cell(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The k best candidates of each query in a cell: query ids, candidate ids, scores."""
    q_code, q_scale, q_norm, q_rest = quantised(q)
    c_code, c_scale, c_norm, c_rest = quantised(c)
    exactly = np.float32 if q.shape[1] * 127 * 127 < 1 << 24 else np.float64
    right = c_code.astype(exactly).T
    for a in range(0, len(q), STRIP):
        b = slice(a, a + STRIP)
        near = (q_code[b].astype(exactly) @ right).astype(np.float64) * q_scale[b, None] * c_scale
        slack = q_rest[b, None] * c_norm + q_norm[b, None] * c_rest + q_rest[b, None] * c_rest
        slack += 1e-9 * (q_norm[b, None] * c_norm)  # rounding of the bounds themselves
        low = near - slack
        low[q_ids[b, None] == c_ids] = -np.inf
        least = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] > k else np.full(len(low), -np.inf)
        rows, cols = np.nonzero((near + slack >= least[:, None]) & (q_ids[b, None] != c_ids))
        for s in _parts(rows, 1 << 18):
            r, o = rows[s], cols[s]
            score = exact(q[b][r], c[o])
            order = np.lexsort((c_ids[o], -score, r))
            r, o, score = r[order], o[order], score[order]
            rank = np.arange(len(r)) - np.searchsorted(r, r)
            best = rank < k
            yield q_ids[b][r[best]], c_ids[o[best]], score[best]


def _parts(rows: np.ndarray, size: int) -> Iterator[slice]:
    """Slices of about ``size`` pairs that end where a query ends, so that no query is cut."""
    at = 0
    while at < len(rows):
        then = len(rows) if at + size >= len(rows) else int(np.searchsorted(rows, rows[at + size - 1], "right"))
        yield slice(at, then)
        at = then


def nearest(rows: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
            query_tile: int = QUERY_TILE, tile: int = TILE) -> DataFrame:
    """The k candidates of largest inner product for each query: query_id, rank, vec_id, score.

    All usable rows but the query's own are candidates, those of equal id too; vectors of another dimension are not
    comparable and are left out of a query's list. Ties go to the smaller id, among equal ids to any row, and a null id
    comes last. A repeated row is a query each time, with a list each time; a null id makes no query where ``is_query``
    is null for it. A query with fewer candidates gets them all; empty tables give no rows.
    """
    double = F.col(vector).cast("array<double>").alias("v")
    valid = rows.where(usable(vector)).select(F.col(vec_id).cast("long").alias("name"), double, F.coalesce(is_query, F.lit(False)).alias("q"), F.monotonically_increasing_id().alias("tie"))
    single = keep(numbered(valid, [F.col("name").asc_nulls_last(), F.col("tie")], "id").select("id", "name", "v", "q"), "vectors")
    queries = tiles(single.where("q").select("id", "v"), query_tile)
    candidates = tiles(single.select("id", "v"), tile)
    # the grid: each query tile is sent to every candidate tile of its dimension, as far as there are any
    grid = queries.select(F.col("tile").alias("q_tile"), "dim").join(candidates.select(F.col("tile").alias("c_tile"), "dim"), "dim")
    cells = (
        grid.join(queries.select(F.col("tile").alias("q_tile"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors")), "q_tile")
        .join(candidates.select(F.col("tile").alias("c_tile"), "ids", "vectors"), "c_tile")
        .select("q_ids", "q_vectors", "ids", "vectors")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q_ids, q, c_ids, c in zip(*batch.columns):
                q_ids, c_ids = (np.frombuffer(x.as_buffer(), "<i8") for x in (q_ids, c_ids))
                q, c = (np.frombuffer(x.as_buffer(), "<f8").reshape(len(i), -1) for x, i in ((q, q_ids), (c, c_ids)))
                for found in cell(q_ids, q, c_ids, c, k):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], [f.split()[0] for f in FOUND.split(", ")])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by query; a heap of k entries, the worst on top, sees each row once."""
        names, types = ["query_id", "rank", "vec_id", "score"], [pa.int64(), pa.int32(), pa.int64(), pa.float64()]
        out: list[tuple] = []
        query, heap = None, []

        def close() -> None:
            out.extend((query, i + 1, -other, score) for i, (score, other) in enumerate(sorted(heap, reverse=True)))

        for batch in batches:
            for q, other, score in zip(*(c.to_pylist() for c in batch.columns)):
                if q != query:
                    close()
                    query, heap = q, []
                if len(heap) < k:
                    heapq.heappush(heap, (score, -other))
                else:
                    heapq.heappushpop(heap, (score, -other))
            if len(out) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out = []
        close()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 4, types)], names)

    found = cells.mapInArrow(search, FOUND).repartition("query_id").sortWithinPartitions("query_id")
    lists = found.mapInArrow(merge, "query_id long, rank int, vec_id long, score double")
    names = single.select("id", "name")
    asked = names.select(F.col("id").alias("query_id"), F.col("name").alias("query_name"))
    lists = lists.join(asked, "query_id").join(names.withColumnRenamed("id", "vec_id"), "vec_id")
    return lists.select(F.col("query_name").alias("query_id"), "rank", F.col("name").alias("vec_id"), "score")


session.ship_with_jobs(__name__)
