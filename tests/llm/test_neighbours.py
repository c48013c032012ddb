import numpy as np
import pytest
from pyspark.sql import functions as F

from cratedig.llm import neighbours
from tests.llm import data  # noqa: F401

SCHEMA = "vec_id bigint, embedding array<float>, label int, ids string, dim string, tile string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x") for i, v in rows], SCHEMA)


def plain(rows, k, is_query):
    """The k best by sequential sums of doubles, ties to the smaller id."""
    fine = []
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            fine.append((i, [float(np.float32(x)) for x in v]))
    out = []
    for at, (q, mine) in enumerate(fine):
        if q is None or not is_query(q):
            continue
        found = []
        for other, (c, v) in enumerate(fine):
            if other != at and len(v) == len(mine):
                s = 0.0
                for a, b in zip(mine, v):
                    s += a * b
                found.append((-s, c is None, c or 0))
        out += [(q, n + 1, None if none else c, -s) for n, (s, none, c) in enumerate(sorted(found)[:k])]
    return ordered(out)


def ordered(rows):
    return sorted(rows, key=lambda r: (*r[:2], r[2] is None, r[2] or 0, r[3]))


@pytest.mark.parametrize("tile", [7, 8192])
def test_equals_full_search(spark, tile):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(300, 16)).astype(np.float32)
    vectors[40:120] = vectors[40]  # many ties
    vectors[130] *= 1e4
    vectors[131] *= 1e-30
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(400, None), (401, []), (402, [0.0] * 16), (403, [float("nan")] * 16), (404, [float("inf")] + [1.0] * 15), (405, [None] + [1.0] * 15)]
    rows += [(None, [1.0] * 16), (20, rows[20][1]), (60, [9.0] * 16), (500, [1.0, 2.0]), (501, [2.0, 1.0]), (520, [3.0] * 3)]
    got = neighbours.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, k=5, query_tile=tile, tile=tile)
    assert ordered(map(tuple, got.collect())) == plain(rows, 5, lambda i: i % 20 == 0)


def test_fewer_candidates_than_k_and_empty(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5])]
    got = neighbours.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0)
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 0.5)]
    assert neighbours.nearest(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.nearest(frame(spark, [(1, [1.0])]), F.col("vec_id") % 20 == 0).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=(50, 64)), rng.normal(size=(60, 64)) * 10.0 ** rng.integers(-3, 3, size=(60, 1))
    (ac, asc, an, ar), (bc, bsc, bn, br) = neighbours.quantised(a), neighbours.quantised(b)
    near = (ac.astype(float) @ bc.astype(float).T) * asc[:, None] * bsc
    slack = ar[:, None] * bn + an[:, None] * br + ar[:, None] * br
    assert (np.abs(a @ b.T - near) <= slack + 1e-9).all()


def test_rows_of_equal_id_are_all_candidates(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.1]), (1, [9.0, 0.0]), (2, [1.0, 1.0]), (0, [3.0, 3.0]), (None, [2.0, 0.0])]
    got = neighbours.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0)
    assert ordered(map(tuple, got.collect())) == plain(rows, 20, lambda i: i % 20 == 0)
    assert (0, 1, 1, 9.0) in map(tuple, got.collect())
