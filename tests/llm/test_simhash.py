import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cratedig.llm import simhash
from cratedig.llm.components import components
from cratedig.llm.queries import QUERIES
from tests.llm import data


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_query_equals_all_pairs(spark):
    docs = data.documents()
    ids = sorted(docs)
    fps = [data.fingerprint(docs[i]) for i in ids]
    least = data.components(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op2_simhash_near_dedup"](spark, data.SF).collect()}
    assert got == {i: (f"{fps[k]:016x}", ids[least[k]]) for k, i in enumerate(ids)}


@pytest.mark.parametrize("piece", [4, 4096])
def test_links_of_clusters_and_chains(spark, piece):
    """Random values, dense clusters and chains; small pieces make the split path do the work."""
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(150)} | {0, 1, 2**63, 2**64 - 1}
    for centre in list(values)[:3]:
        values |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 4))) for _ in range(40)}
    x = rng.getrandbits(64)
    for _ in range(30):
        x ^= sum(1 << b for b in rng.sample(range(64), 3))
        values.add(x)
    values = sorted(values, key=signed)
    rows = spark.createDataFrame([(signed(v),) for v in values], "fp bigint").repartition(5)
    roots = {r.node: r.root for r in components(simhash.links(rows, piece=piece)).collect()}
    want = [signed(values[k]) for k in data.components(values)]
    assert [roots.get(signed(v), signed(v)) for v in values] == want


def test_pivot_distances_never_discard_links():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 500, dtype=np.uint64)
    b = a ^ np.array([sum(1 << int(x) for x in rng.choice(64, 3, replace=False)) for _ in a], np.uint64)
    refs = simhash.pivots()
    table = lambda v: np.bitwise_count(v[:, None] ^ refs).astype(int)
    assert np.abs(table(a) - table(b)).max() <= 3


def test_dirty_rows(spark):
    rows = data.dirty_rows()
    got = simhash.component_ids(data.dirty(spark)).collect()
    fps = [data.fingerprint(r[1]) for r in rows]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    least = data.components([fps[k] for k in order])
    want = sorted((str(rows[k][0]), f"{fps[k]:016x}", str(rows[order[least[p]]][0])) for p, k in enumerate(order))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    kept = simhash.one_of_each(data.dirty(spark))
    assert kept.columns == data.dirty(spark).columns
    stay = sorted(str(rows[order[p]][0]) for p in set(least))
    assert sorted(str(r.doc_id) for r in kept.collect()) == stay


def test_repeated_rows_and_nulls_are_told_apart(spark):
    rows = [(1, "a b c d", None), (1, "a b c d", None), (None, "x y z w", "q"), (None, "x y z w", "q"), (None, "q", None), (None, None, "q")]
    docs = spark.createDataFrame(rows * 3, "doc_id bigint, text string, source string").withColumn("more", F.create_map(F.lit(1), F.lit(2)))
    kept = simhash.one_of_each(docs).select("doc_id", "text", "source").collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, set(rows)))


def test_empty_and_single(spark):
    assert simhash.component_ids(data.empty(spark)).count() == 0
    assert simhash.one_of_each(data.empty(spark)).count() == 0
    assert simhash.one_of_each(data.dirty(spark).where(F.col("doc_id") == 1)).count() == 1
    none = spark.createDataFrame([(1, 1), (None, 2), (3, None)], "a bigint, b bigint")
    assert components(none).count() == 0
