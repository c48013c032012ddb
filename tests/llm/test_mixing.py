from collections import Counter

from cratedig.llm import mixing
from cratedig.llm.queries import QUERIES
from tests.llm import data


def plain_targets(sizes, weights=(1, 2, 3), share=1.0, repeat=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8")))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, target, free = share * sum(sizes.values()), {}, set(order)
    while free:
        rate = (budget - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if rate * weight[s] > repeat * sizes[s]}
        if not over:
            target |= {s: rate * weight[s] for s in free}
            break
        target |= {s: float(repeat * sizes[s]) for s in over}
        free -= over
    return target


def check(rows, docs):
    """docs: (source, text) by order of rows; every source near its target, whole copies only."""
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r, (source, text) in zip(rows, docs):
        assert r.size == len(data.words(text)) and 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        sizes[source] += r.size
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
    target = plain_targets(sizes)
    for r, (source, _) in zip(rows, docs):
        assert r.source_size == sizes[source] and abs(r.target - target[source]) < 1e-6 * max(1, target[source])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6


def test_query(spark):
    import pyarrow.parquet as pq

    source = {r["doc_id"]: (r["source"], r["text"]) for r in pq.read_table(f"{data.SF}/documents.parquet").to_pylist()}
    rows = QUERIES["op3_source_mix"](spark, data.SF).collect()
    check(rows, [source[r.doc_id] for r in rows])
    again = QUERIES["op3_source_mix"](spark, data.SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_dirty_rows(spark):
    docs = data.dirty(spark).coalesce(1)
    rows = mixing.taken(docs).collect()
    by = {}
    for i, t, _, s, *_ in data.dirty_rows():
        by.setdefault((i, len(data.words(t))), []).append((s, t))
    pairs = [by[r.doc_id, r.size][-1] for r in rows]
    sizes, taken = Counter(), Counter()
    for r, (s, _) in zip(rows, pairs):
        sizes[s] += r.size
        taken[s] += r.taken
        assert r.taken <= 3 * r.size
    target = plain_targets(sizes)
    assert all(abs(r.target - target[s]) < 1e-6 * max(1, target[s]) for r, (s, _) in zip(rows, pairs))
    mixed = mixing.mixed(data.dirty(spark))
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r.source] += len(data.words(r.text))
    assert +words == +taken


def test_budgets_are_nested(spark):
    docs = spark.createDataFrame([(i, data.prose(i, 20 + i % 7), f"s{i % 3}") for i in range(300)], "doc_id bigint, text string, source string")
    half, more = ({r.doc_id: r.taken for r in mixing.taken(docs, share=s).collect()} for s in (0.3, 0.7))
    assert all(half[i] <= more[i] for i in half) and sum(half.values()) < sum(more.values())


def test_empty(spark):
    assert mixing.taken(data.empty(spark)).count() == 0
    assert mixing.mixed(data.empty(spark)).count() == 0
