import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cratedig.llm import contraction, trie
from cratedig.llm.queries import QUERIES
from tests.llm import data

SCHEMA = "conv_id bigint, turn int, role string, text string, depth string, part string, ka string, NODE_A string, words string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain(rows):
    """The nodes of (conv_id, turn, role, text) rows without ties, by walking every prefix."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(x, key=lambda x: x[:2])] for c, x in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        turns = tuple(own.get(base, [])[:h] + mine[h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    kids = defaultdict(set)
    for key in members:
        if key:
            kids[key[:-1]].add(key)
    out, leaves, saved = [], {}, {}
    for key in sorted(members, key=len, reverse=True):
        leaves[key] = sum(leaves[k] for k in kids[key]) or 1
        saved[key] = sum(saved[k] for k in kids[key]) + (0 if not key else (len(members[key]) - 1) * len(data.words(key[-1][1])))
        digest = hashlib.sha256(",".join(map(str, sorted(ends[key]))).encode()).hexdigest()
        out.append((min(members[key]), len(key), min(members[key[:-1]]) if key else None, len(members[key]), len(kids[key]), leaves[key], saved[key], digest))
    return sorted(out, key=lambda r: r[:2])


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=lambda r: r[:2])


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA)


def conversations(seed, n, deepest=6):
    """Openings from a few turns, so that prefixes are shared."""
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), " ".join(rng.choices(["a", "b"], k=rng.randrange(3)))) for c in range(n) for t in range(rng.randrange(deepest + 1))]


def test_against_a_plain_walk(spark):
    rows = conversations(1, 300)
    assert found(trie.nodes(frame(spark, rows))) == plain(rows)


def test_query_equals_the_plain_walk(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{data.SF}/conversations.parquet").collect()]
    assert found(QUERIES["op11_prefix_trie"](spark, data.SF)) == plain(rows)


def test_nulls_empty_texts_negative_ids_and_long_conversations(spark):
    rows = [(-7, 1, "user", "hi there"), (-7, None, None, None), (0, 0, "user", ""), (0, 1, None, "x"), (40, 0, "user", "a b"), (41, 0, "user", "a b"), (None, 0, "user", "lost")]
    rows += [(60, t, "user", f"turn {t}") for t in range(300)] + [(61, t, "user", f"turn {t}") for t in range(299)]
    rows += [(80, 0, "user", "w " * 30_000), (99, 5, "user", "only one, taken away where h > 0")]
    assert found(trie.nodes(frame(spark, rows))) == plain(rows)


def test_ties_and_repeated_rows(spark):
    """Repeated rows are turns of their own; equal turn numbers come in the order of their hashes, the same for all."""
    rows = [(c, 0, "user", t) for c in (100, 120, 140) for t in ("p", "q", "q", "r")]
    a, b = (found(trie.nodes(frame(spark, x).repartition(3))) for x in (rows, rows[::-1]))
    assert a == b and [r[1] for r in a] == [0, 1, 2, 3, 4] and {r[3] for r in a} == {3}


def test_empty_table(spark):
    assert trie.nodes(frame(spark, [])).count() == 0
    assert trie.nodes(frame(spark, [(None, 1, "user", "x")])).count() == 0


def tree_of(kind, n, rng):
    if kind == "chain":
        return [i - 1 for i in range(n)]
    if kind == "star":
        return [-1] + [0] * (n - 1)
    if kind == "comb":
        return [-1] + [i - 1 if i % 2 else max(0, i - 2) for i in range(1, n)]
    return [-1] + [rng.randrange(max(0, i - 5), i) for i in range(1, n)]


@pytest.mark.parametrize(("kind", "n"), [("chain", 130), ("star", 60), ("comb", 40), ("random", 150)])
def test_contraction(spark, kind, n):
    rng = random.Random(n)
    up = tree_of(kind, n, rng)
    depth, x, y = [0] * n, [rng.randrange(100) for _ in range(n)], [rng.randrange(-9, 9) for _ in range(n)]
    for i in range(1, n):
        depth[i] = depth[up[i]] + 1
    want = [[a, b] for a, b in zip(x, y)]
    for i in range(n - 1, 0, -1):
        for k in (0, 1):
            want[up[i]][k] += want[i][k]
    rows = [(i, 7, None if up[i] < 0 else up[i], None if up[i] < 0 else 7, depth[i], x[i], y[i]) for i in range(n)]
    tree = spark.createDataFrame(rows, "node_a long, node_b long, up_a long, up_b long, depth long, x long, y long")
    got = {r.node_a: [r.x, r.y] for r in contraction.subtree_sums(tree, ["x", "y"]).collect()}
    assert got == dict(enumerate(want))


def test_contraction_of_forests_and_nothing(spark):
    schema = "node_a long, node_b long, up_a long, up_b long, depth long, x long"
    two = spark.createDataFrame([(1, 0, None, None, 0, 5), (2, 0, 1, 0, 1, 6), (3, 0, None, None, 0, 7)], schema)
    assert {r.node_a: r.x for r in contraction.subtree_sums(two, ["x"]).collect()} == {1: 11, 2: 6, 3: 7}
    assert contraction.subtree_sums(two.limit(0), ["x"]).count() == 0
    ring = spark.createDataFrame([(1, 0, 2, 0, 1, 5), (2, 0, 1, 0, 1, 6)], schema)
    with pytest.raises(RuntimeError, match="cycle"):
        contraction.subtree_sums(ring, ["x"], max_rounds=3)


def test_long_id_lists_are_cut_into_pieces_and_joined_again(spark):
    n = 3 * trie.PIECE + 7
    ends = spark.range(n).select(F.when(F.col("id") < n - 2, 1).otherwise(2).cast("long").alias("ka"), F.lit(3).cast("long").alias("kb"), (F.col("id") * 37 % n).alias("conv_id"))
    rows = {r.ka: r.ends_sha256 for r in trie.digests(ends).collect()}
    for k in (1, 2):
        ids = sorted(r.conv_id for r in ends.where(F.col("ka") == k).collect())
        assert rows[k] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
