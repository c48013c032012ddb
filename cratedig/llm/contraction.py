"""Subtree sums by parallel tree contraction.

A round first rakes the leaves: their totals are known and go to their parents.
Then it compresses chains: an inner node with one child left is taken out if its
priority is lower than its parent's and its child's, so that no two neighbours go
at once, and its child hangs from its parent with the node's value on the edge.
Long chains lose about half of their nodes in a round and bushy parts all their
leaves, so the rounds grow with the logarithm of the tree's size, whatever its
depth. Afterwards the nodes taken out are put back in reverse order: a node's
total is its own value and that of the child which was below it.

Each round is one grouping by parent and two joins by node, and a written table.
Rounds shrink geometrically, and so do the tables that the way back reads.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cratedig import session
from cratedig.llm.common import keep

#: Low bits of a priority that are random; those above count the trailing zeros of the depth.
RANDOM_BITS = 40


def _priority(key: str, depth: str, salt: int) -> Column:
    """Nodes of odd depth first, then those of depth 2 modulo 4, and so on: every other node of an untouched chain."""
    d = F.col(depth)
    zeros = F.bit_count(d.bitwiseAND(-d) - 1)
    return F.shiftleft(zeros.cast("bigint"), RANDOM_BITS) + F.xxhash64(F.col(f"{key}_a"), F.col(f"{key}_b"), F.lit(salt)).bitwiseAND((1 << RANDOM_BITS) - 1)


def _same(left: DataFrame, right: DataFrame, a: str, b: str) -> Column:
    return (left[f"{a}_a"] == right[f"{b}_a"]) & (left[f"{a}_b"] == right[f"{b}_b"])


def subtree_sums(tree: DataFrame, values: list[str], max_rounds: int = 200) -> DataFrame:
    """For nodes (node_a, node_b, up_a, up_b, depth, values...): node_a, node_b and each value summed over the subtree.

    A node's name is a pair of longs, without nulls and unique; ``up`` names its parent, null for a root. ``depth`` is one
    more than the parent's, from 0. Values are longs. A tree of any depth and a parent of any number of children will do;
    a forest too; no nodes give no rows. A node whose parent isn't in the table counts as a root; a cycle raises an error.
    """
    edge = [f"edge_{v}" for v in values]
    parents = tree.where("up_a is not null").groupBy(F.col("up_a").alias("p_a"), F.col("up_b").alias("p_b")).agg(F.count(F.lit(1)).alias("kids"))
    named = ["node_a", "node_b", "up_a", "up_b"]
    state = tree.join(parents, _same(tree, parents, "node", "p"), "left").select(
        *named, "depth", (F.col("depth") - 1).alias("up_depth"), F.coalesce("kids", F.lit(0)).alias("kids"), *values, *(F.lit(0).cast("bigint").alias(e) for e in edge)
    )
    state = keep(state, "tree")
    leaves: list[DataFrame] = []
    taken: list[DataFrame] = []
    for salt in range(max_rounds):
        leaves.append(state.where("kids = 0").select("node_a", "node_b", *values))
        leaf, inner = F.col("kids") == 0, F.col("kids") > 0
        below = state.where("up_a is not null").groupBy(F.col("up_a").alias("p_a"), F.col("up_b").alias("p_b")).agg(
            F.count_if(leaf).alias("raked"),
            *(F.coalesce(F.sum(F.when(leaf, F.col(v) + F.col(e))), F.lit(0)).alias(f"raked_{v}") for v, e in zip(values, edge)),
            # of the one child left, where only one is left
            *(F.max(F.when(inner, F.col(c))).alias(f"only_{n}") for c, n in (("node_a", "a"), ("node_b", "b"), ("depth", "depth"))),
            *(F.max(F.when(inner, F.col(e))).alias(f"only_{e}") for e in edge),
        )
        some = state.where(inner)
        raked = some.join(below, _same(some, below, "node", "p")).select(
            *named, "depth", "up_depth", (F.col("kids") - F.col("raked")).alias("kids"), *((F.col(v) + F.col(f"raked_{v}")).alias(v) for v in values), *edge,
            "only_a", "only_b", "only_depth", *(f"only_{e}" for e in edge),
        )
        mine = _priority("node", "depth", salt)
        goes = (F.col("kids") == 1) & F.col("up_a").isNotNull() & (mine < _priority("only", "only_depth", salt)) & (mine < _priority("up", "up_depth", salt))
        raked = raked.withColumn("goes", F.coalesce(goes, F.lit(False)))
        moved = raked.where("goes").select(
            F.col("only_a").alias("to_a"), F.col("only_b").alias("to_b"), F.col("up_a").alias("new_a"), F.col("up_b").alias("new_b"),
            F.col("up_depth").alias("new_depth"), *((F.col(v) + F.col(e)).alias(f"more_{v}") for v, e in zip(values, edge)),
        )
        hung = F.col("to_a").isNotNull()
        after = raked.join(moved, _same(raked, moved, "node", "to"), "left").select(
            "node_a", "node_b",
            *(F.when(hung, F.col(new)).otherwise(F.col(old)).alias(old) for new, old in (("new_a", "up_a"), ("new_b", "up_b"))),
            "depth", F.when(hung, F.col("new_depth")).otherwise(F.col("up_depth")).alias("up_depth"), "kids", *values,
            *((F.col(e) + F.coalesce(F.col(f"more_{v}"), F.lit(0))).alias(e) for v, e in zip(values, edge)),
            "goes", "only_a", "only_b", *(f"only_{e}" for e in edge),
        )
        after = keep(after, "tree")
        taken.append(after.where("goes").select("node_a", "node_b", "only_a", "only_b", *((F.col(v) + F.col(f"only_{e}")).alias(v) for v, e in zip(values, edge))))
        state = after.where("not goes").select(*named, "depth", "up_depth", "kids", *values, *edge)
        if state.isEmpty():
            break
    else:
        raise RuntimeError(f"the tree did not contract in {max_rounds} rounds: there is a cycle")
    known: list[DataFrame] = []
    for leaf_rows, gone in zip(reversed(leaves), reversed(taken)):
        if known and not gone.isEmpty():
            below = reduce(DataFrame.union, known)
            below = below.select(F.col("node_a").alias("w_a"), F.col("node_b").alias("w_b"), *(F.col(v).alias(f"below_{v}") for v in values))
            back = gone.join(below, _same(gone, below, "only", "w")).select("node_a", "node_b", *((F.col(v) + F.col(f"below_{v}")).alias(v) for v in values))
            known.append(keep(back, "tree"))
        known.append(leaf_rows)
    return reduce(DataFrame.union, known)


session.ship_with_jobs(__name__)
