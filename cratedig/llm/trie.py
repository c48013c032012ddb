"""The trie of conversation prefixes: what a training run saves by computing shared beginnings once.

Texts are hashed where they are read (128 bits for role and text) and never
shuffled. A prefix is known by the sums of its turns' hashes, each of which
depends on the turn's place; sums run along a conversation in slices, so that one
endless conversation is no single task's work. Prefixes are grouped to nodes, and
totals of subtrees come from tree contraction (``contraction``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cratedig import session
from cratedig.llm.common import WORD, keep, shuffle_parts
from cratedig.llm.contraction import subtree_sums

#: Turns taken from the shared opening are fewer than this; groups of so many ids share one.
LENT, GROUP = 4, 20
#: Ids in one piece of a node's list.
PIECE = 512
SUMS = ["s1", "s2", "s3", "s4"]
ENDS = "ka long, kb long, part int, seq int, ids string"
DIGESTS = "ka long, kb long, ends_sha256 string"


def _parts(h: Column) -> list[Column]:
    """The two halves of a hash, so that sums of two thousand million turns fit a long."""
    return [h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32)]


def _name(pos: Column, sums: list[Column]) -> tuple[Column, Column]:
    return F.xxhash64(pos.cast("bigint"), *sums), F.xxhash64(*reversed(sums), pos.cast("bigint"))


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, part, pos and the hashes of each turn: turns numbered from 1 in each conversation, as a written table.

    Rows without a conv_id go. Turns of equal number (null is the first) follow each other by their hash. ``part`` is the
    range of the order that a row lies in; a conversation's parts ascend with its turns.
    """
    spark = conversations.sparkSession
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    slim = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").alias("turn"),
        F.xxhash64(role, text).alias("ha"), F.xxhash64(F.lit("b"), text, role).alias("hb"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"), F.monotonically_increasing_id().alias("tie"),
    )
    order = [F.col("turn").asc_nulls_first(), "ha", "hb", "tie"]
    placed = keep(slim.repartitionByRange(shuffle_parts(spark), "conv_id", *order).withColumn("part", F.spark_partition_id()), "turns")
    return placed.withColumn("inside", F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))).drop("turn", "tie")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with a shared opening: their turns and the list of them.

    Conversation c is the first h = crc32(c) % 4 turns of conversation c - c % 20, then its own after its first h. Returns
    (conv_id, part, pos, total, ha, hb, words), ``total`` being the turns of the rebuilt conversation, and (conv_id, total).
    """
    numbered = turns(conversations)
    at = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    slices = keep(numbered.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(F.sum("n").over(at), F.lit(0))), "slices")
    lent = F.crc32(F.col("conv_id").cast("string").cast("binary")) % LENT
    convs = slices.groupBy("conv_id").agg(F.sum("n").alias("n")).withColumn("h", lent).withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    opening = F.least("h", F.coalesce("n_base", F.lit(0)))
    info = convs.join(bases, "base", "left").select("conv_id", "base", "h", opening.alias("opening"), (opening + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total"))
    info = keep(info, "conversations")
    carried = slices.join(info, "conv_id").select("conv_id", "part", "before", "h", "opening", "total")
    placed = keep(numbered.join(carried, ["conv_id", "part"]).withColumn("own", F.col("inside") + F.col("before")), "turns")
    kept = placed.where("own > h").select("conv_id", "part", (F.col("own") - F.col("h") + F.col("opening")).alias("pos"), "total", "ha", "hb", "words")
    first = placed.where((F.col("own") < LENT) & (F.col("conv_id") % GROUP == 0)).select(F.col("conv_id").alias("base"), F.col("own").alias("pos"), "ha", "hb", "words")
    borrowed = info.where("h > 0").join(first, "base").where("pos <= h").select("conv_id", F.lit(-1).alias("part"), "pos", "total", "ha", "hb", "words")
    return kept.unionByName(borrowed), info.select("conv_id", "total")


def prefixes(rows: DataFrame) -> DataFrame:
    """For numbered turns: conv_id, pos, total, words and the names (ka, kb) of the prefix ending there and (pa, pb) of the one before."""
    hashes = [*_parts(F.xxhash64("pos", "ha", "hb")), *_parts(F.xxhash64("hb", "pos", "ha"))]
    hashed = rows.select("conv_id", "part", F.col("pos").cast("bigint").alias("pos"), "total", "words", "ha", "hb").select("*", *(h.alias(f"t{i}") for i, h in enumerate(hashes, 1)))
    inside = Window.partitionBy("conv_id", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = hashed.groupBy("conv_id", "part").agg(*(F.sum(f"t{i}").alias(f"c{i}") for i in range(1, 5)))
    carry = per_part.select("conv_id", "part", *(F.coalesce(F.sum(f"c{i}").over(earlier), F.lit(0)).alias(f"b{i}") for i in range(1, 5)))
    summed = hashed.select("conv_id", "part", "pos", "total", "words", *(f"t{i}" for i in range(1, 5)), *(F.sum(f"t{i}").over(inside).alias(f"r{i}") for i in range(1, 5)))
    summed = summed.join(carry, ["conv_id", "part"]).select("*", *((F.col(f"r{i}") + F.col(f"b{i}")).alias(s) for i, s in enumerate(SUMS, 1)))
    ka, kb = _name(F.col("pos"), [F.col(s) for s in SUMS])
    pa, pb = _name(F.col("pos") - 1, [F.col(s) - F.col(f"t{i}") for i, s in enumerate(SUMS, 1)])
    return summed.select("conv_id", "pos", "total", "words", ka.alias("ka"), kb.alias("kb"), pa.alias("pa"), pb.alias("pb"))


def digests(ends: DataFrame) -> DataFrame:
    """For rows (ka, kb, conv_id): the SHA-256 of each key's ids, ascending, joined by commas.

    Ids are sorted by ranges of (key, id), so a key with most of the ids is many tasks' work; they reach the one digest,
    which can only be computed from front to back, as pieces of text that stream through in constant memory.
    """
    n = shuffle_parts(ends.sparkSession)
    placed = ends.repartitionByRange(n, "ka", "kb", "conv_id").sortWithinPartitions("ka", "kb", "conv_id").select("ka", "kb", F.spark_partition_id().alias("part"), "conv_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, seq = None, [], 0
        out: list[tuple] = []
        for batch in batches:
            for a, b, part, c in zip(*(x.to_pylist() for x in batch.columns)):
                if held != (a, b, part) or len(ids) == PIECE:
                    if ids:
                        out.append((*held, seq, ",".join(ids)))
                    seq = seq + 1 if held == (a, b, part) else 0
                    held, ids = (a, b, part), []
                ids.append(str(c))
            if out:
                yield rows(out)
                out = []
        if ids:
            yield rows([(*held, seq, ",".join(ids))])

    def rows(found: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], [c.split()[0] for c in ENDS.split(", ")])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        def sent(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.string()))], ["ka", "kb", "ends_sha256"])

        held, state = None, None
        for batch in batches:
            out = []
            for a, b, _, _, ids in zip(*(x.to_pylist() for x in batch.columns)):
                if held != (a, b):
                    if held:
                        out.append((*held, state.hexdigest()))
                    held, state = (a, b), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if out:
                yield sent(out)
        if held:
            yield sent([(*held, state.hexdigest())])

    pieces = placed.mapInArrow(cut, ENDS)
    return pieces.repartition(n, "ka", "kb").sortWithinPartitions("ka", "kb", "part", "seq").mapInArrow(digest, DIGESTS)


def nodes(conversations: DataFrame) -> DataFrame:
    """The trie of rebuilt conversations (conv_id, turn, role, text): one row per node.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. Nulls: a null turn comes first, null role and text count as empty, a row without conv_id belongs to no
    conversation. Ties: turns of the same number are put in the order of their 64-bit hashes; repeated rows are turns of
    their own. A conversation without turns left is a member of the root. No rows give no trie, hence no root. Texts may
    have any length; other columns, whatever their names, are not read.
    """
    rows, convs = rebuilt(conversations)
    spots = keep(prefixes(rows), "prefixes")
    zero = [F.lit(0).cast("bigint")] * 4
    root_a, root_b = _name(F.lit(0), zero)
    grouped = spots.groupBy("ka", "kb").agg(
        F.min("conv_id").alias("conv_id"), F.min("pos").alias("depth"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), F.min("pa").alias("pa"), F.min("pb").alias("pb")
    )
    none = F.lit(None).cast("bigint")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        root_a.alias("ka"), root_b.alias("kb"), "conv_id", F.lit(0).cast("bigint").alias("depth"), "n_convs", F.lit(0).cast("bigint").alias("words"), none.alias("pa"), none.alias("pb")
    )
    alone = keep(grouped.unionByName(root), "nodes")
    upper = alone.select(F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    below = alone.where("depth > 0").join(upper, ["pa", "pb"]).drop("pa", "pb")
    tree = keep(below.unionByName(alone.where("depth = 0").drop("pa", "pb").withColumn("parent_conv_id", none)), "nodes")
    kids = tree.where("depth > 0").groupBy("parent_conv_id", "depth").agg(F.count(F.lit(1)).alias("n_children"))
    kids = kids.select(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"), "n_children")
    tree = keep(tree.join(kids, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    sums = subtree_sums(
        tree.select(
            F.col("conv_id").alias("node_a"), F.col("depth").alias("node_b"), F.col("parent_conv_id").alias("up_a"),
            F.when(F.col("depth") > 0, F.col("depth") - 1).alias("up_b"), "depth",
            (F.col("n_children") == 0).cast("bigint").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
        ),
        ["n_leaves", "saved_tokens"],
    )
    sums = sums.withColumnsRenamed({"node_a": "conv_id", "node_b": "depth"})
    ends = spots.where("pos = total").select("ka", "kb", "conv_id").union(convs.where("total = 0").select(root_a, root_b, "conv_id"))
    made = tree.join(sums, ["conv_id", "depth"]).join(digests(keep(ends, "ends")), ["ka", "kb"], "left")
    return made.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


session.ship_with_jobs(__name__)
