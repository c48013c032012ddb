"""Mixing sources to target weights by hash thresholds.

Every row has a hash. A source's words are summed by the leading bits of the
hash; the running sums show the bucket in which the source's budget runs out, and
only that bucket's rows are summed again by the next bits, until one hash value is
left. Rows below the threshold are taken once more than the others, so a larger
budget always keeps what a smaller one took. Nothing is sorted or gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cratedig.llm.common import WORD, clear_of, keep, numbered

#: Hash bits looked at in one step; 63 bits make seven steps at most.
STEP_BITS, HASH_BITS = 9, 63
LARGEST_REPEAT = 3


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def row_hash(doc_id: str = "doc_id", text: str = "text") -> Column:
    """63 bits that depend on the id and the text, so that rows without an id differ too."""
    return F.shiftrightunsigned(F.xxhash64(F.col(doc_id), F.col(text)), 1)


def targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), share: float = 1.0, repeat: int = LARGEST_REPEAT) -> DataFrame:
    """From one row per source (source, source_size): adds ``target``.

    Sources in code point order, null last, weigh as given, repeating. Together they get ``share`` of all words; no
    target exceeds ``repeat`` times its source, and what is cut goes to the others by weight until none is above.
    Each step of that is one aggregate; only sums reach the driver.
    """
    ranked = numbered(sizes, [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = keep(ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(repeat))), "weights")
    whole = table.agg(F.sum("source_size"), F.sum("weight"), F.count(F.lit(1))).first()
    budget, rate, capped = share * (whole[0] or 0), 0.0, -1
    free, weights_left = budget, whole[1] or 0.0
    while weights_left:
        rate = free / weights_left
        over = F.col("weight") * rate > F.col("cap")
        got = table.agg(
            F.sum(F.when(over, F.col("cap"))), F.sum(F.when(~over, F.col("weight"))), F.count(F.when(over, 1))
        ).first()
        if got[2] == capped:
            break
        capped, free, weights_left = got[2], budget - (got[0] or 0.0), got[1] or 0.0
    return table.select("source", "source_size", F.least(F.col("weight") * rate, "cap").alias("target"))


def thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """From rows (source, size, u) and goals (source, source_size, target): the repeats of each source.

    Returns ``whole`` (times that every row is taken) and ``below`` (rows whose hash is below are taken once more).
    """
    with_rest = goals.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    state = keep(
        with_rest.select(
            "source", "source_size", "target", F.col("whole").cast("int").alias("whole"),
            (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest"),
        ).withColumn("partly", F.col("rest") > 0),
        "goals",
    )
    left = HASH_BITS
    inside = rows
    while left:
        left -= STEP_BITS
        sums = (
            inside.select("source", "size", F.shiftrightunsigned("u", left).alias("bucket"))
            .groupBy("source", "bucket").agg(F.sum("size").alias("words"))
        )
        ahead = Window.partitionBy("source").orderBy("bucket")
        running = sums.withColumn("upto", F.sum("words").over(ahead.rowsBetween(Window.unboundedPreceding, 0)))
        goal = state.select(F.col("source").alias("of"), "rest")
        met = running.join(goal, F.col("source").eqNullSafe(F.col("of"))).where(F.col("upto") > F.col("rest"))
        first = met.groupBy("of").agg(F.min_by(F.struct("bucket", "words", "upto"), "bucket").alias("at"))
        # a source whose budget no bucket crosses has rest 0 or takes all that is left
        state = keep(
            state.join(first.withColumnRenamed("of", "hit"), F.col("source").eqNullSafe(F.col("hit")), "left").select(
                "source", "source_size", "target", "whole", "partly",
                F.when(F.col("at").isNotNull(), F.col("rest") - (F.col("at.upto") - F.col("at.words"))).otherwise(F.col("rest")).alias("rest"),
                F.when(F.col("at").isNotNull(), F.col("at.bucket")).otherwise(F.lit((1 << (HASH_BITS - left)) - 1)).alias("prefix"),
                F.coalesce(F.col("at.words"), F.lit(0)).alias("words"),
            ),
            "goals",
        )
        edge = state.select(F.col("source").alias("of"), "prefix")
        inside = rows.join(
            edge, F.col("source").eqNullSafe(F.col("of")) & (F.shiftrightunsigned("u", left) == F.col("prefix"))
        ).select("source", "size", "u")
    nearer = F.col("words") - F.col("rest") < F.col("rest")  # with the last hash value the sum comes nearer
    below = F.when(F.col("partly"), F.col("prefix") + nearer.cast("int")).otherwise(0)
    return state.select("source", "source_size", "target", "whole", below.alias("below"))


def copies(u: str = "u") -> Column:
    return F.col("whole") + (F.col(u) < F.col("below")).cast("int")


def plan(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), share: float = 1.0, repeat: int = LARGEST_REPEAT) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, source, size, u) as a written table, and one row per source with its thresholds.

    Null texts have size 0; a null source is a source of its own; rows alike in id and text are taken together; an
    empty table gives empty tables.
    """
    rows = keep(docs.select("doc_id", "source", n_words().alias("size"), row_hash().alias("u")), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    return rows, thresholds(rows, targets(sizes, weights, share, repeat))


def taken(docs: DataFrame, **options) -> DataFrame:
    """For each document: doc_id, size, source_size, target of its source, taken (words, repeats counted)."""
    rows, per_source = plan(docs, **options)
    joined = rows.join(per_source.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    return joined.select(F.col("doc_id").cast("bigint").alias("doc_id"), "size", "source_size", "target", (F.col("size") * copies()).alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The columns of ``docs``, each row as many times as the mix takes it."""
    _, per_source = plan(docs, **options)
    of, u, n, whole, below = clear_of(docs, "of", "u", "n", "whole", "below")
    edge = per_source.select(F.col("source").alias(of), F.col("whole").alias(whole), F.col("below").alias(below))
    joined = docs.join(edge, F.col("source").eqNullSafe(F.col(of)))
    times = F.col(whole) + (row_hash() < F.col(below)).cast("int")
    return joined.where(times > 0).withColumn(n, F.explode(F.array_repeat(F.lit(True), times))).select(*docs.columns)
