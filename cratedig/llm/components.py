"""Connected components of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cratedig.llm.common import keep


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """For links (a, b) between long nodes: (node, root), root being the smallest node reachable.

    Nodes without a link to another node, and links with a null end, are left out. Each round hooks every node's
    larger neighbours, then its smaller ones, onto its smallest neighbour; the number of rounds grows with the
    logarithm of the longest chain. Rounds are written tables. Only two numbers a round reach the driver.
    """
    edges = keep(
        links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
        "links",
    )
    state = None
    for _ in range(max_rounds):
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        star = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = star.groupBy("hi").agg(F.min("lo").alias("m"))
        edges = keep(
            star.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .union(low.select("hi", F.col("m").alias("lo"))).distinct(),
            "links",
        )
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
