"""What several operators share: words, stored intermediate tables, per-process caches."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cratedig import session

#: A word is a run of anything but the six ASCII white-space characters, which is what ``bytes.split()`` cuts at.
WORD = r"[^\x20\x09-\x0D]+"


def keep(df: DataFrame, label: str) -> DataFrame:
    """Writes a table once to the shared folder and reads it back, which cuts the lineage there."""
    spark = df.sparkSession
    path = session.scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def as_bytes(text: str = "text") -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(text).cast("string").cast("binary"), F.lit(b""))


def crc_mod(doc_id: str, n: int) -> Column:
    """crc32 of the id written as text, modulo n; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


def clear_of(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that no column of ``df`` has, whatever the letter case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def worker_store(name: str) -> dict:
    """A dictionary that lives as long as this Python process, so that later tasks of a worker find it filled.

    Only the operator that asked last keeps one; another's is given up.
    """
    holder = sys.modules.setdefault("_cratedig_worker_store", types.ModuleType("_cratedig_worker_store"))
    held = getattr(holder, "held", None)
    if held is None or held[0] != name:
        held = holder.held = (name, {})
    return held[1]


def content_key(df: DataFrame, columns: list[str]) -> Column:
    """128 bits that depend on the values of some columns, and on which are null: rows with equal values have equal keys.

    Columns that hold maps have no hash and are left out.
    """
    plain = [F.col(f"`{c}`") for c in columns if "map<" not in dict(df.dtypes)[c]]
    nulls = [c.isNull() for c in plain]
    return F.struct(F.xxhash64(*plain, *nulls).alias("a"), F.xxhash64(F.lit("b"), *nulls, *reversed(plain)).alias("b"))


def hash_cut(rows: DataFrame, h: Column, most: int, bits: int = 12) -> int:
    """The largest bound, as far as found, that at most ``most`` distinct hashes (long) don't exceed.

    Distinct hashes are counted by their leading bits, and only the bucket at the bound is counted again by its next
    bits: the driver gets at most ``2 ** bits`` counts at a time, no task more than its share. Below the smallest long
    there is nothing, so a bound of that value may leave one hash.
    """
    hashed = rows.select(h.alias("h")).where("h is not null").distinct()
    low, width, left = -(1 << 63), 64, most
    while width > 0 and left > 0:
        step = min(bits, width)
        width -= step
        counts = hashed.where(F.col("h").between(low, low + (1 << width + step) - 1)).groupBy(F.shiftright("h", width).alias("at")).agg(F.count(F.lit(1)).alias("n"))
        found = {r["at"]: r["n"] for r in counts.collect()}
        at, last = low >> width, (low >> width) + (1 << step)
        while at < last and found.get(at, 0) <= left:
            left -= found.get(at, 0)
            at += 1
        low = at << width
        if at == last or found[at] <= max(64, most // 8) and left < most // 2:
            break
    return max(low - 1, -(1 << 63))


def bounded(rows: DataFrame, h: Column, value: str, most: int, longest: int = 1 << 15) -> list:
    """At most ``most`` values of at most ``longest`` bytes, those of smallest hash, one for each hash."""
    hashed = rows.select(h.alias("h"), F.col(value).alias("v")).where(F.octet_length("v") <= longest)
    few = hashed.where(F.col("h") <= hash_cut(hashed, F.col("h"), most)).groupBy("h").agg(F.min("v").alias("v"))
    return [r["v"] for r in few.orderBy("h").collect()]


class Recent:
    """A cache of two generations: what is used again moves to the newer one, the older one goes when that is full."""

    def __init__(self, limit: int):
        self.limit = limit
        self.new: dict = {}
        self.old: dict = {}

    def ensure(self, keys: Iterable, make: Callable[[list], Iterable]) -> dict:
        """A dictionary that holds all the keys; ``make`` gives the values of those not known."""
        if len(self.new) > self.limit:
            self.old, self.new = self.new, {}
        new, old, unknown = self.new, self.old, []
        for key in (keys if isinstance(keys, set) else set(keys)).difference(new):
            if (value := old.get(key)) is None:
                unknown.append(key)
            else:
                new[key] = value
        new.update(zip(unknown, make(unknown)))
        return new


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Numbers all rows from 0 in a total order without gathering them in one task.

    Rows are range-partitioned and numbered inside their partition; only one
    count per partition is summed up globally.
    """
    from pyspark.sql import Window

    part, before, n = clear_of(df, "part", "before", "n")
    placed = keep(df.repartitionByRange(shuffle_parts(df.sparkSession), *order).withColumn(part, F.spark_partition_id()), "numbered")
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias(n))
    starts = counts.select(
        F.col(part),
        F.coalesce(F.sum(n).over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(before),
    )
    inside = F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1
    return placed.withColumn(name, inside.cast("bigint")).join(starts, part).withColumn(name, F.col(name) + F.col(before)).drop(part, before)


session.ship_with_jobs(__name__)
