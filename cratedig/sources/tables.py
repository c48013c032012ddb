"""Stored tables: Parquet in key buckets, rewritten bucket by bucket."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

BUCKET = "_bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_or_empty(spark: SparkSession, path: str, schema: str, folder_column: str) -> DataFrame:
    """What is stored under a path, with the column its folders are named by; empty before the first write."""
    whole = f"{schema}, {folder_column}"
    try:
        return spark.read.schema(whole).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], whole).limit(0)  # known to be empty, so merging with it is no join


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The stored table, or an empty one when nothing has been written yet."""
    return read_or_empty(spark, path, schema, f"{BUCKET} int").drop(BUCKET)


def upsert_into(
    spark: SparkSession,
    path: str,
    schema: str,
    batch: DataFrame,
    keys: Sequence[str],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    buckets: int = 64,
    files: int = 4,
) -> None:
    """Merges a batch into a stored table and rewrites only the buckets it touches.

    The touched bucket numbers are at most ``buckets`` values, so they can be
    collected; with them the read side is pruned to those folders. Repeating
    the call after a failure gives the same table as long as ``merge`` does. A
    bucket is written by up to ``files`` tasks, so choose buckets * files by size.
    """
    placed = batch.withColumn(BUCKET, bucket_of(keys, buckets))
    touched = [r[0] for r in placed.select(BUCKET).distinct().collect()]
    if not touched:
        return
    stored = read_or_empty(spark, path, schema, f"{BUCKET} int").filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
    merged = merge(stored, batch).withColumn(BUCKET, bucket_of(keys, buckets))
    (
        merged.repartition(min(len(touched), buckets) * files, BUCKET, F.pmod(F.xxhash64(*keys, F.lit("file")), F.lit(files)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(BUCKET)
        .parquet(path)
    )
