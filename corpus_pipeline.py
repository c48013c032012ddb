"""A corpus pipeline over ``documents`` built from the operators of ``cratedig.llm``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cratedig import session
from cratedig.llm import language, mixing, pieces, quality, simhash

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of unknown language go."""
    return language.accepted(docs)


def host_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or whose source fails a rule as a whole, go."""
    return quality.kept(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash links stays."""
    return simhash.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix of its source takes it."""
    return mixing.mixed(docs)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The text gives way to its piece ids and what they decode to."""
    return pieces.with_pieces(docs, PIECE_BPE)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("host_quality", host_quality),
    ("simhash_near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("piece_encoding", piece_encoding),
]

#: SQL has neither the text model, the fingerprints, the row hashes nor the vocabulary; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes its rows to the shared folder and the next one reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        path = session.scratch(spark, name)
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
