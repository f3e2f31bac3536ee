"""A training-data pipeline over ``documents``: five stages, each a Parquet table that the next one reads.

For every stage: an empty table stays empty, further columns come along whatever their names (the last stage returns its own columns), rows with a null
id are kept unless their text fails, repeated rows are treated alike, very long texts are read whole. What null and empty texts
come to is said at each stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, decontam, minhash, quality, secretscan
from quarry.llm.catalog import MULTI_RANKS
from quarry.llm.common import maybe_broadcast, read_table, written


def _without(docs: DataFrame, dropped: DataFrame, tag: str) -> DataFrame:
    """``docs`` without the rows whose doc_id is in ``dropped``; rows with a null id stay."""
    ids = written(dropped.select(F.col("doc_id").alias("_dropped")).distinct(), tag)
    return docs.join(maybe_broadcast(ids, 16), docs["doc_id"] == F.col("_dropped"), "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, their failing lines removed; null and empty texts go."""
    return quality.cleaned(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id (all rows of that id): five-word shingles, similarity 0.8 or more.
    Texts without a word are in no group and stay."""
    return _without(docs, minhash.near_duplicates(docs).filter("not kept"), "near-copies")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; null and empty texts hold none and stay."""
    return _without(docs, decontam.leaks(docs, read_table(spark, sf_dir, "benchmark")), "leaking-docs")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; null and empty texts stay as they are."""
    return secretscan.redact(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digest of what they decode to; null and empty texts have no ids."""
    encoded = bpe.encode(docs, MULTI_RANKS, public_tokenizers.PATTERN)
    return bpe.decode(encoded, MULTI_RANKS).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                                                   F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("secret scans", secret_scan),
    ("byte-level bpe", byte_bpe),
]

#: The last stage encodes with a vocabulary file, which SQL cannot express; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
