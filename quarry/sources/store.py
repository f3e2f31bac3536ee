"""Parquet sinks and sources for the engine's tables.

Every table is written with an explicit schema and read back with it; a
missing table reads as empty (S8), an invalid one is reported and ignored
(S10). Written tables are also where lineage is cut: later stages read the
files, not the plan that produced them.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quarry.plans.strategy import WRITING

log = logging.getLogger(__name__)

CORPUS_SCHEMA = "url string, content string"
EXPANDED_SCHEMA = "url string, doc_seq bigint, expanded_content string"
DOC_VEC_SCHEMA = "url string, dims array<int>, ws array<double>"
VOCAB_VEC_SCHEMA = "term string, dims array<int>, ws array<double>"


def write_table(df: DataFrame, path: str, *partition_by: str) -> None:
    """Overwrite a Parquet table, no index column."""
    df.write.mode("overwrite").options(**WRITING).partitionBy(*partition_by).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own tables, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The table with the columns it was written with; None when its path does not exist. Other faults are raised. A
    partitioned table without rows has no files to tell its columns, so it has those of ``schema``."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as fault:
        if fault.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return spark.createDataFrame([], schema)
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """Read a table with its declared schema; None when it does not exist.
    A table that lacks a declared column is refused, as it would read as nulls."""
    stored = _stored(spark, path, schema)
    if stored is None:
        return None
    df = spark.read.schema(schema).parquet(path)
    missing = [c for c in df.columns if c not in stored.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    return df


def save_expanded(docs: DataFrame, path: str) -> None:
    """(url, doc_seq, expanded_content); the writer creates parent folders."""
    write_table(docs.select("url", "doc_seq", F.col("text").alias("expanded_content")), path)


def load_expanded(spark: SparkSession, path: str) -> DataFrame:
    """The saved expansions as (url, doc_seq, text); absent -> no rows."""
    df = read_table(spark, path, EXPANDED_SCHEMA)
    if df is None:
        log.warning("no expanded documents at %s", path)
        return spark.createDataFrame([], "url string, doc_seq bigint, text string")
    return df.select("url", "doc_seq", F.col("expanded_content").alias("text"))


def save_vectors(doc_vec: DataFrame, vocab_vec: DataFrame, doc_path: str, vocab_path: str) -> bool:
    """Document vectors, and vocabulary vectors with their word list as
    one table; nothing to save -> warning."""
    if doc_vec is None and vocab_vec is None:
        log.warning("no vectors to save")
        return False
    if doc_vec is not None:
        write_table(doc_vec.select("url", "dims", "ws"), doc_path)
    if vocab_vec is not None:
        write_table(vocab_vec.select("term", "dims", "ws"), vocab_path)
    return True


def load_vectors(spark: SparkSession, doc_path: str, vocab_path: str):
    """(doc_vec, vocab_vec); a part that is missing or has the wrong
    columns is reported and returned as None."""
    out = []
    for path, schema, cols in ((doc_path, DOC_VEC_SCHEMA, {"url", "dims", "ws"}),
                               (vocab_path, VOCAB_VEC_SCHEMA, {"term", "dims", "ws"})):
        df = _stored(spark, path, schema)
        if df is None:
            log.warning("no vectors at %s", path)
            out.append(None)
            continue
        if not cols.issubset(df.columns):
            log.error("invalid vector table at %s: %s", path, df.columns)
            out.append(None)
            continue
        out.append(spark.read.schema(schema).parquet(path).select(*[c.split()[0] for c in schema.split(", ")]))
    return tuple(out)
