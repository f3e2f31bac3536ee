"""Physical-strategy helpers.

A derived side of a join is first stored in the shared folder: its rows are then the same for
every reader, a lost executor costs its own tasks only, and its size is a fact. It is
broadcast up to a bound in bytes; beyond, the join deals every key to ``salts`` pieces by a
hash of another column, so that no key's rows meet in one task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from quarry.session import scratch_path


#: How tables are written. Parquet keeps a column's distinct values in a dictionary of up to that many bytes; by default (1 MB)
#: the terms of a file's postings outgrow it and are written out row by row.
WRITING = {"compression": "zstd", "parquet.dictionary.page.size": str(16 << 20)}


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{tag}-{uuid.uuid4().hex[:12]}")
    df.write.options(**WRITING).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table_bytes(df: DataFrame) -> int:
    """Bytes of the values of a (stored, narrow) table: 8 a number, the bytes of strings, 8 an array element."""
    width = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, StringType):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, ArrayType):
            width = width + 8 * F.coalesce(F.size(f.name), F.lit(0))
        width = width + 8
    return df.agg(F.sum(width)).first()[0] or 0


def sized_join(big: DataFrame, side: DataFrame, keys: str | list[str], by: str, max_bytes: int, salts: int,
               how: str = "inner") -> DataFrame:
    """``big`` joined with ``side`` (stored), the rows of ``big`` kept as ``how`` (inner, left, left_semi) says.

    Up to ``max_bytes`` the side is broadcast. Beyond, the rows of ``big`` go to a piece of their key by the
    hash of their column ``by``, and the side's rows to every piece: equal rows, bounded tasks."""
    if table_bytes(side) <= max_bytes:
        return big.join(F.broadcast(side), keys, how)
    keys = [keys] if isinstance(keys, str) else list(keys)
    left = big.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    right = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def one_row(df: DataFrame) -> DataFrame:
    """A global aggregate has exactly one row: always safe to broadcast."""
    return F.broadcast(df)


def spread(df: DataFrame, factor: int = 2) -> DataFrame:
    """Spread a scan that came back in fewer partitions than the cluster has
    cores (a single large row group, say) with a round-robin repartition.
    A scan of many files already has enough partitions and is returned as
    is, so this adds no shuffle at scale."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * factor) if df.rdd.getNumPartitions() < cores else df
