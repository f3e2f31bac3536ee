"""Helpers shared by the operators: intermediate tables, bounds, prefix sums."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path

#: White space of the word rule: space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]"
#: A side of a join is broadcast only up to this many bytes, counted on the rows themselves.
BROADCAST_BYTES = 16 << 20
#: A key that holds more than one row in so many is dealt to several tasks; at most so many keys can.
HEAVY_SHARE = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def new_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names."""
    return scratch_path(spark, f"{tag}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, tag: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later stages start
    from files that every executor can read, so a lost executor costs its own
    tasks only, and two readers see the same rows."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Give back what the allocators of this process hold unused."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def released(body):
    """An Arrow batch function that gives its task's memory back at its end: workers are kept for later tasks and stages, and
    would keep what their allocators hold."""
    def run(batches):
        try:
            yield from body(batches)
        finally:
            release()
    return run


def settled(flag: Column) -> Column:
    """``flag``, computed once where it stands. A filter moves below projections
    by repeating their expressions inside itself; the always true term
    that is not deterministic keeps a filter on this column above."""
    return F.when(F.monotonically_increasing_id() >= 0, flag)


def small(df: DataFrame, bytes_per_row: int) -> bool:
    """Whether a written table is below the broadcast bound (an exact row count of narrow rows)."""
    return df.count() * bytes_per_row <= BROADCAST_BYTES


def maybe_broadcast(df: DataFrame, bytes_per_row: int) -> DataFrame:
    """``df`` with a broadcast hint when its counted size allows one; else as it is, for a shuffled join."""
    return F.broadcast(df) if small(df, bytes_per_row) else df


def heavy_keys(counts: DataFrame, key: str, n: str) -> DataFrame:
    """``key, _pieces``: the keys of ``counts`` (one row per key, a written table) that hold more than one row in
    HEAVY_SHARE, and how many pieces leave no more than that in one. There are fewer than HEAVY_SHARE of them."""
    total = counts.agg(F.sum(n)).first()[0] or 1
    pieces = F.least(F.col(n), F.ceil(F.col(n) * HEAVY_SHARE / F.lit(total))).cast("int")
    return counts.select(key, pieces.alias("_pieces")).filter("_pieces > 1")


def spread_join(left: DataFrame, right: DataFrame, key: str, heavy: DataFrame, by: str, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on ``key``, every row of both kept as a plain join keeps it. The left
    rows of a heavy key are dealt to its pieces by the hash of ``by``, its right rows go to each piece."""
    heavy = F.broadcast(heavy)
    pieces = F.coalesce("_pieces", F.lit(1))
    salted = left.join(heavy, key, "left").withColumn("_salt", F.pmod(F.xxhash64(by), pieces).cast("int")).drop("_pieces")
    repeated = right.join(heavy, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("_pieces")
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once and stands in the plan once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), 0)


def running_sums(values: Column, chunk: int = 256) -> Column:
    """Inclusive prefix sums of an int array, built chunk by chunk so that
    the work stays near linear in the array's length."""
    def grow(zero, xs):
        return F.aggregate(
            xs, F.struct(zero.alias("s"), F.array().cast("array<bigint>").alias("a")),
            lambda acc, x: F.struct((acc["s"] + x).alias("s"), F.array_append(acc["a"], acc["s"] + x).alias("a")),
            lambda acc: acc["a"])

    zero = F.lit(0).cast("bigint")

    def cut(xs):
        return F.transform(F.sequence(F.lit(0), F.greatest(F.floor((F.size(xs) - 1) / chunk), F.lit(0)).cast("int")),
                           lambda i: F.slice(xs, i * chunk + 1, chunk))

    def summed(pieces):
        # totals of the chunks before each one
        ends = grow(zero, F.transform(pieces, lambda xs: F.aggregate(xs, zero, lambda a, x: a + x)))
        starts = let(ends, lambda e: F.slice(F.concat(F.array(zero), e), F.lit(1), F.size(e)))
        return F.flatten(F.zip_with(pieces, starts, lambda xs, s: F.transform(grow(zero, xs), lambda x: x + s)))

    return let(values, lambda xs: F.when(F.size(xs) > 0, let(cut(xs), summed)).otherwise(F.array().cast("array<bigint>")))
