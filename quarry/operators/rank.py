"""Ordering operators: full ranking (W1), top-n per query (W2), seed set
(W3), cut at k (W6).

Scores are compared after rounding to ``digits`` places and ties are broken
by url, so a ranking does not depend on the order floating sums were
added in (X18).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.config import DEFAULT
from quarry.operators import blocks
from quarry.plans.strategy import sized_join, stored
from quarry.session import ensure_checkpoint_dir


def order_key(score: str = "score", digits: int = 9):
    return [F.round(F.col(score), digits).desc(), F.col("url").asc()]


def top_n(scores: DataFrame, n: int, key: str = "query_id", score: str = "score", digits: int = 9) -> DataFrame:
    """The best ``n`` rows per key with their rank. ``row_number() <= n``
    is planned with a partial window-group-limit before the shuffle, so each
    map task forwards at most n rows per key."""
    w = Window.partitionBy(key).orderBy(*order_key(score, digits))
    return scores.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= n)


def largest(scores: DataFrame, n: int, score: str = "score") -> DataFrame:
    """The rows with the ``n`` largest scores per query of each task, without sorting the rest: the n-th largest of a query is
    among them, as far as scores alone tell. ``url`` is left empty."""
    kinds = dict(scores.dtypes)
    best = scores.select("query_id", score).mapInArrow(blocks.largest_fn(n), f"query_id {kinds['query_id']}, `{score}` {kinds[score]}")
    return best.withColumn("url", F.lit(""))


def rank_all(scores: DataFrame, key: str = "query_id", score: str = "score", digits: int = 9,
             partitions: int | None = None) -> DataFrame:
    """Rank every row within its key, without gathering a key's rows in
    one task (a single query ranks every document).

    1. range-partition on (key, score desc, url) and sort each partition:
       one key's rows may span many partitions;
    2. number rows inside each partition; checkpoint so the partition
       assignment is fixed even if tasks are re-run;
    3. count rows per (partition, key), prefix-sum those small counts per
       key, and add the offset back (a broadcast join of a table with about
       one row per partition).
    """
    spark = scores.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = F.round(F.col(score), digits)
    numbered = (
        scores.withColumn("_s", s)
        .repartitionByRange(n, F.col(key), F.col("_s").desc(), F.col("url"))
        .sortWithinPartitions(F.col(key), F.col("_s").desc(), F.col("url"))
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint()
    )
    counts = numbered.groupBy("_pid", key).agg(
        F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_cnt")
    )
    w = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    offsets = stored(offsets, "rank-offsets")
    return (
        sized_join(numbered, offsets, ["_pid", key], "url", DEFAULT.broadcast_bytes, DEFAULT.salts)
        .withColumn("rank", (F.col("_before") + F.col("_mid") - F.col("_first") + 1).cast("bigint"))
        .drop("_s", "_pid", "_mid", "_first", "_cnt", "_before")
    )


def first_n(docs: DataFrame, n: int, order_col: str = "doc_seq") -> DataFrame:
    """The first ``n`` rows by position (take-ordered: each task keeps
    its own n best, then one small merge; never a global window)."""
    return docs.orderBy(order_col).limit(n)


def cut(ranked: DataFrame, k: int) -> DataFrame:
    """Keep ranks 1..k."""
    return ranked.filter(F.col("rank") <= k)
