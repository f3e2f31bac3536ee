"""Filter interaction audit: what each of five filters removes under every order of application.

A row fails a set of filters, its mask. All that the audit asks for depends only on how many
rows (and labelled rows) of a part have each of the 32 masks, so Spark counts those cells
with map-side combining, and a Gray-code walk over the 32 subsets of filters gives the
survivors of every subset: each step toggles one filter, which raises or lowers the count of
active failures of the masks that hold it; a cell leaves the survivors when its count rises
from zero and comes back when it falls to zero. A step of an order is the difference of two
stored states.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACE

#: The filters, the lowest bit of a mask first.
FILTERS = "ABCDE"
_SCHEMA = ("part string, filter_order string, step int, filter string, kept long, removed long, redundant long, "
           "unique_fails long, good_lost long, toxic_lost long, shapley long")


@dataclass(frozen=True)
class Limits:
    """A: under ``min_words`` words. B: distinct words below ``min_distinct_pct`` % of the words. C: A-Z above
    ``max_upper_pct`` % of the code points. D: any character of ``marks``. E: the text of a smaller id."""

    min_words: int = 100
    min_distinct_pct: int = 80
    max_upper_pct: int = 10
    marks: str = "[#$%&*|]"


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
             limits: Limits = Limits()) -> DataFrame:
    """``doc_id, part, mask, n``: the ``n`` rows that agree in these and in their text. Null text and part are ''.

    A text repeats when a row with a smaller id has it; equal ids do not count, and null ids are neither
    smaller nor greater than others. The smallest id of each text is found on digests, and rows meet it by digest and id together,
    so a text that a third of the rows share is spread over the tasks."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = F.filter(F.split("text", SPACE + "+"), lambda w: w != "")
    seen = rows.select("doc_id", "part", "text", words.alias("words"))
    sized = seen.select("doc_id", "part", "text", F.size("words").cast("long").alias("n_words"),
                        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"))
    upper = F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long")
    conditions = (F.col("n_words") < limits.min_words,
                  F.col("n_distinct") * 100 < F.col("n_words") * limits.min_distinct_pct,
                  upper * 100 > F.length("text").cast("long") * limits.max_upper_pct,
                  F.col("text").rlike(limits.marks))
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions)), F.lit(0))
    kinds = (sized.select("doc_id", "part", mask.alias("own"), F.unhex(F.sha2("text", 256)).alias("digest"))
             .groupBy("digest", "doc_id", "part", "own").agg(F.count(F.lit(1)).alias("n")))
    first = kinds.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter("doc_id IS NOT NULL").withColumn("first", F.lit(True))
    repeats = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return kinds.join(first, ["digest", "doc_id"], "left").select(
        "doc_id", "part", (F.col("own") + F.when(repeats, 1 << 4).otherwise(0)).alias("mask"), "n")


def cells(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``part, mask, n, good, toxic``: rows, rows labelled quality 1, rows labelled toxic 1. Of several labels of an id any counts."""
    any_of = [F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(k) for c, k in (("quality", "is_good"), ("toxic", "is_toxic"))]
    known = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(*any_of)
    return failed.join(known, "doc_id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("is_good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("toxic"))


def survivors(masks: np.ndarray, counts: np.ndarray, n_filters: int = len(FILTERS)) -> np.ndarray:
    """The sums of ``counts`` (a row per mask) over the masks that fail none of a subset's filters, for each subset.

    One walk in Gray-code order: a step toggles one filter."""
    active, running = np.zeros(len(masks), np.int64), counts.sum(axis=0)
    states = np.zeros((1 << n_filters, counts.shape[1]), np.int64)
    states[0], subset = running, 0
    for step in range(1, 1 << n_filters):
        bit = (step & -step).bit_length() - 1
        subset ^= 1 << bit
        hit = (masks >> bit & 1).astype(bool)
        if subset >> bit & 1:
            running = running - counts[hit & (active == 0)].sum(axis=0)
            active[hit] += 1
        else:
            active[hit] -= 1
            running = running + counts[hit & (active == 0)].sum(axis=0)
        states[subset] = running
    return states


def _audited(pdf: pd.DataFrame) -> pd.DataFrame:
    """The steps of all orders for the cells of one part (32 at most)."""
    masks, counts = pdf["mask"].to_numpy(np.int64), pdf[["n", "good", "toxic"]].to_numpy(np.int64)
    states = survivors(masks, counts)
    fails = [int(counts[masks >> i & 1 == 1, 0].sum()) for i in range(len(FILTERS))]
    alone = [int(counts[masks == 1 << i, 0].sum()) for i in range(len(FILTERS))]
    rows, credit = [], [0] * len(FILTERS)
    for order in permutations(range(len(FILTERS))):
        subset = 0
        for step, i in enumerate(order, 1):
            lost = states[subset] - states[subset | 1 << i]
            subset |= 1 << i
            credit[i] += int(lost[0])
            rows.append([pdf["part"].iloc[0], "".join(FILTERS[f] for f in order), step, FILTERS[i], int(states[subset][0]), int(lost[0]),
                         fails[i] - int(lost[0]), alone[i], int(lost[1]), int(lost[2]), i])
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in _SCHEMA.split(", ")])
    out["shapley"] = out["shapley"].map(lambda i: credit[i])
    return out


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
          limits: Limits = Limits()) -> DataFrame:
    """One row per part, order of the five filters and step: ``kept`` after the step, ``removed`` by it,
    ``redundant`` (its filter's failures that an earlier step removed), ``unique_fails`` (rows that fail its filter
    only), ``good_lost`` and ``toxic_lost`` (labelled rows removed by it) and ``shapley`` (what its filter removes,
    summed over all orders). Counts stay within the part, repeats are found table-wide.

    Nulls in text and part are '', the empty text fails A only, rows without a label are neither good nor
    toxic, repeated rows count each, an empty table gives no rows; other columns are not read. A part's 32
    cells are one group, whatever its rows."""
    counted = cells(failures(docs, id_col, text_col, part_col, limits), labels)
    return counted.groupBy("part").applyInPandas(_audited, _SCHEMA)
