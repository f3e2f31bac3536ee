"""MinHash near-duplicates with fast similarity sketches.

A sketch has T coordinates. In round i < T every shingle hashes to a bin
and a value, and writes i + value there if the bin has nothing smaller; in
round T + j every shingle goes to bin j. Rounds stop when all bins are
full, which the second half guarantees, so that similarity estimates
concentrate and big sets cost one round. Rows of a sketch are banded;
documents that share a band are candidates and are confirmed on their full
shingle sets.

Exact copies collapse first (equal shingle sets). In each band bucket the
members are compared with one leader, the member with the most company in
all its buckets. Members of buckets that still hold several components are
compared again, through exact bounds on the places of their first common
shingle. So no group is expanded into all pairs and no link is given up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import heavy_keys, released, small, spread_join, written
from quarry.llm.components import components

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_FIRST_TABLE = "doc_id bigint, n_shingles bigint, set_id binary, bands array<bigint>"


@dataclass(frozen=True)
class Near:
    """``shingle`` words per shingle; a link needs 100 * intersection >= ``percent`` * union.
    ``bands`` x ``rows`` sketch coordinates: a pair at 0.8 shares no band with probability
    (1 - 0.8 ** rows) ** bands, 5e-8 for the defaults."""

    shingle: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * _M1
        x = (x ^ (x >> np.uint64(33))) * _M2
        return x ^ (x >> np.uint64(33))


def _texts(column: pa.Array) -> Iterator[bytes | None]:
    """The texts of a column as UTF-8, one at a time, so that a batch is not held twice."""
    return (x.as_py() for x in column.cast(pa.binary()))


def shingle_set(text: bytes | None, size: int, memo: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text; ``memo`` has the hashes of recent words."""
    words = text.translate(_UPPER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(memo) > 50_000:
        memo.clear()
    for w in words:
        if w not in memo:
            memo[w] = xxhash.xxh64_intdigest(w)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    k = min(size, len(h))
    n = len(h) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = _mix(out ^ h[i:i + n]) + np.uint64(i + 1)
    return np.unique(out)


def sketch(hashes: np.ndarray, t: int) -> np.ndarray:
    """The sketch of a non-empty set: T values, each the round in the high bits and a 48-bit value below."""
    best = np.full(t, np.iinfo(np.uint64).max, np.uint64)
    i, m = 0, len(hashes)
    while True:
        count = max(1, min(t - i if i < t else 2 * t - i, 1024 // m))
        rounds = np.arange(i, i + count, dtype=np.uint64)
        x = _mix(hashes[None, :] ^ _mix(rounds + np.uint64(0x51ED2701))[:, None])
        if i < t:
            bins = (x % np.uint64(t)).astype(np.intp)
        else:
            bins = np.broadcast_to((rounds - np.uint64(t)).astype(np.intp)[:, None], x.shape)
        np.minimum.at(best, bins.ravel(), ((rounds[:, None] << np.uint64(48)) | (x >> np.uint64(16))).ravel())
        i += count
        # a bin filled in round r can only be beaten in round r, so stopping after a block of rounds changes nothing
        if i >= 2 * t or best.max() != np.iinfo(np.uint64).max:
            return best


def _first_pass(conf: Near):
    """mapInArrow body: (doc_id, text) to set size, set identity and band keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, memo = conf.bands * conf.rows, {}
        salt = _mix(np.arange(1, conf.bands + 1, dtype=np.uint64))
        for batch in batches:
            sizes, sets, bands = [], [], []
            for text in _texts(batch.column(1)):
                s = shingle_set(text, conf.shingle, memo)
                sizes.append(len(s))
                if not len(s):
                    sets.append(None)
                    bands.append(None)
                    continue
                sets.append(xxhash.xxh128_digest(s.tobytes()))
                rows, key = sketch(s, t).reshape(conf.bands, conf.rows), salt
                for r in range(conf.rows):
                    key = _mix(key ^ rows[:, r]) + np.uint64(r)
                bands.append(key.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_id", "bands"])
    return run


def _sets(conf: Near):
    """mapInArrow body: (doc_id, text) to the full shingle set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = {}
        for batch in batches:
            rows = [shingle_set(x, conf.shingle, memo).astype(np.int64) for x in _texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int64()))], names=["rep", "shingles"])
    return run


def _fits(a: Column, b: Column, conf: Near) -> Column:
    """Sizes that allow a link."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * conf.percent


def _confirmed(pairs: DataFrame, sets: DataFrame, conf: Near) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    inter = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - inter
    return both.filter(inter * 100 >= union * conf.percent).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", conf: Near = Near()) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest doc_id reachable over links, ``kept``
    says that it is the document's own. A null or empty text, or one of
    white space, has no shingle and is linked with nothing. Rows with a
    null id are linked with nothing, have no component and are kept. Rows
    that share an id are one document: they are in one component, and their
    sets all count. Ties (equal sets) go to the smallest id. Other columns
    are not read; an empty table gives an empty result."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    first = written(texts.mapInArrow(released(_first_pass(conf)), _FIRST_TABLE), "sketches")
    known = first.filter("doc_id is not null and set_id is not null")

    # equal sets: the smallest id stands for all
    reps = written(known.groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "copies")
    copies = spread_join(known.select("doc_id", "set_id"), reps.select("set_id", "rep"), "set_id", heavy_keys(reps, "set_id", "n"), "doc_id", "left")
    members = written(copies.select("doc_id", F.coalesce("rep", "doc_id").alias("rep")).distinct(), "members")
    keyed = known.select("doc_id", "n_shingles", "bands").join(
        members.filter("doc_id = rep").select("doc_id").distinct(), "doc_id").dropDuplicates(["doc_id", "n_shingles", "bands"])
    rows = keyed.select(F.explode("bands").alias("key"), F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"))
    rows = written(rows, "band-rows")
    counts = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("company")).filter("company > 1"), "companies")
    crowds = heavy_keys(counts, "key", "company")
    buckets = written(spread_join(rows, counts, "key", crowds, "rep"), "buckets")

    # leaders: most company over all buckets, then the smallest id
    weight = buckets.groupBy("rep").agg(F.sum("company").alias("weight"), F.max("n").alias("size"))
    weight = written(weight, "weights")
    placed = buckets.select("key", "rep").join(weight, "rep")
    leaders = placed.groupBy("key").agg(F.min(F.struct((-F.col("weight")).alias("w"), F.col("rep").alias("rep"), F.col("size").alias("size"))).alias("lead"))
    stars = (spread_join(placed, leaders, "key", crowds, "rep").filter((F.col("rep") != F.col("lead.rep")) & _fits(F.col("size"), F.col("lead.size"), conf))
             .groupBy("rep", F.col("lead.rep").alias("leader")).agg(F.count(F.lit(1)).alias("shared")))
    # of several leaders, a member is first compared with the one it shares most bands with
    best = stars.groupBy("rep").agg(F.max(F.struct("shared", (-F.col("leader")).alias("leader"))).alias("m"))
    pairs = written(best.select(F.col("rep").alias("b"), (-F.col("m.leader")).alias("a")), "star-pairs")

    wanted = weight.select("rep").distinct()
    if small(weight, 16):
        wanted = F.broadcast(wanted)
    sets = written(texts.join(wanted, texts["doc_id"] == F.col("rep"), "left_semi").mapInArrow(released(_sets(conf)), "rep bigint, shingles array<bigint>"), "sets")
    stars = written(_confirmed(pairs, sets, conf), "star-links")
    same = members.filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    # ids with several sets tie their sets together; most tables have none, and the edges say so
    labels = components(stars)
    links = stars.union(_open_links(buckets, crowds, labels, sets, pairs, conf))
    final = components(links.union(_shared_ids(members))).withColumnRenamed("node", "rep")
    stood = heavy_keys(written(members.groupBy("rep").agg(F.count(F.lit(1)).alias("n")), "stands-for"), "rep", "n")
    tops = spread_join(members, final, "rep", stood, "doc_id", "left").select(
        "doc_id", F.least("rep", F.coalesce("label", "rep")).alias("component_id"))
    tops = tops.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = first.select("doc_id", "n_shingles").join(tops, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def _shared_ids(members: DataFrame) -> DataFrame:
    """Links between the representatives of an id that stands for several sets."""
    several = members.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a <> b")
    return members.join(several.select("doc_id", "a"), "doc_id").filter("rep <> a").select("a", F.col("rep").alias("b"))


def _open_links(buckets: DataFrame, crowds: DataFrame, labels: DataFrame, sets: DataFrame, tested: DataFrame, conf: Near) -> DataFrame:
    """Links between members of one bucket that the leaders left in different components.

    Shingles of the members of such buckets are ordered, rarest first. Two
    linked sets share a shingle among the first |x| - o + 1 of each, o being
    the overlap that the threshold asks for, and at their first common
    shingle, in places i and j, at least o of both sets must remain. A hub's
    shingles come late in the sets that differ much from it, so a big group
    around a hub yields few pairs. Both bounds are exact. Per shingle the
    most frequent component is only on one side of the join, so its members
    are not paired among themselves."""
    own = buckets.select("key", "rep").join(labels, buckets["rep"] == labels["node"], "left").select(
        "key", "rep", F.coalesce("label", "rep").alias("label"))
    own = written(own, "labelled-buckets")
    mixed = own.groupBy("key").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).filter("l0 <> l1").select("key")
    there = written(spread_join(own, mixed, "key", crowds, "rep").select("rep", "label").distinct(), "open-members")
    shingles = sets.join(there, "rep").select("rep", "label", F.size("shingles").alias("n"), F.explode("shingles").alias("h"))
    shingles = written(shingles, "open-shingles")
    common = shingles.groupBy("h").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    # a set is one document's, so its array is bounded by the document
    ordered = (shingles.join(common, "h", "left").groupBy("rep", "label", "n")
               .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(1)).alias("df"), "h"))).alias("all")))
    need = F.ceil(F.col("n") * conf.percent / 100)
    firsts = ordered.select("rep", "label", "n", F.posexplode(F.slice("all", F.lit(1), (F.col("n") - need + 1).cast("int"))).alias("i", "s"))
    firsts = written(firsts.filter("s.df > 1").select("rep", "label", "n", "i", F.col("s.h").alias("h")), "first-shingles")
    by_label = firsts.groupBy("h", "label").agg(F.count(F.lit(1)).alias("n"))
    held = by_label.groupBy("h").agg(F.max(F.struct("n", "label"))["label"].alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("labels"))
    held = written(held.filter("labels > 1"), "held-shingles")
    # the rows carry the pieces of their shingle, so neither side looks them up again
    pieces = F.coalesce("_pieces", F.lit(1)).alias("pieces")
    held = held.join(F.broadcast(heavy_keys(held, "h", "n")), "h", "left").select("h", "top", pieces)
    firsts = written(firsts.join(held, "h"), "paired-shingles")
    names = [F.col(c).alias("x_" + c) for c in ("rep", "label", "n", "i")]
    others = firsts.filter(F.col("label") != F.col("top")).select(
        "h", *names, F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("salt"))
    pairs = firsts.withColumn("salt", F.pmod(F.xxhash64("rep"), F.col("pieces")).cast("int")).join(others, ["h", "salt"])
    overlap = F.ceil((F.col("x_n") + F.col("n")) * conf.percent / (100 + conf.percent))
    left = F.least(F.col("x_n") - F.col("x_i"), F.col("n") - F.col("i"))
    once = (F.col("label") == F.col("top")) | (F.col("x_rep") < F.col("rep"))
    pairs = pairs.filter((F.col("x_label") != F.col("label")) & once & (left >= overlap) & _fits(F.col("x_n"), F.col("n"), conf))
    pairs = pairs.select(F.least("x_rep", "rep").alias("a"), F.greatest("x_rep", "rep").alias("b")).distinct()
    done = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = written(pairs.join(done, ["a", "b"], "left_anti"), "open-pairs")
    return written(_confirmed(pairs, sets, conf), "open-links")
