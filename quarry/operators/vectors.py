"""Vector operators (V1-V5, V8, V9).

An embedder maps ``DataFrame(key, text) -> DataFrame(key, dims, ws)``: sparse entries, or a dense
vector in ``ws`` with ``dims`` null; unit length, or zero. Row-wise embedders
(hashing, or any function of an Arrow batch of texts) add no shuffle; supplied vectors
are joined by key. The default ones hash words (documents, queries) or character trigrams (single
words): deterministic and reproducible in DuckDB, lexical stand-ins for the reference's
neural model, which is not available here.

Every product of two vector tables (V3, V4) packs both sides into blocks and multiplies
block by block in the tasks; each task keeps the best n rows per query.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.config import DEFAULT, Params
from quarry.functions.text import uncut
from quarry.operators import blocks
from quarry.plans.strategy import stored, table_bytes

VECTOR = "dims array<int>, ws array<double>"


def _types(df: DataFrame, columns: list[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join(f"`{c}` {kinds[c]}" for c in columns)


class RowEmbedder:
    """Embeds each row by itself: ``prepared`` is evaluated by Spark, ``batch`` gets its values in Arrow batches."""

    dense = False
    costly = False

    def prepared(self, text: str) -> Column:
        return F.col(text)

    def batch(self):
        raise NotImplementedError

    def embed(self, df: DataFrame, key: str | list[str], text: str = "text") -> DataFrame:
        keys = [key] if isinstance(key, str) else list(key)
        rows = df.select(*keys, self.prepared(text).alias("_text"))
        return rows.mapInArrow(blocks.embed_fn(self.batch(), keys, self.dense), f"{_types(df, keys)}, {VECTOR}")


@dataclass(frozen=True)
class WordHashEmbedder(RowEmbedder):
    """V1 (b): normalised words, hashed to ``size`` signed dimensions, raw
    counts, unit length. The empty word carries no weight."""

    size: int = 256

    def prepared(self, text: str) -> Column:
        return uncut(F.coalesce(F.col(text), F.lit("")))

    def batch(self):
        return blocks.hash_batch(blocks.word_features, self.size)

    def embed_counts(self, packed: DataFrame) -> DataFrame:
        """``embed`` of the texts whose packed postings (url, dl, terms, tfs) these are."""
        return packed.select("url", "terms", "tfs").mapInArrow(blocks.embed_counts_fn(self.size), f"{_types(packed, ['url'])}, {VECTOR}")

    def descriptor(self) -> dict:
        return {"kind": "word-hash", "size": self.size}


@dataclass(frozen=True)
class TrigramHashEmbedder(RowEmbedder):
    """Vectors for single words: character trigrams of '#word#', hashed."""

    size: int = 256

    def batch(self):
        return blocks.hash_batch(blocks.trigram_features, self.size)

    def descriptor(self) -> dict:
        return {"kind": "trigram-hash", "size": self.size}


@dataclass(frozen=True)
class ArrowEmbedder(RowEmbedder):
    """Any function of a list of texts to a matrix of ``size`` columns (a model's encode, say), called per Arrow batch in the tasks.
    ``name`` stands for it in a stored index. Distinct texts are embedded once, as a call may be dear."""

    fn: object
    size: int
    name: str

    dense = True
    costly = True

    def batch(self):
        return self.fn

    def descriptor(self) -> dict:
        return {"kind": "arrow", "size": self.size, "name": self.name}


@dataclass(frozen=True)
class SuppliedVectors:
    """V1 (a): vectors that exist already, ``vectors(key, vec)``, looked up by the first key column as a string. Rows without one get the zero vector."""

    vectors: DataFrame = field(compare=False)
    size: int = 64
    name: str = "supplied"
    key: str = "key"
    vec: str = "vec"

    costly = False

    def embed(self, df: DataFrame, key: str | list[str], text: str = "text") -> DataFrame:
        keys = [key] if isinstance(key, str) else list(key)
        known = self.vectors.select(F.col(self.key).cast("string").alias("_key"), F.transform(self.vec, lambda x: x.cast("double")).alias("_v"))
        norm = F.sqrt(F.aggregate("_v", F.lit(0.0), lambda a, x: a + x * x))
        unit = known.select("_key", F.col("_v"), norm.alias("_n")).select(
            "_key", F.transform("_v", lambda x: F.when(F.col("_n") > 0, x / F.col("_n")).otherwise(F.lit(0.0))).alias("ws"))
        rows = df.select(*keys, F.col(keys[0]).cast("string").alias("_key")).join(unit, "_key", "left")
        return rows.select(*keys, F.lit(None).cast("array<int>").alias("dims"), F.coalesce("ws", F.array().cast("array<double>")).alias("ws"))

    def descriptor(self) -> dict:
        return {"kind": "supplied", "size": self.size, "name": self.name}


def embedder_of(descriptor: dict):
    """The embedder that a stored index names; supplied and custom ones must be passed by the caller."""
    kinds = {"word-hash": WordHashEmbedder, "trigram-hash": TrigramHashEmbedder}
    if descriptor["kind"] not in kinds:
        raise ValueError(f"the index was built with {descriptor}; pass that embedder")
    return kinds[descriptor["kind"]](descriptor["size"])


def embed_distinct(docs: DataFrame, embedder, key: str = "url", text: str = "text", order: str = "doc_seq") -> DataFrame:
    """V8 with A10: embed each distinct text once, then give every key the
    vector of its text. Texts are told apart by their SHA-256 digests: narrow rows find the first
    row of each digest, only those rows' texts are embedded, and vectors go back by digest. Within the byte bound the digests
    that occur again are broadcast, and texts stay where they are read."""
    digest = F.unhex(F.sha2(F.col(text), 256))
    keyed = docs.select(key, order, digest.alias("_h"))
    counts = keyed.groupBy("_h").agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n"))
    again = stored(counts.filter("_n > 1").select("_h", "_first"), "repeated-texts")
    # 32 bytes and a position a row
    if again.count() * 48 <= DEFAULT.broadcast_bytes:
        marked = docs.select(key, order, text, digest.alias("_h")).join(F.broadcast(again), "_h", "left")
        own = F.col("_first").isNull() | (F.col(order) == F.col("_first"))
        chosen = marked.filter(own).select(key, "_h", F.col("_first").isNotNull().alias("_shared"), text)
        vec = stored(embedder.embed(chosen, [key, "_h", "_shared"], text), "distinct-vectors")
        shared = keyed.join(F.broadcast(again), "_h").select(key, "_h").join(vec.filter("_shared").select("_h", "dims", "ws"), "_h")
        return vec.filter("not _shared").select(key, "dims", "ws").unionByName(shared.select(key, "dims", "ws"))
    first = keyed.groupBy("_h").agg(F.min(order).alias(order))
    chosen = docs.select(order, text).join(first, order)
    vec = stored(embedder.embed(chosen, "_h", text), "distinct-vectors")
    return keyed.select(key, "_h").join(vec, "_h").select(key, "dims", "ws")


def embed_all(docs: DataFrame, embedder, key: str = "url", text: str = "text", packed: DataFrame | None = None) -> DataFrame:
    """V8: vectors of all documents; dear embedders see each distinct text once. An embedder of counted words takes them from the
    documents' packed postings, if there are any, and cuts no text again."""
    if packed is not None and hasattr(embedder, "embed_counts"):
        return embedder.embed_counts(packed)
    return embed_distinct(docs, embedder, key, text) if embedder.costly else embedder.embed(docs, key, text)


def sparse_rows(vectors: DataFrame, key: str) -> DataFrame:
    """(key, dim, w) rows, for output and inspection."""
    dims = F.coalesce("dims", F.transform("ws", lambda _, i: i))
    return vectors.select(key, F.inline(F.arrays_zip(dims.alias("dim"), F.col("ws").alias("w"))))


# ---------------------------------------------------------------- block products

def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[kind]


def packed(vectors: DataFrame, key: str, size: int, rows: int) -> DataFrame:
    """(keys, mat): blocks of at most ``rows`` vectors of a partition."""
    kind = dict(vectors.dtypes)[key]
    return vectors.select(key, "dims", "ws").mapInArrow(blocks.pack_fn(rows, size, _arrow(kind)), f"keys array<{kind}>, mat binary")


def _met(docs: DataFrame, queries: DataFrame, salts: int, max_bytes: int) -> DataFrame:
    """Every block of documents beside every block of queries (stored). A batch of queries within the bound is broadcast and the
    documents stay where they are; a larger one is dealt: each piece gets all its blocks, document blocks go to one piece each."""
    n_bytes = queries.agg(F.sum(F.octet_length("q_mat"))).first()[0] or 0
    if n_bytes <= max_bytes:
        return docs.crossJoin(F.broadcast(queries))
    dealt = docs.withColumn("_d", F.pmod(F.xxhash64(F.element_at("keys", 1)), F.lit(salts)).cast("int"))
    return dealt.join(queries.withColumn("_d", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), "_d").drop("_d")


def _query_blocks(queries: DataFrame, key: str, size: int) -> DataFrame:
    """The packed queries, in as few blocks as they need."""
    queries = stored(queries.select(key, "dims", "ws"), "query-vectors")
    n = max(1, -(-queries.count() // blocks.BLOCK_QUERIES))
    blocked = packed(queries.repartition(n) if n > 1 else queries.coalesce(1), key, size, blocks.BLOCK_QUERIES)
    return stored(blocked.select(F.col("keys").alias("q_keys"), F.col("mat").alias("q_mat")), "query-blocks")


def nearest(doc_vec: DataFrame, query_vec: DataFrame, n: int, size: int, key: str = "url", query_key: str = "query_id",
            params: Params = DEFAULT) -> DataFrame:
    """(query_key, key, sim, rank): the ``n`` rows of ``doc_vec`` nearest to each row of ``query_vec`` by cosine,
    rounded to 9 digits, ties by key.

    All products are formed, block by block in the tasks; a task hands on n rows per query at most, and a
    window picks the final ones. No vector passes through the driver but a broadcast within the bound."""
    kind = dict(query_vec.dtypes)[query_key]
    pairs = _met(packed(doc_vec, key, size, blocks.BLOCK_ROWS), _query_blocks(query_vec, query_key, size), params.salts * 4, params.broadcast_bytes)
    best = pairs.select("keys", "mat", "q_keys", "q_mat").mapInArrow(
        blocks.nearest_fn(n, size, _arrow(kind)), f"q_key {kind}, key string, sim double")
    win = Window.partitionBy("q_key").orderBy(F.col("sim").desc(), F.col("key").asc())
    return best.withColumn("rank", F.row_number().over(win).cast("bigint")).filter(F.col("rank") <= n).select(
        F.col("q_key").alias(query_key), F.col("key").alias(key), "sim", "rank")


def all_cosines(doc_vec: DataFrame, query_vec: DataFrame, size: int, params: Params = DEFAULT) -> DataFrame:
    """V3 in full: (query_id, url, cos) of every pair, as the reference's search ranks every document."""
    pairs = _met(packed(doc_vec, "url", size, blocks.BLOCK_ROWS), _query_blocks(query_vec, "query_id", size), params.salts * 4, params.broadcast_bytes)
    return pairs.select("keys", "mat", "q_keys", "q_mat").mapInArrow(
        blocks.products_fn(size, pa.int64()), "q_key bigint, key string, cos double").select(F.col("q_key").alias("query_id"), F.col("key").alias("url"), "cos")


def count_nearer(doc_vec: DataFrame, query_vec: DataFrame, judged: DataFrame, weight: float, size: int, params: Params = DEFAULT) -> DataFrame:
    """(query_id, url, n_before): for each judged row (query_id, url, s), how many documents come before it by
    weight * cosine (higher, or the same and a smaller url). All documents are counted, in count vectors per task."""
    blocked = _query_blocks(query_vec.join(judged.select("query_id").distinct(), "query_id", "left_semi"), "query_id", size)
    lists = judged.groupBy("query_id").agg(F.collect_list(F.struct("s", "url")).alias("rows"))
    at = blocked.select("q_mat", "q_keys", F.posexplode("q_keys").alias("pos", "query_id"))
    with_rows = at.join(lists, "query_id").groupBy("q_keys", "q_mat").agg(F.sort_array(F.collect_list(F.struct("pos", "rows"))).alias("j"))
    blocked = stored(with_rows.select("q_keys", "q_mat", F.col("j.rows").alias("judged")), "judged-blocks")
    pairs = _met(packed(doc_vec, "url", size, blocks.BLOCK_ROWS), blocked, params.salts * 4, params.broadcast_bytes)
    counts = pairs.select("keys", "mat", "q_keys", "q_mat", "judged").mapInArrow(blocks.count_fn(size, weight), "query_id bigint, url string, n_before bigint")
    return counts.groupBy("query_id", "url").agg(F.sum("n_before").alias("n_before"))


def pair_cosines(pairs: DataFrame, doc_vec: DataFrame, query_vec: DataFrame, size: int, params: Params = DEFAULT) -> DataFrame:
    """``pairs`` (query_id, url, ...; stored, each pair once) with the cosine of their two vectors in ``cos``; a document or query
    without a vector has 0. Within the byte bound the pairs are broadcast to the document vectors, which stay where they are."""
    keys = pairs.select("query_id", "url")
    asked = F.broadcast(keys) if table_bytes(keys) <= params.broadcast_bytes else keys
    rows = doc_vec.select("url", "dims", "ws").join(asked, "url").join(
        query_vec.select("query_id", F.col("dims").alias("q_dims"), F.col("ws").alias("q_ws")), "query_id")
    cosines = rows.select("query_id", "url", "dims", "ws", "q_dims", "q_ws").mapInArrow(
        blocks.pair_cos_fn(size, ["query_id", "url"]), f"{_types(keys, ['query_id', 'url'])}, cos double")
    return pairs.join(cosines, ["query_id", "url"], "left").select(*pairs.columns, F.coalesce("cos", F.lit(0.0)).alias("cos"))


def nearest_terms(qterms: DataFrame, vocab_vec: DataFrame, term_embedder, k: int, params: Params = DEFAULT) -> DataFrame:
    """The ``k`` vocabulary terms nearest to each query word: qterms(query_id, pos, term) x vocab_vec(term, dims, ws) ->
    (query_id, pos, term, sim, rank). Each distinct word is compared once."""
    words = qterms.select(F.col("term").alias("word")).distinct()
    near = nearest(vocab_vec, term_embedder.embed(words, "word", "word"), k, term_embedder.size, "term", "word", params)
    near = stored(near, "near-terms")
    return qterms.select("query_id", "pos", F.col("term").alias("word")).join(near, "word").select("query_id", "pos", "term", "sim", "rank")
