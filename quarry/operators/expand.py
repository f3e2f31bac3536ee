"""Document expansion (V5, V6, V7, P8, P9) and query expansion.

Document expansion: each document is compared with the seed set, the
first ``seed_size`` documents by position that come before it; the most
similar seed (ties: the earliest) is appended to its text when the
similarity is strictly above the threshold. A document needs at least two
predecessors. The seed set has a fixed size whatever the corpus, so its vectors are shipped
to every task and each document is handled in its own row: no shuffle, linear in the corpus.

Options of the reference's bulk run: ``recurrent`` compares with the seeds as expanded (X3), by a
fold over the seed rows in order; ``passes=2`` expands documents after the first chunk twice (X2).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.config import DEFAULT, Params
from quarry.operators import blocks
from quarry.operators.rank import first_n
from quarry.operators.vectors import RowEmbedder, nearest_terms
from quarry.plans.strategy import sized_join, stored

LOWEST = -(1 << 63)


def vector_matrix(rows: list, size: int) -> np.ndarray:
    m = np.zeros((len(rows), size))
    for i, r in enumerate(rows):
        m[i, slice(0, len(r["ws"])) if r["dims"] is None else np.asarray(r["dims"], np.int64)] = r["ws"]
    return m


def seed_rows(docs: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """(url, doc_seq, text) of the first ``seed_size`` documents."""
    return first_n(docs.select("url", "doc_seq", "text"), params.seed_size)


def choose_seed(docs: DataFrame, seeds: DataFrame, embedder, seq: str = "doc_seq", kept: tuple[str, ...] = ()) -> DataFrame:
    """V5: (url, doc_seq, text, kept..., n_pred, seed_url, sim) of ``docs`` against ``seeds(url, doc_seq, text)``, of which those
    with a position below the document's ``seq`` count. The vectors of the seeds (``seed_size`` rows) are shipped to the tasks."""
    rows = seeds.select("url", "doc_seq").join(embedder.embed(seeds, "url", "text"), "url").collect()
    rows = sorted(rows, key=lambda r: r["doc_seq"])
    columns = ["url", "doc_seq", "text", *kept]
    if isinstance(embedder, RowEmbedder):
        # only the prepared texts and positions go to Python; not deterministic for the planner, so that it is never evaluated twice
        pick = F.arrow_udf(blocks.pick_seed_fn(embedder.batch(), embedder.dense, np.asarray([r["doc_seq"] for r in rows], dtype=np.int64), [r["url"] for r in rows],
                                               vector_matrix(rows, embedder.size)), "n_pred bigint, seed_url string, sim double").asNondeterministic()
        return docs.select(*columns, pick(embedder.prepared("text"), F.col(seq)).alias("_p")).select(*columns, "_p.n_pred", "_p.seed_url", "_p.sim")
    fn = blocks.best_seed_fn(np.asarray([r["doc_seq"] for r in rows], dtype=np.int64), [r["url"] for r in rows], vector_matrix(rows, embedder.size), columns)
    keyed = docs.select(*columns, F.col(seq).alias("_seq"))
    vectors = embedder.embed(keyed, [*columns, "_seq"], "text")
    kinds = dict(docs.dtypes)
    return vectors.select(*columns, "_seq", "dims", "ws").mapInArrow(
        fn, ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", n_pred bigint, seed_url string, sim double")


def best_seed(docs: DataFrame, embedder, params: Params = DEFAULT) -> DataFrame:
    """V5 + V6 decision: (url, n_pred, seed_url, sim) for every document.

    ``seed_url`` is the arg-max seed (ties: earliest) when at least two
    seeds precede the document, else null; ``sim`` is its cosine rounded to
    9 places."""
    return choose_seed(docs, stored(seed_rows(docs, params), "seeds"), embedder).drop("doc_seq", "text")


def seed_set(docs: DataFrame, embedder, params: Params = DEFAULT, recurrent: bool = False) -> DataFrame:
    """The seed rows as documents are compared with them, stored: (url, doc_seq, text, seed_url, sim, folded).

    ``recurrent`` (X3): each is expanded by the best of those before it *as expanded*, an ordered fold over
    ``seed_size`` rows at most, in one task by nature. Prepared texts are put together as the texts are, since a
    text's features are those of its space-joined parts."""
    seeds = seed_rows(docs, params)
    if not recurrent:
        return stored(seeds.select("*", F.lit(None).cast("string").alias("seed_url"), F.lit(None).cast("double").alias("sim"), F.lit(False).alias("folded")), "seeds")
    if isinstance(embedder, RowEmbedder):
        rows = seeds.select("*", embedder.prepared("text").alias("prepared"), F.array().cast("array<double>").alias("ws"))
        fn = blocks.fold_seeds_fn(embedder.batch(), embedder.dense, embedder.size, params.expand_threshold)
    else:
        rows = seeds.withColumn("prepared", F.lit("")).join(embedder.embed(seeds, "url", "text").select("url", "ws"), "url")
        fn = blocks.fold_seeds_fn(None, True, embedder.size, params.expand_threshold)
    folded = rows.groupBy(F.lit("seeds")).applyInPandas(fn, "url string, doc_seq bigint, text string, seed_url string, sim double")
    return stored(folded.withColumn("folded", F.lit(True)), "folded-seeds")


def first_chunk_end(docs: DataFrame, params: Params = DEFAULT) -> int | None:
    """The position of the last document of the first chunk; None if there are no more documents."""
    row = first_n(docs.select("doc_seq"), params.chunk_size).agg(F.count(F.lit(1)).alias("n"), F.max("doc_seq").alias("last")).first()
    return row["last"] if row["n"] == params.chunk_size else None


def _appended(chosen: DataFrame, seeds: DataFrame, params: Params) -> DataFrame:
    """The text of the chosen seed behind each document whose similarity is above the threshold."""
    texts = seeds.select(F.col("url").alias("seed_url"), F.col("text").alias("seed_text"))
    far = ~F.coalesce(F.col("sim") > F.lit(params.expand_threshold), F.lit(False))
    near = chosen.withColumn("seed_url", F.when(~far, F.col("seed_url"))).withColumn("sim", F.when(~far, F.col("sim")))
    joined = sized_join(near, texts, "seed_url", "url", params.broadcast_bytes, params.salts, "left")
    text = F.when(F.col("seed_text").isNotNull(), F.concat_ws(" ", "text", "seed_text")).otherwise(F.col("text"))
    return joined.withColumn("text", text).drop("seed_text", "n_pred")


def expand_documents(docs: DataFrame, embedder, params: Params = DEFAULT, passes: int = 1, recurrent: bool = False,
                     seeds: DataFrame | None = None, chunk_end: int | None = None) -> DataFrame:
    """V6 / V7: docs(url, doc_seq, text) -> (url, doc_seq, text, seed_url,
    sim), text expanded by its best seed when sim > threshold. Documents
    without a decision keep their text (V7 fallback). ``docs`` is read twice, so it should be a stored table.

    ``passes=2``: documents after the first ``chunk_size`` (not below ``seed_size``) are expanded once more; seed_url
    and sim are those of the last expansion. For a part of the documents, ``seeds`` (a seed_set) and ``chunk_end`` (the
    first_chunk_end) are those of the whole."""
    if passes not in (1, 2) or (passes == 2 and params.chunk_size < params.seed_size):
        raise ValueError("one or two passes, and chunks that hold the seed set")
    if passes == 2 and seeds is None:
        chunk_end = first_chunk_end(docs, params)
    seeds = seed_set(docs, embedder, params, recurrent) if seeds is None else seeds
    out = _appended(choose_seed(docs, seeds, embedder), seeds, params)
    if passes == 2 and chunk_end is not None:
        again = out.withColumnsRenamed({"seed_url": "_seed_url", "sim": "_sim"})
        again = again.withColumn("_later", F.when(F.col("doc_seq") > F.lit(chunk_end), F.col("doc_seq")).otherwise(F.lit(LOWEST)))
        twice = _appended(choose_seed(again, seeds, embedder, "_later", ("_seed_url", "_sim")), seeds, params)
        out = twice.select("url", "doc_seq", "text", F.coalesce("seed_url", "_seed_url").alias("seed_url"), F.coalesce("sim", "_sim").alias("sim"))
    # the seed documents are as the fold left them
    folded = seeds.filter("folded").select("url", *[F.col(c).alias(f"_{c}") for c in ("text", "seed_url", "sim")], F.lit(True).alias("_seed"))
    if not recurrent:
        return out.select("url", "doc_seq", "text", "seed_url", "sim")
    return sized_join(out, folded, "url", "url", params.broadcast_bytes, params.salts, "left").select(
        "url", "doc_seq", *[F.when(F.col("_seed"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in ("text", "seed_url", "sim")])


def neighbour_terms(qterms: DataFrame, vocab_vec: DataFrame, term_embedder, params: Params = DEFAULT) -> DataFrame:
    """J6 with the order of first appearance: (query_id, term, first(pos, rank, sim)) of all neighbours, originals among them."""
    near = nearest_terms(qterms, vocab_vec, term_embedder, params.neighbours, params)
    return near.groupBy("query_id", "term").agg(F.min(F.struct("pos", "rank", "sim")).alias("first"))


def expand_query_terms(qterms: DataFrame, vocab_vec: DataFrame, term_embedder, params: Params = DEFAULT) -> DataFrame:
    """Q1: originals (repeats kept, their positions) followed by new
    neighbour terms in order of first appearance.

    -> (query_id, pos, term, original BOOLEAN, sim)."""
    first = neighbour_terms(qterms, vocab_vec, term_embedder, params)
    new = first.join(qterms.select("query_id", "term").distinct(), ["query_id", "term"], "left_anti")
    n_orig = qterms.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_orig"))
    w = Window.partitionBy("query_id").orderBy(F.col("first.pos"), F.col("first.rank"))
    new = new.join(n_orig, "query_id").select(
        "query_id",
        (F.col("n_orig") + F.row_number().over(w) - 1).cast("bigint").alias("pos"),
        "term",
        F.lit(False).alias("original"),
        F.col("first.sim").alias("sim"),
    )
    orig = qterms.select("query_id", F.col("pos").cast("bigint").alias("pos"), "term",
                         F.lit(True).alias("original"), F.lit(None).cast("double").alias("sim"))
    return orig.unionByName(new)


def weighted_terms(expanded: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Q2 weights: w_original per occurrence of an original word, w_expanded
    once per new term."""
    return expanded.groupBy("query_id", "term").agg(
        F.sum(F.when(F.col("original"), F.lit(params.w_original)).otherwise(F.lit(params.w_expanded))).alias("weight"))
