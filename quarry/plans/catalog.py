"""Registered queries: one per operator of the inventory, each reading the
driver tables (or tables Spark derives from them) in full.

``SPARK[name](spark, sf_dir) -> DataFrame`` and ``SQL[name]`` (DuckDB) are
kept side by side; a missing SQL entry marks an operator that is checked
on rows only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.config import DEFAULT as P
from quarry.functions.text import char_length, normalize, terms
from quarry.operators import evaluate as ev
from quarry.operators import index as ix
from quarry.operators import rank as rk
from quarry.operators import search as se
from quarry.plans import oracle as o
from quarry.plans.strategy import one_row, sized_join, stored
from quarry.sources import corpus as src

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        SPARK[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------- shared

def _docs(spark, d):
    return src.docs(spark, d)


def _lex_parts(spark, d):
    """Postings (stored: every reader starts from them), term and corpus statistics."""
    docs = _docs(spark, d)
    post = stored(ix.postings(docs), "postings")
    return post, ix.term_stats(post), ix.corpus_stats(docs)


def _lex_scores(spark, d):
    post, ts, stats = _lex_parts(spark, d)
    w = se.original_weights(se.query_terms(src.queries(spark, d)), P.w_original)
    return se.lexical_scores(post, ts, stats, w, P).withColumnRenamed("lex", "score")


def _last(spark, d):
    """The documents, one row per url, stored."""
    return stored(ix.last_wins(_docs(spark, d)), "documents")


# ---------------------------------------------------------------- scans / text

@register("s1_corpus_scan", o.ctes(o.DOCS) + "SELECT url, doc_seq, text FROM docs")
def s1(spark, d):
    return _docs(spark, d)


@register("s1_read_corpus", "SELECT CAST(doc_id AS VARCHAR) AS url, row_number() OVER (ORDER BY doc_id) - 1 AS doc_seq, text FROM documents")
def s1_read(spark, d):
    """A crawled corpus of several files without positions: rows are numbered by file and row."""
    path = _scratch(spark, "crawled")
    rows = src.table(spark, d, "documents").select("doc_id", F.col("doc_id").cast("string").alias("URL"), F.col("text").alias("content"))
    store.write_table(rows.repartitionByRange(5, "doc_id").sortWithinPartitions("doc_id").drop("doc_id"), path)
    return src.read_corpus(spark, path)


@register("p2_normalize", o.ctes(o.DOCS) + f"SELECT url, {o.norm('text')} AS normalized FROM docs")
def p2(spark, d):
    return _docs(spark, d).select("url", normalize("text").alias("normalized"))


@register(
    "p3_tokenize",
    o.ctes(o.DOCS) + f"SELECT url, unnest(range(len(t))) AS pos, unnest(t) AS term "
    f"FROM (SELECT url, string_split({o.norm('text')}, ' ') AS t FROM docs)",
)
def p3(spark, d):
    return _docs(spark, d).select("url", F.posexplode(terms("text")).alias("pos", "term")).withColumn(
        "pos", F.col("pos").cast("bigint"))


@register("p4_doc_length", o.ctes(o.DOCS) + "SELECT url, CAST(length(text) AS BIGINT) AS dl FROM docs")
def p4(spark, d):
    return _docs(spark, d).select("url", char_length("text").alias("dl"))


@register("p5_list_urls", o.ctes(o.DOCS) + "SELECT url FROM docs")
def p5(spark, d):
    return ix.last_wins(_docs(spark, d)).select("url")


# ---------------------------------------------------------------- aggregates

@register("a1_postings", o.ctes(o.DOCS, o.TOKS, o.POSTINGS) + "SELECT term, url, tf FROM postings")
def a1(spark, d):
    return ix.postings(_docs(spark, d)).select("term", "url", "tf")


@register("a2_doc_count", o.ctes(o.DOCS, o.STATS) + "SELECT n_docs FROM stats")
def a2(spark, d):
    return ix.corpus_stats(_docs(spark, d)).select("n_docs")


@register("a3_avg_length", o.ctes(o.DOCS, o.STATS) + "SELECT round(avdl, 6) AS avdl, total_len FROM stats")
def a3(spark, d):
    return ix.corpus_stats(_docs(spark, d)).select(r6("avdl").alias("avdl"), "total_len")


@register("a4_doc_freq", o.ctes(o.DOCS, o.TOKS, o.POSTINGS, o.TSTATS) + "SELECT term, df FROM tstats")
def a4(spark, d):
    return ix.document_frequency(_docs(spark, d))


@register("a5_vocabulary", o.ctes(o.DOCS, o.TOKS) + "SELECT DISTINCT term FROM toks")
def a5(spark, d):
    return ix.vocabulary(ix.postings(_docs(spark, d)))


@register(
    "a6_frequent_vocab",
    o.ctes(o.DOCS, o.TOKS, o.POSTINGS, o.TSTATS, o.STATS)
    + f"SELECT t.term, t.df FROM tstats t, stats s WHERE t.df > s.n_docs * {P.vocab_min_df_frac} ORDER BY t.term",
)
def a6(spark, d):
    docs = _docs(spark, d)
    return ix.frequent_vocabulary(ix.document_frequency(docs), ix.corpus_stats(docs), P.vocab_min_df_frac).orderBy("term")


@register(
    "a7_idf",
    o.ctes(o.DOCS, o.TOKS, o.POSTINGS, o.TSTATS, o.STATS)
    + f"SELECT t.term, round({o.idf('t.df', 's.n_docs')}, 6) AS idf FROM tstats t, stats s",
)
def a7(spark, d):
    docs = _docs(spark, d)
    ts = ix.document_frequency(docs)
    st = ix.corpus_stats(docs)
    return ts.crossJoin(F.broadcast(st.select("n_docs"))).select(
        "term", r6(ix.idf(F.col("df"), F.col("n_docs"))).alias("idf"))


_DUP_DOCS = (
    "dup AS (SELECT CAST(doc_id AS VARCHAR) AS url, doc_id AS doc_seq, text FROM documents "
    "UNION ALL SELECT CAST(doc_id AS VARCHAR), doc_id + 1000000, 'revised ' || text FROM documents WHERE doc_id % 10 = 0)"
)


@register(
    "a9_last_wins",
    o.ctes(_DUP_DOCS) + "SELECT url, min(doc_seq) AS doc_seq, arg_max(text, doc_seq) AS text FROM dup GROUP BY url",
)
def a9(spark, d):
    return ix.last_wins(src.docs_with_duplicates(spark, d))


@register("a10_distinct_texts", o.ctes(o.DOCS) + "SELECT DISTINCT text FROM docs")
def a10(spark, d):
    return ix.distinct_texts(_docs(spark, d))


# ---------------------------------------------------------------- lexical search

@register("j1_posting_lookup",
          o.ctes(o.DOCS, o.TOKS, o.POSTINGS, o.QUERIES, o.QTERMS)
          + "SELECT q.query_id, q.pos, p.term, p.url, p.tf FROM qterms q JOIN postings p ON q.term = p.term")
def j1(spark, d):
    qt = se.query_terms(src.queries(spark, d)).withColumn("pos", F.col("pos").cast("bigint"))
    return se.lookup(ix.postings(_docs(spark, d)), stored(qt, "query-terms"), P).select("query_id", "pos", "term", "url", "tf")


@register("j2_term_bm25",
          o.ctes(*o.LEX_BASE[:8]) + "SELECT term, url, round(bm25, 6) AS bm25 FROM term_bm25")
def j2(spark, d):
    post, ts, stats = _lex_parts(spark, d)
    qt = se.query_terms(src.queries(spark, d))
    return se.term_bm25(post, ts, stats, qt, P).select("term", "url", r6("bm25").alias("bm25"))


@register("q2_lexical", o.ctes(*o.LEX_BASE) + "SELECT query_id, url, round(score, 6) AS score FROM lex")
def q2(spark, d):
    return _lex_scores(spark, d).select("query_id", "url", r6("score").alias("score"))


@register("w1_full_ranking",
          o.ctes(*o.LEX_BASE, o.RANKED_LEX) + "SELECT query_id, url, round(score, 6) AS score, rank FROM ranked")
def w1(spark, d):
    ranked = rk.rank_all(_lex_scores(spark, d))
    return ranked.select("query_id", "url", r6("score").alias("score"), "rank")


@register("w2_top_n",
          o.ctes(*o.LEX_BASE, o.RANKED_LEX)
          + f"SELECT query_id, url, round(score, 6) AS score, rank FROM ranked WHERE rank <= {P.top_n}")
def w2(spark, d):
    return rk.top_n(_lex_scores(spark, d), P.top_n).select("query_id", "url", r6("score").alias("score"), "rank")


@register("w3_seed_set", o.ctes(o.DOCS) + f"SELECT url, doc_seq FROM docs ORDER BY doc_seq LIMIT {P.seed_size}")
def w3(spark, d):
    return rk.first_n(_docs(spark, d), P.seed_size).select("url", "doc_seq")


@register("w5_sorted_word_list",
          o.ctes(o.DOCS, o.TOKS, o.POSTINGS, o.TSTATS, o.STATS)
          + f"SELECT t.term FROM tstats t, stats s WHERE t.df > s.n_docs * {P.vocab_min_df_frac} ORDER BY t.term")
def w5(spark, d):
    return a6(spark, d).select("term")


@register("w6_cut_at_k",
          o.ctes(*o.LEX_BASE, o.RANKED_LEX)
          + f"SELECT query_id, url, rank FROM ranked WHERE rank <= {P.eval_k}")
def w6(spark, d):
    return rk.cut(rk.top_n(_lex_scores(spark, d), P.eval_k), P.eval_k).select("query_id", "url", "rank")


@register("q5_post_count", o.ctes(o.DOCS) + "SELECT count(*) AS n_posts FROM (SELECT DISTINCT url FROM docs)")
def q5(spark, d):
    return ix.last_wins(_docs(spark, d)).agg(F.count(F.lit(1)).alias("n_posts"))


# ---------------------------------------------------------------- metrics (lexical engine)

def _lex_ranks(spark, d):
    """Ranks of the judged documents by lexical score, and the judgements; scores are computed once."""
    scores, qrels = stored(_lex_scores(spark, d), "lexical"), stored(src.qrels(spark, d), "qrels")
    return ev.judged_ranks(scores, qrels, params=P), qrels


def _lex_metrics(spark, d, digits):
    ranks, qrels = _lex_ranks(spark, d)
    return ev.per_query(ranks, qrels, src.queries(spark, d), P.eval_k, digits)


@register("j7_relevance_flags",
          o.ctes(*o.LEX_BASE, o.RANKED_LEX, o.QRELS)
          + "SELECT q.query_id, q.url, r.rank FROM qrels q JOIN ranked r ON q.query_id = r.query_id AND q.url = r.url")
def j7(spark, d):
    return _lex_ranks(spark, d)[0]


def _metric_sql(name: str) -> str:
    return o.metrics_sql(o.LEX_BASE + [o.RANKED_LEX], P.eval_k, (name,))


@register("m1_precision_at_k", _metric_sql("precision_at_k"))
def m1(spark, d):
    return _lex_metrics(spark, d, 6).select("query_id", "precision_at_k")


@register("m2_recall_at_k", _metric_sql("recall_at_k"))
def m2(spark, d):
    return _lex_metrics(spark, d, 6).select("query_id", "recall_at_k")


@register("m3_reciprocal_rank", _metric_sql("rr"))
def m3(spark, d):
    return _lex_metrics(spark, d, 6).select("query_id", "rr")


@register("m4_ndcg_at_k", _metric_sql("ndcg"))
def m4(spark, d):
    return _lex_metrics(spark, d, 6).select("query_id", "ndcg")


@register("m5_lexical_evaluation", o.metrics_sql(o.LEX_BASE + [o.RANKED_LEX], P.eval_k))
def m5_lex(spark, d):
    return ev.mean_metrics(_lex_metrics(spark, d, None))


# ---------------------------------------------------------------- vectors, expansion, hybrid

from quarry.operators import vectors as vx  # noqa: E402
from quarry.operators.blocks import best_seed_fn  # noqa: E402
from quarry.operators.expand import best_seed, expand_documents, neighbour_terms, weighted_terms  # noqa: E402
from quarry.plans import engine as en  # noqa: E402

WORDS = vx.WordHashEmbedder(P.text_dim)
TRIGRAMS = vx.TrigramHashEmbedder(P.term_dim)


def _index(spark, d, expand=True):
    return en.build_index(src.docs(spark, d), P, expand=expand)


def _rows6(df, key):
    return vx.sparse_rows(df, key).select(key, "dim", r6("w").alias("w"))


@register("v1_text_embedding", o.ctes(o.DOCS, *o.word_vec("rv", "docs", "url", "text"))
          + "SELECT url, dim, round(w, 6) AS w FROM rv")
def v1(spark, d):
    return _rows6(WORDS.embed(ix.last_wins(_docs(spark, d)), "url", "text"), "url")


_EMB = (
    "ev AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings)",
    "cen AS (SELECT label, i, avg(x) AS c FROM ev GROUP BY label, i)",
)


@register("v2_cosine", o.ctes(*_EMB) + (
    "SELECT e.vec_id, e.label, round(CASE WHEN sqrt(sum(e.x * e.x)) > 0 AND sqrt(sum(c.c * c.c)) > 0 "
    "THEN sum(e.x * c.c) / (sqrt(sum(e.x * e.x)) * sqrt(sum(c.c * c.c))) ELSE 0.0 END, 6) AS cos "
    "FROM ev e JOIN cen c ON e.label = c.label AND e.i = c.i GROUP BY e.vec_id, e.label"))
def v2(spark, d):
    """Cosine of every vector with its label's centroid (per-label mean,
    computed with partial aggregation; the centroid table is tiny)."""
    from quarry.functions.vector import cosine
    emb = src.table(spark, d, "embeddings")
    cen = (emb.select("label", F.posexplode("embedding").alias("i", "x"))
           .groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("c"))
           .groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "c"))).alias("cs"))
           .select("label", F.col("cs.c").alias("centroid")))
    return sized_join(emb, stored(cen, "centroids"), "label", "vec_id", P.broadcast_bytes, P.salts).select(
        "vec_id", "label", r6(cosine(F.col("embedding"), F.col("centroid"))).alias("cos"))


_DENSE_SQL = (
    "e AS (SELECT vec_id, i, x / nrm AS x FROM (SELECT *, sqrt(sum(x * x) OVER (PARTITION BY vec_id)) AS nrm FROM "
    "(SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings)) WHERE nrm > 0)",
    "s AS (SELECT q.vec_id AS query_id, e.vec_id, round(sum(q.x * e.x), 9) AS sim FROM e q JOIN e ON q.i = e.i WHERE q.vec_id % 50 = 0 GROUP BY 1, 2)",
    "r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, CAST(vec_id AS VARCHAR)) AS rank FROM s)",
)


@register("v1_dense_search", o.ctes(*_DENSE_SQL) + f"SELECT query_id, vec_id, rank, round(sim, 6) AS cos FROM r WHERE rank <= {P.eval_k}")
def v1_dense(spark, d):
    """Supplied vectors: the ten nearest of all to every fiftieth vector (the stated query set)."""
    emb = src.table(spark, d, "embeddings")
    size = emb.agg(F.max(F.size("embedding"))).first()[0] or 1
    given = vx.SuppliedVectors(emb, size, "embeddings", "vec_id", "embedding")
    keys = emb.select("vec_id", F.col("vec_id").cast("string").alias("url"))
    queries = given.embed(keys.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id")), "query_id")
    near = vx.nearest(given.embed(keys, "url"), queries, P.eval_k, size, params=P)
    return near.select("query_id", F.col("url").cast("bigint").alias("vec_id"), "rank", r6("sim").alias("cos"))


@register("v3_query_doc_cosine", o.ctes(o.DOCS, o.QUERIES, *o.cosine_side("docs"))
          + "SELECT query_id, url, round(cos, 6) AS cos FROM hcos")
def v3(spark, d):
    """The cosine of every query and document."""
    cos = vx.all_cosines(WORDS.embed(ix.last_wins(_docs(spark, d)), "url", "text"), WORDS.embed(src.queries(spark, d), "query_id", "query"), P.text_dim, P)
    return cos.select("query_id", "url", r6("cos").alias("cos"))


@register("v4_query_neighbours", o.ctes(o.DOCS, *o.query_side("docs"))
          + "SELECT query_id, pos, term, rank, round(sim, 6) AS sim FROM nn")
def v4(spark, d):
    post, ts, stats = _lex_parts(spark, d)
    vocab = ix.frequent_vocabulary(ts, stats, P.vocab_min_df_frac)
    near = vx.nearest_terms(se.query_terms(src.queries(spark, d)), TRIGRAMS.embed(vocab, "term", "term"), TRIGRAMS, P.neighbours, P)
    return near.select("query_id", F.col("pos").cast("bigint").alias("pos"), "term", "rank", r6("sim").alias("sim"))


_EMB_SEED = (
    "en AS (SELECT vec_id, i, x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)) AS x FROM "
    "(SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings))",
    f"es AS (SELECT vec_id FROM embeddings ORDER BY vec_id LIMIT {P.seed_size})",
    "ec AS (SELECT e.vec_id, s.vec_id AS s_id FROM embeddings e JOIN es s ON s.vec_id < e.vec_id)",
    "ed AS (SELECT a.vec_id, b.vec_id AS s_id, sum(a.x * b.x) AS dot FROM en a JOIN en b ON a.i = b.i "
    "WHERE b.vec_id IN (SELECT vec_id FROM es) GROUP BY a.vec_id, b.vec_id)",
    "eb AS (SELECT c.vec_id, c.s_id, round(coalesce(d.dot, 0.0), 9) AS sim, count(*) OVER (PARTITION BY c.vec_id) AS n_pred, "
    "row_number() OVER (PARTITION BY c.vec_id ORDER BY round(coalesce(d.dot, 0.0), 9) DESC, c.s_id) AS rn "
    "FROM ec c LEFT JOIN ed d ON c.vec_id = d.vec_id AND c.s_id = d.s_id)",
    "ebest AS (SELECT e.vec_id, coalesce(b.n_pred, 0) AS n_pred, CASE WHEN b.n_pred >= 2 THEN b.s_id END AS best_id, "
    "CASE WHEN b.n_pred >= 2 THEN b.sim END AS sim FROM embeddings e LEFT JOIN (SELECT * FROM eb WHERE rn = 1) b "
    "ON e.vec_id = b.vec_id)",
)


def _emb_best(spark, d):
    import numpy as np
    emb = src.table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("ws"))
    size = emb.agg(F.max(F.size("ws"))).first()[0] or 1
    seeds = sorted(rk.first_n(emb, P.seed_size, "vec_id").collect(), key=lambda r: r["vec_id"])
    ids = [r["vec_id"] for r in seeds]
    mat = np.zeros((len(seeds), size))
    for row, r in zip(mat, seeds):
        row[:len(r["ws"])] = r["ws"]
    fn = best_seed_fn(np.asarray(ids, dtype=np.int64), ids, mat, ["vec_id"], normalize=True)
    rows = emb.select("vec_id", F.col("vec_id").alias("seq"), F.lit(None).cast("array<int>").alias("dims"), "ws")
    return rows.mapInArrow(fn, "vec_id long, n_pred long, seed_url long, sim double").withColumnRenamed("seed_url", "best_id")


@register("v5_argmax_neighbour", o.ctes(*_EMB_SEED) + "SELECT vec_id, n_pred, best_id, round(sim, 6) AS sim FROM ebest")
def v5(spark, d):
    return _emb_best(spark, d).select("vec_id", "n_pred", "best_id", r6("sim").alias("sim"))


@register("p9_similarity_threshold", o.ctes(o.DOCS, *o.expansion("docs"))
          + f"SELECT url, seed_url, round(sim, 6) AS sim FROM best WHERE sim > {P.expand_threshold}")
def p9(spark, d):
    b = best_seed(_last(spark, d), WORDS, P)
    return b.filter(F.col("sim") > P.expand_threshold).select("url", "seed_url", r6("sim").alias("sim"))


@register("v6_doc_expansion", o.ctes(o.DOCS, *o.expansion("docs"))
          + f"SELECT url, n_pred, seed_url, round(sim, 6) AS sim, coalesce(sim > {P.expand_threshold}, false) AS expanded FROM best")
def v6(spark, d):
    b = best_seed(_last(spark, d), WORDS, P)
    return b.select("url", "n_pred", "seed_url", r6("sim").alias("sim"),
                    F.coalesce(F.col("sim") > P.expand_threshold, F.lit(False)).alias("expanded"))


@register("v7_bulk_expand", o.ctes(o.DOCS, *o.expansion("docs")) + "SELECT url, text FROM exp_docs")
def v7(spark, d):
    return expand_documents(_last(spark, d), WORDS, P).select("url", "text")


@register("p8_append_neighbour", o.ctes(o.DOCS, *o.expansion("docs"))
          + f"SELECT e.url, length(e.text) - length(d.text) AS added FROM exp_docs e JOIN docs d ON e.url = d.url "
          f"WHERE length(e.text) > length(d.text)")
def p8(spark, d):
    docs = _last(spark, d)
    longer = expand_documents(docs, WORDS, P).filter(F.col("seed_url").isNotNull()).select("url", F.length("text").alias("m"))
    return longer.join(docs.select("url", F.length("text").alias("n")), "url").select(
        "url", (F.col("m") - F.col("n")).cast("bigint").alias("added"))


@register("v8_doc_vectors", o.ctes(o.DOCS, *o.expansion("docs"), *o.word_vec("fv", "exp_docs", "url", "text"))
          + "SELECT url, dim, round(w, 6) AS w FROM fv")
def v8(spark, d):
    idx = _index(spark, d)
    return _rows6(vx.embed_distinct(idx.docs, WORDS), "url")


@register("v9_vocab_vectors", o.ctes(o.DOCS, *o.expansion("docs"), *o.query_side("exp_docs"))
          + "SELECT term, dim, round(w, 6) AS w FROM vv")
def v9(spark, d):
    return _rows6(_index(spark, d).vocab_vec, "term")


@register("q1_query_expansion", o.ctes(o.DOCS, *o.expansion("docs"), *o.query_side("exp_docs"))
          + "SELECT query_id, pos, term, original FROM qexp")
def q1(spark, d):
    idx = _index(spark, d)
    return en.query_plan(idx, src.queries(spark, d)).select("query_id", "pos", "term", "original")


@register("j8_new_terms", o.ctes(o.DOCS, *o.expansion("docs"), *o.query_side("exp_docs"))
          + "SELECT query_id, term FROM newt")
def j8(spark, d):
    """All neighbours of the query words, words of the query among them, less those."""
    idx = _index(spark, d)
    qt = se.query_terms(src.queries(spark, d))
    return se.new_terms(neighbour_terms(qt, idx.vocab_vec, idx.term_embedder, P).select("query_id", "term"), qt)


@register("q2_weighted_lexical", o.ctes(*o.hybrid()) + "SELECT query_id, url, round(lex, 6) AS lex FROM hlex")
def q2w(spark, d):
    idx = _index(spark, d)
    return en.lexical(idx, src.queries(spark, d)).select("query_id", "url", r6("lex").alias("lex"))


_RANKED_H = ("ranked AS (SELECT query_id, url, lex, cos, score, row_number() OVER (PARTITION BY query_id "
             "ORDER BY round(score, 9) DESC, url ASC) AS rank FROM hscore)")


@register("q3_hybrid_search", o.ctes(*o.hybrid()) + "SELECT query_id, url, round(score, 6) AS score FROM hscore")
def q3(spark, d):
    """The score of every document for every query."""
    return en.search(_index(spark, d), src.queries(spark, d)).select("query_id", "url", r6("score").alias("score"))


@register("j3_hybrid_merge", o.ctes(*o.hybrid())
          + "SELECT query_id, url, round(coalesce(lex, 0.0), 6) AS lex, round(cos, 6) AS cos, round(score, 6) AS score FROM hscore")
def j3(spark, d):
    """Both scores of every document for every query and their blend."""
    merged = en.search(_index(spark, d), src.queries(spark, d))
    return merged.select("query_id", "url", r6("lex").alias("lex"), r6("cos").alias("cos"), r6("score").alias("score"))


@register("q4_top5", o.ctes(*o.hybrid(), _RANKED_H)
          + f"SELECT query_id, url, round(score, 6) AS score, rank FROM ranked WHERE rank <= {P.top_n}")
def q4(spark, d):
    idx = _index(spark, d)
    return en.top(idx, src.queries(spark, d)).select("query_id", "url", r6("score").alias("score"), "rank")


@register("m5_evaluation", o.metrics_sql(o.hybrid() + [_RANKED_H], P.eval_k))
def m5(spark, d):
    idx = _index(spark, d)
    return en.evaluate(idx, src.queries(spark, d), src.qrels(spark, d))


# ---------------------------------------------------------------- pages

from quarry.functions.text import html_to_text  # noqa: E402


@register("p1_html_to_text", "SELECT page_id, url, " + o.html_sql("html") + " AS content FROM pages")
def p1(spark, d):
    return src.table(spark, d, "pages").select("page_id", "url", html_to_text("html").alias("content"))


# ---------------------------------------------------------------- crawl side

import uuid  # noqa: E402

from quarry.plans import pipelines as pl  # noqa: E402
from quarry.session import scratch_path  # noqa: E402
from quarry.sources import feeds as fd  # noqa: E402
from quarry.sources import store  # noqa: E402
from quarry.streaming import incremental as inc  # noqa: E402


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


_FEED_P = "p AS (SELECT page_id, url, html, regexp_extract(url, '://([^/#?]+)', 1) AS host FROM pages)"
_FEED_ITEMS = (
    "items AS (SELECT 'https://' || host || '/feed/' || CAST(page_id // 50 AS VARCHAR) AS feed_url, page_id, 0 AS kind, "
    "CASE WHEN page_id % 7 <> 3 OR (page_id % 14 = 3 AND length(host) % 2 = 0) THEN url END AS link FROM p UNION ALL "
    "SELECT 'https://' || host || '/feed/' || CAST(page_id // 50 AS VARCHAR), page_id, 1, url || '-gone' FROM p "
    "WHERE page_id % 5 = 0)"
)
_FEED_LINKS = ("links AS (SELECT feed_url, row_number() OVER (PARTITION BY feed_url ORDER BY page_id, kind) - 1 AS pos, "
               "link AS url FROM items WHERE link IS NOT NULL)")
_FEED_BASE = o.ctes(_FEED_P, _FEED_ITEMS, _FEED_LINKS)


def _feed_list(spark, d):
    pages = src.table(spark, d, "pages")
    path = _scratch(spark, "feedlist")
    fd.write_feed_list(pages, path)
    return path, pages


@register("s2_feed_list", o.ctes(_FEED_P) + (
    "SELECT DISTINCT 'https://' || host || '/feed/' || CAST(page_id // 50 AS VARCHAR) AS feed_url FROM p "
    "UNION ALL SELECT DISTINCT 'https://' || host || '/feed/broken' FROM p"))
def s2(spark, d):
    path, _ = _feed_list(spark, d)
    return fd.read_feed_list(spark, path)


@register("s3_feed_links", _FEED_BASE + "SELECT feed_url, pos, url FROM links")
def s3(spark, d):
    return fd.parse_feeds(fd.feed_payloads(src.table(spark, d, "pages")))


@register("s4_attach_pages", _FEED_BASE + (
    "SELECT l.feed_url, l.pos, l.url, CAST(coalesce(length(p.html), 0) AS BIGINT) AS body_len "
    "FROM links l LEFT JOIN p ON l.url = p.url"))
def s4(spark, d):
    pages = src.table(spark, d, "pages")
    b = fd.attach_pages(fd.parse_feeds(fd.feed_payloads(pages)), pages)
    return b.select("feed_url", "pos", "url", F.length("html").cast("bigint").alias("body_len"))


@register("s5_flatten", _FEED_BASE + "SELECT url FROM links")
def s5(spark, d):
    return fd.parse_feeds(fd.feed_payloads(src.table(spark, d, "pages"))).select("url")


@register("s6_parquet_sink", "SELECT CAST(doc_id AS VARCHAR) AS URL, text AS content FROM documents")
def s6(spark, d):
    path = _scratch(spark, "corpus")
    store.write_table(src.table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("URL"), F.col("text").alias("content")), path)
    return spark.read.schema(store.CORPUS_SCHEMA.replace("url", "URL")).parquet(path)


@register("q7_crawl_to_corpus", _FEED_BASE + (
    "SELECT l.url AS URL, " + o.html_sql("p.html") + " AS content FROM links l LEFT JOIN p ON l.url = p.url"))
def q7(spark, d):
    path, pages = _feed_list(spark, d)
    return pl.crawl(spark, path, fd.feed_payloads(pages), pages, _scratch(spark, "crawled"))


# ---------------------------------------------------------------- persistence

@register("s8_load_expanded", o.ctes(o.DOCS, *o.expansion("docs")) + "SELECT url, text FROM exp_docs")
def s8(spark, d):
    path = _scratch(spark, "expanded")
    store.save_expanded(expand_documents(_last(spark, d), WORDS, P), path)  # S7
    return store.load_expanded(spark, path).select("url", "text")


@register("s10_load_vectors", o.ctes(o.DOCS, *o.expansion("docs"), *o.word_vec("fv", "exp_docs", "url", "text"), *o.query_side("exp_docs"))
          + "SELECT 'document' AS part, url AS key, dim, round(w, 6) AS w FROM fv UNION ALL "
            "SELECT 'word' AS part, term AS key, dim, round(w, 6) AS w FROM vv")
def s10(spark, d):
    idx = _index(spark, d)
    dp, vp = _scratch(spark, "doc_vec"), _scratch(spark, "vocab_vec")
    store.save_vectors(idx.doc_vec, idx.vocab_vec, dp, vp)              # S9
    parts = zip(("document", "word"), ("url", "term"), store.load_vectors(spark, dp, vp))
    docs, words = (_rows6(v, k).select(F.lit(part).alias("part"), F.col(k).alias("key"), "dim", "w") for part, k, v in parts)
    return docs.unionByName(words)


@register("s11_reuse_or_build", o.ctes(*o.hybrid(), _RANKED_H)
          + f"SELECT query_id, url, round(score, 6) AS score, rank FROM ranked WHERE rank <= {P.top_n}")
def s11(spark, d):
    out = _scratch(spark, "index")
    pl.bulk_index(spark, _docs(spark, d), out)
    idx = pl.bulk_index(spark, _docs(spark, d), out)                   # second run reuses the expansion
    return en.top(idx, src.queries(spark, d)).select("query_id", "url", r6("score").alias("score"), "rank")


@register("q6_bulk_index", o.ctes(o.DOCS, *o.expansion("docs"), *o.postings_of("ip", "exp_docs"),
                                  o.stats_of("ist", "exp_docs"), o.tstats_of("its", "ip"), o.vocab_of("iv", "its", "ist"))
          + "SELECT s.n_docs, s.total_len, (SELECT count(*) FROM ip) AS n_postings, (SELECT count(*) FROM its) AS n_terms, "
            "(SELECT count(*) FROM iv) AS n_frequent FROM ist s")
def q6(spark, d):
    idx = pl.bulk_index(spark, _docs(spark, d), _scratch(spark, "index"), reuse=False)
    n_post = idx.postings.agg(F.count(F.lit(1)).alias("n_postings"))
    n_terms = idx.term_stats.agg(F.count(F.lit(1)).alias("n_terms"))
    n_freq = idx.vocab_vec.agg(F.count(F.lit(1)).alias("n_frequent"))
    return idx.stats.select("n_docs", "total_len").crossJoin(n_post).crossJoin(n_terms).crossJoin(n_freq)


# ---------------------------------------------------------------- streaming (ST1-ST3)

def _arrive(docs, path, pieces, batches):
    """Write documents as files of about a scan piece each, for ``batches`` micro-batches; how many files one takes."""
    each = max(1, -(-pieces // batches))
    docs.repartition(each * batches).write.mode("append").parquet(path)
    return each


def _streamed(spark, d):
    """The documents indexed by a stream in four micro-batches: the folder of the segments."""
    source, out = _scratch(spark, "stream-src"), _scratch(spark, "stream-out")
    docs = src.table(spark, d, "documents")
    each = _arrive(docs, source, docs.rdd.getNumPartitions(), 4)
    inc.start(spark, source, out, _scratch(spark, "stream-ckpt"), each).awaitTermination()
    return out


@register("st1_incremental_postings", o.ctes(o.DOCS, o.TOKS, o.POSTINGS) + "SELECT term, url, tf FROM postings")
def st1(spark, d):
    return inc.postings(spark, _streamed(spark, d))


@register("st2_running_stats", o.ctes(o.DOCS, o.STATS) + "SELECT n_docs, total_len, round(avdl, 6) AS avdl FROM stats")
def st2(spark, d):
    return inc.running_stats(spark, _streamed(spark, d)).select("n_docs", "total_len", r6("avdl").alias("avdl"))


@register("st3_resume", o.ctes(o.DOCS, o.TOKS, o.POSTINGS, o.TSTATS) + "SELECT term, df FROM tstats")
def st3(spark, d):
    """Index half of the files, stop, add the rest, restart from the same
    checkpoint: only the new files are processed and the result equals a
    single batch build."""
    source, out, ckpt = _scratch(spark, "stream-src"), _scratch(spark, "stream-out"), _scratch(spark, "stream-ckpt")
    docs = src.table(spark, d, "documents")
    half, pieces = F.pmod(F.xxhash64("doc_id"), F.lit(2)), -(-docs.rdd.getNumPartitions() // 2)
    for part in (0, 1):
        each = _arrive(docs.filter(half == part), source, pieces, 2)
        inc.start(spark, source, out, ckpt, each).awaitTermination()
    return inc.document_frequency(spark, out)


# documents indexed again in a later batch: every tenth, but the seed documents
_REVISED = ("docs AS (SELECT CAST(doc_id AS VARCHAR) AS url, doc_id AS doc_seq, CASE WHEN doc_id % 10 = 0 AND doc_id NOT IN "
            f"(SELECT doc_id FROM documents ORDER BY doc_id LIMIT {P.seed_size}) THEN 'revised ' || text ELSE text END AS text FROM documents)")


@register("st4_searchable_segments", o.ctes(*o.hybrid(docs=_REVISED), _RANKED_H)
          + f"SELECT query_id, url, round(score, 6) AS score, rank FROM ranked WHERE rank <= {P.top_n}")
def st4(spark, d):
    """Documents arrive in files by position, some again with another text; segments are merged as they come, and the
    index that is open then answers as one built at once from the last texts."""
    source, out, ckpt = _scratch(spark, "stream-src"), _scratch(spark, "stream-out"), _scratch(spark, "stream-ckpt")
    docs = src.table(spark, d, "documents")
    pieces = -(-docs.rdd.getNumPartitions() // 3)

    def index(rows):
        each = _arrive(rows, source, pieces, 1)
        inc.start(spark, source, out, ckpt, each, expand=True, fanout=2).awaitTermination()

    bounds = [r["b"] for r in docs.agg(F.percentile_approx("doc_id", F.array(*[F.lit(i / 3) for i in (1, 2)])).alias("x")).select(F.explode("x").alias("b")).collect()]
    edges = [None, *bounds, None]
    for low, high in zip(edges, edges[1:]):
        part = docs.filter((F.lit(low is None) | (F.col("doc_id") > F.lit(low))) & (F.lit(high is None) | (F.col("doc_id") <= F.lit(high))))
        index(part)
    seeds = docs.select("doc_id").orderBy("doc_id").limit(P.seed_size)
    again = docs.filter("doc_id % 10 = 0").join(seeds, "doc_id", "left_anti").withColumn("text", F.concat(F.lit("revised "), "text"))
    index(again)
    idx = inc.Segments(spark, out, expand=True).open_index()
    return en.top(idx, src.queries(spark, d)).select("query_id", "url", r6("score").alias("score"), "rank")


# ---------------------------------------------------------------- remaining inventory ids

@register("a8_merge_score_maps", o.ctes(*o.hybrid()) + "SELECT query_id, url, round(lex, 6) AS lex FROM hlex")
def a8(spark, d):
    """Lexical maps of original and of expansion terms, merged by addition."""
    idx = _index(spark, d)
    plan = stored(en.query_plan(idx, src.queries(spark, d)), "query-plan")
    old, new = (se.lexical_scores(idx.stored_postings, idx.term_stats, idx.stats, weighted_terms(plan.filter(F.col("original") == own), P), P)
                for own in (True, False))
    return se.merge_scores(old, new).select("query_id", "url", r6("lex").alias("lex"))


@register("j5_seed_candidates", o.ctes(o.DOCS, *o.expansion("docs")) + "SELECT url, n_pred FROM best")
def j5(spark, d):
    """How many seeds come before each document: positions alone tell."""
    docs = ix.last_wins(_docs(spark, d)).select("url", "doc_seq")
    places = rk.first_n(docs.select("doc_seq"), P.seed_size).agg(F.collect_list("doc_seq").alias("seeds"))
    before = F.size(F.filter("seeds", lambda s: s < F.col("doc_seq"))).cast("bigint")
    return docs.crossJoin(one_row(places)).select("url", before.alias("n_pred"))


@register("w4_new_term_order", o.ctes(o.DOCS, *o.expansion("docs"), *o.query_side("exp_docs"))
          + "SELECT query_id, pos, term FROM qexp WHERE NOT original")
def w4(spark, d):
    return q1(spark, d).filter(~F.col("original")).select("query_id", "pos", "term")


@register("u1_url_union", o.ctes(*o.hybrid()) + "SELECT query_id, count(*) AS n_urls FROM hscore GROUP BY query_id")
def u1(spark, d):
    idx, queries = _index(spark, d), src.queries(spark, d)
    return se.url_counts(en.lexical(idx, queries), idx.docs, queries)
