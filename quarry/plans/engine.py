"""The engine as a whole: hybrid search over a table of queries (Q1-Q4) on a
stored index, and its evaluation (M5).

Plan shape at scale
- the postings of a batch's terms give the lexical scores, once, as a stored table;
- a cosine moves a score by at most ``w_semantic`` either way, so only documents whose lexical
  score is within twice that of the n-th best can be among the best n: their cosines alone are computed.
  Where that leaves room for documents without any lexical match (few or weak matches), the n
  nearest by cosine of these queries join the candidates, from a block product. The result is
  that of scoring every document, and no query x document table is built;
- ranks of judged documents are counted the same way: most documents fall clearly before or behind a
  judged one by their lexical score, the others get their cosine.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.config import DEFAULT, Params
from quarry.operators import blocks
from quarry.operators import evaluate as ev
from quarry.operators import rank as rk
from quarry.operators import search as se
from quarry.operators import vectors as vx
from quarry.operators.expand import expand_query_terms, vector_matrix, weighted_terms
from quarry.plans.strategy import sized_join, stored, table_bytes

#: Room for rounding where scores are compared with bounds.
SLACK = 1e-6


@dataclass
class SearchIndex:
    docs: DataFrame          # url, doc_seq, text (indexed text), dl
    postings: DataFrame      # term, url, dl, tf
    term_stats: DataFrame    # term, df
    stats: DataFrame         # n_docs, total_len, avdl (one row)
    doc_vec: DataFrame       # url, dims, ws
    vocab_vec: DataFrame     # term, dims, ws (frequent vocabulary)
    params: Params = DEFAULT
    embedder: object = field(default=None)
    term_embedder: object = field(default=None)
    packed: DataFrame | None = None   # url, dl, terms, tfs: the postings a row per document, unless they are stored flat

    @property
    def stored_postings(self) -> DataFrame:
        """The postings as they are stored, for ``lexical_scores`` and ``term_stats``."""
        return self.postings if self.packed is None else self.packed


def build_index(raw_docs: DataFrame, params: Params = DEFAULT, **options) -> SearchIndex:
    """Q6 into a scratch folder; the options are those of ``pipelines.bulk_index``."""
    import uuid

    from quarry.plans.pipelines import bulk_index
    from quarry.session import scratch_path

    spark = raw_docs.sparkSession
    return bulk_index(spark, raw_docs, scratch_path(spark, f"index-{uuid.uuid4().hex[:12]}"), params, reuse=False, **options)


def query_plan(index: SearchIndex, queries: DataFrame, expand: bool = True) -> DataFrame:
    """Q1: the term list of each query."""
    qt = se.query_terms(queries)
    if expand:
        return expand_query_terms(qt, index.vocab_vec, index.term_embedder, index.params)
    return qt.select("query_id", F.col("pos").cast("bigint").alias("pos"), "term",
                     F.lit(True).alias("original"), F.lit(None).cast("double").alias("sim"))


def lexical(index: SearchIndex, queries: DataFrame, expand: bool = True,
            restrict_urls: DataFrame | None = None, weights: DataFrame | None = None) -> DataFrame:
    """Q2: (query_id, url, lex)."""
    w = weights if weights is not None else weighted_terms(query_plan(index, queries, expand), index.params)
    return se.lexical_scores(index.stored_postings, index.term_stats, index.stats, w, index.params, restrict_urls)


def query_vectors(index: SearchIndex, queries: DataFrame) -> DataFrame:
    return stored(index.embedder.embed(queries, "query_id", "query"), "query-vectors")


def semantic(index: SearchIndex, queries: DataFrame, n: int) -> DataFrame:
    """V3: (query_id, url, cos, rank), the ``n`` documents nearest to the raw query text."""
    near = vx.nearest(index.doc_vec, index.embedder.embed(queries, "query_id", "query"), n, index.embedder.size, params=index.params)
    return near.withColumnRenamed("sim", "cos")


def search(index: SearchIndex, queries: DataFrame, expand: bool = True) -> DataFrame:
    """Q3 in full: (query_id, url, lex, cos, score) of every document for every query, as the reference returns it: a
    row per pair. ``top`` gives the first ranks of the same list without the rest.

    Within the byte bound the queries' vectors go to every task, and a document's lexical scores meet its vector in one
    row, so no pair is shuffled but the lexical matches; beyond, all products are merged with the matches."""
    p, query_vec = index.params, query_vectors(index, queries)
    if table_bytes(query_vec) > p.broadcast_bytes:
        return se.blend(lexical(index, queries, expand), vx.all_cosines(index.doc_vec, query_vec, index.embedder.size, p), p)
    asked = query_vec.collect()
    w = weighted_terms(query_plan(index, queries, expand), p)
    matches = se.lexical_matches(index.stored_postings, index.term_stats, index.stats, w, p)
    none = F.array().cast("array<struct<query_id:bigint,lex:double>>")
    rows = index.doc_vec.select("url", "dims", "ws").join(matches, "url", "full_outer").select("url", "dims", "ws", F.coalesce("matches", none).alias("matches"))
    return rows.mapInArrow(blocks.scores_fn([r["query_id"] for r in asked], vector_matrix(asked, index.embedder.size), p.w_lexical, p.w_semantic),
                           "query_id bigint, url string, lex double, cos double, score double")


def candidates(index: SearchIndex, queries: DataFrame, query_vec: DataFrame, lex: DataFrame, n: int) -> DataFrame:
    """(query_id, url, lex), stored: pairs that hold the best ``n`` documents of each query; lex is null without a match.

    With l the n-th best lexical score, n documents score at least w_lex l - w_sem, so a match needs w_lex lex >=
    w_lex l - 2 w_sem. A document without a match scores at most w_sem; where that may suffice, the n nearest by cosine
    are enough, since each scores no less than any farther one without a match."""
    p = index.params
    nth = rk.top_n(rk.largest(lex, n, "lex"), n, score="lex", digits=p.score_digits).groupBy("query_id").agg(F.min("lex").alias("nth"), F.count(F.lit(1)).alias("k"))
    nth = queries.select("query_id").distinct().join(nth, "query_id", "left").select("query_id", F.when(F.col("k") == n, F.col("nth")).alias("nth"))
    nth = stored(nth, "nth-lexical")
    bound = p.w_lexical * F.col("nth") - 2 * p.w_semantic - SLACK
    near = sized_join(lex, nth, "query_id", "url", p.broadcast_bytes, p.salts).filter(
        F.col("nth").isNull() | (p.w_lexical * F.col("lex") >= bound)).select("query_id", "url", "lex")
    unsettled = nth.filter(F.col("nth").isNull() | (p.w_lexical * F.col("nth") <= 2 * p.w_semantic + SLACK)).select("query_id")
    if not unsettled.isEmpty():
        asked = query_vec.join(unsettled, "query_id", "left_semi")
        extra = stored(vx.nearest(index.doc_vec, asked, n, index.embedder.size, params=p).select("query_id", "url"), "nearest")
        known = sized_join(lex, extra, ["query_id", "url"], "url", p.broadcast_bytes, p.salts)
        near = near.unionByName(extra.join(known, ["query_id", "url"], "left")).dropDuplicates(["query_id", "url"])
    return stored(near, "candidates")


def top(index: SearchIndex, queries: DataFrame, n: int | None = None, expand: bool = True) -> DataFrame:
    """The best n documents per query with lex, cos, score and rank, equal to the first n of ``search``."""
    n = n or index.params.top_n
    query_vec = query_vectors(index, queries)
    lex = stored(lexical(index, queries, expand), "lexical")
    pairs = candidates(index, queries, query_vec, lex, n)
    cos = vx.pair_cosines(pairs, index.doc_vec, query_vec, index.embedder.size, index.params).select("query_id", "url", "cos")
    scored = se.blend(pairs.filter(F.col("lex").isNotNull()), cos, index.params)
    return rk.top_n(scored, n, digits=index.params.score_digits)


def _scored(index: SearchIndex, pairs: DataFrame, query_vec: DataFrame) -> DataFrame:
    """``pairs`` (query_id, url, lex; stored) with cos and score."""
    p = index.params
    cos = vx.pair_cosines(pairs, index.doc_vec, query_vec, index.embedder.size, p)
    return cos.withColumn("score", p.w_lexical * F.coalesce("lex", F.lit(0.0)) + p.w_semantic * F.col("cos"))


def judged_ranks(index: SearchIndex, queries: DataFrame, qrels: DataFrame, expand: bool = True) -> DataFrame:
    """(query_id, url, rank) of each judged document of the index among all documents, ranked by ``search``.

    A query is settled if no document without a lexical match can come before a judged one. Its matches that are
    clearly before or behind all judged ones are counted by their lexical score, the others get their cosine. For the
    other queries all matches get it, and documents without a match are all documents less the matches, both counted by cosine."""
    p = index.params
    query_vec = query_vectors(index, queries)
    lex = stored(lexical(index, queries, expand), "lexical")
    asked_urls = stored(qrels.select("url").distinct(), "judged-urls")
    there = sized_join(index.docs.select("url"), asked_urls, "url", "url", p.broadcast_bytes, p.salts, "left_semi")
    wanted = stored(qrels.select("query_id", "url").distinct().join(there, "url").select("query_id", "url"), "judged-pairs")
    matched = sized_join(lex, wanted, ["query_id", "url"], "url", p.broadcast_bytes, p.salts)
    judged = _scored(index, stored(wanted.join(matched, ["query_id", "url"], "left"), "judged-lexical"), query_vec)
    judged = stored(judged.select("query_id", "url", F.round("score", p.score_digits).alias("s")), "judged-scores")

    open_ids = stored(judged.filter(F.col("s") <= p.w_semantic + SLACK).select("query_id").distinct(), "unsettled")
    settled = judged.join(open_ids, "query_id", "left_anti")
    asked = stored(settled.groupBy("query_id").agg(F.min("s").alias("least")), "settled")
    # a match that is clearly behind all judged ones comes before none of them
    rows = sized_join(lex, asked, "query_id", "url", p.broadcast_bytes, p.salts).filter(
        p.w_lexical * F.col("lex") + (p.w_semantic + SLACK) >= F.col("least")).select("query_id", "url", F.col("lex").alias("s"))
    sorted_out = stored(ev.dealt(rows, settled, p.salts).mapInArrow(
        blocks.near_judged_fn(p.w_lexical, p.w_semantic + SLACK), "query_id bigint, url string, lex double, sure boolean, n bigint"), "near-judged")
    near = _scored(index, stored(sorted_out.filter("not sure").select("query_id", "url", "lex"), "near-pairs"), query_vec)
    counts = [sorted_out.filter("sure").select("query_id", "url", F.col("n").alias("n_before")), ev.count_before(near, settled, p)]

    if not open_ids.isEmpty():
        rest = stored(judged.join(open_ids, "query_id", "left_semi"), "unsettled-judged")
        all_matches = stored(_scored(index, stored(sized_join(lex, open_ids, "query_id", "url", p.broadcast_bytes, p.salts, "left_semi"), "open-lexical"), query_vec), "open-matches")
        by_cosine = all_matches.withColumn("score", p.w_semantic * F.col("cos"))
        counts += [ev.count_before(all_matches, rest, p), vx.count_nearer(index.doc_vec, query_vec, rest, p.w_semantic, index.embedder.size, p),
                   ev.count_before(by_cosine, rest, p).withColumn("n_before", -F.col("n_before"))]
    total = counts[0]
    for c in counts[1:]:
        total = total.unionByName(c)
    return ev.ranked(judged, total.groupBy("query_id", "url").agg(F.sum("n_before").alias("n_before")))


def evaluate(index: SearchIndex, queries: DataFrame, qrels: DataFrame, expand: bool = True, per_query: bool = False) -> DataFrame:
    """M5: mean P@k, R@k, MRR, nDCG@k over all queries (M1-M4 per query)."""
    qrels = stored(qrels.select("query_id", "url"), "qrels")
    ranks = judged_ranks(index, queries, qrels, expand)
    if per_query:
        return ev.per_query(ranks, qrels, queries, index.params.eval_k)
    return ev.mean_metrics(ev.per_query(ranks, qrels, queries, index.params.eval_k, None))
