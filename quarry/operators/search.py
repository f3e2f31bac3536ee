"""Query-side operators: query terms, BM25 lookup and scoring (J1, J2,
A8, Q2), hybrid blend (J3, U1), expansion difference (J8, U3).

Many queries are answered in one plan: the stored table of query terms is joined to
the postings. Within its byte bound it is broadcast, so postings are only streamed and
filtered; beyond, both sides are dealt by (term, piece of the url), never by the bare
term, which a frequent term would skew.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quarry.config import DEFAULT, Params
from quarry.functions.text import terms
from quarry.operators import blocks
from quarry.operators.index import bm25, idf, repeated_urls, saturation, unpacked
from quarry.plans.strategy import one_row, sized_join, stored, table_bytes


def query_terms(queries: DataFrame) -> DataFrame:
    """P2, P3 on the query text: (query_id, pos, term), repeats kept."""
    return queries.select("query_id", F.posexplode(terms("query")).alias("pos", "term"))


def original_weights(qterms: DataFrame, weight: float) -> DataFrame:
    """An original word weighs ``weight`` per occurrence."""
    return qterms.groupBy("query_id", "term").agg((F.count(F.lit(1)) * F.lit(weight)).alias("weight"))


def lookup(postings: DataFrame, terms_df: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The postings of the terms in ``terms_df`` (stored; its other columns come along)."""
    return sized_join(postings, terms_df, "term", "url", params.broadcast_bytes, params.salts)


def _restricted(postings: DataFrame, urls: DataFrame | None, params: Params) -> DataFrame:
    if urls is None:
        return postings
    by = "dl" if "terms" in postings.columns else "term"
    return sized_join(postings, stored(urls.select("url").distinct(), "wanted-urls"), "url", by, params.broadcast_bytes, params.salts, "left_semi")


def term_bm25(postings: DataFrame, term_stats: DataFrame, stats: DataFrame, terms_df: DataFrame,
              params: Params = DEFAULT, restrict_urls: DataFrame | None = None) -> DataFrame:
    """J1 + J2: (term, url, bm25) for the distinct terms in ``terms_df``.

    ``restrict_urls`` scores only those documents while keeping corpus-wide statistics (used to score judged
    documents cheaply)."""
    wanted = stored(terms_df.select("term").distinct().join(term_stats, "term"), "query-df")
    rows = lookup(_restricted(postings, restrict_urls, params), wanted, params).crossJoin(one_row(stats.select("n_docs", "avdl")))
    return rows.select("term", "url", bm25(F.col("tf"), F.col("dl"), F.col("avdl"), idf(F.col("df"), F.col("n_docs")), params.k1, params.b).alias("bm25"))


#: Pairs of a query and a document that a task adds up, and the most pieces.
PIECE_PAIRS, MOST_PIECES = 1_000_000, 10_000


def _pieces(weights: DataFrame) -> int:
    """Into how many pieces of documents the scores of a batch (query_id, ..., n_docs; stored) are dealt, so that a task's
    table of scores stays bounded however many documents there are."""
    row = weights.agg(F.countDistinct("query_id").alias("q"), F.max("n_docs").alias("n")).first()
    return min(MOST_PIECES, max(weights.sparkSession.sparkContext.defaultParallelism, row["q"] * (row["n"] or 0) // PIECE_PAIRS + 1))


def _query_weights(term_stats: DataFrame, stats: DataFrame, weighted_terms: DataFrame) -> DataFrame:
    """(query_id, term, weight, n_docs), stored: the weights of the query terms that documents have, times their idf."""
    one = one_row(stats.select("n_docs"))
    return stored(weighted_terms.select("query_id", "term", "weight").join(term_stats, "term").crossJoin(one).select(
        "query_id", "term", (F.col("weight") * idf(F.col("df"), F.col("n_docs"))).alias("weight"), "n_docs"), "query-weights")


def _scored(packed: DataFrame, stats: DataFrame, weighted: DataFrame, params: Params, grouped: bool) -> DataFrame:
    """Packed postings against a batch of weights (query_id, term, weight) within the byte bound, where they are read."""
    kinds, url = dict(weighted.dtypes), dict(packed.dtypes)["url"]
    row = stats.select("avdl").first()
    kernel = partial(blocks.lexical_fn, [tuple(r) for r in weighted.collect()], to_arrow_type(weighted.schema["query_id"].dataType), row and row["avdl"],
                     params.k1, params.b)
    read = packed.select("url", "dl", "terms", "tfs")
    # a url with texts of several lengths has several rows, whose scores add up
    again = not repeated_urls(packed).isEmpty()
    if grouped and not again:
        return read.mapInArrow(kernel(grouped=True), f"url {url}, matches array<struct<query_id:{kinds['query_id']},lex:double>>")
    lex = read.mapInArrow(kernel(), f"query_id {kinds['query_id']}, url {url}, lex double")
    lex = lex.groupBy("query_id", "url").agg(F.sum("lex").alias("lex")) if again else lex
    return _by_document(lex) if grouped else lex


def _by_document(lex: DataFrame) -> DataFrame:
    return lex.groupBy("url").agg(F.collect_list(F.struct("query_id", "lex")).alias("matches"))


def lexical_matches(postings: DataFrame, term_stats: DataFrame, stats: DataFrame, weighted_terms: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """``lexical_scores`` a row per document: (url, matches: array of (query_id, lex)). Of packed postings, no pair is shuffled for it."""
    if "terms" in postings.columns:
        weighted = _query_weights(term_stats, stats, weighted_terms).select("query_id", "term", "weight")
        if table_bytes(weighted) <= params.broadcast_bytes:
            return _scored(postings, stats, weighted, params, True)
    return _by_document(lexical_scores(postings, term_stats, stats, weighted_terms, params))


def lexical_scores(postings: DataFrame, term_stats: DataFrame, stats: DataFrame, weighted_terms: DataFrame,
                   params: Params = DEFAULT, restrict_urls: DataFrame | None = None) -> DataFrame:
    """(query_id, url, lex) = sum over the query's weighted terms of
    weight * bm25. Per-term score maps are merged by addition.

    Packed postings (``index.packed_postings``) have all terms of a document in one row. A batch of query terms within the byte bound goes
    to every task, and a document's scores add up where it is read: no exchange.

    Of flat postings, a batch within the bound is broadcast twice: its distinct terms pick and number the postings, which are
    dealt by url, a row per run of a document's postings (they lie together); then the weights meet a document's postings in one
    task, and its scores add up there without another exchange, however many queries share its terms. A larger batch meets the
    postings by (term, piece of the url) first."""
    one = one_row(stats.select("n_docs", "avdl"))
    sized = _query_weights(term_stats, stats, weighted_terms)
    weighted = sized.select("query_id", "term", "weight")
    part = saturation(F.col("tf"), F.col("dl"), F.col("avdl"), params.k1, params.b).alias("part")
    rows = _restricted(postings, restrict_urls, params)
    small = table_bytes(weighted) <= params.broadcast_bytes
    if "terms" in postings.columns:
        if small:
            return _scored(rows, stats, weighted, params, False)
        rows = unpacked(rows)
    if small:
        # a batch within the bound: its terms are numbered in one task
        ids = stored(weighted.select("term").distinct().withColumn("id", F.row_number().over(Window.orderBy("term"))), "term-ids")
        kinds = dict(rows.dtypes)
        packed = rows.join(F.broadcast(ids), "term").select("url", "dl", "id", "tf").mapInArrow(
            blocks.pack_postings_fn(), f"url {kinds['url']}, dl {kinds['dl']}, ids array<int>, tfs array<{kinds['tf']}>")
        dealt = packed.repartition(_pieces(sized), "url").select("url", "dl", F.inline(F.arrays_zip(F.col("ids").alias("id"), F.col("tfs").alias("tf"))))
        met = dealt.crossJoin(one).select("url", "id", part).join(F.broadcast(weighted.join(F.broadcast(ids), "term").select("query_id", "id", "weight")), "id")
    else:
        met = lookup(rows.crossJoin(one).select("term", "url", part), weighted, params)
    return met.groupBy("query_id", "url").agg(F.sum(F.col("weight") * F.col("part")).alias("lex"))


def merge_scores(old: DataFrame, new: DataFrame, score: str = "lex") -> DataFrame:
    """Two (query_id, url, score) maps, added."""
    return old.unionByName(new).groupBy("query_id", "url").agg(F.sum(score).alias(score))


def new_terms(expanded: DataFrame, qterms: DataFrame) -> DataFrame:
    """Expansion terms that are not original words."""
    return expanded.join(qterms.select("query_id", "term").distinct(), ["query_id", "term"], "left_anti")


def blend(lex: DataFrame, sem: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The union of urls from both scorers, a missing side
    counts 0: (query_id, url, lex, cos, score = w_lex * lex + w_sem * cos)."""
    a, b = F.coalesce("lex", F.lit(0.0)), F.coalesce("cos", F.lit(0.0))
    return lex.join(sem, ["query_id", "url"], "full_outer").select(
        "query_id", "url", a.alias("lex"), b.alias("cos"), (F.lit(params.w_lexical) * a + F.lit(params.w_semantic) * b).alias("score"))


def url_counts(lex: DataFrame, docs: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, n_urls), the size of the union of both scorers' urls. The semantic side scores every document, so the
    union is all documents and the lexical urls that are none of them; no pair is built to count it. Which urls are none of them is
    asked once for each url, not for each pair."""
    n_docs = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    lex = stored(lex.select("query_id", "url"), "lexical-pairs")
    strange = stored(lex.select("url").distinct().join(docs.select("url"), "url", "left_anti"), "strange-urls")
    # a null url is no document's and equals none
    pairs = sized_join(lex, strange, "url", "query_id", DEFAULT.broadcast_bytes, DEFAULT.salts, "left_semi").unionByName(lex.filter(F.col("url").isNull()))
    outside = pairs.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_outside"))
    return queries.select("query_id").distinct().join(outside, "query_id", "left").crossJoin(one_row(n_docs)).select(
        "query_id", (F.col("n_docs") + F.coalesce("n_outside", F.lit(0))).alias("n_urls")).filter("n_urls > 0")
