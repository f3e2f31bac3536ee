"""Index construction: documents, postings and corpus statistics (A1-A10).

Layout at scale
- ``docs(url, doc_seq, text, dl)``: one row per url (A9 last-wins).
- ``postings(term, url, tf, dl)``: flat rows, never a list per term, so a
  frequent term is spread over many partitions. ``dl`` is carried along
  (it is functionally dependent on ``url``) so scoring needs no join back
  to the documents.
- ``packed(url, dl, terms, tfs)``: the same postings as they are stored, a row per document: its distinct
  terms with a space between them, and their counts.
- ``term_stats(term, df)``: partial (map-side) counts, then a final count.
- ``corpus_stats(n_docs, total_len, avdl)``: one row, broadcast freely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.config import DEFAULT
from quarry.functions.text import char_length, uncut, terms
from quarry.operators import blocks
from quarry.plans.strategy import sized_join, stored, table_bytes


def clean_corpus(docs: DataFrame) -> DataFrame:
    """Null text is empty text; rows without a url are dropped."""
    return docs.filter(F.col("url").isNotNull()).withColumn("text", F.coalesce("text", F.lit("")))


def last_wins(docs: DataFrame) -> DataFrame:
    """One row per url, the text with the highest ``doc_seq`` and the
    smallest ``doc_seq`` as its position. Narrow (url, doc_seq) rows find both numbers with map-side combining; within the byte
    bound the urls that occur again are broadcast and texts stay where they are read. Beyond, the texts are joined to the
    numbers by (url, doc_seq), once, so a url repeated in a third of the rows is spread by its
    positions. ``doc_seq`` tells the rows of a url apart (``read_corpus`` numbers them so)."""
    clean = clean_corpus(docs)
    keys = clean.groupBy("url").agg(F.max("doc_seq").alias("_last"), F.min("doc_seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    again = stored(keys.filter("_n > 1"), "repeated-urls")
    if table_bytes(again) <= DEFAULT.broadcast_bytes:
        met = clean.join(F.broadcast(again), "url", "left")
        last = F.when(F.col("_n").isNull(), F.col("doc_seq").isNotNull()).otherwise(F.col("doc_seq") == F.col("_last"))
        return met.filter(last).select("url", F.coalesce("_first", "doc_seq").alias("doc_seq"), "text")
    keys = keys.select("url", F.col("_last").alias("doc_seq"), "_first")
    return clean.join(keys, ["url", "doc_seq"]).select("url", F.col("_first").alias("doc_seq"), "text")


def with_length(docs: DataFrame) -> DataFrame:
    """P4 as a column ``dl``."""
    return docs.withColumn("dl", char_length("text"))


def token_rows(docs: DataFrame) -> DataFrame:
    """(url, dl, term) for every token occurrence; narrow, no shuffle.
    ``dl`` is computed in a projection below the generator: in the same
    projection Catalyst would evaluate it once per token, re-reading the
    whole text each time."""
    with_dl = docs if "dl" in docs.columns else docs.withColumn("dl", char_length("text"))
    return with_dl.select("url", "dl", "text").select("url", "dl", F.explode(terms("text")).alias("term"))


def _parted(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The documents (url, dl, text) whose (url, dl) no other row has, and the rest, if there are any. Narrow rows tell them
    apart by hash; a collision only moves documents to the rest."""
    rows = (docs if "dl" in docs.columns else docs.withColumn("dl", char_length("text"))).select("url", "dl", "text")
    keyed = rows.withColumn("_k", F.xxhash64("url", "dl"))
    repeats = stored(keyed.groupBy("_k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_k"), "repeated-keys")
    if repeats.isEmpty():
        return rows, None
    return tuple(sized_join(keyed, repeats, "_k", "dl", DEFAULT.broadcast_bytes, DEFAULT.salts, how).drop("_k") for how in ("left_anti", "left_semi"))


def _counted(rows: DataFrame) -> DataFrame:
    kinds = dict(rows.dtypes)
    return rows.select("url", "dl", uncut("text").alias("_text")).mapInArrow(
        blocks.count_terms_fn(["url", "dl"]), f"term string, url {kinds['url']}, dl {kinds['dl']}, tf bigint")


def postings(docs: DataFrame) -> DataFrame:
    """A1: (term, url, dl, tf), rows of the same url and length taken together. A document's terms are counted where it
    is read, without a shuffle; only documents whose (url, dl) occurs again meet in one (``_parted``)."""
    single, repeated = _parted(docs)
    rows = _counted(single)
    if repeated is None:
        return rows
    return rows.unionByName(_counted(repeated).groupBy("term", "url", "dl").agg(F.sum("tf").alias("tf")))


def repeated_urls(docs: DataFrame) -> DataFrame:
    """(_k), stored: hashes of the urls that several rows have, as rows with the same url and position do; none as a rule."""
    return stored(docs.groupBy(F.xxhash64("url").alias("_k")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_k"), "repeated-urls")


def packed_postings(docs: DataFrame, again: DataFrame) -> DataFrame:
    """A1 as it is stored: (url, dl, terms, tfs), a row per url and length, made where a document is read. Only the rows of urls that
    come ``again`` (``repeated_urls``) meet, and those of the same length are taken together."""
    kinds, rows = dict(docs.dtypes), docs.select("url", "dl", "text")
    repeated = None
    if not again.isEmpty():
        keyed = rows.withColumn("_k", F.xxhash64("url"))
        rows, repeated = (sized_join(keyed, again, "_k", "dl", DEFAULT.broadcast_bytes, DEFAULT.salts, how).drop("_k") for how in ("left_anti", "left_semi"))
    packed = rows.select("url", "dl", uncut("text").alias("_text")).mapInArrow(
        blocks.pack_terms_fn(), f"url {kinds['url']}, dl {kinds['dl']}, terms string, tfs array<int>")
    if repeated is None:
        return packed
    counts = _counted(repeated).groupBy("term", "url", "dl").agg(F.sum("tf").cast("int").alias("tf"))
    lists = counts.groupBy("url", "dl").agg(F.collect_list(F.struct("term", "tf")).alias("l"))
    return packed.unionByName(lists.select("url", "dl", F.array_join("l.term", " ").alias("terms"), F.col("l.tf").alias("tfs")))


def unpacked(packed: DataFrame) -> DataFrame:
    """The flat postings (term, url, dl, tf) of packed ones; further columns come along."""
    others = [c for c in packed.columns if c not in ("url", "dl", "terms", "tfs")]
    rows = packed.select("url", "dl", *others, F.inline(F.arrays_zip(F.split("terms", " ").alias("term"), F.col("tfs").alias("tf"))))
    return rows.select("term", "url", "dl", F.col("tf").cast("bigint").alias("tf"), *others)


def document_frequency(docs: DataFrame) -> DataFrame:
    """A4 from the documents: df of each term as ``term_stats(postings(docs))`` gives it, without making postings: the
    rows of a piece are counted in the tasks, a row per term and piece is shuffled."""
    single, repeated = _parted(docs)
    rows = single.select(uncut("text").alias("_text")).mapInArrow(blocks.row_frequency_fn(), "term string, df bigint")
    if repeated is not None:
        rows = rows.unionByName(term_stats(_counted(repeated).select("term", "url", "dl").distinct()))
    return rows.groupBy("term").agg(F.sum("df").alias("df"))


def accumulate_postings(versions: DataFrame, docs: DataFrame) -> DataFrame:
    """X1 option ``on_duplicate='accumulate'``: re-indexing a url adds to its old postings. ``versions(url, text)`` are all
    its texts as indexed (expanded, if documents are), ``docs(url, dl)`` has the length of the last one."""
    counts = versions.select("url", F.explode(terms("text")).alias("term")).groupBy("term", "url").agg(F.count(F.lit(1)).alias("tf"))
    return counts.join(docs.select("url", "dl"), "url").select("term", "url", "dl", "tf")


def corpus_stats(docs: DataFrame) -> DataFrame:
    """A2, A3: document count, total and average length (one row).
    An empty corpus gives n_docs 0 and a null average (X11). Lengths that are there (``dl``) are not counted again."""
    length = F.col("dl") if "dl" in docs.columns else char_length("text")
    return docs.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.sum(length), F.lit(0)).cast("bigint").alias("total_len"),
        F.avg(length).alias("avdl"),
    )


def term_stats(postings_df: DataFrame) -> DataFrame:
    """A4: document frequency per term. Packed postings are counted in the tasks, a row per term and piece is shuffled."""
    if "terms" in postings_df.columns:
        counts = postings_df.select("terms").mapInArrow(blocks.packed_frequency_fn(), "term string, df bigint")
        return counts.groupBy("term").agg(F.sum("df").alias("df"))
    return postings_df.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def vocabulary(postings_df: DataFrame) -> DataFrame:
    """A5: distinct terms."""
    return postings_df.select("term").distinct()


def frequent_vocabulary(term_stats_df: DataFrame, stats: DataFrame, frac: float) -> DataFrame:
    """Terms whose df is strictly above ``frac`` of the document
    count. The result is bounded whatever the corpus size: at most
    (average distinct terms per document) / frac rows."""
    return (
        term_stats_df.crossJoin(F.broadcast(stats.select("n_docs")))
        .filter(F.col("df") > F.col("n_docs") * F.lit(frac))
        .select("term", "df")
    )


def idf(df_col: Column, n_col: Column) -> Column:
    """ln((N - n + 0.5) / (n + 1) + 1)."""
    return F.log((n_col - df_col + F.lit(0.5)) / (df_col + F.lit(1.0)) + F.lit(1.0))


def saturation(tf: Column, dl: Column, avdl: Column, k1: float, b: float) -> Column:
    """The part of BM25 that depends on the document: tf (k1 + 1) / (tf + k1 (1 - b + b dl / avdl))."""
    return tf * F.lit(k1 + 1.0) / (tf + F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * dl / avdl))


def bm25(tf: Column, dl: Column, avdl: Column, idf_col: Column, k1: float, b: float) -> Column:
    """BM25 of one term in one document."""
    return idf_col * saturation(tf, dl, avdl, k1, b)


def distinct_texts(docs: DataFrame) -> DataFrame:
    """A10: distinct document texts."""
    return docs.select("text").distinct()
