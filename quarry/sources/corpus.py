"""Corpus and query sources (S1) and the inputs derived from the driver
tables: ``docs``, ``queries`` and ``qrels``.

Derivation rules (the same rules are written as SQL for the oracle):
- docs(url, doc_seq, text) = (cast(doc_id as string), doc_id, text)
- queries(query_id, query) = (item_id, the whole normalised text)
- qrels(query_id, url)     = documents whose text contains the benchmark
                             text verbatim
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.config import DEFAULT, Params
from quarry.functions.text import terms, uncut
from quarry.operators import blocks
from quarry.plans.strategy import sized_join, spread, stored, table_bytes

DUPLICATE_SEQ_OFFSET = 1_000_000


TEXT_TABLES = ("documents", "pages", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    # text-heavy tables: make sure per-row text work is spread over the cores
    return spread(df) if name in TEXT_TABLES else df


def read_corpus(spark: SparkSession, path: str, url_col: str = "URL", content_col: str = "content",
                seq_col: str | None = None, params: Params = DEFAULT) -> DataFrame:
    """A crawled corpus (url, content) read from Parquet, projected to
    (url, doc_seq, text). Missing columns fail at once. Without a stored
    sequence column rows are numbered 0, 1, 2, ... by file path and row within the file: the rows of each file are
    counted, the counts summed up in path order (a row per file), and a row adds its own index in its file. The
    numbers are the same however the scan is split."""
    df = spark.read.parquet(path)
    missing = [c for c in (url_col, content_col) if c not in df.columns]
    if missing:
        raise ValueError(f"corpus {path} lacks columns {missing}")
    if seq_col:
        return df.select(F.col(url_col).alias("url"), F.col(seq_col).cast("bigint").alias("doc_seq"), F.col(content_col).alias("text"))
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    counts = df.select(*place).groupBy("_file").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(counts.select("_file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start")), "file-starts")
    rows = df.select(F.col(url_col).alias("url"), F.col(content_col).alias("text"), *place)
    return sized_join(rows, starts, "_file", "url", params.broadcast_bytes, params.salts).select(
        "url", (F.col("_start") + F.col("_row")).alias("doc_seq"), "text")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("url"),
        F.col("doc_id").alias("doc_seq"),
        "text",
    )


def docs_with_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input for A9: every tenth document appears again later, with another text."""
    base = docs(spark, sf_dir)
    again = base.filter(F.col("doc_seq") % 10 == 0).select(
        "url",
        (F.col("doc_seq") + F.lit(DUPLICATE_SEQ_OFFSET)).alias("doc_seq"),
        F.concat(F.lit("revised "), F.col("text")).alias("text"),
    )
    return base.unionByName(again)


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"),
        F.array_join(terms("text"), " ").alias("query"),
    )


def qrels(spark: SparkSession, sf_dir: str, params: Params = DEFAULT) -> DataFrame:
    """Relevant (query, document) pairs of the driver tables: the benchmark passage occurs in the document verbatim."""
    bench = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("passage"))
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("url"), "text")
    return containing(documents, bench, params)


def _terms_among(documents: DataFrame, wanted: DataFrame, *kept: str) -> DataFrame:
    """(kept..., term): the distinct terms of each document (url, text) that are in ``wanted(term)`` (stored, within the byte bound)."""
    kinds = dict(documents.dtypes)
    kernel = blocks.terms_among_fn([r["term"] for r in wanted.select("term").distinct().filter("term is not null").collect()], len(kept))
    return documents.select(*kept, uncut("text").alias("_text")).mapInArrow(kernel, ", ".join([*(f"{c} {kinds[c]}" for c in kept), "term string"]))


def _keyed(bench: DataFrame, doc_terms, params: Params, documents: DataFrame | None = None) -> DataFrame:
    """(query_id, passage, term): each passage with the rarest of its ``t`` terms among the documents, by one scan of their terms.
    With ``documents`` these are whole words: within the byte bound the words wanted go to the tasks, which look for no others."""
    own = bench.select("query_id", "passage", F.explode("t").alias("term"))
    wanted = stored(own.select("term").distinct(), "passage-terms")
    if documents is not None and table_bytes(wanted) <= params.broadcast_bytes:
        met = _terms_among(documents, wanted)
    else:
        met = sized_join(doc_terms, wanted, "term", "url", params.broadcast_bytes, params.salts, "left_semi")
    dfs = met.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    rare = own.join(dfs, "term", "left").groupBy("query_id", "passage").agg(F.min(F.struct(F.coalesce("df", F.lit(0)), "term")).alias("k"))
    return stored(rare.select("query_id", "passage", F.col("k.term").alias("term")), "passage-keys")


def _verified(documents: DataFrame, terms_of, keyed: DataFrame, params: Params, whole_words: bool = False) -> DataFrame:
    """(query_id, url) of the documents that hold a passage, found by its key term and checked in the text.

    Within the byte bound the keys are broadcast and a document's text stays beside its exploded terms; beyond, narrow
    (url, term) rows meet the keys dealt by (term, piece of the url), and texts are joined to the pairs found."""
    if table_bytes(keyed) <= params.broadcast_bytes:
        rows = _terms_among(documents, keyed, "url", "text") if whole_words else documents.select("url", "text", F.explode(terms_of("text")).alias("term"))
        found = rows.join(F.broadcast(keyed), "term")
    else:
        pairs = sized_join(documents.select("url", F.explode(terms_of("text")).alias("term")), keyed, "term", "url", params.broadcast_bytes, params.salts)
        found = documents.join(stored(pairs.select("url", "query_id", "passage"), "passage-candidates"), "url")
    return found.filter(F.instr(F.col("text"), F.col("passage")) > 0).select("query_id", "url")


def _grams(text):
    """Distinct character sequences of 1 to 3 letters within the terms of a text."""
    return F.array_distinct(F.flatten(F.transform(terms(text), lambda w: F.flatten(F.transform(
        F.sequence(F.lit(1), F.lit(3)), lambda k: F.when(F.length(w) >= k, F.transform(
            F.sequence(F.lit(1), F.length(w) - k + 1), lambda i: F.substring(w, i, k))).otherwise(F.array().cast("array<string>")))))))


def containing(documents: DataFrame, bench: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """(query_id, url): the documents (url, text) that contain each passage (query_id, passage), an empty passage none.

    A term strictly inside a passage, with separators on both sides, is a term of every document that contains
    it, so each passage is looked up by the rarest such term: one scan of the documents' terms counts them, one
    finds and checks the candidates. Passages of fewer than three terms have none inside; if there are any, they are
    looked up alike by their rarest run of up to three letters, which every document with the passage has within its
    terms. A passage without letters is compared with every text, as a stated set in one block."""
    bench = stored(bench.filter(F.length("passage") > 0).select("query_id", "passage", terms("passage").alias("t")), "passages")
    long = bench.filter(F.size("t") >= 3).withColumn("t", F.array_distinct(F.slice("t", 2, F.size("t") - 2)))

    def doc_terms(text):
        return F.array_distinct(terms(text))

    out = _verified(documents, doc_terms, _keyed(long, documents.select("url", F.explode(doc_terms("text")).alias("term")), params, documents), params, True)
    short = bench.filter((F.size("t") < 3) & (F.element_at("t", 1) != ""))
    if not short.isEmpty():
        longest = F.array_max(F.transform(_grams("passage"), F.length))
        short = short.withColumn("t", F.filter(_grams("passage"), lambda g: F.length(g) == longest))
        out = out.unionByName(_verified(documents, _grams, _keyed(short, documents.select("url", F.explode(_grams("text")).alias("term")), params), params))
    bare = bench.filter(F.element_at("t", 1) == "")
    if not bare.isEmpty():
        block = bare.agg(F.collect_list(F.struct("query_id", "passage")).alias("block"))
        rows = documents.crossJoin(F.broadcast(block)).select("url", "text", F.explode("block").alias("b"))
        out = out.unionByName(rows.filter(F.instr(F.col("text"), F.col("b.passage")) > 0).select("b.query_id", "url"))
    return out.distinct()
