"""End-to-end pipelines: bulk index with persistence (Q6) and crawl to
corpus (Q7)."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.config import DEFAULT, Params
from quarry.functions.text import html_to_text
from quarry.operators import index as ix
from quarry.operators import vectors as vx
from quarry.operators.expand import expand_documents, first_chunk_end, seed_set
from quarry.plans.engine import SearchIndex
from quarry.sources import feeds as fd
from quarry.sources import store

TABLES = ("documents", "expanded", "versions", "postings", "term_stats", "stats", "doc_vec", "vocab_vec", "seeds", "meta", "done")
#: Of the stored tables; a build in another layout is not gone on with.
LAYOUT = 2
FLAT, PACKED = "term string, url string, dl bigint, tf bigint", "url string, dl bigint, terms string, tfs array<int>"


def _paths(out_dir: str) -> dict[str, str]:
    base = out_dir.rstrip("/")
    return {k: f"{base}/{k}" for k in TABLES}


def corpus_digest(raw_docs: DataFrame) -> str:
    """A digest of the rows (url, doc_seq, text) in any order: their number, the sum and the exclusive or of their hashes."""
    h = F.xxhash64("url", "doc_seq", "text")
    row = raw_docs.agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("s"), F.bit_xor(h).alias("x")).first()
    return f"{row['n']}:{row['s']}:{row['x']}"


class Progress:
    """Which parts of a build are complete, each a marker written behind its tables."""

    def __init__(self, spark: SparkSession, path: str, mark: str, keep: bool):
        self.spark, self.path, self.mark = spark, path, mark
        known = store.read_table(spark, path, "part string, mark string") if keep else None
        self.done = {r["part"] for r in known.collect() if r["mark"] == mark} if known is not None else set()
        if not self.done:
            store.write_table(spark.createDataFrame([], "part string, mark string"), path)

    def run(self, part: str, work) -> None:
        """``work()``, unless it was done before."""
        if part not in self.done:
            work()
            self.spark.createDataFrame([(part, self.mark)], "part string, mark string").coalesce(1).write.mode("append").parquet(self.path)
            self.done.add(part)


def bulk_index(spark: SparkSession, raw_docs: DataFrame, out_dir: str, params: Params = DEFAULT, expand: bool = True, reuse: bool = True,
               embedder=None, term_embedder=None, on_duplicate: str = "last", passes: int = 1, recurrent: bool = False,
               ranges: int = 1) -> SearchIndex:
    """Q6: raw (url, doc_seq, text) -> index tables under ``out_dir``.

    Documents are reduced to their last versions once, as a table in ``ranges`` slices by url; each slice is then expanded and
    embedded by itself. A part counts as done when its marker stands behind it. With ``reuse``, parts that the same documents,
    parameters and options have left (S11: compared by an order-free digest, one more scan) are kept: a finished build is opened, a stopped
    one goes on behind its last marker (S12); anything else is built anew. Postings are packed, a row per
    document, written where the documents are read: no shuffle, and a term of most documents is spread over all files.

    ``on_duplicate='accumulate'`` (X1) adds up the postings of all versions of a url, each expanded as it is indexed; ``passes`` and
    ``recurrent`` are those of ``expand_documents``. Returns the index read back from the written tables."""
    if on_duplicate not in ("last", "accumulate") or (on_duplicate == "accumulate" and recurrent):
        raise ValueError("on_duplicate is 'last' or 'accumulate', the latter without recurrent")
    embedder = embedder or vx.WordHashEmbedder(params.text_dim)
    term_embedder = term_embedder or vx.TrigramHashEmbedder(params.term_dim)
    p = _paths(out_dir)
    options = {"expand": expand, "on_duplicate": on_duplicate, "passes": passes, "recurrent": recurrent, "ranges": ranges,
               "embedder": embedder.descriptor(), "term_embedder": term_embedder.descriptor(), "params": asdict(params)}
    mark = json.dumps(options | {"layout": LAYOUT, "corpus": corpus_digest(raw_docs) if reuse else None}, sort_keys=True)
    progress = Progress(spark, p["done"], mark, reuse)
    if not progress.done:
        for k in ("meta", "expanded", "doc_vec"):   # a build in other slices, or an index that was open to readers
            store.remove(spark, p[k])
    part = F.pmod(F.xxhash64("url"), F.lit(ranges)).cast("int").alias("part")

    progress.run("documents", lambda: store.write_table(ix.last_wins(raw_docs).select("*", part), p["documents"], "part"))
    docs = store.read_table(spark, p["documents"], "url string, doc_seq bigint, text string, part int")
    if expand:
        progress.run("seeds", lambda: store.write_table(seed_set(docs, embedder, params, recurrent), p["seeds"]))
        seeds = spark.read.schema("url string, doc_seq bigint, text string, seed_url string, sim double, folded boolean").parquet(p["seeds"])
        chunk_end = first_chunk_end(docs, params) if passes == 2 else None

    def expanded(rows: DataFrame) -> DataFrame:
        rows = rows.select("url", "doc_seq", "text")
        return expand_documents(rows, embedder, params, passes, recurrent, seeds, chunk_end) if expand else rows

    def indexed(i: int):
        def work():
            store.save_expanded(expanded(docs.filter(F.col("part") == i)), f"{p['expanded']}/part={i}")           # S7
            if not counted:
                embedded(i)()
        return work

    def embedded(i: int, packed: DataFrame | None = None):
        mine = store.load_expanded(spark, f"{p['expanded']}/part={i}")
        return lambda: store.write_table(vx.embed_all(mine, embedder, packed=packed).select("url", "dims", "ws"), f"{p['doc_vec']}/part={i}")   # S9

    # a whole that is one slice has the words of its documents counted once, for postings and vectors
    counted = ranges == 1 and on_duplicate == "last"
    for i in range(ranges):
        progress.run(f"part {i}", indexed(i))
    if on_duplicate == "accumulate":
        progress.run("versions", lambda: store.write_table(expanded(ix.clean_corpus(raw_docs).drop("doc_seq").join(
            docs.select("url", "doc_seq"), "url")).select("url", "text"), p["versions"]))

    docs = ix.with_length(store.load_expanded(spark, p["expanded"]))
    again = ix.repeated_urls(docs) if on_duplicate == "last" else None
    # packed postings are a row per document then
    apart = again is not None and again.isEmpty()

    def write_postings():
        post = ix.accumulate_postings(spark.read.parquet(p["versions"]), docs) if on_duplicate == "accumulate" else ix.packed_postings(docs, again)
        store.write_table(post, p["postings"])

    progress.run("postings", write_postings)
    postings = store.read_table(spark, p["postings"], FLAT if on_duplicate == "accumulate" else PACKED)
    if counted:
        progress.run("vectors", embedded(0, postings if apart else None))
    progress.run("stats", lambda: store.write_table(ix.corpus_stats((postings if apart else docs).select("dl")), p["stats"]))
    stats = spark.read.parquet(p["stats"])
    progress.run("term_stats", lambda: store.write_table(ix.term_stats(postings), p["term_stats"]))
    vocab = ix.frequent_vocabulary(spark.read.parquet(p["term_stats"]), stats, params.vocab_min_df_frac)
    progress.run("vocab_vec", lambda: store.write_table(term_embedder.embed(vocab, "term", "term"), p["vocab_vec"]))
    progress.run("meta", lambda: store.write_table(spark.createDataFrame([(json.dumps(options),)], "options string"), p["meta"]))
    return open_index(spark, out_dir, embedder, term_embedder)


def open_index(spark: SparkSession, out_dir: str, embedder=None, term_embedder=None) -> SearchIndex:
    """Read a stored index (S8, S10) with the parameters it was built with. Supplied or custom embedders
    must be passed and be those of the build; an index that lacks a part is refused."""
    p = _paths(out_dir)
    meta = store.read_table(spark, p["meta"], "options string")
    doc_vec, vocab_vec = store.load_vectors(spark, p["doc_vec"], p["vocab_vec"])
    if meta is None or doc_vec is None or vocab_vec is None:
        raise ValueError(f"no complete index at {out_dir}")
    options = json.loads(meta.first()["options"])
    found = []
    for given, key in ((embedder, "embedder"), (term_embedder, "term_embedder")):
        if given is not None and given.descriptor() != options[key]:
            raise ValueError(f"the index was built with {options[key]}, not {given.descriptor()}")
        found.append(given or vx.embedder_of(options[key]))
    docs = ix.with_length(store.load_expanded(spark, p["expanded"]))
    flat = options["on_duplicate"] == "accumulate"   # the postings of all versions of a url
    postings = store.read_table(spark, p["postings"], FLAT if flat else PACKED)
    packed = None if flat else postings
    return SearchIndex(docs, postings if flat else ix.unpacked(packed), spark.read.parquet(p["term_stats"]),
                       spark.read.parquet(p["stats"]), doc_vec, vocab_vec, Params(**options["params"]), *found, packed)


def crawl(spark: SparkSession, feed_list_path: str, feed_payloads: DataFrame, pages: DataFrame,
          out_path: str) -> DataFrame:
    """Q7: feed list -> entry links -> fetched bodies -> clean text ->
    Parquet (url, content); returns the written table read back.

    ``feed_payloads(feed_url, payload)`` and ``pages(url, html)`` stand for
    the two network fetches. A feed that was not fetched gives no links; a
    page that was not fetched gives empty content; duplicate links are
    kept; of several payloads of one feed the greatest counts."""
    feeds = fd.read_feed_list(spark, feed_list_path)                               # S2
    fetched = feeds.join(feed_payloads.groupBy("feed_url").agg(F.max("payload").alias("payload")),
                         "feed_url", "left")
    links = fd.parse_feeds(fetched)                                                # S3, S5
    bodies = fd.attach_pages(links, pages.select("url", "html"))                   # S4
    corpus = bodies.select(F.col("url").alias("URL"), html_to_text("html").alias("content"))   # P1
    store.write_table(corpus, out_path)                                            # S6
    return spark.read.schema("URL string, content string").parquet(out_path)
