"""Incremental indexing with Structured Streaming (ST1-ST3): a log of immutable segments.

New document files arriving in a folder are indexed micro-batch by micro-batch. Each batch becomes a segment:
documents as indexed (expanded), their vectors, postings and term statistics, every row with the
batch's number. A url that comes again leaves a tombstone, (url, below): its rows of batches before ``below``
are dead. Nothing is changed in place; a manifest version, written last, names the segments that count, so a batch
that is run again after a failure overwrites its own segment or finds itself committed, and readers
see whole versions only. The checkpoint location records which files were processed (ST3).

Segments of like size that follow each other are merged when there are ``fanout`` of them (size-tiered
compaction): the merged segment drops dead rows, and tombstones that nothing older needs.

``open_index`` gives the live rows as a ``SearchIndex``. It equals a batch build if the seed documents
(the first by position) come before the documents that are compared with them and are not indexed again; as
in the reference, documents that were expanded once are not expanded anew when the seeds change.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.config import DEFAULT, Params
from quarry.operators import index as ix
from quarry.operators import vectors as vx
from quarry.operators.expand import expand_documents, seed_rows
from quarry.plans.engine import SearchIndex
from quarry.plans.strategy import sized_join, stored
from quarry.sources import store

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SCHEMAS = {
    "docs": "url string, doc_seq bigint, text string, dl bigint, seq bigint",
    "postings": "url string, dl bigint, terms string, tfs array<int>, seq bigint",
    "doc_vec": "url string, dims array<int>, ws array<double>, seq bigint",
    "term_stats": "term string, df bigint",
    "tombstones": "url string, below bigint",
    "seeds": "url string, doc_seq bigint, text string",
}
#: Documents of the smallest tier.
TIER_DOCS = 1000
#: Of the stored tables: postings are packed.
LAYOUT = 2


@dataclass
class Segments:
    """The segments under ``root`` and how new ones are made."""

    spark: SparkSession
    root: str
    params: Params = DEFAULT
    expand: bool = False
    fanout: int = 4
    embedder: object = None
    term_embedder: object = None
    manifest: dict = field(init=False)

    def __post_init__(self):
        self.root = self.root.rstrip("/")
        self.embedder = self.embedder or vx.WordHashEmbedder(self.params.text_dim)
        self.term_embedder = self.term_embedder or vx.TrigramHashEmbedder(self.params.term_dim)
        self.refresh()

    def refresh(self) -> None:
        """The newest manifest version."""
        known = store.read_table(self.spark, f"{self.root}/manifest", "state string, version bigint")
        last = known.orderBy(F.desc("version")).first() if known is not None else None
        self.manifest = json.loads(last["state"]) | {"version": last["version"]} if last else {
            "version": -1, "last_batch": -1, "segments": [], "seeds": None, "layout": LAYOUT}
        if self.manifest.get("layout") != LAYOUT:
            raise ValueError(f"the segments under {self.root} are in another layout; index their documents again")

    def _commit(self, **changes) -> None:
        state = {k: v for k, v in (self.manifest | changes).items() if k != "version"}
        version = self.manifest["version"] + 1
        store.write_table(self.spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1), f"{self.root}/manifest/version={version}")
        self.manifest = state | {"version": version}

    def _path(self, segment: str, table: str) -> str:
        return f"{self.root}/segments/{segment}/{table}"

    def rows(self, table: str, segments: list[dict] | None = None) -> DataFrame:
        """The rows of a table in all segments of the manifest (or those given), dead ones included."""
        segments = self.manifest["segments"] if segments is None else segments
        if not segments:
            return self.spark.createDataFrame([], SCHEMAS[table])
        return self.spark.read.schema(SCHEMAS[table]).parquet(*[self._path(s["name"], table) for s in segments])

    def _tombstones(self) -> DataFrame | None:
        """(url, below) of all segments; None if there are none, which the manifest knows."""
        marked = [s for s in self.manifest["segments"] if s["tombstones"]]
        return stored(self.rows("tombstones", marked).groupBy("url").agg(F.max("below").alias("below")), "tombstones") if marked else None

    def _told(self, table: str, segments: list[dict] | None = None, dead: bool = False) -> DataFrame:
        rows, marks = self.rows(table, segments), self._tombstones()
        if marks is None:
            return rows.limit(0) if dead else rows
        gone = F.coalesce(F.col("seq") < F.col("below"), F.lit(False))
        joined = sized_join(rows, marks, "url", "url", self.params.broadcast_bytes, self.params.salts, "left")
        return joined.filter(gone if dead else ~gone).select(*rows.columns)

    def live(self, table: str, segments: list[dict] | None = None) -> DataFrame:
        """The rows of the last version of each url; postings, which are stored packed, one by one."""
        rows = self._told(table, segments)
        return ix.unpacked(rows) if table == "postings" else rows

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Index the documents (url, doc_seq, text) of a batch as a segment, then compact."""
        self.refresh()
        if batch_id <= self.manifest["last_batch"]:
            return
        name = f"b{batch_id:09d}"
        rows = stored(ix.last_wins(batch), "batch")
        if rows.isEmpty():
            return self._commit(last_batch=batch_id)
        known = self.rows("docs").select("url", "doc_seq").join(rows.select("url"), "url", "left_semi")
        known = stored(known.groupBy("url").agg(F.min("doc_seq").alias("first")), "known-urls")
        rows = stored(rows.join(known, "url", "left").select("url", F.coalesce("first", "doc_seq").alias("doc_seq"), "text"), "batch")
        seeds = self._seeds(name, rows) if self.expand else None
        docs = rows
        if self.expand:
            chosen = self.spark.read.schema(SCHEMAS["seeds"]).parquet(seeds).select(
                "*", F.lit(None).cast("string").alias("seed_url"), F.lit(None).cast("double").alias("sim"), F.lit(False).alias("folded"))
            docs = expand_documents(rows, self.embedder, self.params, seeds=chosen).select("url", "doc_seq", "text")
        marks = known.select("url", F.lit(batch_id).cast("bigint").alias("below"))
        self._write(name, ix.with_length(docs).withColumn("seq", F.lit(batch_id).cast("bigint")), marks)
        n = self.rows("docs", [{"name": name}]).count()
        self._commit(last_batch=batch_id, seeds=seeds, segments=self.manifest["segments"] + [
            {"name": name, "low": batch_id, "high": batch_id, "n_docs": n, "tombstones": known.count()}])
        self.compact()

    def _seeds(self, name: str, rows: DataFrame) -> str:
        """Write the seed rows after this batch: the first documents, with their last text."""
        path = self._path(name, "seeds")
        pool = rows
        if self.manifest["seeds"]:
            old = self.spark.read.schema(SCHEMAS["seeds"]).parquet(self.manifest["seeds"])
            pool = rows.unionByName(old.join(rows.select("url"), "url", "left_anti"))
        store.write_table(seed_rows(pool, self.params), path)
        return path

    def _write(self, name: str, docs: DataFrame, marks: DataFrame, postings: DataFrame | None = None, vectors: DataFrame | None = None) -> None:
        """The tables of a segment; postings and vectors are made from its documents unless given."""
        store.write_table(docs, self._path(name, "docs"))
        docs = self.rows("docs", [{"name": name}])
        if postings is None:
            seq = docs.select("seq").first()["seq"]
            again = ix.repeated_urls(docs)
            postings = ix.packed_postings(docs, again).withColumn("seq", F.lit(seq))
        store.write_table(postings.select("url", "dl", "terms", "tfs", "seq"), self._path(name, "postings"))
        if vectors is None:
            packed = self.rows("postings", [{"name": name}]) if again.isEmpty() else None
            vectors = vx.embed_all(docs, self.embedder, packed=packed).withColumn("seq", F.lit(seq))
        store.write_table(vectors.select("url", "dims", "ws", "seq"), self._path(name, "doc_vec"))
        store.write_table(ix.term_stats(self.rows("postings", [{"name": name}])), self._path(name, "term_stats"))
        store.write_table(marks, self._path(name, "tombstones"))

    def _tier(self, segment: dict) -> int:
        return max(0, math.floor(math.log(max(1, segment["n_docs"]) / TIER_DOCS, self.fanout)) + 1)

    def _run(self) -> list[dict]:
        """The first ``fanout`` segments in a row that are of one tier; none, an empty list."""
        run: list[dict] = []
        for s in self.manifest["segments"]:
            run = run + [s] if run and self._tier(run[0]) == self._tier(s) else [s]
            if len(run) == self.fanout:
                return run
        return []

    def compact(self) -> int:
        """Merge runs of segments until none is left; how many merges there were."""
        merges = 0
        while run := self._run():
            segments = self.manifest["segments"]
            at = segments.index(run[0])
            name = f"m{run[0]['low']:09d}-{run[-1]['high']:09d}"
            marks = self.rows("tombstones", run).groupBy("url").agg(F.max("below").alias("below"))
            if at == 0:
                marks = marks.limit(0)   # nothing older is left to be dead
            self._write(name, self.live("docs", run), marks, self._told("postings", run), self._told("doc_vec", run))
            merged = {"name": name, "low": run[0]["low"], "high": run[-1]["high"], "n_docs": self.rows("docs", [{"name": name}]).count(),
                      "tombstones": self.rows("tombstones", [{"name": name}]).count()}
            self._commit(segments=segments[:at] + [merged] + segments[at + len(run):])
            merges += 1
        return merges

    def vacuum(self) -> None:
        """Remove the tables of segments and manifest versions that the newest version does not name. Readers of older versions lose them."""
        names = {s["name"] for s in self.manifest["segments"]} | ({self.manifest["seeds"].split("/")[-2]} if self.manifest["seeds"] else set())
        for folder, keep in (("segments", names), ("manifest", {f"version={self.manifest['version']}"})):
            place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
            files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for entry in files.listStatus(place) if files.exists(place) else []:
                if entry.getPath().getName() not in keep:
                    store.remove(self.spark, entry.getPath().toString())

    def term_stats(self) -> DataFrame:
        """ST2: df per term: the sums of the segments' statistics, less the dead postings."""
        dead = ix.term_stats(self._told("postings", dead=True)).withColumn("df", -F.col("df"))
        total = self.rows("term_stats").unionByName(dead).groupBy("term").agg(F.sum("df").cast("bigint").alias("df"))
        return total.filter("df > 0")

    def open_index(self) -> SearchIndex:
        """The live rows of the newest manifest version, ready for search."""
        docs = self.live("docs").select("url", "doc_seq", "text", "dl")
        stats = stored(ix.corpus_stats(docs), "segment-stats")
        terms = stored(self.term_stats(), "segment-terms")
        vocab = stored(self.term_embedder.embed(ix.frequent_vocabulary(terms, stats, self.params.vocab_min_df_frac), "term", "term"), "segment-vocab")
        packed = self._told("postings").select("url", "dl", "terms", "tfs")
        return SearchIndex(docs, ix.unpacked(packed), terms, stats, self.live("doc_vec").select("url", "dims", "ws"), vocab,
                           self.params, self.embedder, self.term_embedder, packed)


def _write_batch(out_dir: str, **options):
    def fn(batch: DataFrame, batch_id: int) -> None:
        docs = batch.select(F.col("doc_id").cast("string").alias("url"), F.col("doc_id").alias("doc_seq"), "text")
        Segments(batch.sparkSession, out_dir, **options).add(docs, batch_id)
    return fn


def start(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str, files_per_batch: int = 1,
          glob: str = "*.parquet", **options):
    """ST1: start the incremental indexer; ``availableNow`` processes what
    is there in bounded batches, then stops. The options are those of ``Segments``."""
    stream = (spark.readStream.schema(DOC_SCHEMA)
              .option("maxFilesPerTrigger", files_per_batch)
              .option("pathGlobFilter", glob)
              .parquet(source_dir))
    return (stream.writeStream.foreachBatch(_write_batch(out_dir, **options))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def postings(spark: SparkSession, out_dir: str) -> DataFrame:
    """(term, url, tf) of the last version of each url."""
    return Segments(spark, out_dir).live("postings").select("term", "url", "tf")


def running_stats(spark: SparkSession, out_dir: str) -> DataFrame:
    """ST2: n_docs, total_len, avdl over all committed batches; a url indexed
    again counts once, with the length of its last version."""
    return Segments(spark, out_dir).live("docs").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.sum("dl"), F.lit(0)).cast("bigint").alias("total_len"),
    ).withColumn("avdl", F.col("total_len") / F.col("n_docs"))


def document_frequency(spark: SparkSession, out_dir: str) -> DataFrame:
    """ST2: df per term from the committed segments."""
    return Segments(spark, out_dir).term_stats()
