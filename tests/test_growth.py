"""Steps that used to grow faster than their input: postings by document, whole pairs, bounded pieces."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F

from quarry.config import DEFAULT
from quarry.operators import evaluate as ev
from quarry.operators import index as ix
from quarry.operators.expand import best_seed
from quarry.operators.vectors import WordHashEmbedder
from quarry.plans import catalog
from quarry.plans import engine as en


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _docs(spark):
    # a repeated row, one url with two lengths, null urls and texts, an empty text
    rows = [("a", 0, "one two two"), ("b", 1, "two three"), ("b", 1, "two three"), ("c", 2, "four"), ("c", 3, "four five"),
            (None, 4, "one six"), (None, 5, "one ten"), ("d", 6, None), ("e", 7, "")]
    return spark.createDataFrame(rows, "url string, doc_seq bigint, text string")


def test_postings_and_frequencies_of_repeated_documents(spark):
    docs = _docs(spark)
    plain = ix.token_rows(docs).groupBy("term", "url", "dl").agg(F.count(F.lit(1)).alias("tf"))
    want = sorted(map(str, (r.asDict() for r in plain.collect())))
    assert sorted(map(str, (r.asDict() for r in ix.postings(docs).select("term", "url", "dl", "tf").collect()))) == want
    assert {tuple(r) for r in ix.document_frequency(docs).collect()} == {tuple(r) for r in ix.term_stats(plain).collect()}


def test_postings_of_distinct_documents_are_not_shuffled(spark):
    docs = spark.range(50).select(F.col("id").cast("string").alias("url"), F.col("id").alias("doc_seq"), F.concat_ws(" ", F.lit("x"), "id").alias("text"))
    assert "Exchange" not in _plan(ix.postings(docs))


def test_expansion_sends_no_texts_back_from_python(spark):
    docs = spark.range(5).select(F.col("id").cast("string").alias("url"), F.col("id").alias("doc_seq"), F.lit("same words here").alias("text"))
    chosen = best_seed(docs, WordHashEmbedder(DEFAULT.text_dim))
    assert "MapInArrow" not in _plan(chosen)
    assert {(r["url"], r["n_pred"], r["seed_url"]) for r in chosen.collect()} == {
        ("0", 0, None), ("1", 1, None), ("2", 2, "0"), ("3", 3, "0"), ("4", 4, "0")}


def test_search_gives_every_pair_by_either_way(spark):
    docs = spark.range(130).select(F.col("id").cast("string").alias("url"), F.col("id").alias("doc_seq"),
                                   F.concat_ws(" ", F.lit("word"), F.concat(F.lit("w"), (F.col("id") % 7).cast("string"))).alias("text"))
    queries = spark.createDataFrame([(1, "word w1"), (2, "w3 nothing"), (3, "absent")], "query_id bigint, query string")
    index = en.build_index(docs)
    rows = {(r["query_id"], r["url"]): (round(r["lex"], 9), round(r["cos"], 9), round(r["score"], 9)) for r in en.search(index, queries).collect()}
    assert len(rows) == 3 * 130
    index.params = index.params.with_(broadcast_bytes=0)
    assert rows == {(r["query_id"], r["url"]): (round(r["lex"], 9), round(r["cos"], 9), round(r["score"], 9)) for r in en.search(index, queries).collect()}


def test_reports_of_pairs_are_not_cut():
    for name in ("v3_query_doc_cosine", "q3_hybrid_search", "j3_hybrid_merge"):
        assert "rank <=" not in catalog.SQL[name].split("SELECT query_id, url, round")[-1] and "rank" not in catalog.SQL[name].rsplit("SELECT", 1)[1]


def test_rows_behind_all_judged_ones_are_not_dealt(spark, monkeypatch):
    scores = spark.range(1000).select(F.lit(1).cast("bigint").alias("query_id"), F.col("id").cast("string").alias("url"), F.col("id").cast("double").alias("score"))
    judged = spark.createDataFrame([(1, "990", 990.0), (1, "995", 995.0)], "query_id bigint, url string, s double")
    seen = []
    dealt = ev.dealt
    monkeypatch.setattr(ev, "dealt", lambda rows, *a: seen.append(rows.count()) or dealt(rows, *a))
    assert {r["url"]: r["n_before"] for r in ev.count_before(scores, judged).collect()} == {"990": 9, "995": 4}
    assert seen == [10]


def test_stream_files_follow_the_scan(spark, tmp_path):
    docs = spark.range(400).repartition(12)
    assert catalog._arrive(docs, str(tmp_path / "in"), docs.rdd.getNumPartitions(), 4) == 3
    assert len(glob.glob(str(tmp_path / "in" / "*.parquet"))) == 12


def test_last_versions_of_distinct_urls_are_not_shuffled(spark):
    docs = spark.range(50).select(F.col("id").cast("string").alias("url"), F.col("id").alias("doc_seq"), F.concat_ws(" ", F.lit("x"), "id").alias("text"))
    assert "Exchange hashpartitioning" not in _plan(ix.last_wins(docs))


def test_last_versions_by_either_way(spark, monkeypatch):
    rows = [*map(tuple, _docs(spark).collect()), ("f", None, "no place"), ("g", None, "no place"), ("g", 9, "a place")]
    docs = spark.createDataFrame(rows, "url string, doc_seq bigint, text string")
    got = sorted(map(tuple, ix.last_wins(docs).collect()))
    assert got == [("a", 0, "one two two"), ("b", 1, "two three"), ("b", 1, "two three"), ("c", 2, "four five"), ("d", 6, ""), ("e", 7, ""), ("g", 9, "a place")]
    monkeypatch.setattr(ix, "DEFAULT", DEFAULT.with_(broadcast_bytes=0))
    assert sorted(map(tuple, ix.last_wins(docs).collect())) == got


def test_postings_are_dealt_a_row_per_document(spark):
    docs = spark.createDataFrame([(u, i, t) for i, (u, t) in enumerate([("a", "one two two"), ("b", "two three one"), ("c", "four")])], "url string, doc_seq bigint, text string")
    index = en.build_index(docs)
    queries = spark.createDataFrame([(1, "one two"), (2, "two two four")], "query_id bigint, query string")
    scores = en.lexical(index, queries, expand=False)
    assert "MapInArrow" in _plan(scores)
    got = {(r["query_id"], r["url"]): round(r["lex"], 9) for r in scores.collect()}
    index.params = index.params.with_(broadcast_bytes=0)
    assert got == {(r["query_id"], r["url"]): round(r["lex"], 9) for r in en.lexical(index, queries, expand=False).collect()}
    assert set(got) == {(1, "a"), (1, "b"), (2, "a"), (2, "b"), (2, "c")}


def test_packed_runs_hold_every_row():
    import pyarrow as pa

    from quarry.operators import blocks
    rows = pa.RecordBatch.from_pydict({"url": ["a", "a", "b", "b", "b", None, "a"], "dl": [1, 1, 1, 1, 2, 2, 1], "id": pa.array([1, 2, 1, 2, 3, 4, 5], pa.int32()),
                                       "tf": [1, 1, 2, 2, 3, 4, 5]})
    out = [r for b in blocks.pack_postings_fn()([rows, rows.slice(0, 0)]) for r in b.to_pylist()]
    assert [(r["url"], r["dl"], r["ids"], r["tfs"]) for r in out] == [
        ("a", 1, [1, 2], [1, 1]), ("b", 1, [1, 2], [2, 2]), ("b", 2, [3], [3]), (None, 2, [4], [4]), ("a", 1, [5], [5])]


def test_postings_keep_terms_in_a_dictionary(spark, tmp_path):
    import pyarrow.parquet as pq

    from quarry.sources import store
    rows = spark.range(400_000, numPartitions=1).select(F.sha1(F.floor(F.col("id") / 4).cast("string")).alias("term"), F.lit("u").alias("url"))
    store.write_table(rows, str(tmp_path / "p"))
    column = pq.ParquetFile(glob.glob(str(tmp_path / "p" / "*.parquet"))[0]).metadata.row_group(0).column(0)
    assert column.total_uncompressed_size < 100_000 * 44 + 400_000 * 4 and "PLAIN" not in column.encodings
