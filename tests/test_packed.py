"""Packed postings: terms cut in the tasks, vectors and scores from them, no pair or text shuffled."""

from __future__ import annotations

import math

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.functions.text import terms, uncut
from quarry.operators import blocks
from quarry.operators import index as ix
from quarry.operators import search as se
from quarry.operators import vectors as vx
from quarry.operators.rank import largest
from quarry.plans import engine as en
from quarry.sources import corpus as src
from quarry.streaming import incremental as inc

TEXTS = ["The cat, the CAT!", "", " -- ", None, "ÄB äb ÇA x　y\x1cz", "ΟΔΟΣ. ΟΔΟΣ ΑΣ'Α", "İSTANBUL   Straße\u0085STRASSE", "a_b“q”—d", "Ɤ \U00010d50x",
         "日本　語    😀", "x" * 5000 + " the"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _docs(spark):
    return spark.createDataFrame([(f"u{i}", i, t) for i, t in enumerate(TEXTS)], "url string, doc_seq bigint, text string")


def test_cutter_finds_the_terms_of_the_expression(spark):
    rows = _docs(spark).select("text", uncut("text").alias("u"), terms("text").alias("t")).collect()
    found, codes, at = blocks.coded_terms(pa.array([None, *(r["u"] for r in rows)], pa.string()).slice(1))
    got = [[] for _ in rows]
    for c, i in zip(codes, at):
        got[i].append(found[c].as_py())
    assert got == [[w for w in r["t"] or [] if w] for r in rows]
    assert len(set(found.to_pylist())) == len(found)


def test_packed_postings_are_the_flat_ones(spark):
    docs = ix.with_length(ix.last_wins(_docs(spark)))
    packed, flat = ix.packed_postings(docs, ix.repeated_urls(docs)), ix.postings(docs)
    assert sorted(map(str, ix.unpacked(packed).collect())) == sorted(map(str, flat.select("term", "url", "dl", "tf").collect()))
    assert {tuple(r) for r in ix.term_stats(packed).collect()} == {tuple(r) for r in ix.term_stats(flat).collect()}
    assert ix.corpus_stats(packed).first() == ix.corpus_stats(docs).first()
    words = vx.WordHashEmbedder(32)
    assert sorted(map(str, vx.embed_all(docs, words, packed=packed).collect())) == sorted(map(str, words.embed(docs, "url").collect()))


def test_rows_that_come_again_are_taken_together(spark):
    rows = [("a", 0, "one two two"), ("a", 0, "one two two"), ("b", 1, "two three"), ("c", 2, "four one"), ("c", 2, "four four five one"), ("d", 3, ""), ("d", 3, "")]
    docs = spark.createDataFrame(rows, "url string, doc_seq bigint, text string")
    index = en.build_index(docs, expand=False)
    flat = ix.postings(index.docs)
    assert sorted(map(str, index.postings.collect())) == sorted(map(str, flat.select("term", "url", "dl", "tf").collect()))
    assert {tuple(r) for r in index.term_stats.collect()} == {tuple(r) for r in ix.term_stats(flat).collect()}
    assert index.stats.first()["n_docs"] == 7 and index.doc_vec.count() == 7
    queries = spark.createDataFrame([(1, "one two"), (2, "four")], "query_id bigint, query string")
    weights = se.original_weights(se.query_terms(queries), 1.2)
    got, want = ({(r["query_id"], r["url"]): round(r["lex"], 9) for r in se.lexical_scores(p, index.term_stats, index.stats, weights).collect()} for p in (index.packed, flat))
    assert got == want and set(got) == {(1, "a"), (1, "b"), (1, "c"), (2, "c")}
    by_document = se.lexical_matches(index.packed, index.term_stats, index.stats, weights).collect()
    assert {(m["query_id"], r["url"]): round(m["lex"], 9) for r in by_document for m in r["matches"]} == got and len(by_document) == 3


def test_many_terms_are_handed_on(monkeypatch):
    monkeypatch.setattr(blocks, "FREQUENCY_ROWS", 2)
    rows = [pa.RecordBatch.from_pydict({"terms": pa.array(x, pa.string())}) for x in (["a b", None, "a c d"], ["e f g", "a"], [""], [])]
    got: dict = {}
    for b in blocks.packed_frequency_fn()(rows):
        for r in b.to_pylist():
            got[r["term"]] = got.get(r["term"], 0) + r["df"]
    assert got == {"a": 3, "b": 1, "c": 1, "d": 1, "e": 1, "f": 1, "g": 1, "": 1}


def test_scores_add_up_where_a_document_is_read(spark):
    docs = spark.createDataFrame([(u, i, t) for i, (u, t) in enumerate([("a", "one two two"), ("b", "two three one"), ("c", "four")])], "url string, doc_seq bigint, text string")
    index = en.build_index(docs)
    queries = spark.createDataFrame([(1, "one two"), (2, "two two four"), (3, "none")], "query_id bigint, query string")
    scores = en.lexical(index, queries, expand=False)
    assert "Exchange" not in _plan(scores)
    got = {(r["query_id"], r["url"]): round(r["lex"], 9) for r in scores.collect()}
    by_document = se.lexical_matches(index.packed, index.term_stats, index.stats, se.original_weights(se.query_terms(queries), index.params.w_original))
    assert {(m["query_id"], r["url"]): round(m["lex"], 9) for r in by_document.collect() for m in r["matches"]} == got
    index.packed = None   # flat postings
    assert got == {(r["query_id"], r["url"]): round(r["lex"], 9) for r in en.lexical(index, queries, expand=False).collect()}


def test_largest_scores_per_query():
    rows = pa.RecordBatch.from_pydict({"query_id": pa.array([1, 2, None, 1, 1, None, 2], pa.int64()), "lex": [1.0, 5.0, 2.0, 3.0, 2.0, 1.0, 4.0]})
    got = [tuple(r.values()) for b in blocks.largest_fn(2)([rows, rows.slice(0, 0), rows.slice(3)]) for r in b.to_pylist()]
    assert sorted(got, key=str) == sorted([(1, 3.0), (1, 3.0), (2, 5.0), (2, 4.0), (None, 2.0), (None, 1.0)], key=str)


def test_the_nth_score_is_found_without_a_sort(spark):
    scores = spark.range(5000).select((F.col("id") % 3).alias("query_id"), F.col("id").cast("string").alias("url"), (F.col("id") * 7 % 5000).cast("double").alias("lex"))
    best = largest(scores, 4, "lex")
    assert "Sort" not in _plan(best)
    want = {q: sorted((i * 7 % 5000 for i in range(5000) if i % 3 == q), reverse=True)[:4] for q in range(3)}
    got = {q: sorted((r["lex"] for r in best.collect() if r["query_id"] == q), reverse=True)[:4] for q in range(3)}
    assert got == want


def test_passages_are_looked_up_without_exploding_texts(spark):
    docs = spark.createDataFrame([("a", "One two, three four."), ("b", "one two three"), ("a", "x two, three four y"), (None, "x two, three four y"), ("c", None)], "url string, text string")
    bench = spark.createDataFrame([(1, "two, three four"), (2, "One two, three")], "query_id bigint, passage string")
    found = src.containing(docs, bench)
    assert "Generate" not in _plan(found)
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, [(1, "a"), (1, None), (2, "a")]))


def test_strange_urls_are_counted_once_per_query(spark):
    docs = spark.createDataFrame([("a",), ("b",)], "url string")
    lex = spark.createDataFrame([(1, "a"), (1, "x"), (2, "x"), (2, "y"), (2, None)], "query_id bigint, url string")
    queries = spark.createDataFrame([(1,), (2,), (3,)], "query_id bigint")
    assert {tuple(r) for r in se.url_counts(lex, docs, queries).collect()} == {(1, 3), (2, 5), (3, 2)}


def test_texts_stay_in_place_for_distinct_vectors(spark):
    docs = spark.createDataFrame([("a", 0, "red fox"), ("b", 1, "blue"), ("c", 2, "red fox"), ("d", 3, "red fox"), ("e", 4, "")], "url string, doc_seq bigint, text string")
    seen = []

    class Counting(vx.WordHashEmbedder):
        def embed(self, df, key, text="text"):
            seen.append(_plan(df))
            return super().embed(df, key, text)

    got = {r["url"]: (r["dims"], r["ws"]) for r in vx.embed_distinct(docs, Counting(32)).collect()}
    assert len(got) == 5 and got["a"] == got["c"] == got["d"] != got["b"] and math.isclose(sum(w * w for w in got["a"][1]), 1.0)
    assert len(seen) == 1 and "hashpartitioning" not in seen[0]


def test_segments_of_another_layout_are_refused(spark, tmp_path):
    segments = inc.Segments(spark, str(tmp_path))
    segments.add(spark.createDataFrame([("1", 1, "one")], "url string, doc_seq long, text string"), 0)
    segments._commit(layout=1)
    with pytest.raises(ValueError):
        inc.Segments(spark, str(tmp_path))
