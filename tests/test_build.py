"""Building and opening a stored index: numbering, reuse, resumption, duplicates, passes, recurrence, embedders."""

import numpy as np
import pytest

from quarry.config import DEFAULT as P
from quarry.operators import index as ix
from quarry.operators import vectors as vx
from quarry.operators.expand import expand_documents
from quarry.plans import engine as en
from quarry.plans import pipelines as pl
from quarry.sources import corpus as src
from quarry.sources import store

SCHEMA = "url string, doc_seq long, text string"
ROWS = [(f"u{i}", i, t) for i, t in enumerate(["red fox", "blue bird", "red fox runs", "green frog", "blue bird sings", "red fox runs far", "a b c", "blue sky", ""])]


def tables(index):
    return {k: sorted(map(str, getattr(index, k).collect())) for k in ("docs", "postings", "term_stats", "stats", "doc_vec", "vocab_vec")}


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_rows_are_numbered_by_file_and_row(spark, tmp_path):
    rows = [(f"http://x/{i}", f"text {i}") for i in range(57)]
    for k, (a, b) in enumerate(((0, 20), (20, 21), (21, 57))):
        spark.createDataFrame(rows[a:b], "URL string, content string").coalesce(1).write.parquet(f"{tmp_path}/corpus/day={k}")
    want = [(u, i, t) for i, (u, t) in enumerate(rows)]
    assert sorted(map(tuple, src.read_corpus(spark, f"{tmp_path}/corpus").collect()), key=lambda r: r[1]) == want
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
        got = src.read_corpus(spark, f"{tmp_path}/corpus", params=P.with_(broadcast_bytes=0))
        assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    with pytest.raises(ValueError):
        src.read_corpus(spark, f"{tmp_path}/corpus", content_col="body")
    spark.createDataFrame([], "URL string, content string").write.parquet(f"{tmp_path}/none")
    assert src.read_corpus(spark, f"{tmp_path}/none").count() == 0


def test_last_version_at_its_first_position(spark):
    rows = [("a", 3, "old"), ("b", 4, None), ("a", 9, "new"), (None, 1, "x"), ("a", 5, "mid")]
    got = sorted(map(tuple, ix.last_wins(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == [("a", 3, "new"), ("b", 4, "")]
    plan = ix.last_wins(spark.createDataFrame(rows, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def counting(monkeypatch):
    """Names of the tables that are written from now on."""
    written, write = [], store.write_table

    def spy(df, path, *by):
        written.append(path.split("/index/")[-1] if "/index/" in path else path)
        return write(df, path, *by)

    monkeypatch.setattr(store, "write_table", spy)
    return written


def test_only_the_same_corpus_and_options_are_reused(spark, docs, tmp_path, monkeypatch):
    out = f"{tmp_path}/index"
    first = tables(pl.bulk_index(spark, docs, out))
    written = counting(monkeypatch)
    assert tables(pl.bulk_index(spark, docs.repartition(5), out)) == first and written == []
    for changed in (dict(raw_docs=docs.union(spark.createDataFrame([("new", 99, "red fox again")], SCHEMA))), dict(params=P.with_(expand_threshold=0.99)),
                    dict(ranges=3)):
        written.clear()
        given = dict(raw_docs=docs) | changed
        index = pl.bulk_index(spark, given.pop("raw_docs"), out, **given)
        assert "documents" in written and "postings" in written
        assert index.docs.count() == len(ROWS) + ("raw_docs" in changed)
        if "ranges" in changed:
            assert tables(index) == first


def test_a_stopped_build_goes_on(spark, docs, tmp_path, monkeypatch):
    want = tables(pl.bulk_index(spark, docs, f"{tmp_path}/whole/index"))
    out, write = f"{tmp_path}/index", store.write_table

    def failing(df, path, *by):
        if path.endswith("expanded/part=2"):
            raise RuntimeError("stopped")
        return write(df, path, *by)

    monkeypatch.setattr(store, "write_table", failing)
    with pytest.raises(RuntimeError):
        pl.bulk_index(spark, docs, out, ranges=4)
    with pytest.raises(ValueError):
        pl.open_index(spark, out)
    monkeypatch.setattr(store, "write_table", write)
    written = counting(monkeypatch)
    assert tables(pl.bulk_index(spark, docs, out, ranges=4)) == want
    assert not {"documents", "seeds", "expanded/part=0", "expanded/part=1"} & set(written) and "expanded/part=2" in written


def test_accumulated_postings_count_every_version_as_indexed(spark):
    rows = ROWS[:6] + [("u1", 20, "red fox hides"), ("u1", 21, "blue bird again")]
    docs = spark.createDataFrame(rows, SCHEMA)
    params = P.with_(expand_threshold=0.5)
    last, all_of = (en.build_index(docs, params, on_duplicate=k) for k in ("last", "accumulate"))
    assert sorted(last.docs.collect()) == sorted(all_of.docs.collect())
    length = {r.url: r.dl for r in all_of.docs.collect()}
    got = {(r.term, r.url): r.tf for r in all_of.postings.collect()}
    assert all(r.dl == length[r.url] for r in all_of.postings.collect())
    want = {}
    for url, _, text in rows:
        seq = next(s for u, s, _ in rows if u == url)
        version = expand_documents(spark.createDataFrame([(u, s, t) for u, s, t in (r for r in rows if r[0] != url) if s < 20] + [(url, seq, text)], SCHEMA),
                                   vx.WordHashEmbedder(params.text_dim), params).filter(f"url = '{url}'").first().text
        for w in version.split():
            want[w, url] = want.get((w, url), 0) + 1
    # u1 has one predecessor only, so none of its versions is expanded, and no seed text before it changes
    assert {k: v for k, v in got.items() if k[1] == "u1"} == {k: v for k, v in want.items() if k[1] == "u1"}
    assert got["blue", "u1"] == 2 and got["hides", "u1"] == 1
    with pytest.raises(ValueError):
        pl.bulk_index(spark, docs, "/nowhere", on_duplicate="accumulate", recurrent=True)


TINY = P.with_(seed_size=3, chunk_size=4, expand_threshold=0.5)


def expanded(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA)
    return {r.url: r.text for r in expand_documents(docs, vx.WordHashEmbedder(1024), TINY, **options).collect()}


def test_two_passes_expand_later_chunks_twice(spark):
    # seeds a, b, c; chunk of 4 ends with d; e and f come later
    rows = [("a", 0, "one"), ("b", 1, "two"), ("c", 2, "three three"), ("d", 3, "one one"), ("e", 4, "one one"), ("f", 5, "nine")]
    once = {"a": "one", "b": "two", "c": "three three", "d": "one one one", "e": "one one one", "f": "nine"}
    assert expanded(spark, rows) == once
    assert expanded(spark, rows, passes=2) == once | {"e": "one one one one"}
    with pytest.raises(ValueError):
        expand_documents(spark.createDataFrame(rows, SCHEMA), vx.WordHashEmbedder(64), TINY.with_(chunk_size=2), passes=2)


def test_recurrent_seeds_are_compared_as_expanded(spark):
    # c is expanded by a; d is then nearest to c as expanded and takes its whole text
    rows = [("a", 0, "x y"), ("b", 1, "q"), ("c", 2, "x z"), ("d", 3, "x z x y"), ("e", 4, "q q")]
    plain = {"a": "x y", "b": "q", "c": "x z", "d": "x z x y x y", "e": "q q q"}
    assert expanded(spark, rows) == plain   # c . a = 0.5 is not above the threshold
    rows[2] = ("c", 2, "x x z")
    want = {"a": "x y", "b": "q", "c": "x x z x y", "d": "x z x y x x z x y", "e": "q q q"}
    assert expanded(spark, rows, recurrent=True) == want
    assert expanded(spark, rows)["d"] != want["d"]


def letter_counts():
    """A function that is shipped by value, as the workers do not have this module."""
    def count(texts):
        return np.array([[t.count(c) for c in "abcde"] for t in texts], float)

    return count


letters = letter_counts()


def test_arrow_embedder_in_a_stored_index(spark, docs, tmp_path):
    mine = vx.ArrowEmbedder(letters, 5, "letters")
    index = pl.bulk_index(spark, docs, f"{tmp_path}/index", embedder=mine, expand=False)
    for r in index.docs.join(index.doc_vec, "url").collect():
        v = letters([r.text])[0]
        assert r.dims is None and np.allclose(r.ws, v / np.linalg.norm(v) if v.any() else v)
    again = pl.open_index(spark, f"{tmp_path}/index", mine)
    queries = spark.createDataFrame([(1, "a bad cab"), (2, "zzz")], "query_id long, query string")
    assert {(r.query_id, r.url, r["rank"]) for r in en.top(again, queries, 3).collect()} == {(r.query_id, r.url, r["rank"]) for r in en.top(index, queries, 3).collect()}
    for other in (None, vx.ArrowEmbedder(letters, 5, "others"), vx.WordHashEmbedder(5)):
        with pytest.raises(ValueError):
            pl.open_index(spark, f"{tmp_path}/index", other)
    with pytest.raises(ValueError):
        pl.open_index(spark, f"{tmp_path}/nothing")


def test_supplied_vectors_in_a_stored_index(spark, docs, tmp_path):
    rng = np.random.default_rng(5)
    given = {u: rng.normal(size=4) for u, _, _ in ROWS[:-1]} | {"7": rng.normal(size=4)}
    known = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in given.items()], "key string, vec array<float>")
    index = pl.bulk_index(spark, docs, f"{tmp_path}/index", P.with_(w_lexical=0.0), embedder=vx.SuppliedVectors(known, 4))
    queries = spark.createDataFrame([(7, "whatever the words")], "query_id long, query string")
    got = [r.url for r in en.top(index, queries, 3).orderBy("rank").collect()]
    q = given["7"] / np.linalg.norm(given["7"])
    near = sorted(((-float(v @ q / np.linalg.norm(v)), u) for u, v in given.items() if u != "7"))
    assert got == [u for _, u in near[:3]]


def test_distinct_texts_are_embedded_once(spark):
    docs = spark.createDataFrame(ROWS + [("v1", 50, "red fox"), ("v2", 51, ""), ("v3", 52, "red fox")], SCHEMA)
    words = vx.WordHashEmbedder(32)
    a, b = (sorted(map(str, f.select("url", "dims", "ws").collect())) for f in (vx.embed_distinct(docs, words), words.embed(docs, "url")))
    assert a == b


def test_expansion_reads_its_table_without_a_shuffle(spark, tmp_path):
    store.write_table(spark.createDataFrame(ROWS, SCHEMA), f"{tmp_path}/docs")
    docs = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/docs")
    plan = expand_documents(docs, vx.WordHashEmbedder(64), P)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortAggregate" not in plan
