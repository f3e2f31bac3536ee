"""The log of segments: versions, tombstones, compaction, repeated batches, and search equal to a build at once."""

import pytest

from quarry.config import DEFAULT as P
from quarry.plans import engine as en
from quarry.streaming import incremental as inc

SCHEMA = "doc_id long, text string"
PARAMS = P.with_(seed_size=4, vocab_min_df_frac=0.05)
BASE = [(i, f"{a} {b} {a}{i % 4} common") for i, (a, b) in enumerate((a, b) for a in ("red", "blue", "green", "grey") for b in ("fox", "bird", "frog", "fox"))]


def test_url_indexed_again_counts_once(spark, tmp_path):
    out = str(tmp_path)
    write = inc._write_batch(out)
    write(spark.createDataFrame([(1, "one two"), (2, "three")], SCHEMA), 0)
    write(spark.createDataFrame([(1, "one two four")], SCHEMA), 1)
    row = inc.running_stats(spark, out).first()
    assert (row.n_docs, row.total_len) == (2, 17)
    assert sorted((r.term, r.url, r.tf) for r in inc.postings(spark, out).collect()) == [("four", "1", 1), ("one", "1", 1), ("three", "2", 1), ("two", "1", 1)]
    assert {r.term: r.df for r in inc.document_frequency(spark, out).collect()} == {"one": 1, "two": 1, "four": 1, "three": 1}


def test_postings_of_an_open_batch_are_not_read(spark, tmp_path):
    out = str(tmp_path)
    inc._write_batch(out)(spark.createDataFrame([(1, "one")], SCHEMA), 0)
    # a batch that stopped before its manifest version
    segments = inc.Segments(spark, out)
    segments._commit = lambda **_: (_ for _ in ()).throw(RuntimeError("stopped"))
    with pytest.raises(RuntimeError):
        segments.add(spark.createDataFrame([("9", 9, "ghost")], "url string, doc_seq long, text string"), 1)
    assert [r.term for r in inc.postings(spark, out).collect()] == ["one"]
    inc._write_batch(out)(spark.createDataFrame([(9, "ghost")], SCHEMA), 1)
    assert sorted(r.term for r in inc.postings(spark, out).collect()) == ["ghost", "one"]


def batches():
    """Five batches by position; documents come again in the third, the fifth and, twice, in the sixth."""
    return [BASE[:5], BASE[5:8], BASE[8:12] + [(6, "changed to zebra")], BASE[12:], [(13, "zebra now"), (6, "last of all yak")], [(14, None), (13, "yak and fox")], []]


def rows_of(index, query, spark):
    queries = spark.createDataFrame(query, "query_id long, query string")
    return {(r.query_id, r.url, r["rank"], round(r.score, 9)) for r in en.top(index, queries, 6).collect()}


@pytest.mark.parametrize("fanout", [3, 99])
def test_search_equals_a_build_at_once(spark, tmp_path, fanout):
    write = inc._write_batch(str(tmp_path), params=PARAMS, expand=True, fanout=fanout)
    for k, rows in enumerate(batches()):
        write(spark.createDataFrame(rows, SCHEMA), k)
        write(spark.createDataFrame([(1, "run again")], SCHEMA), k)   # committed already: nothing happens
    segments = inc.Segments(spark, str(tmp_path), PARAMS, expand=True)
    assert len(segments.manifest["segments"]) == {3: 2, 99: 6}[fanout]
    last = dict(r for rows in batches() for r in rows)
    at_once = en.build_index(spark.createDataFrame([(str(i), i, t or "") for i, t in last.items()], "url string, doc_seq long, text string"), PARAMS)
    index = segments.open_index()
    for name in ("docs", "postings", "term_stats", "doc_vec", "vocab_vec"):
        a, b = (sorted(map(str, getattr(x, name).select(*getattr(at_once, name).columns).collect())) for x in (index, at_once))
        assert a == b, name
    asked = [(1, "yak"), (2, "red fox common"), (3, "zebra"), (4, "changed")]
    assert rows_of(index, asked, spark) == rows_of(at_once, asked, spark)
    live = segments.live("docs").count()
    segments.vacuum()
    again = inc.Segments(spark, str(tmp_path), PARAMS, expand=True)
    assert again.live("docs").count() == live == len(last) and again.manifest == segments.manifest
    again.add(spark.createDataFrame([("500", 500, "one more fox")], "url string, doc_seq long, text string"), 50)
    assert again.live("docs").count() == live + 1


def test_compaction_drops_dead_rows_and_needless_tombstones(spark, tmp_path):
    segments = inc.Segments(spark, str(tmp_path), PARAMS, fanout=2)

    def add(k, *rows):
        segments.add(spark.createDataFrame([(str(i), i, t) for i, t in rows], "url string, doc_seq long, text string"), k)

    add(0, (1, "a"), (2, "b"))
    add(1, (1, "c"))
    assert [(s["name"], s["n_docs"], s["tombstones"]) for s in segments.manifest["segments"]] == [("m000000000-000000001", 2, 0)]
    assert sorted((r.url, r.text, r.seq) for r in segments.rows("docs").collect()) == [("1", "c", 1), ("2", "b", 0)]


def test_empty_store(spark, tmp_path):
    segments = inc.Segments(spark, f"{tmp_path}/none")
    assert segments.live("postings").count() == 0 and segments.term_stats().count() == 0
    queries = spark.createDataFrame([(1, "a")], "query_id long, query string")
    assert en.top(segments.open_index(), queries).count() == 0
