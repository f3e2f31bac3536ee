"""Block products, rank counting and top-n search against plain computations; every way around a size bound."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from quarry.config import DEFAULT as P
from quarry.operators import blocks
from quarry.operators import evaluate as ev
from quarry.operators import vectors as vx
from quarry.operators.rank import top_n
from quarry.plans import engine as en
from quarry.plans.strategy import sized_join, stored, table_bytes
from quarry.sources import corpus as src

SMALL = P.with_(broadcast_bytes=0, salts=3)


def vectors(spark, rows, key):
    kind = "long" if isinstance(rows[0][0], int) else "string"
    return spark.createDataFrame([(k, None, [float(x) for x in v]) for k, v in rows], f"{key} {kind}, dims array<int>, ws array<double>")


@pytest.fixture(scope="module")
def tables():
    rng = np.random.default_rng(3)
    docs = [(f"d{i:03d}", rng.integers(-2, 3, 6)) for i in range(150)]
    docs += [(f"e{i}", docs[i][1]) for i in range(10)] + [("zero", np.zeros(6))]
    return docs, [(i, rng.integers(-2, 3, 6)) for i in range(9)]


def unit(v):
    n = np.sqrt((v * v).sum())
    return v / n if n else v * 0.0


@pytest.mark.parametrize("params", [P, SMALL])
def test_nearest_against_all_products(spark, tables, params, monkeypatch):
    docs, queries = [[(k, unit(v)) for k, v in t] for t in tables]
    got = vx.nearest(vectors(spark, docs, "url").repartition(5), vectors(spark, queries, "query_id"), 7, 6, params=params).collect()
    want = {(q, u, r) for q, y in queries for r, (_, u) in enumerate(sorted((-round(float(x @ y), 9), u) for u, x in docs)[:7], 1)}
    assert {(r.query_id, r.url, r["rank"]) for r in got} == want and len(got) == len(want)
    full = vx.all_cosines(vectors(spark, docs, "url"), vectors(spark, queries, "query_id"), 6, params).collect()
    assert len(full) == len(docs) * len(queries)


def test_heaps_that_are_handed_on_lose_nothing(monkeypatch):
    monkeypatch.setattr(blocks, "HEAP_ENTRIES", 4)
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(40, 3)), rng.normal(size=(2, 3))
    batches = [pa.RecordBatch.from_arrays([pa.array([[f"k{i:02d}" for i in range(s, s + 8)]]), pa.array([x[s:s + 8].tobytes()], pa.binary()),
                                           pa.array([[1, 2]]), pa.array([y.tobytes()], pa.binary())], names=["a", "b", "c", "d"]) for s in range(0, 40, 8)]
    out = [r for b in blocks.nearest_fn(3, 3, pa.int64())(iter(batches)) for r in b.to_pylist()]
    for q in (1, 2):
        best = sorted((-round(float(v @ y[q - 1]), 9), f"k{i:02d}") for i, v in enumerate(x))[:3]
        assert sorted((-r["sim"], r["key"]) for r in out if r["q_key"] == q)[:3] == best


def test_counters_against_comparing_all():
    random.seed(1)
    for _ in range(30):
        rows = [(random.choice([0.5, 0.25, 0.75, random.random()]), f"u{i}") for i in range(40)]
        judged = random.sample(rows, 7)
        c = blocks.Counters([s for s, _ in judged], [u for _, u in judged])
        for part in (rows[:13], rows[13:]):
            c.add(np.array([s for s, _ in part]), np.array([u for _, u in part], dtype=object))
        assert dict(zip(c.urls, c.before())) == {u: sum((-a, b) < (-s, u) for a, b in rows) for s, u in judged}


def test_stacked_rows_sparse_dense_and_sliced():
    dims = pa.array([[0, 2], None, [], None, [1]], pa.list_(pa.int32()))
    ws = pa.array([[1.0, 2.0], [3.0, 4.0, 5.0], [], [], [6.0]])
    want = np.array([[1, 0, 2], [3, 4, 5], [0, 0, 0], [0, 0, 0], [0, 6, 0]], float)
    assert (blocks.stack(dims, ws, 3) == want).all() and (blocks.stack(dims[1:4], ws[1:4], 3) == want[1:4]).all()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_joins_are_equal_on_both_sides_of_the_bound(spark, how):
    big = spark.createDataFrame([(i % 5, f"u{i}") for i in range(60)], "k long, url string")
    side = stored(spark.createDataFrame([(0, "a"), (0, "b"), (3, None), (9, "c")], "k long, v string"), "side")
    a, b = (sorted(map(str, sized_join(big, side, "k", "url", n, 4, how).collect())) for n in (1 << 20, 0))
    assert a == b and len(a) > 0
    assert table_bytes(side) == 4 * 16 + 3


DOCS = [(f"d{i}", i, t) for i, t in enumerate([
    "alpha beta gamma", "alpha alpha delta", "beta, epsilon!", "zeta eta theta iota", "alpha beta gamma delta epsilon", "kappa", "", "lambda mu nu",
    "xi omicron pi rho", "alpha beta gamma", "sigma tau", "upsilon phi chi psi omega", "the alpha of the omega", "beta beta beta beta", "mu mu nu"] * 3)]
DOCS = [(f"{u}-{i}", i, t) for i, (u, _, t) in enumerate(DOCS)]
QUERIES = [(1, "alpha beta"), (2, "omega"), (3, "nothing known here"), (4, "mu nu lambda"), (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (6, "")]


@pytest.fixture(scope="module")
def index(spark):
    docs = spark.createDataFrame(DOCS, "url string, doc_seq long, text string")
    return en.build_index(docs, P.with_(vocab_min_df_frac=0.05)), spark.createDataFrame(QUERIES, "query_id long, query string")


@pytest.mark.parametrize("n", [1, 20])
@pytest.mark.parametrize("w", [(0.6, 0.4), (0.05, 0.95), (3.0, 0.1)])
def test_top_is_the_head_of_the_full_search(spark, index, n, w):
    idx, queries = index
    idx = en.SearchIndex(**{**vars(idx), "params": idx.params.with_(w_lexical=w[0], w_semantic=w[1])})
    key = ("query_id", "url", "rank")
    want = {tuple(r[k] for k in key): r.score for r in top_n(en.search(idx, queries), n).collect()}
    got = {tuple(r[k] for k in key): r.score for r in en.top(idx, queries, n).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    assert len(got) == min(n, len(DOCS)) * len(QUERIES)


@pytest.mark.parametrize("params", [P, SMALL])
def test_judged_ranks_against_the_full_search(spark, index, params):
    idx, queries = index
    random.seed(7)
    # judged rows with and without a lexical match, copies among them, an unknown document, a query without any
    qrels = [(q, u) for q in (1, 2, 3, 4, 5) for u, _, _ in random.sample(DOCS, 6)] + [(1, "unknown")]
    given = spark.createDataFrame(qrels, "query_id long, url string")
    for w in ((0.6, 0.4), (0.05, 0.95), (3.0, 0.1)):
        mine = en.SearchIndex(**{**vars(idx), "params": params.with_(w_lexical=w[0], w_semantic=w[1], vocab_min_df_frac=0.05)})
        full = {(r.query_id, r.url): r["rank"] for r in top_n(en.search(mine, queries), 10_000).collect()}
        got = {(r.query_id, r.url): r["rank"] for r in en.judged_ranks(mine, queries, given).collect()}
        assert got == {k: full[k] for k in qrels if k in full}


def test_lexical_scores_on_both_sides_of_the_bound(spark, index):
    idx, queries = index
    want = {(r.query_id, r.url): r.lex for r in en.lexical(idx, queries).collect()}
    small = en.SearchIndex(**{**vars(idx), "params": SMALL.with_(vocab_min_df_frac=0.05)})
    scores = en.lexical(small, queries)
    got = {(r.query_id, r.url): r.lex for r in scores.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", scores._jdf.queryExecution().executedPlan().toString())
    assert not any(re.fullmatch(r"term#\d+, \d+", e) for e in exchanges)


def test_ranks_of_plain_scores(spark):
    random.seed(2)
    rows = [(q, f"u{i}", random.choice([0.5, random.random()])) for q in range(3) for i in range(50)]
    scores = spark.createDataFrame(rows, "query_id long, url string, score double")
    qrels = spark.createDataFrame([(q, f"u{i}") for q in range(3) for i in range(0, 50, 4)] + [(1, "none"), (8, "u1")], "query_id long, url string")
    got = {(r.query_id, r.url): r["rank"] for r in ev.judged_ranks(scores, qrels).collect()}
    want = {(q, u): 1 + sum((-round(b, 9), v) < (-round(s, 9), u) for k, v, b in rows if k == q) for q, u, s in rows if int(u[1:]) % 4 == 0}
    assert got == want


def test_url_union_counts_every_document(spark, index):
    from quarry.operators import search as se

    idx, queries = index
    got = {r.query_id: r.n_urls for r in se.url_counts(en.lexical(idx, queries), idx.docs, queries).collect()}
    assert got == {q: len(DOCS) for q, _ in QUERIES}


@pytest.mark.parametrize("params", [P, SMALL])
def test_passages_against_searching_all_texts(spark, params):
    texts = ["The cat sat on the mat, again.", "a mat. The CAT sat on the mat", "concatenate these", "x -- y", "cat", "", "dog's life; cat sat", "ça va bien là", "- -", "sat on the"]
    passages = ["cat sat on the", "cat", "at s", "--", "", "sat on the mat", "va bien l", "!", "the", "dog's life", "t, a", "sat on the mat, again.", " ", "nowhere to be found", "ç"]
    docs = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "url string, text string")
    bench = spark.createDataFrame(list(enumerate(passages)) + [(99, None)], "query_id long, passage string")
    got = sorted(map(tuple, src.containing(docs, bench, params).collect()))
    assert got == sorted((q, f"d{i}") for q, p in enumerate(passages) for i, t in enumerate(texts) if p and p in t)


def test_passages_need_no_nested_loop(spark):
    found = src.qrels(spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("documents.parquet") == 1
