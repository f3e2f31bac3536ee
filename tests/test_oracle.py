"""Registered queries against their DuckDB twins on the smallest tables."""

import pytest

import __spark_entry__ as E
from conftest import SF
from quarry.plans import catalog
from tools.oracle_check import compare, duck

FAST = ["p2_normalize", "a1_postings", "a3_avg_length", "a6_frequent_vocab", "a9_last_wins", "q2_lexical",
        "w1_full_ranking", "m5_lexical_evaluation", "v2_cosine", "v5_argmax_neighbour", "v6_doc_expansion",
        "q1_query_expansion", "q4_top5", "p1_html_to_text", "s3_feed_links", "q7_crawl_to_corpus",
        "st3_resume"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF)
    assert r["ok"], r


def test_every_query_has_an_oracle():
    assert set(catalog.SPARK) == set(catalog.SQL)
    assert set(catalog.SPARK) <= set(E.queries()) and set(catalog.SQL) <= set(E.oracle_sql())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
