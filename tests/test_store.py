"""Stored tables: absent paths, missing columns, round trips."""

import pytest

from quarry.sources import store


def test_expanded_round_trip_and_absent_path(spark, tmp_path):
    docs = spark.createDataFrame([("u", 1, "a text"), ("v", 2, None)], "url string, doc_seq bigint, text string")
    store.save_expanded(docs, f"{tmp_path}/deep/expanded")
    got = store.load_expanded(spark, f"{tmp_path}/deep/expanded")
    assert got.columns == docs.columns and sorted(got.collect()) == sorted(docs.collect())
    assert store.load_expanded(spark, f"{tmp_path}/nothing").count() == 0
    store.save_expanded(docs.limit(0), f"{tmp_path}/empty")
    assert store.load_expanded(spark, f"{tmp_path}/empty").count() == 0


def test_table_without_a_declared_column_is_refused(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/other")
    with pytest.raises(ValueError):
        store.load_expanded(spark, f"{tmp_path}/other")


def test_faults_are_not_absence(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.parquet").write_bytes(b"not a table")
    with pytest.raises(Exception):
        store.load_expanded(spark, f"{tmp_path}/broken")


def test_vectors_report_missing_parts(spark, tmp_path):
    vec = spark.createDataFrame([("u", [1], [0.5])], store.DOC_VEC_SCHEMA)
    words = spark.createDataFrame([("w", [2], [1.0])], store.VOCAB_VEC_SCHEMA)
    assert not store.save_vectors(None, None, f"{tmp_path}/d", f"{tmp_path}/v")
    assert store.save_vectors(vec, words, f"{tmp_path}/d", f"{tmp_path}/v")
    d, v = store.load_vectors(spark, f"{tmp_path}/d", f"{tmp_path}/v")
    assert d.collect() == vec.collect() and v.collect() == words.collect()
    d, v = store.load_vectors(spark, f"{tmp_path}/nothing", f"{tmp_path}/d")
    assert d is None and v is None
