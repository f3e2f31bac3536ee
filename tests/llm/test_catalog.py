"""The registered queries: each has SQL or a brute-force test; SQL twins on odd rows; sides beyond the broadcast bound; long
and empty inputs."""

import random

import pytest

import __spark_entry__ as E
from quarry.llm import catalog, common, interplay, quality, secretscan, warc
from tools.oracle_check import compare, duck

#: Where a query that SQL cannot express is compared with a plain version, a library or an exact round trip.
TESTED = {
    "op1_mincut_text": "test_mincut: test_the_labelling_is_the_cheapest_of_all",
    "op2_template_leaks": "test_operators: test_leaks_verbatim_and_changed_slots",
    "op5_license_rules": "test_operators: test_licence_sequences",
    "op7_byte_bpe": "test_operators: test_bpe_equals_the_library_and_round_trips",
    "op9_token_files": "test_operators: test_token_files_equal_the_library",
    "op10_secret_spans": "test_operators: test_secret_spans_against_regular_expressions",
    "op13_noisy_toxicity": "test_audits: test_decoding_finds_the_cheapest_path, test_held_out_documents",
    "pipeline": "test_operators: test_pipeline_against_plain_stages",
}


def test_every_query_is_compared_with_something():
    queries = set(catalog.SPARK) | {"pipeline"}
    assert queries == set(catalog.SQL) | set(TESTED) and queries <= set(E.queries())


DOC = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = " ".join(f"word{i} and{i} some{i} more{i}" for i in range(30)) + "."


def tables(spark, path, rows, labels=((1, 1, 0),)):
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOC).write.parquet(f"{path}/d")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{path}/l")
    for name, part in (("documents", "d"), ("labels", "l")):
        import pyarrow.parquet as pq
        pq.write_table(pq.read_table(f"{path}/{part}"), f"{path}/{name}.parquet")
    return str(path)


LINES = ["\t".join(f"w{j}" for j in range(8)), "    " * 4 + "Sign up for our newsletter today", "read" + " " * 14 + "more", "Her blog in 2012 won a prize.",
         "The design in oak was admired by all.", "We use cookies", "All rights reserved.", "menu", "a b", "done:", "x | y | z | w", "!!! ??? ;;; ,,, ((( )))",
         "Subscribed, you will read more today.", "She baked cookies for the whole class on Monday.", "Resign up to now", "subscribers", "", " \t ", "Log in", "ends\r"]


@pytest.mark.parametrize("name", ["op8_line_quality", "op11_source_divergence", "op12_filter_interplay"])
def test_twins_on_odd_rows(spark, tmp_path, name):
    random.seed(9)
    rows = [(i, "\n".join(random.choices(LINES, k=random.randint(0, 12)) + random.choice([[], [PROSE], [PROSE] * 2]))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, PROSE), (103, PROSE), (104, "\tA B　c " * 60)]
    sf = tables(spark, tmp_path, rows, [(i, i % 2, i % 3 % 2) for i in range(0, 80, 2)])
    r = compare(spark, duck(sf), name, E.queries()[name], E.oracle_sql()[name], sf)
    assert r["ok"], r


def test_archives_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = [(i, f"http://x.org/{i}", random.choice(["", "same", f"own {i}"])) for i in range(40)] + [(None, "http://n", "same"), (3, "http://x.org/3", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    key = ["page_id", "url_key", "record_type", "refers_to", "payload_digest"]
    want = sorted(map(str, warc.capture_index(pages).select(*key).collect()))
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    assert sorted(map(str, warc.capture_index(pages).select(*key).collect())) == want


def test_very_long_texts(spark):
    long = " ".join(f"w{i % 5000}" for i in range(60_000)) + " password=" + "0123456789abcdef" * 2
    df = spark.createDataFrame([(1, long)], "doc_id long, text string")
    assert quality.judge(df).first().n_words == 60_001
    assert [s.start for s in secretscan.find(df).first().base][0] == len(long) - 41
    assert interplay.failures(df.withColumn("lang", df.text)).count() == 1


def test_redaction_keeps_all_rows_and_columns(spark):
    schema = "doc_id long, text string, row string, _spans string, tokens int"
    rows = [(1, "password=" + "0123456789abcdef" * 2, "r", "s", 1), (1, None, None, None, None), (None, "", "r", "s", 2), (2, "plain", "r", "s", 3), (2, "plain", "r", "s", 3)]
    got = secretscan.redact(spark.createDataFrame(rows, schema))
    assert got.columns == ["doc_id", "text", "row", "_spans", "tokens"]
    assert sorted(map(str, got.collect())) == sorted(map(str, spark.createDataFrame([(1, "[SECRET]", "r", "s", 1), *rows[1:]], schema).collect()))
    assert secretscan.redact(spark.createDataFrame([], schema)).count() == 0


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    sf = tables(spark, tmp_path, [])
    spark.createDataFrame([(1, "a passage of some words to find")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0


WORDS = "token http order user client server request value index handler config parser stream buffer result event manager service factory model".split()


def test_rates_of_keys_found_and_names_taken_for_keys(spark):
    """Of each kind of random key at least nine in ten are found; of names put together from words at most two in a hundred are taken for one."""
    random.seed(12)
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    kinds = {"letters": (upper + lower, 40), "base62": (upper + lower + digits, 40), "base36": (lower + digits, 32), "hex upper": ("0123456789ABCDEF", 40)}
    keys = {k: ["".join(random.choices(a, k=n)) for _ in range(60)] for k, (a, n) in kinds.items()}
    keys["dashed"] = ["-".join("".join(random.choices(upper + digits, k=5)) for _ in range(5)) for _ in range(60)]
    names = ["".join(w.capitalize() for w in random.sample(WORDS, random.randint(2, 5))) + str(random.randint(10, 99)) for _ in range(300)]
    names += ["_".join(random.sample(WORDS, 4)) + "_" + str(i) for i in range(100)] + ["".join(w.capitalize() for w in random.sample(WORDS, 5)) for _ in range(100)]
    rows = [(i, f"see {t} here", kind) for i, (kind, t) in enumerate([(k, t) for k, ts in keys.items() for t in ts] + [("name", n) for n in names])]
    found = {r.doc_id for r in secretscan.find(spark.createDataFrame(rows, "doc_id long, text string, kind string")).filter("size(spans) > 0").collect()}
    rate = {k: sum(i in found for i, _, kind in rows if kind == k) / sum(kind == k for _, _, kind in rows) for k in [*keys, "name"]}
    assert all(rate[k] >= 0.9 for k in keys) and rate["name"] <= 0.02, rate
