"""The ten operators on hand-made tables: nulls, empty texts, ties, repeated
rows, empty tables, extra columns with clashing names, and plain versions
of what SQL cannot express."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from quarry.llm import bpe, catalog, common, components, decontam, licenses, mincut, minhash, quality, secretscan, tokenfile, urlrep, warc

SCHEMA = "doc_id long, text string, words string, base string, kept int, label string, host string, n_words int"
PROSE = " ".join(f"word{i} and{i} some{i} more{i}" for i in range(30)) + "."


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1, "z", "h", 0) for i, t in rows], SCHEMA)


ROWS = [(1, PROSE), (2, PROSE), (2, PROSE), (3, None), (4, ""), (5, " \n\t"), (None, PROSE), (6, "lone")]


def test_quality_counts_and_edges(spark):
    rows = ROWS + [(7, "a b c\na b c\n\n| x | y | z |\n" + PROSE), (8, "menu\n" + PROSE)]
    got = {r.doc_id: r for r in quality.judge(docs(spark, rows)).collect() if r.doc_id is not None}
    assert (got[3].n_words, got[3].base_failed, got[3].kept) == (0, True, False)
    assert got[1].kept and got[1].n_lost_chars == 0
    assert got[8].clean_text == PROSE
    text = rows[-2][1]
    w = re.findall("[^\x20\x09-\x0d]+", text)
    win = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    covered = {i + k for i, x in enumerate(win) if win.count(x) > 1 for k in range(3)}
    assert got[7].n_repeat_words == len(covered) and got[7].n_dup_lines == 1 and got[7].n_symbols == 4
    assert quality.judge(docs(spark, [])).count() == 0
    kept = quality.cleaned(docs(spark, rows))
    assert kept.columns == docs(spark, []).columns and {r.doc_id for r in kept.collect()} == {1, 2, None, 7, 8}


def test_line_words_and_phrases(spark):
    tabbed = "\n".join("\t".join(f"w{i}x{j}" for j in range(8)) for i in range(20))
    said = "Her blog in 2012 won a prize.\nThe design in oak was admired by all.\nShe baked cookies for the whole class on Monday."
    fat = "    " * 4 + "Sign up for our newsletter today"
    gaps = "read" + " " * 14 + "more"
    rows = [(1, tabbed), (2, PROSE + "\n" + said), (3, PROSE + "\n" + fat), (4, PROSE + "\n" + gaps), (5, PROSE + "\nWe use cookies\nAll rights reserved.")]
    got = {r.doc_id: r for r in quality.judge(docs(spark, rows)).collect()}
    assert got[1].kept and got[1].clean_text == tabbed and got[2].clean_text == rows[1][1]
    assert all(got[i].clean_text == PROSE for i in (3, 4, 5))


def test_repeat_words_many_windows(spark):
    random.seed(3)
    text = " ".join(random.choice("abcde") for _ in range(900))
    w = text.split()
    win = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    covered = {i + k for i, x in enumerate(win) if win.count(x) > 1 for k in range(3)}
    assert quality.judge(docs(spark, [(1, text)])).first().n_repeat_words == len(covered)


def plain_sets(rows, k):
    out = {}
    for i, t in rows:
        w = (t or "").encode().translate(minhash._UPPER).split()
        out[i] = frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    return out


def test_near_duplicates_against_all_pairs(spark):
    random.seed(5)
    base = [f"w{random.randint(0, 400)}" for _ in range(120)]
    rows = list(enumerate([" ".join(random.choice([x] * 60 + ["new"]) for x in base) for _ in range(40)]))
    rows += [(100, None), (101, ""), (102, "one"), (103, "ONE"), (104, rows[3][1])]
    sets = plain_sets(rows, 4)
    top = {i: i for i in sets}

    def find(i):
        return i if top[i] == i else find(top[i])

    for a in sets:
        for b in sets:
            inter = len(sets[a] & sets[b])
            if a < b and inter and 100 * inter >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    got = minhash.near_duplicates(docs(spark, rows + [(104, rows[3][1]), (None, "one")]), conf=minhash.Near(shingle=4)).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id)


def test_spread_join_keeps_what_a_plain_join_keeps(spark):
    rows = [("hot", i) for i in range(3000)] + [(f"k{i % 1500}", i) for i in range(3000, 6000)] + [(None, 6000)]
    left = spark.createDataFrame(rows, "key string, a long")
    counts = common.written(left.groupBy("key").count().filter("key is not null"), "test-counts")
    heavy = common.heavy_keys(counts, "key", "count")
    assert [(r.key, r._pieces) for r in heavy.collect()] == [("hot", 500)]
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k3", 3), ("none", 4), (None, 5)], "key string, b long")
    for how in ("inner", "left"):
        got = common.spread_join(left, right, "key", heavy, "a", how).select("key", "a", "b")
        assert sorted(map(str, got.collect())) == sorted(map(str, left.join(right, "key", how).select("key", "a", "b").collect()))


def test_components_of_a_chain_a_hub_and_a_pair(spark):
    edges = [(i, i + 1) for i in range(40, 70)] + [(90, i) for i in range(91, 140)] + [(200, 7)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 40 for i in range(40, 71)} | {i: 90 for i in range(90, 140)} | {200: 7, 7: 7}


def test_sketch_fills_every_coordinate():
    for m in (1, 2, 7, 5000):
        s = minhash.sketch(np.arange(m, dtype=np.uint64) * np.uint64(977), 128)
        assert s.max() != np.iinfo(np.uint64).max
    a, b = np.arange(1000, dtype=np.uint64), np.arange(111, 1111, dtype=np.uint64)
    same = (minhash.sketch(a, 512) == minhash.sketch(b, 512)).mean()
    assert abs(same - 889 / 1111) < 0.1


def test_near_duplicates_empty_table(spark):
    assert minhash.near_duplicates(docs(spark, [])).count() == 0


def test_leaks_verbatim_and_changed_slots(spark):
    item = "A train with 12 wagons needs 40 minutes to cross the long bridge and 12 minutes more to reach the town beyond it."
    other = item.replace("12", "7").replace("40", "55")
    mixed = item.replace("12", "7", 1)  # one value stands for two
    rows = [(1, "Before.\n" + item + "\nAfter."), (2, other), (3, mixed), (4, PROSE), (5, None), (1, "Before.\n" + item), (None, item)]
    bench = spark.createDataFrame([(9, item), (9, item), (10, None), (11, "short one")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.kind for r in decontam.leaks(docs(spark, rows), bench).collect()}
    assert got[1, 9] == "verbatim" and got[2, 9] == "re-parameterised" and not {i for i, _ in got} & {4, 5, None}
    joined = {(r.doc_id, r.item_id): r.kind for r in decontam.leaks(docs(spark, rows), bench, broadcast_bytes=0).collect()}
    assert joined == got
    assert decontam.leaks(docs(spark, []), bench).count() == 0 and decontam.leaks(docs(spark, rows), bench.limit(0)).count() == 0


def test_leaks_keep_the_windows_beside_a_conflict(spark):
    item = "A train with 12 wagons needs 40 minutes to cross the long bridge and 12 minutes more to reach the town beyond it."
    names = "There we saw Natalia sell some clips to her old friends in April, and then Natalia sold half as many clips in May again."
    rows = [(1, item.replace("12", "7", 1)), (2, item.replace("40", "12")), (3, item.replace("12", "7", 1).replace("12", "8").replace("40", "7")),
            (4, names.replace("Natalia", "Maria", 1)), (5, names.replace("Natalia", "Maria")),
            (6, "three apples and 3 pears")]
    bench = spark.createDataFrame([(9, item), (10, names)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.leaks(docs(spark, rows), bench).collect()}
    assert sorted(got) == [(1, 9), (2, 9), (3, 9), (4, 10), (5, 10)]
    assert [got[k].kind for k in sorted(got)] == ["re-parameterised"] * 3 + ["verbatim", "re-parameterised"]
    assert all(got[k].n_matched == got[k].n_windows for k in ((1, 9), (2, 9), (3, 9), (5, 10)))
    assert got[4, 10].n_matched < got[4, 10].n_windows  # Maria and Natalia for one name: its own name wins the tie


def test_template_tokens_of_many_texts_are_those_of_the_pattern():
    import xxhash

    token = re.compile(r"[^\W\d]+|[.!?\n%$€£]|\d+(?:[.,]\d+)*")
    draw = random.Random(4)
    parts = ["a", "B", "kg", "Kg", "_", "é", "日", "ǅ", "𝐀", "²", "½", "1", "23", "٣", "\u0301", ".", ".", ",", "!", "?", "\n", "%", "€", "£", " ", "-", "\0", "👍", "ª"]
    for _ in range(1000):
        texts = ["".join(draw.choices(parts, k=draw.choice([0, 1, 2, 4, 20]))) for _ in range(draw.choice([1, 2, 6]))]
        tokens, ends = decontam._cut([t.encode() for t in texts])
        found = [token.findall(t) for t in texts]
        assert tokens.to_pylist() == sum(found, []) and ends.tolist() == np.cumsum([len(f) for f in found]).tolist()
        canon = decontam.Canon(decontam.Templates(), most=3)
        for rows, tokens in zip(canon.rows(texts), found, strict=True):
            assert rows[:, 0].tolist() == [xxhash.xxh64_intdigest(t.lower()) for t in tokens]
            assert [decontam._kinds(t)[1] for t in tokens] == rows[:, 1].tolist()
    marks = ["word", "Name", "NAME", "A", "iPhone", "²x", "𝐀", "𝐀b", "7", "1.5", "kg", "KG", "%", ".", "\n"]
    assert [decontam._kinds(t)[1] for t in marks] == [0, 2, 2, 4, 0, 1, 0, 2, 1, 1, 4, 6, 4, 3, 3]


def test_a_template_token_is_told_once_for_many_texts(monkeypatch):
    asked, told = [], decontam._kinds
    monkeypatch.setattr(decontam, "_kinds", lambda t: asked.append(t) or told(t))
    joined = []
    cut = decontam._cut
    monkeypatch.setattr(decontam, "_cut", lambda texts: joined.append(len(texts)) or cut(texts))
    batch = pa.record_batch([pa.array([1, 2, None, 4, 5], pa.int64()), pa.array(["a b a", None, "no id", "", "b c"])], names=["id", "text"])
    got = list(decontam._texts(decontam.Canon(decontam.Templates()), batch))
    assert [(k, len(rows)) for k, rows in got] == [(1, 3), (5, 2)] and sorted(asked) == ["a", "b", "c"] and joined == [2]


def test_token_memo_grows():
    value, _, _ = decontam.Canon(decontam.Templates()).read(" ".join(a + b + c for a in "abcdefghijklmnop" for b in "abcdefghijklmnop" for c in "abcdefgh"))
    assert len(set(value.tolist())) == 2048


def test_leaks_whatever_opens_a_sentence(spark):
    girl = ("Natalia sold clips to friends in April. Natalia then sold half as many clips in May. Natalia wants to know how "
            "many clips were sold in both months together.")
    bench = spark.createDataFrame([(1, girl), (2, "What is the capital of France?"), (3, "Compute 12 + 5 * 7"), (4, "Mix the red paint in first"),
                                   (5, "It takes 12 kg of Flour 3 l of Milk")], "item_id long, text string")
    rows = [(1, girl.replace("Natalia", "Maria")), (2, "Question: What is the capital of France?"), (3, "so: compute 12 + 5 * 7 now"),
            (4, "Mix the red paint in first!"), (5, "Then Mix the red paint in first"), (6, "Compute 13 + 5 * 7 now"),
            (7, "It takes 12\nkg of\nFlour 3\nl of Milk"), (8, "We ask what is the capital of France?"), (9, girl.replace(" ", "\n"))]
    for most in (16 << 20, 0):
        got = sorted((r.doc_id, r.item_id) for r in decontam.leaks(docs(spark, rows), bench, broadcast_bytes=most).collect())
        assert got == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (7, 5), (8, 2), (9, 1)]


def plain_spans(text):
    out = []
    for m in re.finditer(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.I | re.A):
        out += [(m.start(), 0, m.end())] if len(m[2]) >= 8 else []
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def test_plan_of_the_secret_scan_is_small(spark):
    scan = secretscan._scan(docs(spark, [(1, "x")]).selectExpr("doc_id", "text AS _text"), secretscan.Battery())
    plan = scan._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") < 60 and len(plan) < 60_000


def test_secret_spans_against_regular_expressions(spark):
    random.seed(1)
    hexed = "".join(random.choice("0123456789abcdef") for _ in range(40))
    b64 = "".join(random.choice(secretscan.ALPHABETS["base64"][:62]) for _ in range(48))
    text = f"é password = \"{hexed}\" token: secret: abcdefgh AKIA{'Q7' * 9} {hexed} API_KEY='short' apikey=longenough1 𝒳 {b64} the end"
    rows = [(1, text), (2, None), (3, ""), (3, "token=abc"), (None, text), (4, (text + "\n") * 40),
            (5, "Internationalisation/ofEverything1/isAnOrdinaryPath2/toSomeFolder/aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1B")]
    for r in secretscan.find(docs(spark, rows)).collect():
        want = [plain_spans(t or "") for i, t in rows if i == r.doc_id]
        assert [(s.start, s.kind, s.stop) for s in r.base] in want
        assert r.spans == sorted(r.spans) and all(s in r.spans for s in r.base)
        assert (3 in {s.kind for s in r.spans}) == (r.doc_id in (1, 4, None))
    clean = {r.doc_id: r.text for r in secretscan.redact(docs(spark, rows)).collect()}
    assert hexed not in clean[1] and b64 not in clean[4] and clean[2] is None and clean[1].endswith("the end")
    assert secretscan.find(docs(spark, [])).count() == 0


def test_secret_spans_of_all_encodings_parts_and_short_tokens(spark):
    random.seed(11)
    draw = lambda k, n: "".join(random.choice(secretscan.ALPHABETS[k]) for _ in range(n))
    rows, n = [], 40
    for k, size in (("base36", 40), ("hex upper", 40), ("base36 upper", 40), ("base62", 32), ("base62", 20)):
        rows += [(len(rows) + i, "see " + draw(k, size) + " there") for i in range(n)]
    start = len(rows)
    rows += [(start + i, "at services/hooks/incoming/v1/" + draw("base62", 32)) for i in range(n)]
    start = len(rows)
    rows += [(start + i, f"internationalisation{i % 7} thePreparationOfInternationalDinners{i % 9} in some/ordinary/place-of-interest{i}") for i in range(n)]
    got = {r.doc_id: r.spans for r in secretscan.find(docs(spark, rows)).collect()}
    for low in range(0, start, n):
        assert sum(any(s.kind == 3 for s in got[i]) for i in range(low, low + n)) >= 0.9 * n, low
    assert all(s.value in rows[i][1] and rows[i][1][s.start:s.stop] == s.value for i in got for s in got[i])
    assert sum(any(s.kind == 3 for s in got[i]) for i in range(start, start + n)) <= 0.1 * n


def test_running_sums(spark):
    from pyspark.sql import functions as F

    from quarry.llm.common import running_sums

    xs = list(range(1000))
    df = spark.createDataFrame([(xs,), ([],), ([5],)], "a array<bigint>")
    assert [r[0] for r in df.select(running_sums(F.col("a"), 7)).collect()] == [np.cumsum(xs).tolist(), [], [5]]


ODD = [(1, None), (2, ""), (3, "  a  b\n\n c\t\x1c x\x85y  "), (4, "I'll we've don't 's  "), (5, "日本語 ½ ² Ⅷ ٣٤ 👍🏽 é"), (6, "x" * 3000 + " " * 300),
       (None, "null id"), (4, "again"), (8, "<|endoftext|> hi"), (9, PROSE)]


def test_bpe_equals_the_library_and_round_trips(spark):
    import tiktoken

    path = catalog.MULTI_RANKS
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=dict(bpe.read_ranks(path)), special_tokens={})
    got = bpe.decode(bpe.encode(docs(spark, ODD), path, public_tokenizers.PATTERN), path).collect()
    want = sorted((str(i), enc.encode_ordinary(t or ""), (t or "").encode()) for i, t in ODD)
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in got) == want
    assert bpe.encode(docs(spark, []), path, public_tokenizers.PATTERN).count() == 0


def test_token_files_equal_the_library(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(catalog.TOKENIZER)
    manifest = tokenfile.write_tokens(docs(spark, ODD), catalog.TOKENIZER, public_tokenizers.PATTERN)
    got = sorted(tokenfile.checksums(tokenfile.read_tokens(manifest)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in ODD), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
        choices = [tok.encode(t or "", add_special_tokens=False).ids + [0] for i, t in ODD if i == r.doc_id]
        assert (r.n_tokens, r.ids_crc32) in [(len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for c in choices]
    assert tokenfile.read_tokens(tokenfile.write_tokens(docs(spark, []), catalog.TOKENIZER, public_tokenizers.PATTERN)).count() == 0


def test_token_files_of_a_wide_vocabulary(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    letters = pre_tokenizers.ByteLevel.alphabet()
    vocab = {f"filler{i}": i for i in range(70_000)} | {c: 70_000 + i for i, c in enumerate(sorted(letters))}
    tok = Tokenizer(models.BPE(vocab=vocab, merges=[]))
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.save(f"{tmp_path}/wide.json")
    manifest = tokenfile.write_tokens(docs(spark, [(1, "a wide text"), (2, "é\n"), (3, None)]), f"{tmp_path}/wide.json", public_tokenizers.PATTERN)
    assert {r.width for r in manifest.collect()} == {4}
    for r in tokenfile.checksums(tokenfile.read_tokens(manifest)).collect():
        ids = tok.encode({1: "a wide text", 2: "é\n", 3: ""}[r.doc_id], add_special_tokens=False).ids + [0]
        assert min(ids[:-1], default=70_000) >= 70_000 and (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_starts_are_where_the_pattern_matches():
    import regex

    from quarry.llm.pretoken import starts

    draw, full = random.Random(3), regex.compile(public_tokenizers.PATTERN)
    parts = ["'", "'", "s", "t", "re", "ve", "ll", "l", "d", "m", "S", " ", " ", " ", "\n", "\t", "\r", "\x85", "\xa0", "\u3000", "\x1c", "\0", "1", "½", "٣", "Ⅷ",
             "é", "ß", "ж", "日", "\u0301", ".", "_", "-", "\u200b", "👍", "𝟘", "𝒜", "\U0010ffff"]
    for _ in range(1500):
        texts = ["".join(draw.choices(parts, k=draw.choice([0, 1, 2, 3, 6, 30]))) for _ in range(draw.choice([1, 2, 6]))]
        data = "".join(texts).encode()
        at = starts(np.frombuffer(data, np.uint8), np.cumsum([len(t.encode()) for t in texts])).tolist()
        assert [data[a:b].decode() for a, b in zip(at, [*at[1:], len(data)])] == [w for t in texts for w in full.findall(t)]


def test_a_word_is_looked_up_once_for_many_texts(monkeypatch):
    from tokenizers import Tokenizer

    asked = []

    class Asked(tokenfile.Words):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    monkeypatch.setattr(tokenfile, "Words", Asked)
    tok = Tokenizer.from_file(catalog.TOKENIZER)
    texts = ["wide open", "", None, " wide wide\n", "it's <|endoftext|> wide", "wide é open"]
    want = [np.array(tok.encode(t or "", add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    encode = tokenfile.WordEncoder(catalog.TOKENIZER, public_tokenizers.PATTERN)
    assert list(encode(texts[:4])) == want[:4] and sorted(asked) == ["\n", " open", " wide", "wide"]
    assert list(encode(texts)) == want
    monkeypatch.setattr(tokenfile, "CHUNK_BYTES", 10)
    assert list(encode(texts)) == want
    assert list(tokenfile.WordEncoder(catalog.TOKENIZER, r"[a-z]|[^a-z]+")(["ab c"])) == [b"".join(map(encode.word, "ab c"))]


def test_word_table_keeps_the_words_of_late():
    asked = []
    words = tokenfile.Words(lambda w: asked.append(w) or w.encode(), 2)
    assert [words[w] for w in "abcabdb"] == [w.encode() for w in "abcabdb"] and len(words) <= 2
    assert asked.count("b") == 1


def test_reader_takes_single_documents_and_finds_damage(tmp_path):
    from quarry.llm.files import Replacing, opened

    with Replacing(str(tmp_path), "f") as out:
        tokenfile.write_file(out, [(1, b"ab" * 50), (None, b""), (3, b"cd")], 2)
    reader = tokenfile.Reader(opened(f"{tmp_path}/f"))
    assert reader.names == [1, None, 3] and reader.ids(2) == b"cd" and reader.ids(1) == b""
    raw = bytearray((tmp_path / "f").read_bytes())
    raw[int(reader.ends[2]) - 1] ^= 1
    (tmp_path / "g").write_bytes(raw)
    with pytest.raises(Exception):
        tokenfile.Reader(opened(f"{tmp_path}/g")).ids(2)


PAGES = "page_id long, url string, html string, rule string, verdict string, bad int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 0) for r in rows], PAGES)


def test_loser_tree():
    random.seed(2)
    for _ in range(200):
        runs = [sorted(random.randint(0, 9) for _ in range(random.randint(0, 6))) for _ in range(random.randint(0, 9))]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_warc_round_trip(spark):
    body = "a\r\n\r\nb\r\n\r\n"
    rows = [(5, "http://x.org/b", body), (3, "http://X.org/b", body), (3, "http://x.org/b", body), (9, None, None), (1, "u\r\nv", ""),
            (None, "http://a.x.org/", body), (2, "http://x.org/a", "é")]
    got = warc.capture_index(pages(spark, rows)).orderBy("place").collect()
    assert [(r.url_key, r.ts, r.page_id or -1) for r in got] == sorted((r.url_key, r.ts, r.page_id or -1) for r in got)
    by = {r.page_id: r for r in got}
    assert (by[5].record_type, by[5].refers_to, by[5].payload_bytes) == ("revisit", 3, len(body))
    assert by[3].record_type == "response" and by[None].refers_to == 3 and by[9].refers_to == 1 and len(got) == 7
    import base64
    assert by[2].payload_digest == base64.b32encode(hashlib.sha1("é".encode()).digest()).decode()
    assert warc.capture_index(pages(spark, [])).count() == 0


def test_warc_payloads_that_end_with_line_breaks(spark):
    bodies = ["abc\r\n", "\r\n", "x\r\n\r\n\r\n", "y\r", "z\n", "\r\n\r", "end", "w\r\n"]
    rows = [(i, f"http://x.org/{9 - i}", b) for i, b in enumerate(bodies)]
    folder = warc.write_archives(pages(spark, rows).coalesce(1))
    runs = warc.read_archives(spark, folder).collect()
    assert {r.page_id: r.payload_bytes for r in runs} == {i: len(b) for i, b in enumerate(bodies)}
    assert [r.url_key for r in runs] == sorted(r.url_key for r in runs)
    assert warc.merge_runs(warc.read_archives(spark, folder)).count() == len(rows)


def test_cut_warc_records_are_errors():
    def record(body):
        return b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)

    def read(raw):
        pieces = raw.split(b"\r\n\r\n")
        return [x[3] for x in warc._records(("f", p) for p in (pieces if pieces[-1] else pieces[:-1]))]

    raw = record(b"abc\r\n") + record(b"d\r\n\r\ne") + record(b"\r\n")
    assert read(raw) == [b"abc\r\n", b"d\r\n\r\ne", b"\r\n"]
    for cut in (12, 35, 60, len(raw) - 8):
        with pytest.raises(ValueError):
            read(raw[:cut])


def test_reputation_and_rules(spark):
    rows = [(i, f"http://bad.site.com/{i}", "") for i in range(40)] + [(100 + i, f"http://good{i % 9}.org/{i}", "") for i in range(60)]
    rows += [(200, None, None), (201, "nohost", ""), (202, "https://EN.Example.net/en/x?q#f", ""), (203, "http://example.net", ""), (202, "http://a.org/fr/", "")]
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(100 + i, 0) for i in range(60)] + [(None, 1), (31, None)], "page_id long, bad int")
    got = urlrep.judge(pages(spark, rows), labels, catalog.URL_RULES).collect()
    by = {(r.page_id, r.host): r for r in got}
    assert len(got) == len(rows) and by[39, "bad.site.com"].verdict == "block" and by[100, "good0.org"].verdict == "allow"
    assert by[202, "en.example.net"].rule == "example.net/en/" and by[203, "example.net"].rule is None and by[202, "a.org"].rule == "org/fr/"
    assert by[200, ""].path == "" and by[201, ""].verdict == "allow"
    assert urlrep.judge(pages(spark, []), labels, catalog.URL_RULES).count() == 0
    assert {r.verdict for r in urlrep.judge(pages(spark, rows[40:100]), labels.limit(0)).collect()} == {"allow"}


def test_licence_sequences(spark):
    s = licenses.SENTENCES
    mit = f"Copyright (c) 2020\n\n{s['mit.grant']}\n\n{s['mit.keep']}"
    rows = [(1, PROSE + "\nReleased under the MIT License."), (2, mit), (3, f"{s['mit.keep']}\n{s['mit.grant']}"), (4, None), (4, ""),
            (None, s["apache2.notice"].upper()), (5, PROSE), (6, s["ccbync4.notice"] + "\n" + s["reserved"])]
    got = [(r.doc_id, r.licences) for r in licenses.recognise(docs(spark, rows)).collect()]
    want = [(1, ["MIT"]), (2, ["MIT"]), (3, []), (4, []), (4, []), (None, ["Apache-2.0"]), (5, []), (6, ["All-rights-reserved", "CC-BY-NC-4.0"])]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert licenses.recognise(docs(spark, [])).count() == 0


def test_wrapped_licences_and_notices(spark):
    import textwrap

    s = licenses.SENTENCES

    def wrapped(mark, *paragraphs, width=72):
        return f"\n{mark.rstrip()}\n".join(textwrap.fill(x, width, initial_indent=mark, subsequent_indent=mark, break_on_hyphens=False) for x in paragraphs)

    bsd3 = s["bsd.name"].replace("the copyright holder", "Foo Labs")
    gnu = ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
           "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.")
    rows = [(wrapped("", "MIT License", s["mit.grant"], s["mit.keep"]), ["MIT"]), (wrapped(" * ", s["mit.grant"], s["mit.keep"]), ["MIT"]),
            (wrapped("# ", "Copyright 2020 X", s["apache2.notice2"], s["apache2.copy"]), ["Apache-2.0"]),
            ("# Copyright (C) 2020 X\n" + wrapped("# ", s["gpl.notice"], s["gpl.warranty"]), ["GPL-3.0-or-later"]),
            (wrapped("// ", gnu), ["LGPL-2.1-or-later"]), (wrapped("", s["bsd.grant"], "1. " + s["bsd.source"], "2. " + s["bsd.binary"]), ["BSD-2-Clause"]),
            (wrapped("  ", s["bsd.grant"], "1. " + s["bsd.source"], "2. " + s["bsd.binary"], "3. " + bsd3), ["BSD-3-Clause"]),
            (wrapped("; ", s["isc.grant"], width=50), ["ISC"]), (wrapped("", s["unlicense.grant"], width=40), ["Unlicense"]),
            (wrapped("-- ", s["mpl2.notice"], width=40), ["MPL-2.0"]), ("This file is released under the MIT License.", ["MIT"]),
            ("Text before. It is licensed under the terms of the GNU General Public License, version 2.", ["GPL-2.0"]),
            ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]),
            ("License: MIT", ["MIT"]), ("// SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR MIT\nint a;", ["GPL-2.0-only", "MIT"]),
            ("Mein Hund kam mit.", []), ("The code was never released under the MIT License.", []), ("GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991", ["GPL-2.0"])]
    got = {r.doc_id: r.licences for r in licenses.recognise(docs(spark, [(i, t) for i, (t, _) in enumerate(rows)])).collect()}
    assert got == {i: want for i, (_, want) in enumerate(rows)}


def test_notices_that_list_licences(spark):
    s = licenses.SENTENCES
    rows = [("This project is MIT licensed.", ["MIT"]), ("Licensed under the MIT license and the Apache License, Version 2.0.", ["Apache-2.0", "MIT"]),
            ("Licensed under either of Apache License, Version 2.0 or MIT license at your option.", ["Apache-2.0", "MIT"]),
            ("Dual licensed under GPL v2 or later.", ["GPL-2.0-or-later"]), (f"{s['zlib.warranty']}\n\n{s['zlib.grant']}", ["Zlib"]),
            (f"# {s['apache2.basis']}\n# {s['apache2.see']}", ["Apache-2.0"]), ("Available under the BSD 3-Clause or the ISC license.", ["BSD-3-Clause", "ISC"]),
            ("This program is licensed under the GNU LGPL v3.", ["LGPL-3.0"]), ("The committee was licensed to operate a bar.", []), ("She is licensed.", []),
            ("We met under the bridge and the old mill.", [])]
    got = {r.doc_id: r.licences for r in licenses.recognise(docs(spark, [(i, t) for i, (t, _) in enumerate(rows)])).collect()}
    assert got == {i: want for i, (_, want) in enumerate(rows)}


HTML = """<html><head><title>T</title></head><body><header><a href=x>home</a></header><div class="cookie-notice">We use cookies here, as you
may well know by now.</div><main><h1>Title</h1><p>First  para, <b>bold</b> &eacute;&#8217;s &lt;x&gt;.<ul><li>one item</ul>
<div class="ad">Buy now this thing today.</div><p>Second para with words in it.<form><label>Name</label></form></main>
<section id="comments"><p>Great post, I really liked it all.</p></section><footer>c 2020</footer></body>"""


def test_extraction(spark):
    rows = [(1, "u", HTML), (2, None, None), (2, "v", ""), (None, "w", "<p>A paragraph of text that is long enough, to stay in.</p><scr"), (3, "x", "<div" * 50)]
    got = {(r.page_id, r.url): r for r in mincut.extract(pages(spark, rows)).collect()}
    assert got[1, "u"].text == "Title\nFirst para, bold é’s <x>.\none item\nSecond para with words in it."
    assert got[2, None].text == "" and got[None, "w"].n_chars == 52 and mincut.extract(pages(spark, [])).count() == 0


def test_silence_ends_with_what_is_around_it():
    article = "<article><h1>Title</h1><p>A paragraph of text that is long enough, to stay in.</p></article>"
    want = "Title\nA paragraph of text that is long enough, to stay in."
    for before in ("<datalist id=d><option value=a><option value=b></datalist>", "<datalist><option>Alpha one<option>Beta two", "<div><svg><path d=x></div>",
                   "<svg viewBox=x><path d=x><title>Sun</title>", "<div><object data=x><param name=y></div>", "<object data=x><param name=y>",
                   "<select><option>One<option>Two", "<div><math><mi>x</div>", "<object><object><p>no</object><div>no</div></object>",
                   "<svg><foreignObject><div>no</div></foreignObject><text>no</text></svg>", "<select><option>One<optgroup><option>no</select>",
                   "<svg><style>a{}</style><g><a>no</a></g></svg>"):
        assert mincut.main_text(f"<html><body>{before}{article}</body></html>") == want, before


def test_cut_is_minimal():
    random.seed(4)
    for _ in range(60):
        n = random.randint(1, 7)
        edges = [(random.randint(0, n + 1), random.randint(0, n + 1), random.randint(1, 9)) for _ in range(14)]
        edges = [(a, b, c) for a, b, c in edges if a != b]
        g = mincut.Cut(n + 2)
        for a, b, c in edges:
            g.edge(a, b, c)
        side = g.source_side(n, n + 1)

        def cost(inside):
            return sum(c for a, b, c in edges if inside[a] and not inside[b])

        best = min(cost([bool(m >> i & 1) for i in range(n)] + [True, False]) for m in range(1 << n))
        assert cost(side) == best


def test_pipeline_against_plain_stages(spark, tmp_path):
    import corpus_pipeline

    secret = "password=" + "0123456789abcdef" * 2
    other = " ".join(f"term{i} stands{i} here{i} now{i}" for i in range(30)) + "."
    bench = "The quick survey of nine harbours found that tides and winds alone decide when small boats may leave."
    rows = [(1, PROSE), (2, PROSE + " Extra."), (3, other + " " + secret), (4, "too short"), (5, "\n".join([bench, " ".join(f"leaf{i} falls{i} down{i}" for i in range(30)) + "."])), (6, None)]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    want = {1: PROSE, 3: other + " [SECRET]"}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()}
