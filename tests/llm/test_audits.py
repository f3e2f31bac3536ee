"""Divergence, filter interplay and toxicity on hand-made tables, against plain versions."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quarry.llm import catalog, common, divergence, interplay, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, mask int, score double"
SF = "/root/testdata/sf0.01"


def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 1, 0.5) for r in rows], SCHEMA)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# ---------------------------------------------------------------- divergence

def plain_divergence(rows, min_docs, top):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    df, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(low))
        df[lang or ""].update(set(terms))
        counts[lang or "", source or ""].update(terms)
        groups[lang or ""].add(source or "")
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        v = len(kept)

        def share(get):
            total = sum(map(get, kept))
            return {t: 1 + 10**9 * (get(t) + 2) // (total + 2 * v) for t in kept}

        p = {s: share(lambda t: counts[lang, s][t]) for s in sources}
        q = share(lambda t: sum(counts[lang, s][t] for s in sources))
        for s in sources:
            pair = [(sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o) for o in sources if o != s]
            term = [((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, len(pair)), ("term", term, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, r) for r, (value, item) in enumerate(found[:most], 1)]
    return sorted(out)


@pytest.mark.parametrize("conf", [
    divergence.Audit(min_docs=3, top=4),
    # three digests share each value and the bitmap has 64 bits: every path of collisions; blocks of two sources, four terms in a matrix
    divergence.Audit(min_docs=3, top=4, digest_bits=5, map_bits=64, block=2, per_salt=4),
])
def test_divergence_against_a_plain_count(spark, conf):
    random.seed(4)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)] + ["Äpfel", "äpfel", "Z", "日本"]
    rows = [(i, " ".join(random.choices(words, k=random.randint(0, 40))) + random.choice(["", " AB_ab9", "\tz"]), random.choice(["en", "de", None]),
             random.choice(["s1", "s2", "s3", "s4", "s5", None])) for i in range(120)]
    rows += [(500, None, "fr", "s1"), (501, "", "fr", "s2"), (502, "only here", "it", "s9"), (rows[3])]
    got = divergence.audit(docs(spark, rows), conf=conf)
    assert sorted(tuple(r) for r in got.collect()) == plain_divergence(rows, 3, 4)
    assert divergence.audit(docs(spark, []), conf=conf).count() == 0


def test_shares_are_exact_beyond_64_bits():
    n, total, v = 9 * 10**10, 10**14 + 7, 10**6
    got = divergence._shares(np.array([n], np.int64), np.array([total + 2 * v], np.int64), 10**9)[0]
    assert got == 1 + 10**9 * (n + 2) // (total + 2 * v)


def test_share_expression_is_exact(spark):
    n, total, v = 9 * 10**10, 10**14 + 7, 10**6
    row = spark.sql(f"SELECT {n}L AS n, {total}L AS total, {v}L AS v").select(divergence._share("n", "total", 10**9).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 2) // (total + 2 * v)


def test_a_bitmap_marks_all_its_digests(spark):
    digests = [-1, 0, 63, 64, 2**62, -2**63]
    bits = divergence.bitmap_of(spark.createDataFrame([(d,) for d in digests], "digest long"), 1 << 10)
    assert divergence._marked(np.array(digests, np.int64).view(np.uint64), bits).all()
    assert not divergence._marked(np.array([5], np.uint64), bits).any()


# ---------------------------------------------------------------- filter interplay

def plain_interplay(rows, known):
    good, toxic = ({i for i, q, t in known if i is not None and (q, t)[k] == 1} for k in (0, 1))
    fails = []
    for i, text, lang, _ in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0d]+", t)
        f = {k for k, hit in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search("[#$%&*|]", t)),
            any((u or "") == t and j is not None and i is not None and j < i for j, u, *_ in rows))) if hit}
        fails.append((i, lang or "", f))
    out, credit = [], Counter()
    for part in {p for _, p, _ in fails}:
        mine = [(i, f) for i, p, f in fails if p == part]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, k in enumerate(order, 1):
                gone = [(i, f) for i, f in left if k in f]
                left = [(i, f) for i, f in left if k not in f]
                credit[part, k] += len(gone)
                out.append((part, "".join(order), step, k, len(left), len(gone), sum(k in f for _, f in mine) - len(gone), sum(f == {k} for _, f in mine),
                            sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)))
    return sorted(r + (credit[r[0], r[3]],) for r in out)


def test_interplay_against_every_order(spark):
    random.seed(8)

    def text():
        words = random.choices([f"w{i}" for i in range(random.choice([60, 400]))], k=random.choice([0, 40, 120, 150]))
        t = " ".join(words) + random.choice(["", " #", ""])
        return t.upper() if random.random() < 0.3 else t

    texts = [text() for _ in range(12)] + [None, "", " \t\n"]
    rows = [(random.randint(0, 30), random.choice(texts), random.choice(["en", "de", "", None]), "s") for _ in range(70)]
    rows += [(None, texts[0], "en", "s"), (None, texts[0], "en", "s"), (1, texts[1], "en", "s"), (1, texts[1], "en", "s"), (40, texts[1], "de", "s")]
    known = [(i, i % 2, int(i % 3 == 0)) for i in range(25)] + [(3, 0, 1), (None, 1, 1), (5, None, None)]
    got = interplay.audit(docs(spark, rows), labels(spark, known))
    assert sorted(tuple(r) for r in got.collect()) == plain_interplay(rows, known)
    assert interplay.audit(docs(spark, []), labels(spark, known)).count() == 0
    assert interplay.audit(docs(spark, rows), labels(spark, [])).filter("good_lost + toxic_lost > 0").count() == 0


def test_interplay_of_a_very_long_text(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    got = interplay.failures(docs(spark, [(1, long, "en", "s"), (2, long + " #", "en", "s"), (3, long, "en", "s")])).collect()
    assert {r.doc_id: r.mask for r in got} == {1: 0, 2: 8, 3: 16}


def test_gray_walk_equals_filtering():
    rng = np.random.default_rng(2)
    masks, counts = np.arange(32), rng.integers(0, 50, (32, 3))
    states = interplay.survivors(masks, counts)
    for s in range(32):
        assert (states[s] == counts[(masks & s) == 0].sum(axis=0)).all()


# ---------------------------------------------------------------- toxicity

def model_of(words):
    counts = np.zeros(1 << 16, np.float32)
    for w, n in words.items():
        w = f"^{w}$"
        for i, k in itertools.product(range(len(w)), range(1, toxicity.ORDER + 1)):
            if i + k <= len(w):
                counts[zlib.crc32(w[i:i + k].encode()) % len(counts)] += n
        counts[0] += n * (len(w) - 1)
    return toxicity.CharModel(counts)


WORDS = {"idiot": 40, "stupid": 40, "trash": 30, "hello": 90, "you": 200, "are": 200, "letter": 50, "class": 60, "an": 100}


def test_decoding_finds_the_cheapest_path():
    model, channel = model_of(WORDS), toxicity.Channel()
    for text in ("1d10t", "tr4$h", "heelo", "a-b!", "cl*ss", "00"):
        moves = toxicity._moves(text, channel)
        best = math.inf
        for path in itertools.product(*moves):
            spent, context = 0.0, "^"
            for char, price in path:
                spent += price
                if char == " ":
                    spent, context = spent + (model.cost(context, "$") if context != "^" else 0), "^"
                elif char:
                    spent, context = spent + model.cost(context, char), (context + char)[1 - toxicity.ORDER:]
            spent += model.cost(context, "$") if context != "^" else 0
            if spent < best - 1e-9:
                best, said = spent, "".join(c for c, _ in path)
        assert toxicity.decode(moves, model) == said


def test_restored_text():
    r = toxicity.Restorer(model_of(WORDS))
    for noisy, clean in (("you are an 1d10t!!", "you are an idiot"), ("s t u p i d", "stupid"), ("stuuupiid", "stupid"), ("t.r.a.s.h", "trash"),
                         ("hello, class", "hello class"), ("letter", "letter"), ("tr*sh", "trash"), ("", ""), ("2012 !!", "2012 !!"), ("$tup!d", "stupid")):
        assert r.text(noisy) == clean
    assert len(r.text("1d10t " * 20_000).split()) == 20_000
    assert r.token("x7" * 5_000)


def test_memo_forgets_the_oldest():
    made = []
    memo = toxicity.Memo(lambda k: made.append(k) or k * 2, most=3)
    assert [memo[k] for k in (1, 2, 3, 4, 1, 4, 5, 6, 7, 8, 1)] == [2, 4, 6, 8, 2, 8, 10, 12, 14, 16, 2]
    assert len(memo) <= 3 and made.count(4) == 1


@pytest.fixture(scope="module")
def trained(spark):
    d, known = (common.read_table(spark, SF, n) for n in ("documents", "labels"))
    return d, known, toxicity.train(d, known)


def test_held_out_documents(spark, trained):
    d, known, model = trained
    got = toxicity.score(d, model).join(known, "doc_id").filter("held_out").collect()
    truth = [r.toxic for r in got]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    ranked = sum((a.score > b.score) + 0.5 * (a.score == b.score) for a in got for b in got if a.toxic > b.toxic)
    assert ranked / (sum(truth) * (len(truth) - sum(truth))) > 0.75
    assert sum(r.predicted == r.toxic for r in got) / len(got) > 0.85


def test_obfuscated_copies_score_alike(spark, trained):
    d, _, model = trained
    rows = [(1, "the idiot and the", "en", "s"), (2, "the 1d10t and the", "en", "s"), (3, "the i d i o t and the", "en", "s"), (4, "the idiiiot and the", "en", "s"),
            (10, "the i.d.i.o.t and the", "en", "s"), (11, "the i-d-i-o-t and the", "en", "s"), (12, "the IDI0T! and the", "en", "s"),
            (5, "the and that with", "en", "s"), (None, "the", "en", "s"), (7, None, None, None), (8, "", "en", "s"), (8, "", "en", "s")]
    got = toxicity.score(docs(spark, rows), model).collect()
    score = {r.doc_id: r.score for r in got}
    assert len(got) == len(rows) and all(abs(score[i] - score[1]) < 0.1 and score[i] > 2 * score[5] for i in (2, 3, 4, 10, 11, 12))
    assert score[7] == score[8] and not next(r.held_out for r in got if r.doc_id is None)
    assert [r.held_out for r in got if r.doc_id == 1] == [zlib.crc32(b"1") % 5 == 0]
    assert toxicity.score(docs(spark, []), model).count() == 0
    restored = {r.doc_id: r.restored for r in toxicity.restore(docs(spark, rows), model).collect()}
    assert restored[2] == restored[3] == restored[4] == "the idiot and the" and restored[7] is None


def test_training_without_labels_or_texts(spark):
    d = docs(spark, [(1, "a text", "en", "s"), (2, None, "en", "s")])
    for known in ([], [(1, 1, None), (None, 1, 1)], [(1, 1, 1), (1, 1, 0), (9, 0, 0)]):
        got = toxicity.score(d, toxicity.train(d, labels(spark, known))).collect()
        assert sorted(r.doc_id for r in got) == [1, 2] and all(0 <= r.score <= 1 for r in got)
    empty = docs(spark, [])
    assert toxicity.score(empty, toxicity.train(empty, labels(spark, []))).count() == 0


def test_held_out_labels_are_not_learned(spark):
    d = docs(spark, [(i, f"text {i} words", "en", "s") for i in range(40)])
    known = labels(spark, [(i, 1, i % 2) for i in range(40)])
    used = {r._id for r in toxicity.labelled_texts(d, known).collect()}
    assert used == {i for i in range(40) if zlib.crc32(str(i).encode()) % 5}


def test_queries_are_registered():
    assert {"op11_source_divergence", "op12_filter_interplay"} <= set(catalog.SQL) and "op13_noisy_toxicity" in catalog.SPARK
