"""Source divergence audit: how far the term shares of each source stray from the other sources of its language.

Terms are counted by 64-bit digests; texts of terms stay where they are read. Three scans:

1. documents per (language, digest), which leaves the digests that can reach the required
   number of documents; a bitmap of fixed size carries them to the next scans (digests that
   share a bit with them come along and fall out in the last count);
2. the smallest and the greatest term of each digest left: where they differ, several terms
   share the digest, and a second bitmap tells the last scan to tell them apart;
3. occurrences per (language, source, digest), a term's own bytes behind the digest where it
   is shared, so every count belongs to one term.

Term texts are joined back to the few terms that are returned.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import maybe_broadcast, written

#: Bytes of terms keep their value, A-Z in lower case; all others part terms. UTF-8 beyond ASCII has only bytes from 0x80 on.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Entries that a task counts before it hands them on.
FLUSH = 500_000


@dataclass(frozen=True)
class Audit:
    """``min_docs``: documents of a language that a kept term needs. ``top``: ranks of the term part.
    ``digest_bits``: width of the digests; ``map_bits``: bits of the bitmaps (4 MB). ``block``: sources of
    a language that meet in one matrix. ``per_salt``: kept terms in one matrix."""

    min_docs: int = 10
    top: int = 10
    scale: int = 1_000_000_000
    digest_bits: int = 64
    map_bits: int = 1 << 25
    block: int = 128
    per_salt: int = 2000


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_TERM_BYTES).split()


def _digests(terms: list[bytes], bits: int) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, terms), np.uint64, len(terms)) & np.uint64((1 << bits) - 1)


def _marked(digests: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Which digests have their bit set."""
    at = digests % np.uint64(len(bitmap) * 64)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def bitmap_of(digests: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of ``bits`` bits with those of the column ``digest`` (bigint, taken as unsigned) set: at most
    ``bits`` / 64 words come to the driver, whatever the number of digests."""
    low = F.col("digest").bitwiseAND(F.lit(bits - 1))
    words = digests.select(F.shiftright(low, 6).alias("at"), F.expr(f"shiftleft(1L, cast((digest & {bits - 1}) & 63 as int))").alias("bit"))
    table = words.groupBy("at").agg(F.bit_or("bit").alias("word")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[table["at"].to_numpy()] = table["word"].to_numpy().view(np.uint64)
    return out


def _rows(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    def filled(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    return docs.select(filled(lang_col).alias("lang"), filled(source_col).alias("source"), filled(text_col).cast("binary").alias("text"))


def _document_counts(conf: Audit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)

        def flush():
            for lang, c in counts.items():
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(c)), pa.array(_digests(list(c), conf.digest_bits).view(np.int64)),
                                                  pa.array(np.fromiter(c.values(), np.int64, len(c)))], names=["lang", "digest", "df"])
            counts.clear()

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                counts[lang].update(set(terms_of(text)))
                if sum(map(len, counts.values())) > FLUSH:
                    yield from flush()
        yield from flush()
    return run


def _strings(conf: Audit, kept):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()

        def flush():
            terms = list(seen)
            digests = _digests(terms, conf.digest_bits)
            hit = np.flatnonzero(_marked(digests, kept.value))
            yield pa.RecordBatch.from_arrays([pa.array(digests[hit].view(np.int64)), pa.array([terms[i].decode() for i in hit], pa.string())],
                                             names=["digest", "term"])
            seen.clear()

        for b in batches:
            for text in b.column(0).to_pylist():
                seen.update(terms_of(text))
                if len(seen) > FLUSH:
                    yield from flush()
        yield from flush()
    return run


def _term_ids(digests: np.ndarray, many, terms) -> pa.Array:
    """Each digest's eight bytes, behind them its term where several share the digest (``many``; empty: none does)."""
    plain = digests.astype(">u8").tobytes()
    if not len(many):
        places = np.arange(0, len(plain) + 8, 8, dtype=np.int32)
        return pa.Array.from_buffers(pa.binary(), len(digests), [None, pa.py_buffer(places), pa.py_buffer(plain)])
    return pa.array([plain[8 * k:8 * k + 8] + (t if m else b"") for k, (t, m) in enumerate(zip(terms, many))], pa.binary())


def _occurrences(conf: Audit, kept, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, Counter] = defaultdict(Counter)
        within: dict[tuple, Counter] = defaultdict(Counter)
        split = bool(shared.value.any())

        def flush():
            for (lang, source), c in counts.items():
                terms = list(c)
                digests = _digests(terms, conf.digest_bits)
                hit = np.flatnonzero(_marked(digests, kept.value))
                n = np.fromiter(c.values(), np.int64, len(c))[hit]
                ids, own = _term_ids(digests[hit], [], []), np.zeros(len(hit), np.int64)
                if split:
                    many, docs = _marked(digests[hit], shared.value), within[lang, source]
                    ids = _term_ids(digests[hit], many, [terms[i] for i in hit])
                    own = np.fromiter((docs[terms[i]] if m else 0 for i, m in zip(hit, many)), np.int64, len(hit))
                yield pa.RecordBatch.from_arrays([*[pa.repeat(pa.scalar(g, pa.string()), len(hit)) for g in (lang, source)], ids, pa.array(n), pa.array(own)],
                                                 names=["lang", "source", "term_id", "n", "df"])
            counts.clear()
            within.clear()

        for b in batches:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                terms = terms_of(text)
                counts[lang, source].update(terms)
                if split:
                    within[lang, source].update(set(terms))
                if sum(map(len, counts.values())) > FLUSH:
                    yield from flush()
        yield from flush()
    return run


@dataclass
class TermCounts:
    """``counts``: lang, source, term_id, n, total (n of the language) of kept terms, n > 0. ``texts``: digest, low
    (its term). ``groups``: lang, source, at (place of the source in its language), n_sources, n, n_lang, v, for every group."""

    counts: DataFrame
    texts: DataFrame
    groups: DataFrame


def count_terms(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", conf: Audit = Audit()) -> TermCounts:
    """The three scans, as tables in the shared folder."""
    context = docs.sparkSession.sparkContext
    rows = _rows(docs, text_col, lang_col, source_col)
    df = rows.select("lang", "text").mapInArrow(_document_counts(conf), "lang string, digest bigint, df bigint")
    # tasks hand on counts, a row per key: they are dealt as they are and added up where they meet
    df = written(df.repartition("lang", "digest").groupBy("lang", "digest").agg(F.sum("df").alias("df")).filter(F.col("df") >= conf.min_docs), "digest-documents")
    kept = context.broadcast(bitmap_of(df, conf.map_bits))

    texts = rows.select("text").mapInArrow(_strings(conf, kept), "digest bigint, term string")
    texts = written(texts.repartition("digest").groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high")), "term-texts")
    shared = context.broadcast(bitmap_of(texts.filter("low <> high"), conf.map_bits))

    counts = rows.mapInArrow(_occurrences(conf, kept, shared), "lang string, source string, term_id binary, n bigint, df bigint")
    counts = written(counts.repartition("lang", "source", "term_id").groupBy("lang", "source", "term_id").agg(F.sum("n").alias("n"), F.sum("df").alias("df")), "term-counts")
    # a digest's documents are its term's, unless several terms share it; those were counted apart
    totals = counts.groupBy("lang", "term_id").agg(F.sum("n").alias("total"), F.sum("df").alias("own")).withColumn("digest", _digest())
    totals = totals.join(df, ["lang", "digest"]).filter(F.when(F.length("term_id") > 8, F.col("own")).otherwise(F.col("df")) >= conf.min_docs)
    totals = totals.select("lang", "term_id", "total")
    counts = written(counts.drop("df").join(totals, ["lang", "term_id"]), "kept-counts")

    by_lang = (counts.groupBy("lang", "term_id").agg(F.first("total").alias("total"))
               .groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("n_lang")))
    by_source = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    sources = Window.partitionBy("lang")
    groups = rows.select("lang", "source").distinct().join(by_source, ["lang", "source"], "left").join(by_lang, "lang", "left")
    groups = written(groups.select(
        "lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "n_lang", "v")]).select(
        "*", (F.row_number().over(sources.orderBy("source")) - 1).alias("at"), F.count(F.lit(1)).over(sources).cast("int").alias("n_sources")), "term-groups")
    return TermCounts(counts, texts, groups)


def _digest() -> Column:
    """The digest in front of a term's id."""
    return F.conv(F.hex(F.substring("term_id", 1, 8)), 16, -10).cast("long")


def _share(n: str, total: str, scale: int) -> Column:
    """1 + floor(scale * (n + 2) / (total + 2 v)), in exact decimals."""
    return F.expr(f"1 + (cast({n} + 2 as decimal(27,0)) * {scale}BD) div (cast({total} as decimal(27,0)) + 2 * v)")


def _shares(counts: np.ndarray, totals: np.ndarray, scale: int) -> np.ndarray:
    """The same in 64-bit integers: long division in steps of 1000, as counts times the scale may not fit."""
    rest, out = counts + 2, np.zeros(np.broadcast_shapes(counts.shape, totals.shape), np.int64)
    while scale > 1:
        rest = rest * 1000
        out = out * 1000 + rest // totals
        rest = rest % totals
        scale //= 1000
    return out + 1


def _divergence(p, q):
    return (p - q) * (p - q) // (p + q)


def _pair_sums(conf: Audit):
    """Sums of the divergences of all pairs of sources in two blocks, over the kept terms of one salt."""
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("at")
        at, names = right["at"].to_numpy(), right["source"].to_pylist()
        totals = np.maximum(right["denominator"].to_numpy(), 1)
        n_terms = int(right["n_terms"][0].as_py())
        codes = left["term_id"].combine_chunks().dictionary_encode() if left.num_rows else None
        found = 0 if codes is None else len(codes.dictionary)
        matrix = np.zeros((found, len(at)), np.int64)
        if found:
            matrix[codes.indices.to_numpy(), np.searchsorted(at, left["at"].to_numpy())] = left["n"].to_numpy()
        p, zero = _shares(matrix, totals, conf.scale), _shares(np.zeros(1, np.int64), totals, conf.scale)
        low, high = key[1].as_py(), key[2].as_py()
        rows = [k for k in range(len(at)) if at[k] // conf.block == low]
        cols = np.array([k for k in range(len(at)) if at[k] // conf.block == high], np.int64)
        out_a, out_b, out_v = [], [], []
        for a in rows:
            sums = _divergence(p[:, cols], p[:, [a]]).sum(axis=0) + _divergence(zero[cols], zero[a]) * (n_terms - found)
            for b, v in zip(cols.tolist(), sums.tolist()):
                if low != high:
                    out_a += [names[a], names[b]]
                    out_b += [names[b], names[a]]
                    out_v += [v, v]
                elif a != b:
                    out_a.append(names[a])
                    out_b.append(names[b])
                    out_v.append(v)
        return pa.table({"lang": pa.array([key[0].as_py()] * len(out_a), pa.string()), "source": pa.array(out_a, pa.string()),
                         "item": pa.array(out_b, pa.string()), "value": pa.array(out_v, pa.int64())})
    return run


def pairs(found: TermCounts, conf: Audit = Audit()) -> DataFrame:
    """``lang, source, item, value``: every ordered pair of sources of a language and their summed divergence.

    Kept terms are dealt to salts and sources to blocks; the counts of a salt's terms in two blocks form one
    matrix of bounded size, beside the totals of the blocks' sources."""
    n_salts = F.greatest(F.lit(1), F.ceil(F.col("v") / conf.per_salt)).cast("int")
    blocks = F.ceil(F.col("n_sources") / conf.block).cast("int")
    places = found.groups.select("lang", "source", "at", "n_sources", n_salts.alias("n_salts"), blocks.alias("blocks"),
                                 (F.col("n") + 2 * F.col("v")).alias("denominator"))
    salt = F.pmod(F.xxhash64("term_id"), F.col("n_salts")).cast("int").alias("salt")

    def dealt(df, *columns):
        mine = F.floor(F.col("at") / conf.block).cast("int")
        other = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return other.select("lang", F.least(mine, "other").alias("low"), F.greatest(mine, "other").alias("high"), *columns)

    by_group = maybe_broadcast(places.select("lang", "source", "at", "n_salts", "blocks"), 64)
    left = dealt(found.counts.join(by_group, ["lang", "source"]).withColumn("salt", salt), "salt", "term_id", F.col("at").alias("at"), "n")
    langs = places.groupBy("lang").agg(F.first("n_salts").alias("n_salts"))
    terms = found.counts.join(maybe_broadcast(langs, 32), "lang").select("lang", "term_id", salt).distinct().groupBy("lang", "salt").agg(
        F.count(F.lit(1)).alias("n_terms"))
    spread = places.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("n_salts") - 1))).join(terms, ["lang", "salt"], "left")
    right = dealt(spread, "salt", "at", "source", "denominator", F.coalesce("n_terms", F.lit(0)).alias("n_terms"))
    keys = ["lang", "low", "high", "salt"]
    sums = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_pair_sums(conf), "lang string, source string, item string, value bigint")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def leading_terms(found: TermCounts, conf: Audit = Audit()) -> DataFrame:
    """``lang, source, item, value, rank``: the terms that a source has more often than its language, most divergent first, up to rank ``top``.

    The candidates (ties at the last rank included) are cut on numbers; only they get their text, which settles the ties."""
    groups = maybe_broadcast(found.groups.select("lang", "source", F.col("n").alias("n_group"), "n_lang", "v"), 64)
    p, q = _share("n", "n_group", conf.scale), _share("total", "n_lang", conf.scale)
    rows = found.counts.join(groups, ["lang", "source"]).select("lang", "source", "term_id", p.alias("p"), q.alias("q"))
    value = F.expr("((p - q) * (p - q)) div (p + q)")
    by_group = Window.partitionBy("lang", "source")
    best = rows.filter("p > q").select("lang", "source", "term_id", value.alias("value")).withColumn(
        "rank", F.rank().over(by_group.orderBy(F.desc("value")))).filter(F.col("rank") <= conf.top).drop("rank")
    best = written(best.withColumn("digest", _digest()), "leading-terms")
    texts = found.texts.select("digest", "low").join(maybe_broadcast(best.select("digest").distinct(), 16), "digest", "left_semi")
    own = F.decode(F.expr("substring(term_id, 9)"), "UTF-8")
    named = best.join(texts, "digest").select("lang", "source", F.when(F.length("term_id") > 8, own).otherwise(F.col("low")).alias("item"), "value")
    return named.withColumn("rank", F.row_number().over(by_group.orderBy(F.desc("value"), "item"))).filter(F.col("rank") <= conf.top)


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", conf: Audit = Audit()) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (lang, source) group: part ``pair`` ranks the other sources of
    the language by divergence, part ``term`` the terms that the group has more often than its language.

    Nulls in text, lang and source are ''. A language without kept terms has pairs of value 0 and no terms; a
    single source has no pairs. Ties take the smaller item in UTF-8 order. Repeated rows count each, an empty table
    gives no rows, other columns are not read, texts are read whole."""
    found = count_terms(docs, text_col, lang_col, source_col, conf)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    both = pairs(found, conf).withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair")).unionByName(
        leading_terms(found, conf).withColumn("part", F.lit("term")))
    return both.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
