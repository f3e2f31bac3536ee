"""Numpy kernels that run inside Spark tasks on Arrow batches.

Spark partitions and shuffles the work; a kernel sees bounded batches: rows of vectors to be
hashed or compared with the fixed-size seed set, packed blocks of documents and queries to
be multiplied, or one query's score rows behind its judged rows. None holds more than
its blocks, its heaps and its counters.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# ship these task bodies by value: executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROUND = 9
# rows and columns of one block product
BLOCK_ROWS, BLOCK_QUERIES = 1024, 1024
# products that a task hands on at once
PRODUCT_ROWS = 100_000
# largest scores that a task holds before it drops what cannot be among the best
LARGEST_ROWS = 200_000
# heap entries that a task holds before it hands them on
HEAP_ENTRIES = 1_000_000
# words whose slot a worker remembers
MEMO = 100_000
# documents whose terms are counted at once
COUNT_ROWS = 512
# scores of documents and queries that a task adds up at once
SCORE_CELLS = 1_000_000
# terms whose documents a task counts before it hands the counts on
FREQUENCY_ROWS = 500_000
NOTHING = np.zeros(0)


# ---------------------------------------------------------------- vectors in Arrow

def stack(dims: pa.Array, ws: pa.Array, size: int) -> np.ndarray:
    """Rows of (dims, ws) as a dense matrix; a row without dims is dense already."""
    n = len(ws)
    lens = pc.fill_null(pc.list_value_length(ws), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.asarray(ws.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    rows = np.repeat(np.arange(n), lens)
    cols = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
    if dims is not None and dims.null_count < n:
        named = np.repeat(dims.is_valid().to_numpy(zero_copy_only=False), lens)
        cols[named] = dims.flatten().to_numpy(zero_copy_only=False)
    m = np.zeros((n, size), dtype=np.float64)
    m[rows, cols] = flat
    return m


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows scaled to unit length; zero rows stay."""
    norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, norm, out=np.zeros_like(m, dtype=np.float64), where=norm > 0)


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """A list array of numpy rows."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat).cast(kind))


# ---------------------------------------------------------------- terms of texts

# the separators of terms in UTF-8 (functions.text: PUNCT_CLASS, WS_CHARS): those of one byte, then of two and three
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[*range(0x09, 0x0e), *range(0x1c, 0x30), *range(0x3a, 0x41), *range(0x5b, 0x61), *range(0x7b, 0x7f)]] = True
LEADS = np.isin(np.arange(256), [0xc2, 0xe1, 0xe2, 0xe3])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5b] += 0x20
WIDE = [c.encode() for c in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200b)))]
# capital letters of Unicode 16, which Python's tables may lack and Spark's have
NEW_CAPITALS = {0x1c89: 0x1c8a, 0xa7cb: 0x264, 0xa7cc: 0xa7cd, 0xa7da: 0xa7db, 0xa7dc: 0x19b} | {c: c + 0x20 for c in range(0x10d50, 0x10d66)}


def words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words, rows): the runs between separators of all texts, A to Z in lower case, and the row of each; null and empty
    texts have none."""
    if text.null_count:
        text = pc.fill_null(text, "")
    n = len(text)
    _, ends, data = text.buffers()
    ends = np.frombuffer(ends, np.int32)[text.offset:text.offset + n + 1] if n else np.zeros(1, np.int32)
    data = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if ends[-1] > ends[0] else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    inside = ~SEPARATOR[data]
    leads = np.flatnonzero(LEADS[data])
    for mark in WIDE if len(leads) else ():
        at = leads[leads <= len(data) - len(mark)]
        for i, byte in enumerate(mark):
            at = at[data[at + i] == byte]
        for i in range(len(mark)):
            inside[at + i] = False
    # a word begins and ends at a separator or at the border of a row
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begin = ends[:-1][ends[:-1] < ends[1:]]
    first[begin] = inside[begin]
    stop = ends[1:][ends[:-1] < ends[1:]] - 1
    last[stop] = inside[stop]
    first, last = np.flatnonzero(first), np.flatnonzero(last)
    offsets = np.zeros(len(first) + 1, np.int32)
    np.cumsum(last - first + 1, out=offsets[1:])
    rows = np.repeat(np.arange(n), np.diff(np.searchsorted(first, ends)))
    return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(LOWER[data[inside]])), rows


def coded_terms(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(terms, codes, rows): the distinct words of all texts in lower case, and of each word its term and its row. The words are those
    of ``functions.text.normalize``: lower case depends on letters of the same word at most."""
    found, rows = words(text)
    coded = found.dictionary_encode()
    terms, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    wide = pc.not_equal(pc.utf8_length(terms), pc.binary_length(terms))
    as_found = terms.filter(wide).to_pylist()
    lower = [w.lower().translate(NEW_CAPITALS) for w in as_found]
    if lower != as_found:
        coded = pc.replace_with_mask(terms, wide, pa.array(lower, pa.string())).dictionary_encode()
        terms, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[codes]
    return terms, codes, rows


def _counts(text: pa.Array):
    """(terms, rows, places, counts) of the distinct terms of each text, in row order; a text without a word has the term "", null
    has none."""
    terms, codes, rows = coded_terms(text)
    k = len(terms) + 1
    bare = np.ones(len(text), bool)
    bare[rows] = False
    bare &= text.is_valid().to_numpy(zero_copy_only=False)
    bare = np.flatnonzero(bare)
    code = rows * k + codes
    if len(bare):
        terms = pa.concat_arrays([terms, pa.array([""], pa.string())])
        code = np.concatenate([code, bare * k + k - 1])
    code, n = np.unique(code, return_counts=True)
    return terms, code // k, code % k, n


def count_terms_fn(kept: list[str]):
    """mapInArrow body: (kept..., text) -> (term, kept..., tf), a row per distinct term of each row."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), COUNT_ROWS):
                b = whole.slice(start, COUNT_ROWS)
                terms, rows, at, n = _counts(b.column(len(kept)))
                rows = pa.array(rows)
                yield pa.RecordBatch.from_arrays([terms.take(pa.array(at)), *[c.take(rows) for c in b.columns[:len(kept)]], pa.array(n, pa.int64())],
                                                 names=["term", *kept, "tf"])
    return fn


def pack_terms_fn():
    """mapInArrow body: (url, dl, text) -> (url, dl, terms, tfs): the distinct terms of each row with a space between
    them, and how often each occurs. Null has none."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), COUNT_ROWS):
                b = whole.slice(start, COUNT_ROWS)
                terms, rows, at, n = _counts(b.column(2))
                offsets = pa.array(np.searchsorted(rows, np.arange(len(b) + 1)).astype(np.int32))
                joined = pc.binary_join(pa.ListArray.from_arrays(offsets, terms.take(pa.array(at))), " ")
                if b.column(2).null_count:
                    joined = pc.if_else(b.column(2).is_valid(), joined, pa.scalar(None, pa.string()))
                yield pa.RecordBatch.from_arrays([*b.columns[:2], joined, pa.ListArray.from_arrays(offsets, pa.array(n, pa.int32()))],
                                                 names=["url", "dl", "terms", "tfs"])
    return fn


def packed_frequency_fn():
    """mapInArrow body: (terms) -> (term, df): in how many packed rows of a task each term occurs; counts beyond FREQUENCY_ROWS are handed on."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray]] = []

        def summed():
            coded = pa.concat_arrays([t for t, _ in held]).dictionary_encode()
            df = np.bincount(coded.indices.to_numpy(zero_copy_only=False), weights=np.concatenate([n for _, n in held]), minlength=len(coded.dictionary))
            return coded.dictionary, df.astype(np.int64)

        for whole in batches:
            for start in range(0, len(whole), 4 * COUNT_ROWS):
                coded = pc.split_pattern(whole.slice(start, 4 * COUNT_ROWS).column(0), " ").flatten().dictionary_encode()
                held.append((coded.dictionary, np.bincount(coded.indices.to_numpy(zero_copy_only=False), minlength=len(coded.dictionary))))
                if sum(len(t) for t, _ in held) > 2 * FREQUENCY_ROWS:
                    held = [summed()]
                    if len(held[0][0]) > FREQUENCY_ROWS:
                        yield pa.RecordBatch.from_arrays([held[0][0], pa.array(held[0][1])], names=["term", "df"])
                        held = []
        if held:
            yield pa.RecordBatch.from_arrays([*map(pa.array, summed())], names=["term", "df"])
    return fn


def terms_among_fn(wanted: list[str], kept: int):
    """mapInArrow body: (kept..., text) -> (kept..., term): a row for each of the ``wanted`` terms that a text has."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(wanted, pa.string())
        for whole in batches:
            for start in range(0, len(whole) if wanted else 0, COUNT_ROWS):
                b = whole.slice(start, COUNT_ROWS)
                terms, codes, rows = coded_terms(b.column(kept))
                place = pc.fill_null(pc.index_in(terms, value_set=known), -1).to_numpy(zero_copy_only=False)[codes]
                found = np.unique(rows[place >= 0] * len(wanted) + place[place >= 0])
                at = pa.array(found // len(wanted))
                yield pa.RecordBatch.from_arrays([*[c.take(at) for c in b.columns[:kept]], known.take(pa.array(found % len(wanted)))],
                                                 names=[*b.schema.names[:kept], "term"])
    return fn


def lexical_fn(weights: list[tuple], id_type: pa.DataType, avdl: float | None, k1: float, b: float, grouped: bool = False):
    """mapInArrow body: packed postings (url, dl, terms, tfs) -> (query_id, url, lex) of every query with a term of the document: the sum
    of weight * tf (k1 + 1) / (tf + k1 (1 - b + b dl / avdl)). ``weights``: (query_id, term, weight), each pair once. ``grouped``: a row
    per document with a match, (url, list of (query_id, lex))."""
    ids = list(dict.fromkeys(q for q, _, _ in weights))
    number = {q: i for i, q in enumerate(ids)}
    terms = list(dict.fromkeys(t for _, t, _ in weights))
    place = {t: i for i, t in enumerate(terms)}
    at = np.asarray([place[t] for _, t, _ in weights], dtype=np.int64)
    order = np.argsort(at, kind="stable")
    # the queries and weights of a term lie together
    first = np.searchsorted(at[order], np.arange(len(terms) + 1))
    query = np.asarray([number[q] for q, _, _ in weights], dtype=np.int64)[order]
    weight = np.asarray([w for _, _, w in weights], dtype=np.float64)[order]
    step = max(1, min(COUNT_ROWS // 2, SCORE_CELLS // max(1, len(ids))))

    def one(p: pa.RecordBatch, known: pa.Array, asked: pa.Array):
        parts = pc.split_pattern(p.column(2), " ")
        rows = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        term = pc.fill_null(pc.index_in(parts.flatten(), value_set=known), -1).to_numpy(zero_copy_only=False)
        hit = np.flatnonzero(term >= 0)
        if not len(hit):
            return
        term, rows, tf = term[hit], rows[hit], p.column(3).flatten().to_numpy(zero_copy_only=False)[hit].astype(np.float64)
        dl = p.column(1).to_numpy(zero_copy_only=False)[rows].astype(np.float64)
        if not avdl:
            raise ZeroDivisionError("the documents have no length")
        part = tf * (k1 + 1.0) / (tf + k1 * ((1.0 - b) + b * dl / avdl))
        n = first[term + 1] - first[term]
        each = np.repeat(first[term] - np.cumsum(n) + n, n) + np.arange(n.sum())
        cell = np.repeat(rows * len(ids), n) + query[each]
        lex = np.bincount(cell, weights=np.repeat(part, n) * weight[each], minlength=len(p) * len(ids))
        there = np.zeros(len(lex), bool)
        there[cell] = True
        there = np.flatnonzero(there)
        if grouped:
            mine, begin = np.unique(there // len(ids), return_index=True)
            matches = pa.StructArray.from_arrays([asked.take(pa.array(there % len(ids))), pa.array(lex[there])], names=["query_id", "lex"])
            yield pa.RecordBatch.from_arrays([p.column(0).take(pa.array(mine)), pa.ListArray.from_arrays(pa.array(np.append(begin, len(there)).astype(np.int32)), matches)],
                                             names=["url", "matches"])
            return
        yield pa.RecordBatch.from_arrays([asked.take(pa.array(there % len(ids))), p.column(0).take(pa.array(there // len(ids))), pa.array(lex[there])],
                                         names=["query_id", "url", "lex"])

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, asked = pa.array(terms, pa.string()), pa.array(ids, id_type)
        for whole in batches:
            for start in range(0, len(whole) if terms else 0, step):
                yield from one(whole.slice(start, step), known, asked)
    return fn


def pack_postings_fn():
    """mapInArrow body: (url, dl, id, tf) -> (url, dl, ids, tfs), a row per run of rows of the same url and length."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            url, dl, ids, tfs = b.columns
            ends = [pc.run_end_encode(c).run_ends.to_numpy() for c in (url, dl)]
            ends = np.union1d(*ends).astype(np.int32)
            offsets = pa.array(np.concatenate([np.zeros(1, np.int32), ends]))
            at = pa.array(ends - 1)
            yield pa.RecordBatch.from_arrays([url.take(at), dl.take(at), pa.ListArray.from_arrays(offsets, ids), pa.ListArray.from_arrays(offsets, tfs)],
                                             names=["url", "dl", "ids", "tfs"])
    return fn


def row_frequency_fn():
    """mapInArrow body: (text) -> (term, df): in how many rows of a piece each term occurs."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), 4 * COUNT_ROWS):
                terms, _, at, _ = _counts(whole.slice(start, 4 * COUNT_ROWS).column(0))
                yield pa.RecordBatch.from_arrays([terms, pa.array(np.bincount(at, minlength=len(terms)), pa.int64())], names=["term", "df"])
    return fn


# ---------------------------------------------------------------- hashed embedding

def _slot(feature: bytes, size: int) -> int:
    """Dimension and sign of a feature in one number: md5's first seven hex digits modulo the size, its eighth the sign."""
    h = int.from_bytes(hashlib.md5(feature).digest()[:4], "big")
    return (h >> 4) % size * 2 + (h & 15 >= 8)


def word_features(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    return coded_terms(texts)


def trigram_features(terms: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct trigrams, codes, rows) of '#term#'; '' has none."""
    framed = [f"#{t or ''}#" for t in terms.to_pylist()]
    found = [t[i:i + 3] for t in framed for i in range(len(t) - 2)]
    coded = pa.array(found, pa.string()).dictionary_encode()
    rows = np.repeat(np.arange(len(framed)), np.asarray([max(0, len(t) - 2) for t in framed], dtype=np.int64))
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), rows


def hash_batch(features, size: int):
    """A function texts (Arrow) -> (dims, ws) lists: signed counts of hashed features, unit length; no features, no entries.
    ``features`` gives the distinct ones of all texts at once, and of each occurrence its feature and its row. ``counts``: how
    often each occurs, instead of once."""
    memo: dict[bytes, int] = {}

    def slot(f):
        got = memo.get(f)
        if got is None:
            got = _slot(f, size)
            if len(memo) < MEMO:
                memo[f] = got
        return got

    def fn(texts: pa.Array | list[str | None], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], list[np.ndarray]]:
        distinct, code, rows = features(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        code = np.fromiter(map(slot, distinct.cast(pa.binary()).to_pylist()), np.int64, len(distinct))[code]
        cell, n = rows * size + (code >> 1), len(texts) * size
        there = np.flatnonzero(np.bincount(cell, minlength=n))
        sign = 1.0 - 2.0 * (code & 1)
        w = np.bincount(cell, weights=sign if counts is None else sign * counts, minlength=n)[there]
        # sums of whole numbers: the same in any order
        norm = np.sqrt(np.bincount(there // size, weights=w * w, minlength=len(texts)))[there // size]
        w = np.divide(w, norm, out=np.zeros(len(w)), where=norm > 0)
        edges = np.searchsorted(there // size, np.arange(1, len(texts)))
        return (np.split((there % size).astype(np.int32), edges), np.split(w, edges)) if len(texts) else ([], [])
    return fn


def listed_terms(terms: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(terms, codes, rows) of packed terms."""
    parts = pc.split_pattern(terms, " ")
    rows, coded = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False).astype(np.int64), parts.flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), rows


def embed_counts_fn(size: int):
    """mapInArrow body: packed postings (url, terms, tfs) -> (url, dims, ws), the vectors of the words of the texts."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = hash_batch(listed_terms, size)
        for whole in batches:
            for start in range(0, len(whole), BLOCK_ROWS):
                b = whole.slice(start, BLOCK_ROWS)
                # a text without words has the empty term, which carries no weight
                some = pc.fill_null(pc.not_equal(b.column(1), ""), False)
                mine = b.filter(some)
                found = iter(zip(*batch(mine.column(1), mine.column(2).flatten().to_numpy(zero_copy_only=False))))
                d, w = zip(*(next(found) if there else (NOTHING, NOTHING) for there in some.to_pylist()))
                yield pa.RecordBatch.from_arrays([b.column(0), lists(d, pa.int32()), lists(w, pa.float64())], names=["url", "dims", "ws"])
    return fn


def embed_fn(batch, keys: list[str], dense: bool):
    """mapInArrow body: (keys..., text) -> (keys..., dims, ws). ``batch`` gives sparse lists, or a matrix if ``dense``."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), BLOCK_ROWS):
                b = whole.slice(start, BLOCK_ROWS)
                yield pa.RecordBatch.from_arrays([*b.columns[:len(keys)], *embedded(batch, b.column(len(keys)), dense)], names=[*keys, "dims", "ws"])
    return fn


def embedded(batch, texts: pa.Array, dense: bool) -> tuple[pa.Array, pa.Array]:
    """(dims, ws) of a piece of a batch of texts."""
    if dense:
        m = unit_rows(np.asarray(batch([t or "" for t in texts.to_pylist()]), dtype=np.float64).reshape(len(texts), -1))
        return pa.nulls(len(texts), pa.list_(pa.int32())), lists(list(m), pa.float64())
    d, w = batch(texts)
    return lists(d, pa.int32()), lists(w, pa.float64())


# ---------------------------------------------------------------- seed set

def best_seed_fn(seed_seq: np.ndarray, seed_url: list, seed_mat: np.ndarray, kept: list[str], normalize: bool = False):
    """mapInArrow body over (kept..., seq, dims, ws): the kept columns and n_pred, seed_url, sim. The seed set has a
    fixed size and is sorted by position, so argmax's first maximum is the earliest seed among equals."""
    seed_url = np.asarray(seed_url, dtype=object)
    size = seed_mat.shape[1]
    if normalize:
        seed_mat = unit_rows(seed_mat)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), BLOCK_ROWS):
                yield one(whole.slice(start, BLOCK_ROWS))

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        n, at = len(b), len(kept)
        x = stack(b.column(at + 1), b.column(at + 2), size)
        if normalize:
            x = unit_rows(x)
        seq = b.column(at).to_numpy(zero_copy_only=False)
        eligible = seed_seq[None, :] < seq[:, None]
        n_pred = eligible.sum(axis=1)
        ok = n_pred >= 2
        url, sim = np.full(n, None, dtype=object), np.full(n, np.nan)
        if len(seed_seq):
            sims = np.where(eligible, np.round(x @ seed_mat.T, ROUND), -np.inf)
            best = sims.argmax(axis=1)
            url[ok], sim[ok] = seed_url[best[ok]], sims[np.arange(n), best][ok]
        kind = pa.int64() if len(seed_url) and not isinstance(seed_url[0], str) else pa.string()
        return pa.RecordBatch.from_arrays(
            [*b.columns[:at], pa.array(n_pred, pa.int64()), pa.array(url.tolist(), kind), pa.array(sim, mask=~ok)],
            names=[*kept, "n_pred", "seed_url", "sim"])
    return fn


def pick_seed_fn(batch, dense: bool, seed_seq: np.ndarray, seed_url: list, seed_mat: np.ndarray):
    """Arrow function (prepared texts, positions) -> (n_pred, seed_url, sim): a text's vector is made and compared piece by
    piece, so a worker holds the vectors of one piece and no other column of the rows."""
    compare = best_seed_fn(seed_seq, seed_url, seed_mat, [])
    kind = pa.struct([("n_pred", pa.int64()), ("seed_url", pa.string()), ("sim", pa.float64())])

    def fn(texts: pa.Array, seq: pa.Array) -> pa.Array:
        out = []
        for start in range(0, len(texts), BLOCK_ROWS):
            piece = seq.slice(start, BLOCK_ROWS)
            b = pa.RecordBatch.from_arrays([piece, *embedded(batch, texts.slice(start, BLOCK_ROWS), dense)], names=["seq", "dims", "ws"])
            out += [pa.StructArray.from_arrays(r.columns, fields=list(kind)) for r in compare([b])]
        return pa.concat_arrays(out) if out else pa.array([], kind)
    return fn


def fold_seeds_fn(batch, dense: bool, size: int, threshold: float):
    """applyInPandas body over the seed rows (url, doc_seq, text, prepared, ws): each expanded by the best of those before it as
    expanded. Without ``batch`` the vectors in ``ws`` stand for the rows, whatever their texts become."""
    def vector(prepared, ws):
        if batch is None:
            return np.resize(np.asarray(ws, dtype=np.float64), size) if len(ws) else np.zeros(size)
        if dense:
            return unit_rows(np.asarray(batch([prepared]), dtype=np.float64).reshape(1, -1))[0]
        (dims,), (weights,) = batch([prepared])
        v = np.zeros(size)
        v[dims] = weights
        return v

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_seq").reset_index(drop=True)
        texts, prepared, vectors, chosen, sims = list(pdf["text"]), list(pdf["prepared"]), [], [], []
        for i in range(len(pdf)):
            mine, seed, sim = vector(prepared[i], pdf["ws"][i]), None, None
            if i >= 2:
                products = np.round(np.stack(vectors) @ mine, ROUND)
                best = int(products.argmax())
                if products[best] > threshold:
                    seed, sim = pdf["url"][best], float(products[best])
                    texts[i], prepared[i] = f"{texts[i]} {texts[best]}", f"{prepared[i]} {prepared[best]}"
                    mine = vector(prepared[i], pdf["ws"][i])
            vectors.append(mine)
            chosen.append(seed)
            sims.append(sim)
        return pd.DataFrame({"url": pdf["url"], "doc_seq": pdf["doc_seq"], "text": texts, "seed_url": pd.Series(chosen, dtype=object),
                             "sim": pd.Series(sims, dtype=float)})
    return fold


# ---------------------------------------------------------------- block products

def pack_fn(rows: int, size: int, key_type: pa.DataType):
    """mapInArrow body: (key, dims, ws) -> (keys, mat): blocks of at most ``rows`` rows as one float64 matrix each."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0

        def blocks(last: bool):
            nonlocal held, n
            table = pa.Table.from_batches(held).combine_chunks()
            end = n if last else n // rows * rows
            for start in range(0, end, rows):
                part = table.slice(start, min(rows, end - start)).to_batches()[0]
                yield pa.RecordBatch.from_arrays([pa.array([part.column(0).to_pylist()], pa.list_(key_type)), pa.array(
                    [stack(part.column(1), part.column(2), size).tobytes()], pa.binary())], names=["keys", "mat"])
            held = table.slice(end).to_batches()
            n -= end

        for b in batches:
            if len(b):
                held.append(b)
                n += len(b)
            if n >= rows:
                yield from blocks(False)
        if n:
            yield from blocks(True)
    return fn


def nearest_fn(keep: int, size: int, query_type: pa.DataType):
    """mapInArrow body over pairs of blocks (keys, mat, q_keys, q_mat) -> (q_key, key, sim): the ``keep`` best
    rounded products per query of the task, ties by key. Heaps beyond HEAP_ENTRIES are handed on, which a later cut makes good."""
    names = ["q_key", "key", "sim"]

    def best(q: np.ndarray, keys: np.ndarray, sims: np.ndarray):
        """Of entries (query number, key, sim) the best ``keep`` of each query."""
        _, key_rank = np.unique(keys, return_inverse=True)
        order = np.lexsort((key_rank, -sims, q))
        q, keys, sims = q[order], keys[order], sims[order]
        place = np.arange(len(q)) - np.searchsorted(q, q, side="left")
        top = place < keep
        return q[top], keys[top], sims[top]

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[tuple, tuple] = {}

        def hand_on():
            for q_keys, (q, keys, sims) in heaps.items():
                yield pa.RecordBatch.from_arrays([pa.array([q_keys[i] for i in q], query_type), pa.array(keys.tolist(), pa.string()), pa.array(sims)], names=names)
            heaps.clear()

        for b in batches:
            for i in range(len(b)):
                keys = np.asarray(b.column(0)[i].as_py(), dtype=object)
                q_keys = tuple(b.column(2)[i].as_py())
                x = np.frombuffer(b.column(1)[i].as_buffer(), np.float64).reshape(len(keys), size)
                y = np.frombuffer(b.column(3)[i].as_buffer(), np.float64).reshape(len(q_keys), size)
                sims = np.round(y @ x.T, ROUND)                                   # queries x rows
                if len(keys) > keep:
                    cut = np.partition(sims, len(keys) - keep, axis=1)[:, len(keys) - keep]
                    q, at = np.nonzero(sims >= cut[:, None])
                else:
                    q, at = (a.reshape(-1) for a in np.indices(sims.shape))
                old = heaps.get(q_keys, (np.zeros(0, np.int64), np.zeros(0, object), np.zeros(0)))
                heaps[q_keys] = best(np.concatenate([old[0], q]), np.concatenate([old[1], keys[at]]), np.concatenate([old[2], sims[q, at]]))
            if sum(len(h[0]) for h in heaps.values()) > HEAP_ENTRIES:
                yield from hand_on()
        yield from hand_on()
    return fn


def products_fn(size: int, query_type: pa.DataType):
    """mapInArrow body over pairs of blocks -> (q_key, key, cos): all products, for whoever asks for every pair."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                keys, q_keys = pa.array(b.column(0)[i].as_py(), pa.string()), pa.array(b.column(2)[i].as_py(), query_type)
                x = np.frombuffer(b.column(1)[i].as_buffer(), np.float64).reshape(len(keys), size)
                y = np.frombuffer(b.column(3)[i].as_buffer(), np.float64).reshape(len(q_keys), size)
                step = max(1, PRODUCT_ROWS // max(1, len(keys)))
                for start in range(0, len(q_keys), step):
                    cos = y[start:start + step] @ x.T
                    q, at = (pa.array(a.reshape(-1)) for a in np.indices(cos.shape))
                    yield pa.RecordBatch.from_arrays([q_keys.slice(start, step).take(q), keys.take(at), pa.array(cos.reshape(-1))], names=["q_key", "key", "cos"])
    return fn


def scores_fn(query_ids: list, query_mat: np.ndarray, w_lex: float, w_sem: float):
    """mapInArrow body over documents with their lexical scores (url, dims, ws, lex: list of (query_id, lex)) -> (query_id, url,
    lex, cos, score) for every query. A document without a vector (``ws`` null) has its matches only."""
    ids = pa.array(query_ids, pa.int64())
    known = np.unique(np.asarray([q for q in query_ids if q is not None], dtype=np.int64))
    # the column of each query among the known ids; a null id is no query's match
    column = np.asarray([len(known) if q is None else np.searchsorted(known, q) for q in query_ids], dtype=np.int64)
    size = query_mat.shape[1]

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), BLOCK_ROWS // 4):
                b = whole.slice(start, BLOCK_ROWS // 4)
                n = len(b)
                cos, lex, found = stack(b.column(1), b.column(2), size) @ query_mat.T, np.zeros((n, len(known) + 1)), np.zeros((n, len(known) + 1), bool)
                rows, flat = pc.list_parent_indices(b.column(3)).to_numpy(zero_copy_only=False), b.column(3).flatten()
                named = flat.field(0).is_valid().to_numpy(zero_copy_only=False)
                q, s = flat.field(0).drop_null().to_numpy(zero_copy_only=False), flat.field(1).to_numpy(zero_copy_only=False)[named]
                place = (rows[named], np.searchsorted(known, q))
                lex[place], found[place] = s, True
                lex, found = lex[:, column], found[:, column]
                given = found | b.column(2).is_valid().to_numpy(zero_copy_only=False)[:, None]
                at, col = np.nonzero(given)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(col)), b.column(0).take(pa.array(at)), pa.array(lex[given]), pa.array(cos[given]), pa.array((w_lex * lex + w_sem * cos)[given])],
                    names=["query_id", "url", "lex", "cos", "score"])
    return fn


def count_fn(size: int, weight: float):
    """mapInArrow body over pairs of blocks with the queries' judged rows (keys, mat, q_keys, q_mat, judged) ->
    (query_id, url, n_before): how many rows of the task come before each judged one, by weight * product."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict = {}
        for b in batches:
            for i in range(len(b)):
                keys = np.asarray(b.column(0)[i].as_py(), dtype=object)
                q_keys = b.column(2)[i].as_py()
                x = np.frombuffer(b.column(1)[i].as_buffer(), np.float64).reshape(len(keys), size)
                y = np.frombuffer(b.column(3)[i].as_buffer(), np.float64).reshape(len(q_keys), size)
                scores = np.round(weight * (y @ x.T), ROUND)
                for k, (q, judged) in enumerate(zip(q_keys, b.column(4)[i].as_py())):
                    if q not in counters:
                        counters[q] = Counters([j["s"] for j in judged], [j["url"] for j in judged])
                    counters[q].add(scores[k], keys)
        yield from counted(counters)
    return fn


# ---------------------------------------------------------------- rank counting

class Counters:
    """How many (score, key) rows come before each judged one: higher score, or the same and a smaller key."""

    def __init__(self, scores: list[float], urls: list[str]):
        order = sorted(range(len(urls)), key=lambda i: (-scores[i], urls[i]))
        self.urls = np.asarray([urls[i] for i in order], dtype=object)
        self.falling = -np.asarray([scores[i] for i in order], dtype=np.float64)
        self.n = np.zeros(len(order) + 1, np.int64)

    def add(self, scores: np.ndarray, keys: np.ndarray) -> None:
        low, high = np.searchsorted(self.falling, -scores, side="left"), np.searchsorted(self.falling, -scores, side="right")
        tied = low < high
        self.n += np.bincount(low[~tied], minlength=len(self.n))
        for l, h in {*zip(low[tied].tolist(), high[tied].tolist())}:
            # among judged rows of the same score the key decides
            at = l + np.searchsorted(self.urls[l:h], keys[tied & (low == l)], side="right")
            self.n += np.bincount(at, minlength=len(self.n))

    def before(self) -> np.ndarray:
        """Rows before each judged row (in their order); a row's place is the number of judged rows up to it, so it is not before itself."""
        return np.cumsum(self.n)[:-1]


def counted(counters: dict) -> Iterator[pa.RecordBatch]:
    for q, c in counters.items():
        if len(c.urls):
            yield pa.RecordBatch.from_arrays([pa.array([q] * len(c.urls), pa.int64()), pa.array(c.urls.tolist(), pa.string()), pa.array(c.before())],
                                             names=["query_id", "url", "n_before"])


def count_rows_fn():
    """mapInArrow body over (query_id, salt, url, s, judged) sorted by these with a group's judged rows first (``judged`` true):
    (query_id, url, n_before) counted over the other rows of the group."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, names, scores, counter = None, [], [], None

        def ended():
            if group is not None and names:
                yield from counted({group[0]: counter or Counters(scores, names)})

        for b in batches:
            query, salt = b.column(0).to_numpy(), b.column(1).to_numpy()
            urls, s, judged = np.asarray(b.column(2).to_pylist(), dtype=object), b.column(3).to_numpy(), b.column(4).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((query[1:] != query[:-1]) | (salt[1:] != salt[:-1])) + 1
            for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(b)]):
                if start == end:
                    continue
                if (query[start], salt[start]) != group:
                    yield from ended()
                    group, names, scores, counter = (query[start], salt[start]), [], [], None
                own = judged[start:end].astype(bool)
                names += urls[start:end][own].tolist()
                scores += s[start:end][own].tolist()
                if not own.all() and names:
                    counter = counter or Counters(scores, names)
                    counter.add(s[start:end][~own], urls[start:end][~own])
        yield from ended()
    return fn


def near_judged_fn(w_lex: float, margin: float):
    """mapInArrow body over the same rows, ``s`` a lexical score (null for judged rows, whose score is in ``at``): the rows whose
    final score, w_lex * s give or take ``margin``, may fall beside a judged one (``sure`` false), and per judged row how
    many of the others come before it (``sure`` true, their number in ``n``)."""
    names = ["query_id", "url", "lex", "sure", "n"]

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, urls_of, scores, falling, n = None, [], [], None, None

        def ended():
            if group is not None and urls_of:
                before = np.cumsum(n)[:-1] if n is not None else np.zeros(len(urls_of), np.int64)
                ordered = [urls_of[i] for i in np.argsort(-np.asarray(scores), kind="stable")]
                k = len(ordered)
                yield pa.RecordBatch.from_arrays([pa.array([group[0]] * k, pa.int64()), pa.array(ordered, pa.string()), pa.nulls(k, pa.float64()),
                                                  pa.array([True] * k), pa.array(before, pa.int64())], names=names)

        for b in batches:
            query, salt = b.column(0).to_numpy(), b.column(1).to_numpy()
            urls, s, judged = np.asarray(b.column(2).to_pylist(), dtype=object), b.column(3).to_numpy(), b.column(4).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((query[1:] != query[:-1]) | (salt[1:] != salt[:-1])) + 1
            for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(b)]):
                if start == end:
                    continue
                if (query[start], salt[start]) != group:
                    yield from ended()
                    group, urls_of, scores, falling, n = (query[start], salt[start]), [], [], None, None
                own = judged[start:end].astype(bool)
                urls_of += urls[start:end][own].tolist()
                scores += s[start:end][own].tolist()
                if own.all() or not urls_of:
                    continue
                if falling is None:
                    falling, n = np.sort(-np.asarray(scores)), np.zeros(len(scores) + 1, np.int64)
                lex, names_here = s[start:end][~own], urls[start:end][~own]
                high = np.searchsorted(falling, -(w_lex * lex + margin), side="left")
                low = np.searchsorted(falling, -(w_lex * lex - margin), side="right")
                sure = high == low
                n += np.bincount(high[sure], minlength=len(n))
                k = int((~sure).sum())
                if k:
                    yield pa.RecordBatch.from_arrays([pa.array([group[0]] * k, pa.int64()), pa.array(names_here[~sure].tolist(), pa.string()), pa.array(lex[~sure]),
                                                      pa.array([False] * k), pa.nulls(k, pa.int64())], names=names)
        yield from ended()
    return fn


# ---------------------------------------------------------------- largest scores

def largest_fn(n: int):
    """mapInArrow body: (query_id, lex) -> the rows with the ``n`` largest values per query of the task (one of those that are equal)."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def cut() -> pa.RecordBatch:
            b = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            q = b.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            order = np.lexsort((-b.column(1).to_numpy(zero_copy_only=False), q))
            q = q[order]
            return b.take(pa.array(order[np.arange(len(q)) - np.searchsorted(q, q, side="left") < n]))

        for b in batches:
            if len(b):
                held.append(b)
                rows += len(b)
            if rows > LARGEST_ROWS:
                held = [cut()]
                if len(held[0]) > LARGEST_ROWS // 2:   # very many queries
                    yield held.pop()
                rows = sum(map(len, held))
        if held:
            yield cut()
    return fn


# ---------------------------------------------------------------- pairs

def pair_cos_fn(size: int, kept: list[str]):
    """mapInArrow body over (kept..., dims, ws, q_dims, q_ws): the kept columns and the product of the two vectors."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = len(kept)
        for whole in batches:
            for start in range(0, len(whole), BLOCK_ROWS * 4):
                b = whole.slice(start, BLOCK_ROWS * 4)
                x, y = stack(b.column(at), b.column(at + 1), size), stack(b.column(at + 2), b.column(at + 3), size)
                yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array((x * y).sum(axis=1))], names=[*kept, "cos"])
    return fn
