"""Benchmark decontamination by templates.

Numbers, units and names become typed placeholders, so a question with
other numbers or names keeps its template. A capital that opens a sentence
may be a name or not, so windows are read both ways, and a third time as
plain words, which finds copies whatever their capitals, line breaks and
number of placeholders are. Windows of template tokens are
hash-joined with the benchmark's windows. A hit counts if its slot values
are the benchmark's, or if its names are consistent: along one alignment, a
benchmark name stands for one document name. Numbers and units are free, as
two independent ones may be equal on one side.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import BROADCAST_BYTES, maybe_broadcast, released, written
from quarry.llm.pretoken import classes, kinds, strings

#: Words that are units when a number stands before them; fixed values.
UNITS = frozenset(
    "kg g mg lb lbs oz t ton tons km m cm mm mi mile miles ft feet inch inches yd l ml litre litres liter liters gal s "
    "sec second seconds min minute minutes h hr hour hours day days week weeks month months year years % percent usd "
    "eur gbp dollar dollars euro euros cent cents pound pounds k w kw v a hz mb gb tb mph kmh c f".split())
#: Runs of word characters, runs of digits (joined by a dot or comma between them), and marks, each by itself, are tokens.
_RUNS = re.compile(r"[^\W\d]+"), re.compile(r"\d+"), re.compile(r"[.!?\n%$€£]")
#: Bytes of text cut into tokens together; one longer text is alone.
CHUNK_BYTES = 1 << 20
#: The low bits of a slot value are its kind.
_KIND = 3
_VALUE = np.uint64((1 << 64) - 1 - _KIND)
_NUM, _NAME, _UNIT = (xxhash.xxh64_intdigest(x) for x in ("<num>", "<name>", "<unit>"))
_BREAK = np.uint64(xxhash.xxh64_intdigest("\n"))
#: Template token by slot kind.
_PLACEHOLDERS = np.array([0, _NUM, _UNIT, _NAME], np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_WINDOWS = "id bigint, whash bigint, pos int, slots array<bigint>, n_windows int, n_rich int, rich boolean"


@dataclass(frozen=True)
class Templates:
    """``window``: template tokens per window (a shorter text is one window).
    ``min_words``: plain words a window needs to match as a template, so that rows of placeholders match their own values only.
    ``coverage_pct``: share of an item's windows, or of those with ``min_words``, that a document must hold, with consistent names."""

    window: int = 8
    min_words: int = 3
    coverage_pct: int = 50


def _kinds(token: str) -> tuple[int, int]:
    """(hash of the lower-case token, kind, plus 4 for a unit): kind 0 word, 1 number, 2 capitalised, 3 sentence end."""
    low = token.lower()
    h = xxhash.xxh64_intdigest(low)
    if token.islower() and token.isalpha():
        return h, 4 * (low in UNITS)
    if token[0].isdigit():
        return h, 1
    if token in ".!?\n":
        return h, 3
    return h, (2 if token[0].isupper() and token[1:] != token[1:].upper() or len(token) > 1 and token.isupper() else 0) + 4 * (low in UNITS or token in "%$€£")


def _cut(texts: list[bytes]) -> tuple[pa.StringArray, np.ndarray]:
    """(tokens of all texts, how many of them stand before the end of each)."""
    ends = np.cumsum([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts) + bytes(4), np.uint8)
    kind, n = kinds(data, classes(*_RUNS)), len(data) - 4
    first = np.zeros(n + 4, bool)
    first[0] = first[ends] = True
    dots = np.flatnonzero((data[1:n] == 0x2E) | (data[1:n] == 0x2C)) + 1
    dots = dots[(kind[dots - 1] == 2) & (kind[dots + 1] == 2) & ~first[dots] & ~first[dots + 1]]
    kind[dots] = 2
    begin = first
    begin[1:] |= kind[1:] != kind[:-1]
    begin |= (kind == 3) & ((data & 0xC0) != 0x80)
    used = kind[:n] > 0
    at = np.flatnonzero(begin[:n][used])
    return strings(data[:n][used], at), np.searchsorted(at, np.append(0, np.cumsum(used))[ends])


def _rolled(token: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` tokens along the last axis: hashes of 1, 2, 4, ... tokens, joined by the bits of ``size``."""
    def join(a, b):
        with np.errstate(over="ignore"):
            h = a * _MIX
            h ^= b
            h *= _MIX
            h ^= h >> np.uint64(29)
            return h

    n, done, power, width = token.shape[-1] - size + 1, 0, token, 1
    h = np.full(token.shape[:-1] + (n,), size, np.uint64)
    while True:
        if size & width:
            h = join(h, power[..., done:done + n])
            done += width
        width *= 2
        if width > size:
            return h
        power = join(power[..., :power.shape[-1] - width // 2], power[..., width // 2:])


class Canon:
    """Token lists to template hashes. Keeps a bounded memo of tokens seen."""

    def __init__(self, conf: Templates, most: int = 400_000):
        self.conf, self.most, self.memo, self.row = conf, most, {}, struct.Struct("<QQ").pack

    def rows(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Of each text, in order, the hash and kind of each token. Reads ahead by CHUNK_BYTES."""
        chunk, size = [], 0
        for text in texts:
            raw = text.encode()
            if chunk and size + len(raw) > CHUNK_BYTES:
                yield from self._together(chunk)
                chunk, size = [], 0
            chunk.append(raw)
            size += len(raw)
        if chunk:
            yield from self._together(chunk)

    def _together(self, texts: list[bytes]) -> list[np.ndarray]:
        tokens, ends = _cut(texts)
        tokens = tokens.dictionary_encode()
        distinct, memo = tokens.dictionary.to_numpy(zero_copy_only=False).tolist(), self.memo
        if len(memo) > self.most:
            memo.clear()
        try:
            known = list(map(memo.__getitem__, distinct))
        except KeyError:
            for t in distinct:
                if t not in memo:
                    memo[t] = self.row(*_kinds(t))
            known = list(map(memo.__getitem__, distinct))
        rows = np.frombuffer(b"".join(known), np.uint64).reshape(-1, 2)[tokens.indices.to_numpy()]
        return np.split(rows, ends[:-1])

    def read(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.template(next(self.rows([text])))

    def template(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(value per template token, its slot kind by reading, template token by reading) of a text's rows.

        Readings: capitals that open a sentence are words; they are names; every token is a word."""
        kind, unit = (rows[:, 1] & np.uint64(3)).astype(np.int8), rows[:, 1] > 3
        ends = kind == 3
        if len(kind):
            before_end = np.concatenate([[True], ends[:-1]])
            solid = rows[:, 0] != _BREAK
            after_num = np.zeros(len(kind), bool)
            after_num[solid] = np.concatenate([[False], kind[solid][:-1] == 1])
        else:
            before_end = after_num = ends
        keep = ~ends
        value, capital, opening = rows[keep, 0], (kind == 2)[keep], before_end[keep]
        slot = ((kind == 1) + np.uint8(2) * ((kind != 1) & unit & after_num))[keep].astype(np.uint8)
        name = capital & (slot == 0)
        slots = np.zeros((3, len(value)), np.uint8)
        slots[:2] = slot
        slots[0][name & ~opening] = 3
        slots[1][name] = 3
        token = np.empty((3, len(value)), np.uint64)
        token[2] = value
        token[1] = np.where(slots[1] > 0, _PLACEHOLDERS.take(slots[1]), value)
        token[0] = np.where(name & opening, value, token[1])
        return value, slots, token

    def counted(self, read: tuple[np.ndarray, np.ndarray, np.ndarray], h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(counted by reading and window?, rich by the first reading?) of the windows of ``size`` tokens with hashes ``h``.

        A reading's window counts if it is rich and no reading before gives the same; as plain words any window counts."""
        plain = np.zeros((2, len(read[0]) + 1), np.int32)
        np.cumsum(read[1][:2] == 0, axis=1, out=plain[:, 1:])
        rich = plain[:, size:] - plain[:, :-size] >= min(self.conf.min_words, size)
        return np.stack([rich[0], rich[1] & ((h[1] != h[0]) | ~rich[0]),
                         ((h[2] != h[0]) | ~rich[0]) & ((h[2] != h[1]) | ~rich[1])]), rich[0]


def _texts(canon: Canon, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(id, rows) of the texts of (id, text) that are neither null nor empty and have an id."""
    for low in range(0, batch.num_rows, 256):
        part = batch.slice(low, 256)
        texts = [(k, t) for k, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) if k is not None and t]
        yield from zip([k for k, _ in texts], canon.rows(t for _, t in texts))


def _emit(conf: Templates, lengths: tuple[int, ...], wanted: np.ndarray | None):
    """mapInArrow body: rows (id, text) to windows; only those whose hash is in ``wanted``, if given.

    ``lengths``: window lengths below the usual one that some short item has; documents get windows of these lengths too."""
    some = None
    if wanted is not None:  # most windows end at this table of the first 20 bits
        some = np.zeros(1 << 20, bool)
        some[(wanted >> np.uint64(44)).astype(np.int64)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canon = Canon(conf)
        for batch in batches:
            ids, hashes, places, slots, counts, riches, rich_counts = [], [], [], [], [], [], []
            for key, rows in _texts(canon, batch):
                read = canon.template(rows)
                value, kinds, _ = read
                n = len(value)
                own = min(conf.window, n)
                for size in sorted({own, *(x for x in lengths if x < own)} - {0}):
                    h = _rolled(read[2], size)
                    if wanted is None:
                        which = at = None
                    else:
                        which, at = np.nonzero(some[(h >> np.uint64(44)).astype(np.int64)])
                        got = h[which, at]
                        same = wanted[np.minimum(np.searchsorted(wanted, got), len(wanted) - 1)] == got if len(at) else np.zeros(0, bool)
                        which, at = which[same], at[same]
                        if not len(at):
                            continue
                    counted, rich = canon.counted(read, h, size)
                    if wanted is None:
                        which, at = np.nonzero(counted)
                    else:
                        use = counted[which, at]
                        which, at = which[use], at[use]
                    n_rich = int(rich.sum())
                    for r, i in zip(which.tolist(), at.tolist()):
                        kind = kinds[r, i:i + size]
                        part = value[i:i + size] & _VALUE | kind.astype(np.uint64)
                        ids.append(key)
                        hashes.append(int(h[r, i].astype(np.int64)))
                        places.append(i)
                        slots.append(part[kind > 0].astype(np.int64).tolist())
                        counts.append(n - size + 1)
                        rich_counts.append(n_rich)
                        riches.append(bool(rich[i]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(places, pa.int32()),
                 pa.array(slots, pa.list_(pa.int64())), pa.array(counts, pa.int32()), pa.array(rich_counts, pa.int32()), pa.array(riches, pa.bool_())],
                names=["id", "whash", "pos", "slots", "n_windows", "n_rich", "rich"])
    return run


def _consistent(hits: Column) -> Column:
    """The windows of one alignment that count: those with the item's own values, and those whose names are all
    the ones that stand for the item's names in most windows (ties: the item's own name, then the largest hash)."""
    def is_name(p):
        return p["own"].bitwiseAND(F.lit(_KIND)) == 3

    def counted(names):
        return F.transform(F.array_distinct(names), lambda p: F.struct(
            p["own"].alias("own"), F.struct(F.size(F.filter(names, lambda q: q == p)).alias("n"), (p["own"] == p["got"]).alias("same"),
                                            p["got"].alias("got")).alias("rank"), p.alias("pair")))

    def chosen(ranked):
        best = F.filter(ranked, lambda p: ~F.exists(ranked, lambda q: (q["own"] == p["own"]) & (q["rank"] > p["rank"])))
        return F.transform(best, lambda p: p["pair"])

    def let(value, body):
        """``body`` of a value that is computed once."""
        return F.get(F.transform(F.array(value), body), 0)

    names = F.filter(F.flatten(F.transform(hits, lambda h: h["pairs"])), is_name)
    stands = let(let(names, counted), chosen)
    return let(stands, lambda good: F.filter(hits, lambda h: F.forall(h["pairs"], lambda p: p["own"] == p["got"]) | F.forall(
        h["pairs"], lambda p: ~is_name(p) | F.array_contains(good, p))))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", conf: Templates = Templates(), broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per leaked pair: ``doc_id, item_id, n_windows, n_matched, n_slots, n_changed, kind``
    (kind: ``verbatim`` if all slot values of the counted windows are the item's, else ``re-parameterised``).

    A document leaks an item if at least ``coverage_pct`` of the item's
    windows, or of those with ``min_words`` plain words, occur in it with the item's own slot values or with consistent names. Rows with a
    null id or a null or empty text on either side match nothing; repeated
    rows give the pair once; other columns are not read. Empty tables give
    an empty result. The benchmark's window hashes are broadcast as a
    filter if they take at most ``broadcast_bytes``; beyond that every
    window of the documents goes to the shuffled join."""
    items = benchmark.select(F.col(item_col).cast("bigint").alias("id"), F.col(item_text_col).alias("text"))
    keys = written(items.mapInArrow(_emit(conf, (), None), _WINDOWS).distinct(), "bench-windows")
    short = tuple(sorted(r[0] for r in written(items.mapInArrow(_lengths(conf), "n int").distinct(), "bench-lengths").collect()))
    n_hashes = keys.select("whash").distinct().count()
    wanted = None
    if n_hashes * 8 <= broadcast_bytes:
        wanted = np.sort(np.array([r[0] for r in keys.select("whash").distinct().collect()], np.int64).view(np.uint64))
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    found = texts.mapInArrow(released(_emit(conf, short, wanted)), _WINDOWS)
    b = keys.select(F.col("id").alias("item_id"), "whash", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"), "n_windows", "n_rich", "rich")
    hits = found.select(F.col("id").alias("doc_id"), "whash", "pos", "slots").join(maybe_broadcast(b, 128), "whash")
    hits = written(hits.filter(F.size("slots") == F.size("item_slots")).select(
        "doc_id", "item_id", "n_windows", "n_rich", (F.col("pos") - F.col("item_pos")).alias("shift"),
        F.struct(F.col("item_pos").alias("place"), "rich", F.arrays_zip(F.col("item_slots").alias("own"), F.col("slots").alias("got")).alias("pairs")).alias("hit")),
        "window-hits")
    pair = ["doc_id", "item_id", "n_windows", "n_rich"]
    # an item has a bounded number of tokens, so an alignment has a bounded number of windows and pairs
    per_shift = hits.groupBy(*pair, "shift").agg(F.collect_set("hit").alias("hits")).withColumn("hits", _consistent(F.col("hits")))
    pairs_of = F.array_distinct(F.flatten(F.col("hits.pairs")))
    changed = F.size(F.filter(pairs_of, lambda p: p["own"] != p["got"]))
    # alignments of one pair: the best covered ones first, each adds the places it covers
    pairs = (per_shift.withColumn("n_changed", changed).withColumn("n_slots", F.size(pairs_of))
             .select(*pair, F.explode("hits").alias("hit"), "n_changed", "n_slots")
             .groupBy(*pair, "hit.place", "hit.rich").agg(F.min(F.struct("n_changed", "n_slots")).alias("m"))
             .groupBy(*pair).agg(
                 F.count(F.lit(1)).cast("int").alias("n_matched"), F.count(F.when(F.col("rich"), 1)).alias("rich_matched"), F.max("m.n_slots").alias("n_slots"), F.max("m.n_changed").alias("n_changed")))
    enough = pairs.filter((F.col("n_matched") * 100 >= F.col("n_windows") * conf.coverage_pct)
                         | (F.col("n_rich") > 0) & (F.col("rich_matched") * 100 >= F.col("n_rich") * conf.coverage_pct))
    kind = F.when(F.col("n_changed") == 0, "verbatim").otherwise("re-parameterised")
    return enough.select("doc_id", "item_id", "n_windows", "n_matched", "n_slots", "n_changed", kind.alias("kind"))


def _lengths(conf: Templates):
    """mapInArrow body: template lengths of the texts shorter than a window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canon = Canon(conf)
        for batch in batches:
            sizes = {len(canon.template(rows)[0]) for rows in canon.rows(t for t in batch.column(1).to_pylist() if t)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(s for s in sizes if 0 < s < conf.window), pa.int32())], names=["n"])
    return run
