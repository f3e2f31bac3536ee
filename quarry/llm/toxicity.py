"""Toxicity of noisy text: a noisy channel is decoded before words are judged.

- A character model of orders 1 to 5 is counted over all words of the corpus, into a table of fixed
  size (hashed n-grams), so it can be shipped whatever the corpus.
- A token that holds marks or digits, or a letter twice in a row, and a chain of single
  characters with separators between them, open a lattice: a mark may stand for a letter, part two words or be
  noise; a repeated letter may be one too many; a separator may join or part. The Viterbi
  path through the lattice under the character model is the restored text.
- Restored words have a weight of evidence from labelled documents (the lower bound of
  their log odds of being in a toxic one, taken over the word and its openings), and a logistic model
  over a document's strongest words, fitted on labelled rows that the weights have not seen, gives the score.
"""

from __future__ import annotations

import math
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import maybe_broadcast, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What a mark or digit may stand for; fixed values.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il",
              "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i", "§": "s", "¢": "c", "¥": "y"}
#: Longest n-gram; an n-gram's bucket is its crc32 modulo the table size.
ORDER = 5
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_LETTER = re.compile(r"[^\W\d_]")
_PAIR, _TRIPLE = re.compile(r"(\w)\1"), re.compile(r"(\w)\1\1")
#: Single characters with one or two separators between them, four at least.
_SINGLE = r"(?:[^\W\d_]|[0-9@$!|+])"
_CHAIN = re.compile(rf"(?<![^\s.,;:*_\-]){_SINGLE}(?:[ .\-_*,]{{1,2}}{_SINGLE}){{3,}}(?![^\s.,;:!?*_\-])")
_EDGE = "\"'`.,;:?!()[]{}<>«»„“”‚‘’…–—-_*#%&$|~^/\\=+@"
#: Marks around a token that may be letters, three of a kind that are none, and marks that never are.
_OUTER = re.compile(r"[$!|+@]")
_RUN = re.compile(r"^([$!|+@])\1\1+|([$!|+@])\2\2+$")
_FRAME = "\"'`.,;:?()[]{}<>«»„“”‚‘’…–—-_#%&~^/\\="


@dataclass(frozen=True)
class Channel:
    """Costs (negative log probabilities) of the channel's moves."""

    stands_for: float = 1.5
    masked: float = 4.0
    noise: float = 3.0
    parts: float = 2.0
    joins: float = 0.2
    double: float = 2.5
    triple: float = 0.1
    drawn: float = 4.0


@dataclass(frozen=True)
class Learning:
    """``lm_bits``: size of the character table. ``weight_bits``: buckets of word evidence. ``openings``: lengths of a word's
    openings that count as evidence for it. ``z``: standard deviations below the log odds. ``least``: toxic
    documents that a bucket needs. ``rows``: labelled texts of each kind that train, about (all, or a share by hash of the digest);
    ``fit_rows``: rows (those of the smallest hashes) that fit the logistic model."""

    lm_bits: int = 21
    weight_bits: int = 20
    openings: tuple[int, ...] = (4, 5, 6)
    z: float = 1.645
    least: int = 2
    rows: int = 30_000
    fit_rows: int = 100_000


#: Bytes of tokens: marks that stand for no letter part them, A-Z in lower case (other capitals when a token is restored).
_TOKEN_BYTES = bytes(b + 32 if 65 <= b <= 90 else 32 if chr(b) in " \t\n\r\x0b\x0c.,;:?\"()[]{}<>/\\=~^%&#" else b for b in range(256))
#: What every chain over white space has within: single characters, the second of them behind a space.
_MAYBE = re.compile(rb" \S{1,2}[.,*_-]? {1,2}\S{1,2}[.,*_-]? {1,2}\S{1,2}[.,*_-]?(?![^\s.,;:!?*_-])")
#: The same for chains parted by the marks that part tokens.
_DOTTED = re.compile(rb"([.,])[^\s.,]{1,2}\1[^\s.,]{1,2}\1")


def tokens_of(data: bytes) -> list[bytes]:
    """The tokens of a text in UTF-8."""
    return data.translate(_TOKEN_BYTES).split()


class CharModel:
    """Interpolated character probabilities from the table of hashed n-gram counts."""

    def __init__(self, counts: np.ndarray):
        self.counts, self.size, self.memo = counts, len(counts), {}

    def count(self, gram: str) -> float:
        return float(self.counts[zlib.crc32(gram.encode("utf-8", "replace")) % self.size])

    def cost(self, context: str, char: str) -> float:
        """-log P(char | last characters of the word so far), by Witten-Bell-like weights between orders."""
        key = context + char
        got = self.memo.get(key)
        if got is None:
            if len(self.memo) > 500_000:
                self.memo.clear()
            p = 1e-4
            for k in range(min(len(context), ORDER - 1) + 1):
                past = context[len(context) - k:]
                total = self.count(past) if k else self.count("")
                p = (self.count(past + char) + 5 * p) / (total + 5) if total > 0 else p
            got = self.memo[key] = -math.log(min(p, 1.0))
        return got


def _moves(text: str, channel: Channel) -> list[list[tuple[str, float]]]:
    """For each character what it may emit ("" nothing, " " a border of words) at what cost."""
    out = []
    for i, ch in enumerate(text):
        if ch.isalpha():
            run = 1
            while i >= run and text[i - run] == ch:
                run += 1
            longer = i + 1 < len(text) and text[i + 1] == ch
            if run == 1:
                out.append([(ch, 0.0)])
            elif run == 2 and not longer:
                out.append([(ch, 0.0), ("", channel.double)])
            else:
                out.append([("", channel.triple), (ch, channel.triple if run == 2 else channel.drawn)])
            continue
        inside = 0 < i < len(text) - 1
        moves = [(c, channel.stands_for) for c in LOOKALIKES.get(ch, "")]
        if ch.isspace():
            moves.append((" ", 0.0))
        else:
            moves.append(("", channel.noise if inside else 0.5))
            if not ch.isdigit():
                moves.append((" ", channel.parts))
        if ch == "*" and inside and (text[i - 1].isalpha() or text[i + 1].isalpha()):
            moves += [(c, channel.masked) for c in _LETTERS]
        out.append(moves)
    return out


def _chain_moves(text: str, channel: Channel) -> list[list[tuple[str, float]]]:
    """The moves of a chain of single characters: separators join or part."""
    out = []
    for ch in text:
        if ch.isalpha():
            out.append([(ch, 0.0)])
        elif ch in LOOKALIKES:
            out.append([(c, channel.stands_for) for c in LOOKALIKES[ch]])
        else:
            out.append([("", channel.joins), (" ", channel.parts)])
    return out


def decode(moves: list[list[tuple[str, float]]], model: CharModel) -> str:
    """The cheapest emission of the lattice; a state is the last characters of the word so far ("^" opens it)."""
    states: dict[str, tuple[float, tuple | None]] = {"^": (0.0, None)}
    cost = model.cost
    for options in moves:
        following: dict[str, tuple[float, tuple | None]] = {}
        for context, (spent, path) in states.items():
            for char, price in options:
                total = spent + price
                if char == "":
                    after, trail = context, path
                elif char == " ":
                    if context != "^":
                        total += cost(context, "$")
                    after, trail = "^", (path, " ")
                else:
                    total += cost(context, char)
                    after, trail = (context + char)[1 - ORDER:], (path, char)
                best = following.get(after)
                if best is None or total < best[0]:
                    following[after] = (total, trail)
        states = following
    _, path = min(((spent + (cost(c, "$") if c != "^" else 0.0), p) for c, (spent, p) in states.items()), key=lambda x: x[0])
    out = []
    while path is not None:
        path, char = path
        out.append(char)
    return "".join(reversed(out))


class Memo(dict):
    """Values of a function by key; of at most ``most`` keys, then those of the last ``most`` before are looked up first."""

    def __init__(self, make, most: int = 300_000):
        self.make, self.most, self.before = make, most, {}

    def __missing__(self, key):
        got = self.before.get(key)
        if got is None:
            got = self.make(key)
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        self[key] = got
        return got


class Restorer:
    """Tokens to restored words."""

    def __init__(self, model: CharModel, channel: Channel = Channel()):
        self.model, self.channel = model, channel
        self.doubtful = Memo(self._doubtful)

    def _doubtful(self, around: str) -> bool:
        """Whether a letter twice in a row is rare behind what stands before it (the last letter and the pair are given)."""
        return self.model.count(around) < 0.02 * self.model.count(around[:-1])

    def _plain(self, word: str) -> bool:
        """Letters only, none three times in a row, no doubtful pair."""
        framed = "^" + word
        for m in _PAIR.finditer(framed):
            i = m.start()
            if framed[i + 2:i + 3] == framed[i] or self.doubtful[framed[i - 1:i + 2]]:
                return False
        return True

    def token(self, token: str) -> str:
        """The restored form of a token without white space; '' if it holds no letter."""
        low = token.lower()
        if " " in low or "\xa0" in low:   # white space beyond ASCII
            return " ".join(filter(None, map(self.token, low.split())))
        core = low.strip(_EDGE)
        if core.isalpha() and (len(core) == len(low) or not _OUTER.search(low)):
            if not _PAIR.search(core) or self._plain(core):
                return core
        elif not _LETTER.search(low):
            return ""
        noisy = _RUN.sub("", low.strip(_FRAME)).strip(_FRAME)
        if _CHAIN.fullmatch(noisy):
            return " ".join(decode(_chain_moves(noisy, self.channel), self.model).split())
        return " ".join(decode(_moves(noisy, self.channel), self.model).split())

    def chains(self, data: bytes) -> list[str]:
        """The restored words of the chains of single characters in a text in UTF-8."""
        if not (_MAYBE.search(data) or _DOTTED.search(data)):
            return []
        text = data.decode("utf-8", "replace")
        return [w for m in _CHAIN.finditer(text) for w in decode(_chain_moves(m.group().lower(), self.channel), self.model).split()]

    def text(self, text: str) -> str:
        """The whole text restored: chains joined, tokens decoded, white space as it was."""
        text = _CHAIN.sub(lambda m: decode(_chain_moves(m.group().lower(), self.channel), self.model).strip(), text)
        return re.sub(r"\S+", lambda m: self.token(m.group()) or m.group(), text)


def char_counts(docs: DataFrame, text_col: str = "text", learning: Learning = Learning()) -> np.ndarray:
    """Counts of the n-grams of all plain words (letters only, none three times in a row) of the corpus, by bucket.

    Words are counted first, so n-grams are taken from distinct words. The table has 2 ** ``lm_bits`` numbers
    whatever the corpus."""
    size = 1 << learning.lm_bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens: Counter = Counter()

        def flush():
            words: Counter = Counter()
            for token, n in tokens.items():
                word = token.decode("utf-8", "replace").lower().strip(_EDGE)
                if word.isalpha() and not _TRIPLE.search(word):
                    words[word] += n
            tokens.clear()
            yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for data in b.column(0).to_pylist():
                if data:
                    tokens.update(tokens_of(data))
                if len(tokens) > 400_000:
                    yield from flush()
        yield from flush()

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, crc32 = np.zeros(size, np.int64), zlib.crc32
        for b in batches:
            at, ns = [], []
            for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                chars = [c.encode() for c in f"^{word}$"]
                before = len(at)
                for i in range(len(chars)):
                    crc = 0
                    for c in chars[i:i + ORDER]:
                        crc = crc32(c, crc)
                        at.append(crc)
                ns.append((len(at) - before, n))
                table[0] += n * (len(chars) - 1)   # the empty n-gram counts every character after the first
            sizes, counts = np.array(ns, np.int64).reshape(-1, 2).T
            np.add.at(table, np.array(at, np.int64) & (size - 1), np.repeat(counts, sizes))
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(table[at])], names=["at", "n"])

    words = docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(count, "word string, n bigint")
    words = words.groupBy("word").agg(F.sum("n").alias("n"))
    table = written(words.mapInArrow(grams, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")), "char-counts")
    got, counts = table.toArrow(), np.zeros(size, np.float32)
    counts[got["at"].to_numpy()] = got["n"].to_numpy()
    return counts


_WHOLE = zlib.crc32(b"=")


def evidence(word: str, learning: Learning) -> list[int]:
    """The buckets of a word and its openings (counted in bytes)."""
    data, most = word.encode("utf-8", "replace"), (1 << learning.weight_bits) - 1
    out, crc, at = [zlib.crc32(data, _WHOLE) & most], 0, 0
    for k in learning.openings:
        if len(data) <= k:
            break
        crc, at = zlib.crc32(data[at:k], crc), k
        out.append(crc & most)
    return out


def _bucket_counts(rows: DataFrame, counts, learning: Learning, channel: Channel, only=None) -> DataFrame:
    """``at, n``: of the texts, how many hold each bucket of evidence (of those that ``only`` marks, if given)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, seen = Restorer(CharModel(counts.value), channel), np.zeros(1 << learning.weight_bits, np.int32)
        keep = None if only is None else only.value
        memo = Memo(lambda token: tuple(k for w in restorer.token(token.decode("utf-8", "replace")).split() for k in evidence(w, learning)
                                        if keep is None or keep[k]))
        for b in batches:
            for data in b.column(0).to_pylist():
                found = set(chain.from_iterable(map(memo.__getitem__, set(tokens_of(data)))))
                found.update(k for w in restorer.chains(data) for k in evidence(w, learning) if keep is None or keep[k])
                seen[np.fromiter(found, np.int64, len(found))] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at].astype(np.int64))], names=["at", "n"])

    return rows.select(F.col("text").cast("binary")).mapInArrow(run, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n"))


def weigh(rows: DataFrame, totals: dict[int, int], counts, learning: Learning, channel: Channel) -> dict[int, float]:
    """Evidence by bucket from ``text, toxic``: the lower bound of the log odds that a document with it is toxic; positive ones only.

    Toxic texts name the buckets in question, then the others are counted for these alone. There are at most
    2 ** ``weight_bits`` of them."""
    toxic = written(_bucket_counts(rows.filter("toxic = 1"), counts, learning, channel).filter(F.col("n") >= learning.least), "toxic-buckets").toArrow()
    at = toxic["at"].to_numpy()
    t, c = np.zeros(1 << learning.weight_bits), np.zeros(1 << learning.weight_bits)
    t[at] = toxic["n"].to_numpy()
    only = rows.sparkSession.sparkContext.broadcast(t > 0)
    clean = _bucket_counts(rows.filter("toxic = 0"), counts, learning, channel, only).toArrow()
    c[clean["at"].to_numpy()] = clean["n"].to_numpy()
    t, c = t + 0.5, c + 0.5
    weight = np.log(t / (totals.get(1, 0) + 1)) - np.log(c / (totals.get(0, 0) + 1)) - learning.z * np.sqrt(1 / t + 1 / c)
    return {int(k): float(weight[k]) for k in at if weight[k] > 0}


class Scorer:
    """A text's features: the strongest and second strongest evidence, how many words have any, and its size."""

    def __init__(self, restorer: Restorer, weights: dict[int, float], learning: Learning):
        self.restorer, self.weights, self.learning = restorer, weights, learning
        self.strength = Memo(self._strength)

    def of(self, phrase: str) -> float:
        get = self.weights.get
        return max([get(k, 0.0) for w in phrase.split() for k in evidence(w, self.learning)], default=0.0)

    def _strength(self, token: bytes) -> tuple[str, float] | tuple:
        """The restored token and its evidence; empty without any."""
        phrase = self.restorer.token(token.decode("utf-8", "replace"))
        s = self.of(phrase)
        return (phrase, s) if s > 0 else ()

    def __call__(self, text: str | bytes | None) -> tuple[float, float, float, float]:
        data = text.encode("utf-8", "replace") if isinstance(text, str) else text or b""
        tokens = tokens_of(data)
        best = dict(filter(None, map(self.strength.__getitem__, set(tokens))))
        best.update((w, s) for w in self.restorer.chains(data) if (s := self.of(w)) > 0)
        top = sorted(best.values(), reverse=True)[:2] + [0.0, 0.0]
        return top[0], top[1], math.log1p(len(best)), math.log1p(len(tokens))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights of a ridge-penalised logistic model (the last one the intercept), by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    """Everything a score needs; of bounded size."""

    counts: np.ndarray
    weights: dict[int, float]
    logit: np.ndarray
    learning: Learning
    channel: Channel

    def scorer(self) -> Scorer:
        return Scorer(Restorer(CharModel(self.counts), self.channel), self.weights, self.learning)

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.logit[:-1] + self.logit[-1], -30, 30)))


def fold(id_col: str) -> F.Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id, digest, toxic, fold``: of each distinct text with a label outside fold 0 its smallest such id; toxic if any of its rows is."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col("toxic").isin(0, 1)).groupBy(F.col(id_col).alias("_id")).agg(
        F.max("toxic").cast("int").alias("toxic")).filter(fold("_id") != 0)
    narrow = docs.select(F.col(id_col).alias("_id"), F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("digest"))
    narrow = narrow.join(maybe_broadcast(written(known, "labels"), 16), "_id")
    chosen = narrow.groupBy("digest").agg(F.min("_id").alias("_id"), F.max("toxic").alias("toxic"))
    return written(chosen.withColumn("fold", fold("_id").cast("int")), "labelled-texts")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          learning: Learning = Learning(), channel: Channel = Channel()) -> Model:
    """A model from all texts (characters) and the labelled rows outside fold 0: folds 1 to 3 weigh words, fold 4 fits the
    logistic model. Without labels of both kinds in fold 4 the score is that of the strongest word alone."""
    counts = char_counts(docs, text_col, learning)
    shipped = docs.sparkSession.sparkContext.broadcast(counts)
    chosen = labelled_texts(docs, labels, id_col, text_col)
    shares = {r["toxic"]: min(1.0, learning.rows / r["n"]) for r in chosen.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = F.pmod(F.xxhash64("digest"), F.lit(1 << 30)) < F.when(F.col("toxic") == 1, shares.get(1, 1.0)).otherwise(shares.get(0, 1.0)) * float(1 << 30)
    chosen = chosen.filter(drawn)
    totals = {r["toxic"]: r["n"] for r in chosen.filter("fold <> 4").groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}

    def rows(which):
        text = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        # an id may stand for several texts: only the row of the chosen one counts
        return text.join(maybe_broadcast(chosen.filter(which), 64), "_id").filter(F.unhex(F.sha2("text", 256)) == F.col("digest"))

    weights = weigh(rows("fold <> 4"), totals, shipped, learning, channel)
    model = Model(counts, weights, np.array([1.0, 0.0, 0.0, 0.0, -3.0]), learning, channel)
    row = F.struct(F.xxhash64("digest").alias("tie"), "toxic").alias("row")
    fitted = _features(rows("fold = 4").select("text", row), model, "row struct<tie:bigint,toxic:int>")
    fitted = fitted.select("row.*", "f0", "f1", "f2", "f3").orderBy("tie").limit(learning.fit_rows).toPandas()
    if fitted["toxic"].nunique() == 2:
        model.logit = _logistic(fitted[["f0", "f1", "f2", "f3"]].to_numpy(), fitted["toxic"].to_numpy(float))
    return model


def _shipped(rows: DataFrame, model: Model):
    """A function that makes the model's scorer in a task; only arrays and numbers are broadcast, so workers need not have the package."""
    data = rows.sparkSession.sparkContext.broadcast((model.counts, model.weights))
    logit, learning, channel = model.logit, model.learning, model.channel
    return lambda: Model(*data.value, logit, learning, channel).scorer()


def _features(rows: DataFrame, model: Model, kept: str) -> DataFrame:
    """The features of ``text`` beside one other column."""
    scorer_of = _shipped(rows, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of()
        for b in batches:
            x = np.array([scorer(t) for t in b.column(0).to_pylist()], float).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([b.column(1), *[pa.array(x[:, k]) for k in range(4)]], names=[kept.split()[0], "f0", "f1", "f2", "f3"])

    rows = rows.withColumn("text", F.col("text").cast("binary"))
    return rows.mapInArrow(run, f"{kept}, f0 double, f1 double, f2 double, f3 double")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, from its text alone.

    Null and empty texts get the score of no words; a row with a null id is not held out; repeated rows each get
    their score; an empty table gives no rows; other columns are not read; texts are read whole."""
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(id_col).alias("doc_id"))
    w = [float(x) for x in model.logit]
    z = sum((F.col(f"f{k}") * w[k] for k in range(4)), F.lit(w[4]))
    p = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
    scored = _features(rows, model, f"doc_id {dict(rows.dtypes)['doc_id']}").select("doc_id", p.alias("score"))
    return scored.select("doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def restore(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, restored``: the texts as the channel decoder reads them; null stays null."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("doc_id"))
    scorer_of = _shipped(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = scorer_of().restorer
        for b in batches:
            texts = [None if t is None else restorer.text(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(texts, pa.string())], names=["doc_id", "restored"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, restored string")
