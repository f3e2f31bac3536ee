"""Splitting text into pre-tokens, as byte-level BPE vocabularies ask for."""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
import regex

#: Letters up to U+024F (the feminine and masculine ordinal and micro signs included), digits and other numbers up
#: to U+00FF, white space up to U+00FF: what the classes L, N and White_Space hold there.
_L = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_N = "0-9²³¹¼-¾"
_S = r"\t-\r \x85\xa0"
_WIDE = re.compile("[ɐ-\U0010ffff]")
_QUICK = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_FULL: dict[str, regex.Pattern] = {}


def splitter(pattern: str):
    """A function text -> list of the matches of ``pattern``.

    The published pattern, on texts without characters beyond U+024F, runs
    as an equal one with spelled-out classes, at twice the speed."""
    import public_tokenizers

    full = _FULL.setdefault(pattern, regex.compile(pattern))
    if pattern != public_tokenizers.PATTERN:
        return full.findall
    return lambda text: full.findall(text) if _WIDE.search(text) else _QUICK.findall(text)


@cache
def classes(*runs: re.Pattern | regex.Pattern) -> np.ndarray:
    """By code point: the number from 1 of the pattern of runs that takes it, 0 if none does."""
    every, table = "".join(map(chr, range(0x110000))), np.zeros(0x110000, np.uint8)
    for k, c in enumerate(runs, 1):
        for run in c.finditer(every):
            table[run.start():run.end()] = k
    return table


def kinds(padded: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The class of each byte's character in UTF-8 with four zeros behind it."""
    kind = table[:256].take(padded)
    lead = np.flatnonzero(padded >= 0xC0)
    if len(lead):
        a, b, c, d = (padded[lead + i].astype(np.int32) for i in range(4))
        b, c, d = b & 63, c & 63, d & 63
        point = np.where(a < 0xE0, (a & 31) << 6 | b, np.where(a < 0xF0, (a & 15) << 12 | b << 6 | c, (a & 7) << 18 | b << 12 | c << 6 | d))
        of = table[point]
        for i, least in enumerate((0xC0, 0xC0, 0xE0, 0xF0)):
            longer = a >= least
            kind[lead[longer] + i] = of[longer]
    return kind


def strings(data: np.ndarray, at: np.ndarray) -> pa.StringArray:
    """The pieces of UTF-8 ``data`` that begin ``at`` these places."""
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(data)).astype(np.int32)), pa.py_buffer(data))


_PUBLISHED = regex.compile(r"\p{L}+"), regex.compile(r"\p{N}+"), regex.compile(r"\s+")


def starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places where the published pattern's matches begin in ``data``, the UTF-8 of texts that end at ``ends``, one behind the other.

    Matches leave nothing out, so they end where the next one or the next text begins. Letters, numbers, white space and all
    else make runs; a run takes the space before it, and white space before other text keeps its last character apart."""
    n = len(data)
    first = np.zeros(n + 4, bool)  # of a text; the end of the data counts as one
    first[0] = first[n:] = True
    first[ends] = True
    padded = np.concatenate([data, np.zeros(4, np.uint8)])
    kind = kinds(padded, classes(*_PUBLISHED))
    begin = first.copy()
    begin[1:] |= kind[1:] != kind[:-1]
    behind = np.flatnonzero((kind[:-1] == 3) & (kind[1:] != 3) & ~first[1:]) + 1
    last = behind - 1
    for _ in range(3):
        last = last - ((padded[last] & 0xC0) == 0x80)
    begin[last] = True
    begin[behind[padded[behind - 1] == 0x20]] = False
    mark = np.flatnonzero(data == 0x27)
    mark = mark[begin[mark] & ~first[mark + 1]]
    x, y = padded[mark + 1], padded[mark + 2]
    one = np.isin(x, np.frombuffer(b"stmd", np.uint8))
    two = ~first[mark + 2] & (np.isin(x, np.frombuffer(b"rv", np.uint8)) & (y == ord("e")) | (x == ord("l")) & (y == ord("l")))
    begin[mark[one | two] + 1] = False
    begin[mark[one] + 2] = True
    begin[mark[two] + 3] = True
    return np.flatnonzero(begin[:n])
