"""Quality rules, line first: judge every line, drop the failing ones, reject
documents that lose too much of their text or fail the base rule.

All of it is DataFrame expressions on one row at a time: no shuffle, no
Python on the executors, memory bounded by one document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACE, settled

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Phrases of page furniture; a short line holding one as words of its own is boilerplate, if it is no sentence.
BOILERPLATE = (
    "all rights reserved", "cookie", "javascript", "lorem ipsum", "privacy policy", "terms of use",
    "terms of service", "subscribe", "sign up", "sign in", "log in", "click here", "read more", "share this",
    "back to top", "skip to content", "newsletter",
)


@dataclass(frozen=True)
class LineRules:
    """Parameters of the rules; a line fails if any rule applies.

    - boilerplate: at most ``boilerplate_words`` words and a furniture phrase, but no sentence: ``sentence_words``
      words or more, the last one with . ! ? or ellipsis;
    - navigation: at least ``min_separators`` of ``| > » › • ·`` and one or more per ``words_per_separator`` words;
    - punctuation: more than ``max_mark_pct`` per cent of its non-space characters are neither letter nor
      digit (in a line of at least ``mark_chars`` of them), or it has fewer than ``fragment_words`` words
      and no closing mark;
    A document is rejected if more than ``max_lost_pct`` per cent of its word characters were in failing lines.
    """

    boilerplate_words: int = 12
    sentence_words: int = 5
    min_separators: int = 3
    words_per_separator: int = 3
    max_mark_pct: int = 20
    mark_chars: int = 20
    fragment_words: int = 3
    max_lost_pct: int = 50
    min_words: int = 50
    max_repeat_pct: int = 50


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+"), "")


def good_lines(lines: Column, rules: LineRules) -> Column:
    """The lines that no rule fails; lines without a word always stay.

    The counts that rules share are taken once per line. A line's marks are
    ASCII punctuation."""
    phrase = rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(BOILERPLATE)})(?:s|d|rs?)?(?![\p{{L}}\p{{N}}])"
    measured = F.transform(lines, lambda x: F.struct(
        x.alias("line"),
        F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+")).alias("n"),
        F.length(F.replace(x, F.lit(" "), F.lit(""))).alias("solid"),
        F.length(F.regexp_replace(x, r"[^!-/:-@\[-`{-~]+", "")).alias("marks"),
        F.length(F.regexp_replace(x, "[^|>»›•·]+", "")).alias("seps")))

    def passes(m):
        n_words = m["n"]
        closed = m["line"].rlike("[.!?…:;,。！？][\"'»”’)\\]]*" + SPACE + "*$")
        sentence = (n_words >= rules.sentence_words) & m["line"].rlike("[.!?…。！？][\"'»”’)\\]]*" + SPACE + "*$")
        boiler = (n_words <= rules.boilerplate_words) & F.lower(m["line"]).rlike(phrase) & ~sentence
        nav = (m["seps"] >= rules.min_separators) & (m["seps"] * rules.words_per_separator >= n_words)
        marked = (m["solid"] >= rules.mark_chars) & (m["marks"] * 100 > m["solid"] * rules.max_mark_pct)
        fragment = (n_words < rules.fragment_words) & ~closed & (n_words > 0)
        return ~(nav | marked | boiler | fragment)

    return F.transform(F.filter(measured, passes), lambda m: m["line"])


def _repeat_words(df: DataFrame, few: int = 64) -> DataFrame:
    """Add ``n_repeat_words`` from ``words``: words inside a 3-word window that occurs twice or more.

    Windows are compared by 64-bit hash; the repeated hashes stand side by
    side in sorted order. Up to ``few`` of them are looked up one by one for
    every window; for more, windows are sorted with their positions. Either
    way gives the positions in order, and each covers the words of its
    window that are not covered yet."""
    n = F.size("words")
    df = df.withColumn("_wh", F.transform("words", lambda w: F.xxhash64(w)))
    df = df.withColumn("_win", F.when(n >= 3, F.transform(
        F.slice("_wh", F.lit(1), n - 2), lambda h, i: F.xxhash64(h, F.get("_wh", i + 1), F.get("_wh", i + 2)))))
    df = df.withColumn("_sorted", F.sort_array("_win"))
    df = df.withColumn("_twice", F.array_distinct(F.filter("_sorted", lambda h, i: h == F.get("_sorted", i + 1))))
    n_twice = F.size("_twice")
    by_lookup = F.filter(F.transform("_win", lambda h, i: F.when(F.array_contains("_twice", h), i)),
                         lambda i: i.isNotNull())
    pairs = F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_pairs", F.when(n_twice > few, pairs))
    by_sort = F.sort_array(F.transform(
        F.filter("_pairs", lambda p, j: (p["h"] == F.get("_sorted", j + 1)) | (p["h"] == F.get("_sorted", j - 1))),
        lambda p: p["i"]))
    df = df.withColumn("_at", F.when(n_twice > few, by_sort).when(n_twice > 0, by_lookup))
    covered = F.aggregate(
        "_at", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, i: F.struct((acc["n"] + (i + 3) - F.greatest(i, acc["end"])).alias("n"), (i + 3).alias("end")),
        lambda acc: acc["n"])
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint"))


def _judged(df: DataFrame, rules: LineRules) -> DataFrame:
    """Add the counts and verdicts to rows with ``_text``; ``_row``, if there, stays."""
    others = [c for c in df.columns if c != "_text"]
    df = (df.withColumn("words", words_of(F.col("_text")))
          .withColumn("_lines", F.split("_text", "\n")))
    df = (df
          .withColumn("n_words", F.size("words").cast("bigint"))
          .withColumn("word_chars", F.length(F.regexp_replace("_text", SPACE + "+", "")).cast("bigint"))
          .withColumn("n_symbols", F.length(F.regexp_replace("_text", f"[^{SYMBOLS}]+", "")).cast("bigint"))
          .withColumn("_worded", F.filter("_lines", lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
          .withColumn("n_dup_lines", (F.size("_worded") - F.size(F.array_distinct("_worded"))).cast("bigint"))
          .withColumn("_good", good_lines(F.col("_lines"), rules)))
    df = _repeat_words(df).withColumn("clean_text", F.array_join("_good", "\n"))
    lost = F.col("word_chars") - F.length(F.regexp_replace("clean_text", SPACE + "+", ""))
    df = df.withColumn("n_lost_chars", lost.cast("bigint"))
    failed = ((F.col("n_words") < rules.min_words)
              | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_pct))
    too_lossy = F.col("n_lost_chars") * 100 > F.col("word_chars") * rules.max_lost_pct
    return df.select(*others, "clean_text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                     "n_lost_chars", failed.alias("base_failed"), settled(~failed & ~too_lossy).alias("kept"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """One row per input row: ``doc_id, clean_text``, the base counts,
    ``n_lost_chars``, ``base_failed`` and ``kept``.

    A null or empty text has no words, so the base rule fails it; its
    ``clean_text`` is empty. Null and repeated ids stay as they are; other
    columns of the input are not carried, so their names cannot clash.
    Lines are compared as they stand (ties: the first of equal lines is
    not a duplicate). An empty table gives an empty result."""
    return _judged(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")), rules)


def cleaned(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", rules: LineRules = LineRules()) -> DataFrame:
    """The kept rows of ``docs`` with all its columns, the failing lines gone from the text and ``chars_col``, if there, counted anew.

    Null and empty texts go, as the base rule fails them; null ids and repeated rows stay as they are; columns may have any names; an empty
    table stays empty."""
    df = _judged(docs.select(F.struct("*").alias("_row"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")), rules).filter("kept")
    new = {text_col: F.col("clean_text"), chars_col: F.length("clean_text").cast(dict(docs.dtypes).get(chars_col, "bigint"))}
    return df.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])
