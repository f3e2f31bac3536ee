"""Secret scans: fixed patterns, and a battery of randomness tests on long
tokens whose rejections keep a false-discovery rate per length class.

Everything is DataFrame expressions. Pass one finds spans row by row and
writes a narrow table; the p-values of its tokens are counted in bins over
the whole corpus, the bins give one threshold per length class, and pass
two applies the thresholds row by row. Nothing is grouped by document.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import let, running_sums, written

#: Patterns of the base kinds, in their order; fixed values.
ASSIGN = (r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
          r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
#: Alphabets of the inferred encodings; a symbol's place in the string is its value.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "hex upper": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base36 upper": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base52": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "dashed": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
}
#: Encodings of both cases, and keys in groups of one length between dashes.
MIXED = ("base52", "base62", "base64")
DASHED = "|".join(f"[0-9A-Z]{{{k}}}(?:-[0-9A-Z]{{{k}}}){{2,}}" for k in range(4, 9))
#: Letters of European prose by falling frequency, in per mille; words have high ones, random letters have not.
LETTERS = {c: n for c, n in zip("etaoinsrhldcumfpgwybvkxjqz", (127, 91, 82, 75, 70, 67, 63, 60, 61, 40, 43, 28, 28, 24, 22, 19, 20, 24, 20, 15, 10, 8, 2, 2, 1, 1))}
#: p-values are counted in this many equal bins of -log10 p, up to 10 ** -(BINS / PER_DECADE).
BINS, PER_DECADE = 400, 20


@dataclass(frozen=True)
class Battery:
    """``min_len``: shortest token or part of one that is tested, as shorter ones give the tests no power.
    ``min_letters``: the same for tokens of letters alone. ``lengths``: lower ends of the length classes. ``fdr``: share of false
    rejections allowed in each class. ``least_p``: a token below is dropped whatever the others are, so at most this
    share of random tokens is lost to it, and names that the rule would let pass among many keys are not."""

    min_len: int = 16
    lengths: tuple[int, ...] = (16, 24, 32, 48, 80)
    fdr: float = 0.05
    least_p: float = 0.01
    min_letters: int = 24


def _spans(text: Column, pattern: str, kind: int) -> Column:
    """Matches of ``pattern`` as array<struct<start, kind, stop, value>> in code points.

    Texts between the matches come from ``split`` on the same pattern, so
    the prefix sums of both lengths place every match."""
    none = F.array().cast("array<struct<start:bigint,kind:int,stop:bigint,value:string>>")

    def placed(found):
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        steps = F.zip_with(gaps, found, lambda g, m: (F.length(g) + F.length(m)).cast("bigint"))
        return F.zip_with(found, running_sums(steps), lambda m, stop: F.struct(
            (stop - F.length(m)).alias("start"), F.lit(kind).alias("kind"), stop.alias("stop"), m.alias("value")))

    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)).otherwise(none)


def normal_tail(z: Column) -> Column:
    """P(Z > z): a five-term polynomial in 1 / (1 + 0.2316419 |z|) times the
    normal density; absolute error below 1e-7."""
    a = F.abs(z)
    t = 1 / (1 + F.lit(0.2316419) * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) / 2.5066282746310002 * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def chi2_tail(x: Column, df: Column) -> Column:
    """P(chi-squared with ``df`` degrees > x) by the cube-root normal approximation."""
    v = 2 / (9 * df)
    return normal_tail((F.pow(F.greatest(x, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - v)) / F.sqrt(v))


def _encoding(value: Column, battery: Battery) -> Column:
    """The encoding a token's characters allow, or null: letters and digits must both occur, in base62 and base64 both cases; letters
    alone in both cases count from ``min_letters`` on."""
    both = value.rlike("[0-9]")
    return (F.when(value.rlike("^[0-9a-f]+$") & both & value.rlike("[a-f]"), F.lit("hex"))
            .when(value.rlike("^[0-9A-F]+$") & both & value.rlike("[A-F]"), F.lit("hex upper"))
            .when(value.rlike("^[A-Z2-7]+=*$") & both & value.rlike("[A-Z]"), F.lit("base32"))
            .when(value.rlike("^[0-9a-z]+$") & both & value.rlike("[a-z]"), F.lit("base36"))
            .when(value.rlike("^[0-9A-Z]+$") & both & value.rlike("[A-Z]"), F.lit("base36 upper"))
            .when(value.rlike("^[0-9A-Za-z]+$") & both & value.rlike("[a-z]") & value.rlike("[A-Z]"), F.lit("base62"))
            .when(value.rlike("^[A-Za-z]+$") & (F.length(value) >= battery.min_letters) & value.rlike("[a-z]") & value.rlike("[A-Z]"), F.lit("base52"))
            .when(both & value.rlike("[A-Z]") & value.rlike(f"^(?:{DASHED})$"), F.lit("dashed"))
            .when(both & value.rlike("[a-z]") & value.rlike("[A-Z]"), F.lit("base64")))


def tested(value: Column, battery: Battery) -> Column:
    """struct<encoding, cls, bin> of one token: its length class and the bin of
    -log10 of the combined p-value of four tests of uniform randomness.

    - chi-squared of the symbol counts against equal frequencies;
    - number of runs of values below and above the middle of the alphabet;
    - correlation of neighbouring values;
    - mean frequency of the letters in prose, where the alphabet has all letters;
    - share of capitals among the letters, where the alphabet has both cases.
    The squares of the normal scores (the first only when the counts are too
    uneven, the fourth only when the letters are too frequent) add up to a
    statistic with three degrees of freedom, and one more for each of the last two."""
    logs = {c: math.log(n) for c, n in LETTERS.items()}
    middle = sum(logs.values()) / 26
    spread = math.sqrt(sum((v - middle) ** 2 for v in logs.values()) / 26)
    rank = F.create_map(*[F.lit(v) for c, n in logs.items() for v in (c, (n - middle) / spread)])
    alphabets = F.create_map(*[F.lit(x) for kv in ALPHABETS.items() for x in kv])
    cls = F.lit(0)
    for i, low_end in enumerate(battery.lengths):
        cls = F.when(F.length(value) >= low_end, F.lit(i)).otherwise(cls)

    def wordiness(letters):
        return F.greatest(F.lit(0.0), F.aggregate(
            letters, F.lit(0.0), lambda acc, c: acc + F.coalesce(F.element_at(rank, c), F.lit(0.0))) / F.sqrt(F.size(letters)))

    def squared(m, size):
        """Sum of the squares of the first three scores, from the values, how many there are, how many are high, and the neighbours."""
        x, n, high, pairs = m["x"], m["n"], m["high"], m["pairs"]
        counts = F.transform(F.array_distinct(x), lambda a: F.size(F.filter(x, lambda b: a == b)).cast("double"))
        squares = F.aggregate(counts, F.lit(0.0), lambda acc, c: acc + c * c)
        chi = squares * size / n - n
        v = 2 / (9 * (size - 1))
        z_chi = F.greatest((F.pow(F.greatest(chi, F.lit(0.0)) / (size - 1), F.lit(1 / 3)) - (1 - v)) / F.sqrt(v), F.lit(0.0))
        low = n - high
        runs = 1 + F.size(F.filter(pairs, lambda p: (p["a"] * 2 >= size) != (p["b"] * 2 >= size))).cast("double")
        mean_runs = 1 + 2 * high * low / n
        var_runs = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
        z_runs = F.when(var_runs > 0, (runs - mean_runs) / F.sqrt(var_runs)).otherwise(F.sqrt(n))
        mean = (size - 1) / 2
        cov = F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + (p["a"] - mean) * (p["b"] - mean))
        z_serial = cov / ((size * size - 1) / 12) / F.sqrt(n - 1)
        return let(F.struct(z_chi.alias("c"), z_runs.alias("r"), z_serial.alias("s")), lambda z: z["c"] * z["c"] + z["r"] * z["r"] + z["s"] * z["s"])

    def measured(x, size):
        return let(F.struct(
            x.alias("x"), F.size(x).cast("double").alias("n"), F.size(F.filter(x, lambda a: a * 2 >= size)).cast("double").alias("high"),
            F.zip_with(F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1),
                       lambda a, b: F.struct(a.alias("a"), b.alias("b"))).alias("pairs")), lambda m: squared(m, size))

    def binned(p):
        return F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * PER_DECADE), F.lit(BINS - 1)).cast("int")

    def judged(e):
        """``e``: the encoding, its alphabet and the token's symbols as that alphabet writes them."""
        values = F.transform(F.split(e["body"], ""), lambda c: (F.instr(e["alphabet"], c) - 1).cast("double"))
        size, hexes = F.length(e["alphabet"]).cast("double"), e["encoding"].startswith("hex")
        letters = F.split(F.regexp_replace(F.lower(e["body"]), "[^a-z]+", ""), "")
        words = F.when(hexes, F.lit(0.0)).otherwise(let(letters, wordiness))
        mixed = e["encoding"].isin(*MIXED)
        capitals = let(F.struct(F.length(F.regexp_replace(e["body"], "[^A-Z]+", "")).alias("u"), F.length(F.regexp_replace(e["body"], "[^A-Za-z]+", "")).alias("n")),
                       lambda c: F.when(mixed, F.pow(c["u"] * 2 - c["n"], F.lit(2.0)) / c["n"]).otherwise(F.lit(0.0)))
        statistic = let(size, lambda k: let(values, lambda x: measured(x, k))) + let(words, lambda w: w * w) + capitals
        p = let(F.struct(statistic.alias("x"), F.when(hexes, 3.0).when(mixed, 5.0).otherwise(4.0).alias("df")), lambda s: chi2_tail(s["x"], s["df"]))
        return F.struct(e["encoding"].alias("encoding"), cls.alias("cls"), let(p, binned).alias("bin"))

    def inferred(name):
        body = F.when(name == "dashed", F.translate(value, "-", "")).otherwise(F.regexp_replace(F.translate(value, "-_", "+/"), "=+$", ""))
        return F.when(name.isNotNull(), let(F.struct(
            name.alias("encoding"), F.element_at(alphabets, name).alias("alphabet"), body.alias("body")), judged))

    return let(_encoding(value, battery), inferred)


def _parts(token: Column, min_len: int) -> Column:
    """The parts of a token between / - _ that have ``min_len`` characters, as spans; none of a token without these marks."""
    none = F.array().cast("array<struct<start:bigint,kind:int,stop:bigint,value:string>>")

    def placed(pieces):
        return F.transform(pieces, lambda p, i: F.struct(
            (token["start"] + i + F.length(F.array_join(F.slice(pieces, F.lit(1), i), ""))).alias("start"), token["kind"].alias("kind"),
            (token["start"] + i + F.length(F.array_join(F.slice(pieces, F.lit(1), i + 1), ""))).alias("stop"), p.alias("value")))

    parts = F.filter(let(F.split(token["value"], "[/_-]", -1), placed), lambda p: F.length(p["value"]) >= min_len)
    return F.when(token["value"].rlike("[/_-]"), parts).otherwise(none)


def _scan(df: DataFrame, battery: Battery) -> DataFrame:
    """Add ``base`` and ``tokens`` (spans; tokens with ``test``) to rows with ``_text``; other columns stay."""
    text, others = F.col("_text"), [c for c in df.columns]
    assign = F.filter(_spans(text, ASSIGN, 0), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 8)
    long = _spans(text, rf"[A-Za-z0-9+/_-]{{{battery.min_len},}}={{0,2}}", 3)
    df = df.select(*others, F.array_sort(F.concat(
        assign, _spans(text, ACCESS, 1), _spans(text, HEX, 2))).alias("base"), F.flatten(F.transform(long, lambda t: F.concat(
            F.array(t), _parts(t, battery.min_len)))).alias("_long"))
    free = F.filter("_long", lambda t: ~F.exists("base", lambda b: (b["start"] < t["stop"]) & (t["start"] < b["stop"])))
    df = df.withColumn("_free", free)
    judged = F.transform("_free", lambda t: F.struct(
        t["start"].alias("start"), t["kind"].alias("kind"), t["stop"].alias("stop"), t["value"].alias("value"),
        tested(t["value"], battery).alias("test")))
    return df.select(*others, "base", F.filter(judged, lambda t: t["test"].isNotNull()).alias("tokens"))


def thresholds(scanned: DataFrame, battery: Battery) -> DataFrame:
    """``cls, from_bin``: in each length class, tokens from this bin on are rejected as not random.

    The step-up rule over all tokens of the class: the largest p-value with
    p <= fdr * (tokens at or below p) / (tokens), found on the bin counts,
    with each bin's largest p. At most classes x BINS rows are windowed."""
    bins = (scanned.select(F.explode("tokens").alias("t")).groupBy(F.col("t.test.cls").alias("cls"), F.col("t.test.bin").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")))
    per = Window.partitionBy("cls")
    ranked = (bins.withColumn("upto", F.sum("n").over(per.orderBy(F.desc("bin"))))
              .withColumn("total", F.sum("n").over(per)))
    p_max = F.pow(F.lit(10.0), -F.col("bin") / PER_DECADE)
    return ranked.filter(p_max <= F.lit(battery.fdr) * F.col("upto") / F.col("total")).groupBy("cls").agg(F.min("bin").alias("from_bin"))


def _accepted(cuts: dict[int, int], battery: Battery) -> Column:
    """``base`` and the tokens below their class's cut, as one ordered array."""
    most = min(BINS, round(-math.log10(battery.least_p) * PER_DECADE))

    def random(t):
        cut = F.lit(most)
        for cls, from_bin in cuts.items():
            cut = F.when(t["test"]["cls"] == cls, F.lit(min(from_bin, most))).otherwise(cut)
        return t["test"]["bin"] < cut

    extra = F.transform(F.filter("tokens", random), lambda t: F.struct(
        t["start"].alias("start"), t["kind"].alias("kind"), t["stop"].alias("stop"), t["value"].alias("value")))
    # parts of an accepted token stand in its span
    outer = let(extra, lambda xs: F.filter(xs, lambda t: ~F.exists(xs, lambda o: (o["start"] <= t["start"]) & (t["stop"] <= o["stop"])
                                                                   & ((o["start"] < t["start"]) | (t["stop"] < o["stop"])))))
    return F.array_sort(F.concat("base", outer))


def _cuts(scanned: DataFrame, battery: Battery) -> dict[int, int]:
    """The thresholds on the driver: one number per length class."""
    return {r["cls"]: r["from_bin"] for r in thresholds(scanned, battery).collect()}


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", battery: Battery = Battery()) -> DataFrame:
    """One row per input row: ``doc_id, base, spans`` as arrays of
    ``struct<start, kind, stop, value>`` ordered by start, then kind.

    ``base`` holds the pattern matches, ``spans`` those and the tokens, or parts
    of them between / - _, that the battery takes for random. Null or empty text: empty arrays. Null and
    repeated ids stay as they are; other input columns are not carried."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    scanned = _scan(docs.select(F.col(id_col).alias("doc_id"), text.alias("_text")), battery).drop("_text")
    scanned = written(scanned, "secret-scan")
    return scanned.select("doc_id", "base", _accepted(_cuts(scanned, battery), battery).alias("spans"))


def named(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span, overlapping ones merged, replaced by ``mark``."""
    kept = F.aggregate(
        spans, F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(
            s["stop"].alias("at"),
            F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                     F.lit(mark)).alias("out")))
        .otherwise(F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), acc["out"].alias("out"))),
        lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, kept).otherwise(text)


def redact(docs: DataFrame, text_col: str = "text", battery: Battery = Battery()) -> DataFrame:
    """``docs`` with the secrets of its text column replaced; all columns and rows stay, null text stays null.

    One pass scans the texts and writes each row with its spans; the thresholds are counted on what it wrote, and the
    rows are read back with them. An empty table stays empty, repeated rows stay as they are, columns may have any names."""
    row = F.struct("*").alias("row")
    scanned = written(_scan(docs.select(row, F.coalesce(F.col(text_col), F.lit("")).alias("_text")), battery).drop("_text"), "secret-rows")
    text = F.col("row")[text_col]
    out = F.when(text.isNotNull(), redacted(text, F.col("_spans")))
    found = scanned.select("row", _accepted(_cuts(scanned, battery), battery).alias("_spans"))
    return found.select(*[(out if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
