"""Text column functions: page cleaning (P1), normalisation (P2),
tokenising (P3), document length (P4).

All are compositions of built-in expressions, so they run inside
whole-stage codegen; none needs Python on the executors.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference for equal results):
# - punctuation set: the 32 ASCII marks of Python's string.punctuation,
#   !"#$%&'()*+,-./:;<=>?@[\]^_`{|}~  written as the ranges below;
# - whitespace set: the characters Python's str.split() splits on.
PUNCT_CLASS = r"[!-/:-@\[-`{-~]"
WS_CHARS = (
    r"\t\n\x{0b}\x{0c}\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS_RUN = f"[{WS_CHARS}]+"
# line breaks of Python's str.splitlines()
LINE_BREAKS = r"\n\r\x{0b}\x{0c}\x{1c}\x{1d}\x{1e}\x{85}\x{2028}\x{2029}"

# Fixed values for page cleaning: elements whose content is dropped, and the
# character references decoded without their semicolon too.
DROPPED_ELEMENTS = ("script", "style")
BARE_REFERENCES = ("lt", "gt", "quot", "nbsp", "copy", "middot", "amp")
# a tag up to the first ">" outside quotes (possessive, so that many quotes need no deep
# stack); then, for tags with a lone quote, up to the first ">"
TAGS = (r"""<[!/?a-zA-Z][^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+>""", r"<[!/?a-zA-Z][^>]*>")
# numeric references 128 to 159 mean the characters of code page 1252
C1 = [bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(128, 160)]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# punctuation becomes a space and whitespace runs collapse: one pass over
# runs of either class gives the same string
PUNCT_OR_WS_RUN = f"[{PUNCT_CLASS[1:-1]}{WS_CHARS}]+"


def normalize(text) -> Column:
    """Punctuation to space, whitespace runs to one space, trim, lower.
    After the single replacement only one ASCII space can remain at either
    end, which ``trim`` removes."""
    return F.lower(F.trim(F.regexp_replace(_col(text), PUNCT_OR_WS_RUN, " ")))


def uncut(text) -> Column:
    """What ``blocks.coded_terms`` cuts into the terms of ``text``: it finds separators and lower case itself, many times cheaper
    than the regular expression. Null stays null."""
    return F.make_valid_utf8(_col(text))


def tokenize(normalized) -> Column:
    """Split a normalised string on single spaces; "" gives [""]."""
    return F.split(_col(normalized), " ")


def terms(text) -> Column:
    """P2 then P3."""
    return tokenize(normalize(text))


def char_length(text) -> Column:
    """Document length in characters (code points), as BIGINT."""
    return F.length(_col(text)).cast("bigint")


def strip_ws(text) -> Column:
    """Remove leading and trailing whitespace (the str.strip() set)."""
    return F.regexp_replace(_col(text), f"^{WS_RUN}|{WS_RUN}$", "")


def _character(code: Column) -> Column:
    """The character of a code point; U+FFFD for those that stand for none."""
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
    return F.translate(char, "".join(map(chr, range(128, 160))), "".join(C1))


def decode_references(text: Column) -> Column:
    """Character references, each once: decimal, hexadecimal, and the HTML 4 names;
    the semicolon may be missing after numbers and ``BARE_REFERENCES``. Others stay."""
    names = F.create_map(*[F.lit(x) for n, c in name2codepoint.items() for x in (n, chr(c))])

    def decoded(p):
        digits = F.regexp_extract(p, "^#([0-9]{1,7})", 1)
        hexes = F.regexp_extract(p, "^#[xX]([0-9a-fA-F]{1,6})", 1)
        name = F.try_element_at(names, F.regexp_extract(p, "^([A-Za-z][A-Za-z0-9]*);", 1))
        bare = F.regexp_extract(p, f"^({'|'.join(BARE_REFERENCES)})", 1)
        rest = F.regexp_replace(p, "^#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});?", "")
        return (F.when(digits != "", F.concat(_character(digits.try_cast("bigint")), rest))
                .when(hexes != "", F.concat(_character(F.conv(hexes, 16, 10).try_cast("bigint")), rest))
                .when(name.isNotNull(), F.concat(name, F.regexp_replace(p, "^[A-Za-z0-9]+;", "")))
                .when(bare != "", F.concat(F.try_element_at(names, bare), F.regexp_replace(p, f"^(?:{'|'.join(BARE_REFERENCES)});?", "")))
                .otherwise(F.concat(F.lit("&"), p)))

    pieces = F.split(text, "&", -1)
    return F.when(F.contains(text, F.lit("&")), F.array_join(
        F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(decoded(p))), "")).otherwise(text)


def html_to_text(html) -> Column:
    """Page to text the way the crawler's cleaner does it.

    Drops script and style elements with their content, then comments and
    tags; text nodes are glued with no separator. Decodes
    character references. Each line is stripped and split on two spaces, each piece
    stripped, empty pieces dropped, the rest joined with one space.
    """
    c = F.coalesce(_col(html), F.lit(""))
    for tag in DROPPED_ELEMENTS:
        c = F.regexp_replace(c, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "")
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", "")
    for tag in TAGS:
        c = F.regexp_replace(c, tag, "")
    c = decode_references(c)
    sep = f"[{WS_CHARS}]*(?:[{LINE_BREAKS}]| {{2}})[{WS_CHARS}]*"
    c = F.regexp_replace(c, sep, " ")
    return strip_ws(c)
