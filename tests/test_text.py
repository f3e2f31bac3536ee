"""P1-P4 on hand-made cases and against plain-Python statements of the
same rules."""

import string

from hypothesis import given, settings, strategies as st

from quarry.functions.text import html_to_text, normalize, terms


from conftest import plain_words


def py_normalize(s: str) -> str:
    return " ".join(plain_words(s))


def _one(spark, col_fn, value):
    return spark.createDataFrame([(value,)], "x string").select(col_fn("x").alias("y")).first()["y"]


def test_empty_text(spark):
    for v in ("", "!!!"):
        assert _one(spark, normalize, v) == ""
        assert _one(spark, terms, v) == [""]


def test_punctuation(spark):
    assert _one(spark, normalize, "  x--y__z ") == "x y z"


def test_non_ascii_punctuation_kept(spark):
    v = "“q”—d"
    assert _one(spark, normalize, v) == v
    assert _one(spark, terms, v) == [v]


def test_unicode_whitespace(spark):
    v = "a b　c d\x1ce"
    assert _one(spark, normalize, v) == py_normalize(v) == "a b c d e"


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=string.printable + " 　é—", max_size=30), min_size=1, max_size=20))
def test_normalize_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r["y"] for r in df.select(normalize("x").alias("y")).collect()]
    assert got == [py_normalize(v) for v in values]


def test_page_cleaning(spark):
    assert _one(spark, html_to_text, "<p>a</p><p>b</p><script>s</script>") == "ab"
    assert _one(spark, html_to_text, "x &amp<b>y</b>") == "x &y"
    assert _one(spark, html_to_text, "<style>p{}</style><!-- c --><div>one  two\n\n three</div>") == "one two three"
    assert _one(spark, html_to_text, "") == ""


def test_character_references(spark):
    assert _one(spark, html_to_text, "caf&eacute; &#8217;q&#x27; &hellip;&mdash;&#150;") == "café ’q' …—–"
    assert _one(spark, html_to_text, "&amp;lt; &copy2020 &ltx; R&D &unknown; &#55296; &#128512 &") == "&lt; ©2020 <x; R&D &unknown; \ufffd 😀 &"


def test_quoted_marks_in_tags(spark):
    assert _one(spark, html_to_text, """<a title="a > b" alt='c > d'>t</a>""") == "t"
    assert _one(spark, html_to_text, "<p don't>one</p> two") == "one two"
    assert _one(spark, html_to_text, "<a " + "x='1' " * 20000 + ">t</a>") == "t"
