"""Extraction: the labelling is the cheapest of all, wrappers keep their article, odd markup, very long and very deep pages."""

import itertools
import math
import random
import time

import pyarrow.parquet as pq
import pytest

from quarry.llm import mincut

ARTICLE = "<h1>Title</h1><p>A paragraph of text that is long enough, to stay in.</p><p>Another one, with as many words as the first has.</p>"
WANT = "Title\nA paragraph of text that is long enough, to stay in.\nAnother one, with as many words as the first has."


def energy(blocks, places, labels, costs):
    """Cost of a labelling: unary costs of the blocks, edges between different labels; places stand on their side."""
    sides = list(labels) + [p.article for p in places]
    cost = sum(max(s, 0) if not keep else max(-s, 0) for s, keep in ((mincut.score(b, costs), k) for b, k in zip(blocks, labels)))
    return cost + sum(room for a, b, room in mincut.edges_of(blocks, places, costs) if sides[a] != sides[b])


def test_the_labelling_is_the_cheapest_of_all():
    random.seed(6)
    costs = mincut.Costs()
    for _ in range(60):
        places = [mincut.Place(random.random() < 0.5, False, -1) for _ in range(random.randint(0, 2))]
        blocks = []
        for _ in range(random.randint(1, 9)):
            words = random.randint(1, 25)
            blocks.append(mincut.Block(" ".join(["word"] * words) + random.choice([".", ""]), random.choice([0, 0, words]), random.random() < 0.1,
                                       random.randint(0, 2), random.randint(-1, len(places) - 1)))
        best = min(energy(blocks, places, labels, costs) for labels in itertools.product([False, True], repeat=len(blocks)))
        got = mincut.content(blocks, places, costs)
        assert energy(blocks, places, got, costs) == pytest.approx(best)


def test_the_cut_decides_blocks_of_the_given_pages():
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist()
    moved = total = 0
    for page in pages:
        blocks, places = mincut.blocks_of(page or "")
        keep = mincut.content(blocks, places)
        total += len(blocks)
        moved += sum(k != (mincut.score(b, mincut.Costs()) > 0) for b, k in zip(blocks, keep))
    assert moved > 0.02 * total


@pytest.mark.parametrize("before", [
    '<div class="layout has-sidebar">', '<div class="content no-comments">', '<div class="search-results">', '<div class="post tag-news">',
    '<div class="promo-free main">', "<div class=x'>", '<div id="sidebar-wrapper">', '<div class="page-header">', "<article><div class='entry share-enabled'>", "<main>",
    '<section class="widget">', "<div title=\"it's\">"])
def test_wrappers_keep_their_article(before):
    page = f"<html><body><nav><a href=/>Home</a></nav>{before}{ARTICLE}</div></article></main></section><footer>&copy; 2020 All rights reserved.</footer></body></html>"
    assert mincut.main_text(page) == WANT


@pytest.mark.parametrize("extra", [
    "<nav><ul><li><a href=/>One</a><li><a href=/>Two</a></ul></nav>", "<div class='comments'><p>What a great article, I liked it very much indeed.</p></div>",
    "<ul class='related-posts'><li><a href=/>Another story of the day</a></ul>", "<div id=comment-list><p>Reader one says that it is all wrong, from the start.</p></div>",
    "<aside><p>Some side note that runs for quite a few words.</p></aside>", "<form><label>Your name</label><input></form>",
    "<div class='site-footer'>Copyright of us, all rights reserved by us.</div>", "<div class='ad ad-12'>Buy the best of all things here today.</div>",
    "<div role=search>Find things</div>", "<div class=cookie-notice>We use cookies to make this site better for you.</div>"])
def test_furniture_goes_wherever_it_stands(extra):
    assert mincut.main_text(f"<body>{extra}<article>{ARTICLE}</article>{extra}</body>") == WANT
    assert mincut.main_text(f"<body><article>{ARTICLE}{extra}</article></body>") == WANT


def test_short_lines_and_link_lists_of_an_article_stay():
    page = f"<nav><a href=/>Home</a></nav><article>{ARTICLE}<ul><li><a href=/a>First source</a></li><li><a href=/b>Second</a></li></ul><p>End</p></article>"
    assert mincut.main_text(page) == WANT + "\nFirst source\nSecond\nEnd"
    assert mincut.main_text("<article><p>Hi</p></article>") == "Hi"


def test_odd_markup():
    assert mincut.main_text("<article><p>if a<b here today, then we stay.<p>Next line of text follows.</article>") == "if a<b here today, then we stay.\nNext line of text follows."
    assert mincut.main_text('<article><p title="a > b">One line of text is here.</p><p class="x>Two lines of text are here.</p></article>') == \
        "One line of text is here.\nTwo lines of text are here."
    assert mincut.main_text("<article><p>Some line of text is here.</p><div class=\"cut") == "Some line of text is here."
    assert mincut.main_text("<article><ul><li>one item<li>two items<ul><li>inner item</ul><li>three</ul></article>") == "one item\ntwo items\ninner item\nthree"
    assert mincut.main_text("<article><table><tr><td>cell a<td>cell b<tr><td>cell c</table></article>") == "cell a\ncell b\ncell c"


def test_depth_and_length_cost_in_proportion():
    def seconds(page):
        began = time.process_time()
        text = mincut.main_text(page)
        return time.process_time() - began, text

    for unit in ("<div>", "<ul><li>", "<li><div>", "<p><b>"):
        t1, _ = seconds("<article>" + unit * 4_000 + "A line of text that is long enough, to stay.")
        t2, text = seconds("<article>" + unit * 32_000 + "A line of text that is long enough, to stay.")
        assert text == "A line of text that is long enough, to stay." and t2 < 40 * t1 + 0.5, unit
    long = "<article>" + "".join(f"<p>Paragraph {i} of a very long page, with some words.</p>" for i in range(30_000)) + "</article>"
    t, text = seconds(long)
    assert text.count("\n") == 29_999 and t < 30


def test_ties_go_to_boilerplate():
    costs = mincut.Costs(base=-0.15, sentence=0.0)
    block = mincut.Block("word")
    assert math.isclose(mincut.score(block, costs), 0.0) and mincut.content([block], [], costs) == [False]
