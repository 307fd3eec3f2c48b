from __future__ import annotations

import html
import re

import numpy as np
import pytest

from prodlake.llm.main_text import best_region, class_weights, labelled_elements, main_text, mark, weights
from prodlake.llm.main_text_pages import HELD_OUT


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>a<b>b</b>c</p><p>d</p>", "abc d"),
        ("<article><header><h1>T</h1></header><p>one two</p><aside>no</aside></article><footer>f</footer>", "T one two"),
        ("<div class='content has-sidebar'><p>real words of the text</p></div>", "real words of the text"),
        ("<div class='sidebar content'>aaa bbb</div><p title=\"a > b\">kept one two</p>", "kept one two"),
        ("<div class='comment-content'><p>what a reader says at length</p></div><p>the text itself</p>", "the text itself"),
        ("<p>x &lt;b&gt; &amp;amp; &eacute; &#x41;</p>", "x <b> &amp; é A"),
        ("<p>a<script>var t = '</p>';</script>b</p>", "ab"),
        ("<article><p>cut off in the mid", "cut off in the mid"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<!-- <p>no</p> --><p>yes it is</p><!-- open", "yes it is"),
        ("<p>a\n\t b&nbsp;c</p>", "a b c"),
        ("<form><p>Name and many more words</p></form><p>one</p>", "one"),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><p>start words here</p><section class='social-history'><p>the history of it</p></section><p>end</p></article>", "start words here the history of it end"),
        ("<article><p>start words</p><div class='notice-board-history'><p>the board was old</p></div></article>", "start words the board was old"),
        ("<nav/><a>menu</a> words of it</nav><p>real text</p>", "real text"),
        ("<div class=nav data-x=/a/><a>m</a> menu</div><p>text real here</p>", "text real here"),
        ("<p style='display: none'>hidden words</p><p hidden>more</p><p>shown words</p>", "shown words"),
        ("<article class='comment'><p>I was there too</p></article><p>the text itself</p>", "the text itself"),
        ("<div>" * 50_000 + "deep words" + "</div>" * 50_000, "deep words"),
    ],
)
def test_marked_and_unclosed_elements(page, text):
    assert main_text(page) == text


def test_region_against_all_runs():
    rng = np.random.default_rng(2)
    for _ in range(300):
        gain = rng.integers(-4, 4, size=int(rng.integers(0, 14))).tolist()
        first, last = best_region(gain)
        best = max([sum(gain[a:e]) for a in range(len(gain)) for e in range(a + 1, len(gain) + 1)], default=0)
        assert (sum(gain[first : last + 1]) == best) if best > 0 else (last < first)


def test_text_does_not_depend_on_the_name_of_the_root(spark, small):
    for r in spark.read.parquet(f"{small}/pages.parquet").collect():
        assert main_text(r["html"].replace("article>", "div>")) == main_text(r["html"])


def test_weights_are_learned():
    assert class_weights()["ad"] < class_weights()["sidebar"] < 0 < class_weights()["article"]
    table = weights()
    assert table["w:word"] > table["w:link"] > 0 > table["t:p"] > table["t:a"]


def test_articles_of_the_small_table(spark, small):
    for r in spark.read.parquet(f"{small}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(</article>|<footer>|\Z)", r["html"], re.S)
        assert main_text(r["html"]) == " ".join(html.unescape(re.sub(r"<[^>]*>", "\n", article[1])).split())


@pytest.mark.parametrize(
    "words",
    ["cookie-bar-wrapper", "gdpr-popin overlay-x", "promo-box", "reader-responses-thread", "related-stories-block", "ad adslot-7", "site-cookie-notice", "js-newsletter-signup", "share-tools bar", "zz-sidebar"],
)
def test_marked_blocks_beside_an_article(words):
    """Not returned with an article of many words, nor in the place of one of a single word."""
    noise = "<div class='%s'><p>%s</p></div>" % (words, "words that are not of the article " * 6)
    assert main_text(noise + "<article><p>The text itself has seven words here.</p></article>" + noise) == "The text itself has seven words here."
    assert main_text("<article><p>Short.</p></article>" + noise) == "Short."


@pytest.mark.parametrize("words", ["xq-77", "lorem", "content-wrapper", "zz-article-text", "js-a b_c", "row inner"])
def test_unknown_words_weigh_nothing(words):
    assert main_text(f"<div class='{words}'><p>The text itself has seven words here.</p></div>") == "The text itself has seven words here."


def test_held_out_pages():
    """Elements of pages that nothing was learned from are told apart, and so is their text."""
    rows = labelled_elements(HELD_OUT)
    right = [(mark(list(words)) >= 0) == holds for words, holds in rows]
    assert len(right) >= 18 and sum(right) / len(right) >= 0.85  # by class words alone
    assert main_text(re.sub(r"</?x-\w+>", "", HELD_OUT[0])) == "The bridge is open again after two years. Lorries must still go round."
    assert main_text(re.sub(r"</?x-\w+>", "", HELD_OUT[1])) == "Bees on the roof Four hives stand above the library. The honey is sold in June."
