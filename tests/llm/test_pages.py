"""Implied end tags, names of page parts, and alignment in bounded memory."""

from __future__ import annotations

import random

import pytest

from feedkit.llm import pages


def text(page: str) -> str:
    return " ".join(pages.blocks(page)[0])


@pytest.mark.parametrize(
    "page, want",
    [
        ('<article><p class="ad">Buy now<p>Main text.</article>', "Main text."),
        ('<article><ul><li class="share">Tweet<li>First real point<li>Second</ul><p>More text</article>', "First real point Second More text"),
        ("<article><p>One<form><input><p>Name</article><p>After", "One"),
        ("<main><form>Search<p>all</main><main>Rest of it</main>", "Rest of it"),
        ('<article><h1 id="social-security-notice">Title</h1><p class="widget-count">Ten widgets</p></article>', "Title Ten widgets"),
        ('<article><section id="related-work">Earlier work</section><ol class="commentlist"><li>me too</ol></article>', "Earlier work"),
        ('<article><div class="share-buttons top">x</div><div id="sidebar2">y</div>kept</article>', "kept"),
        ('<article><table><tr><td class="ad">x<td>cell<tr><td>next</table></article>', "cell next"),
        ('<article><dl><dt>term<dd class="promo">buy<dt>other<dd>text</dl></article>', "term other text"),
        ('<article><p>a <span class="ad">b <b>c</b></span> d</p></article>', "a d"),
        ('<article><p>a <span class="ad">b<p>c</article>', "a c"),
        ("<nav><ul><li>Home<article><p>Main</article>", "Main"),
        ("<nav>Home</nav><div>only <p>this</div> and that", "only this and that"),
        ('<div class="ad"><div>x</div>y</div><p>kept', "kept"),
        ("<article><aside>no</article><article>second</article>", "second"),
        ("<article>a</b></p></div>b</article>c", "a b"),
        ("<article><main>in</main>still</article>out", "in still"),
        ("", ""),
        (None, ""),
    ],
)
def test_what_counts(page, want):
    assert text(page) == want


def test_deep_and_broken_pages():
    assert text("<div>" * 30_000 + "<p>deep") == "deep"
    assert text("</p>" * 20_000 + "<article>" + "<p class=ad>x<p>y" * 3000 + "</article>") == " ".join(["y"] * 3000)


def brute(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("bits", [0, 40, 1 << 26])
def test_alignment_is_longest(monkeypatch, bits):
    monkeypatch.setattr(pages, "ROW_BITS", bits)
    rng = random.Random(3)
    for _ in range(150):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 24))] for _ in range(2))
        left, right = pages.common(a, b)
        assert [a[i] for i in left] == [b[j] for j in right] and len(left) == brute(a, b)
        assert all(x < y for xs in (left, right) for x, y in zip(xs, xs[1:]))


def test_alignment_of_very_long_pages():
    """300,000 lines a page: rows of all of them would take 11 GB."""
    n = 300_000
    a = [*range(n)]
    b = [*range(7, 1000), -1, *range(1000, n // 2), *range(n // 2 + 50, n), -2]
    left, right = pages.common(a[::1], b)
    assert len(left) == len(b) - 2 and [a[i] for i in left] == [b[j] for j in right]


def test_alignment_reaches_articles_and_their_neighbours(spark):
    """A page's neighbours are the pages of nearest URL, with an article or not; what is in doubt in an article is deleted if shared."""
    article = "<div>All our shops</div><article><p>{0} begins</p><p>Same words</p><ul><li><a>Home</a><li><a>{0} more</a></ul><div class=autumn-promo>Order now {1}</div></article><p>Imprint</p>"
    pages_ = [
        (1, "http://h.org/a", article.format("One", "")),
        (2, "http://h.org/b", "<div>All our shops</div><p>Two</p><p>Imprint</p>"),
        (3, "http://h.org/c", article.format("Three", "")),
        (4, "http://h.org/d", article.format("Four", "")),
        (5, None, article.format("Five", "here")),
    ]
    got = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(pages_, "page_id long, url string, html string")).collect()}
    assert got == {
        1: "One begins Same words Home One more Order now",
        2: "Two",
        3: "Three begins Same words Three more",
        4: "Four begins Same words Four more",
        5: "Five begins Same words Home Five more Order now here",
    }
