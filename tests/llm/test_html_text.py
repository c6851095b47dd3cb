"""Main text against the known form of the test pages, and defined cases."""

from __future__ import annotations

import html
import random
import re

import numpy as np
import pytest

from stockweave.llm import html_text
from stockweave.llm.html_text import main_text

PAGES = "page_id bigint, url string, html string, text string"


def plain(page):
    """The blocks inside the one article of a generated page."""
    article = re.search("<article>(.*)</article>", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)>", article[1].replace("<br>", " ")) if article else []
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", part)).split()) for part in parts]
    return "\n\n".join(b for b in blocks if b)


def test_corpus(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = html_text.digest(pages).collect()
    assert len(rows) == pages.count()
    texts = {r.page_id: plain(r.html) for r in pages.collect()}
    assert all(r.text == texts[r.page_id] and r.n_chars == len(r.text) for r in rows)


LONG = "A sentence that is long enough to count as the content of a page. " * 5
CASES = [
    ("", ""),
    ("<p></p>", ""),
    ("plain words", "plain words"),
    ("<article><h1>T</h1><p>a &amp; b&nbsp;c\n d<br>e<p>f<b>g</b>h</article><footer>x</footer>", "T\n\na & b c d e\n\nfgh"),
    ("<article><p>One.</p><div class='ad banner'>Buy!</div><p>Two.</p></article>", "One.\n\nTwo."),
    (f"<main><p>{LONG}</p><section id=comments><p>{LONG}</p></section></main>", LONG.strip()),
    (f"<div class='site-header'>Menu</div><div id=content class=has-sidebar><p>{LONG}<p>End.</div><div>x</div>",
     f"{LONG.strip()}\n\nEnd.\n\nx"),
    (f"<nav><a href=x>{LONG}</a></nav><p>{LONG}</p><aside>{LONG}</aside><form>{LONG}</form>", LONG.strip()),
    ("<article><script>if (a < b) '</p>'</script><style>p{}</style><!-- no --><p>yes</article>", "yes"),
    ("<article><p>kept<div role=alert>no</div><div hidden=hidden>no</div></article>", "kept"),
    ("<article><p>cut off in the mid", "cut off in the mid"),
    ("<article><header><h1>Head</h1></header><p>x</p></article><article class='comment'><p>no</p></article>", "Head\n\nx"),
    ("</p></div></article>text", "text"),
]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_cases(page, text):
    assert main_text(page) == text


def test_smoothing():
    flat = html_text.smoothed(np.ones(20))
    assert np.allclose(flat[3:-3], 1) and flat[0] < 1
    assert np.isclose(html_text.smoothed(np.eye(9)[4]).sum(), 1)


def test_defined_cases(spark):
    rows = [(1, "u", None, "own"), (1, "u", None, "own"), (None, None, "<article>" + "<b>x " * 20_000, "own")]
    pages = spark.createDataFrame(rows, PAGES)
    out = html_text.digest(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r.n_chars for r in out.collect()) == [0, 0, 39_999]
    assert html_text.digest(pages.limit(0)).count() == 0


IMPLIED = [
    (f"<html><head><title>x</title><body><p>{LONG}</p></body></html>", LONG.strip()),
    (f"<html><head><title>x</title><meta charset=utf-8><p>{LONG}", LONG.strip()),
    (f"<html><head><title>x</title>{LONG}", LONG.strip()),
    ("<article><p class=ad>no<p>text<div>more</div></article>", "text\n\nmore"),
    ("<article><ul><li class=share>no<li>text<ul><li>inner</ul><li>last</ul></article>", "text\n\ninner\n\nlast"),
    ("<article><dl><dt class=promo>no<dd>text<dt>more</dl></article>", "text\n\nmore"),
    ("<article><table><tr class=ad><td>no<tr><td class=share>no<td>text<th>more<tr><td>last</table></article>", "text\n\nmore\n\nlast"),
    ("<article><p>kept<div hidden>no</div><p hidden>no<p>text</article>", "kept\n\ntext"),
    ("<article><ul><li class=share><p>no<ul><li>no</ul>no<li>text</ul></article>", "text"),
]


@pytest.mark.parametrize(("page", "text"), IMPLIED)
def test_end_tags_left_out(page, text):
    assert main_text(page) == text


def paragraph(rng, words):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(words)).capitalize() + "."


def unmarked_page(rng):
    """A page that names none of its parts: bars of links, teasers and lines of small print around its text."""

    def links(n):
        return "".join(f"<p><a href=/{i}>{paragraph(rng, rng.randint(1, 6))}</a></p>" for i in range(n))

    def teaser():
        return f"<div>{links(3)}<div><p>{paragraph(rng, rng.randint(14, 22))}</p></div>{links(3)}</div>"

    blocks = [paragraph(rng, rng.randint(35, 90)) for _ in range(rng.randint(5, 12))]
    for at in sorted(rng.sample(range(1, len(blocks)), 2)):
        blocks[at] = paragraph(rng, rng.randint(6, 12))
    body = "".join(f"<p>{block}</p>" for block in blocks)
    small = "".join(f"<p>{paragraph(rng, 3)}</p>" for _ in range(3))
    page = f"<html><body><div>{links(6)}</div>{teaser()}<div>{body}</div><div>{links(4)}</div>{teaser()}<div>{small}</div></body></html>"
    return page, "\n\n".join(blocks)


def marked_page(rng):
    """An article with paragraphs that are one link, and a list of links that names itself nowhere."""
    blocks, body = [], ""
    for _ in range(rng.randint(4, 9)):
        for wrapped in (False, rng.random() < 0.3, False):
            blocks.append(paragraph(rng, rng.randint(8, 60)))
            body += f"<p><a href=x>{blocks[-1]}</a></p>" if wrapped else f"<p>{blocks[-1]}</p>"
    more = "".join(f"<li><a href=/{i}>{paragraph(rng, rng.randint(3, 9))}</a></li>" for i in range(rng.randint(5, 9)))
    at = body.index("</p>", len(body) // 2) + 4
    if rng.random() < 0.5:
        return f"<article>{body[:at]}<ul>{more}</ul>{body[at:]}</article>", "\n\n".join(blocks)
    return f"<article>{body}<ul>{more}</ul></article>", "\n\n".join(blocks)


def share_right(make, n=60):
    rng = random.Random(6)
    pages = [make(rng) for _ in range(n)]
    return np.mean([main_text(page) == text for page, text in pages])


@pytest.mark.parametrize("make", [unmarked_page, marked_page])
def test_ratios_decide(make):
    assert share_right(make) > 0.85


@pytest.mark.parametrize("make", [unmarked_page, marked_page])
def test_smoothing_and_threshold_are_needed(make, monkeypatch):
    """Without either of them most texts of these pages are wrong."""
    with monkeypatch.context() as patch:
        patch.setattr(html_text, "smoothed", lambda values: values)
        assert share_right(make) < 0.5
    with monkeypatch.context() as patch:
        patch.setattr(html_text, "threshold", lambda values: 0.0)
        assert share_right(make) < 0.5


def test_threshold_parts_two_clusters():
    assert html_text.threshold(np.array([1.0, 2.0, 100.0, 110.0])) == (1 + 105) / 2
    assert html_text.threshold(np.array([4.0])) == 2 and html_text.threshold(np.zeros(3)) == 0
