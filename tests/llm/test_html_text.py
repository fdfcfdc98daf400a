import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import got

from cartlens.llm import html_text

CASES = {
    "plain": ("<html><body><article><h1>T</h1><p>One  two\n three</p><p>x &amp; y&nbsp;z</p></article></body></html>", "T\nOne two three\nx & y z"),
    "unclosed": ("<nav><ul><li>a<li>b</ul></nav><article><h1>T</h1><p><b>bold<br><p>next<p>last", "T\nbold\nnext\nlast"),
    "inline": ("<article><p>a<b>b</b>c <i>d</i><br>e</p></article>", "abc d e"),
    "script": ('<article><script>var t="</p>";</script><style>p{}</style><p>x</p><noscript>n</noscript></article>', "x"),
    "outside": (
        "<header>h</header><main><p>kept</p><aside>s</aside><div class='ad-box'>advert<p>more</div><form>f<input></form>"
        "<section id='comments'><p>first!</p></section><div class='cookie notice'>c</div><p>also</p></main><footer>f</footer>",
        "kept\nalso",
    ),
    "lists": ("<article><ul><li>one<li>two <b>x</b></ul>tail<table><tr><td>a<td>b<tr><td>c</table></article>", "one\ntwo x\ntail\na\nb\nc"),
    "text around blocks": ("<article>before<p>in</p>after</article>outside", "before\nin\nafter"),
    "stray end tags": ("<article></div></b><p>x</i></p></span>y</article>", "x\ny"),
    "cut in a tag": ("<article><p>x</p><p cla", "x"),
    "nothing": ("", ""),
    "comment": ("<article><!-- a < b --><p>x</p><!-- open", "x"),
    "header in article": ("<article><header><p>by me</p></header><p>x</p></article>", "x"),
    "entities": ("<article><p>&lt;b&gt; &#233; &eacute; &unknown; &copy</p></article>", "<b> é é &unknown; ©"),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name, monkeypatch):
    html, text = CASES[name]
    assert html_text.main_text(html) == text
    monkeypatch.setattr(html_text, "PIECE", 11)
    assert html_text.main_text(html) == text


def test_ratio_finds_content_without_marks():
    menu = "".join(f"<div><a href='/{k}'>item</a> <a>{k}</a></div>" for k in range(12))
    body = "".join(f"<p>{'long running text of the page ' * 12}{k}</p>" for k in range(6))
    text = html_text.main_text(f"<body>{menu}<div>{body}</div>{menu}</body>")
    lines = text.split("\n")
    assert sum(line.startswith("long running") for line in lines) == 6 and len(lines) <= 8


def test_smoothing_and_threshold():
    values = html_text.smoothed(np.array([1.0] * 10 + [100.0] * 5 + [1.0] * 10))
    assert values.max() <= 100 and values.argmax() in range(10, 15)
    assert 1 < html_text.threshold(values) < 100
    assert html_text.smoothed(np.array([5.0])).tolist() == [5.0]


def test_long_page_is_kept_whole():
    paragraphs = [f"paragraph {k} with words" for k in range(20_000)]
    html = "<article>" + "".join(f"<p>{p}" for p in paragraphs) + "</article>"
    assert html_text.main_text(html) == "\n".join(paragraphs)


def test_table(spark):
    pages = [(1, "u", CASES["plain"][0], "x"), (2, None, None, "x"), (2, None, None, "x"), (None, "v", "", None), (3, "w", "no tags", "y")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, text string")
    rows = got(html_text.extract(df), "page_id", "url", "text", "n_chars")
    assert rows == sorted(
        [(1, "u", CASES["plain"][1], len(CASES["plain"][1])), (2, None, "", 0), (2, None, "", 0), (None, "v", "", 0), (3, "w", "no tags", 7)], key=repr
    )
    assert html_text.extract(df.limit(0)).count() == 0


def test_every_page_against_a_plain_rule(spark, folder):
    import html
    import re

    for r in html_text.extract(spark.read.parquet(f"{folder}/pages.parquet")).join(spark.read.parquet(f"{folder}/pages.parquet"), "page_id").collect():
        article = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = re.split("</?(?:p|h1)>|<br>", re.sub("</?b>", "", article))
        assert r["text"] == "\n".join(b for b in (" ".join(html.unescape(x).split()) for x in blocks) if b)


PROSE = [f"{'long running text of the page ' * 12}{k}" for k in range(6)]
BODY = "".join(f"<p>{p}</p>" for p in PROSE)
MENU = "".join(f"<li><a href='/{k}'>item {k}</a></li>" for k in range(12))


def test_article_is_one_signal_beside_the_ratios():
    # the page marks only a part of its content
    part = f"<ul>{MENU}</ul><article><p>marked text of the page</p><p>short</p></article><div>{BODY}</div><ul>{MENU}</ul>"
    assert html_text.main_text(part).split("\n") == ["marked text of the page", "short", *PROSE]
    # and the article holds what is not content
    more = f"<article><h1>T</h1>{BODY}<ul>{MENU}</ul></article>"
    lines = html_text.main_text(more).split("\n")
    assert lines[:7] == ["T", *PROSE] and len(lines) <= 9  # smoothing may keep the edge of the menu


def test_ratios_are_taken_on_every_page(monkeypatch):
    calls = []
    real = html_text.smoothed
    monkeypatch.setattr(html_text, "smoothed", lambda *a: calls.append(1) or real(*a))
    for html, text in CASES.values():
        calls.clear()
        html_text.main_text(html)
        assert bool(calls) == bool(text)


def test_head_without_end_tag():
    assert html_text.main_text("<html><head><title>T</title><body><article><p>text") == "text"
    assert html_text.main_text("<html><head><meta charset=x><title>T</title><article><p>text") == "text"
    assert html_text.main_text("<head><title>T</title><style>p{}</style>bare text") == "bare text"


@pytest.mark.parametrize("open_", ["<div class='content has-sidebar'>", "<div class='no-comments'>", "<div id=with-header>",
                                   "<div class='search-results'>", "<form action='/'>", "<form><div class='search-results'>"])
@pytest.mark.parametrize("article", ["", "<article>"])
def test_marks_do_not_take_most_of_a_page(open_, article):
    html = f"<nav>{MENU}</nav>{open_}<div class=comments><p>first! and some more words</p></div>{article}{BODY}"
    assert html_text.main_text(html).split("\n") == PROSE


def test_marks_beside_an_article_hold_however_long():
    html = f"<article><p>short article</p></article><section id=comments>{BODY}</section>"
    assert html_text.main_text(html) == "short article"
    assert html_text.main_text("<p>one <span class=share>Share</span> two</p>") == "one two"


LEAD = "This paragraph is long enough to be running text of an article, with many words and hardly a tag in it at all. " * 3


def test_nothing_inside_an_article_is_lost():
    """Marks that only look like those of adverts, comments or forms, and linked lists amid the text."""
    cases = {
        '<pre>x = 1 <span class="hljs-comment"># note</span></pre>': "x = 1 # note",
        '<pre>y <span class="comment">-- why</span></pre>': "y -- why",
        'the <span class="search-term">needle</span> is': "the needle is",
        'in <abbr class="ad">AD</abbr> 70': "in AD 70",
        f'<div class="social-history"><p>Social history: {LEAD}</p></div>': f"Social history: {LEAD.strip()}",
        "press the <label>red knob</label> now": "press the red knob now",
        "<ul><li><a href=a>First item</a></li><li><a href=b>Second item</a></li></ul>": "First item\nSecond item",
    }
    for html, text in cases.items():
        page = f"<html><body><article><p>{LEAD}</p>{html}<p>{LEAD}</p></article></body></html>"
        assert html_text.main_text(page) == f"{LEAD.strip()}\n{text}\n{LEAD.strip()}"


def test_headings_and_short_lines_without_an_article():
    page = f"<body><nav><a href=a>Home</a></nav><div><h1>Title here</h1><p>{LEAD}</p><h2>Part two</h2><p>Short one.</p><p>{LEAD}</p></div></body>"
    assert html_text.main_text(page) == f"Title here\n{LEAD.strip()}\nPart two\nShort one.\n{LEAD.strip()}"


def test_marked_lines_go():
    page = f'<article><p>{LEAD}</p><p><b class="share-line">Share this</b></p><div class="share"><a href=x>x</a> Share</div></article>'
    assert html_text.main_text(page) == LEAD.strip()


def test_pages_without_their_article_tags(folder, spark):
    """The ratios alone find nearly all of the text of the supplied pages, and hardly any other."""
    import re

    kept = wanted = got = 0
    for r in spark.read.parquet(f"{folder}/pages.parquet").collect():
        html = r["html"] or ""
        right = Counter(html_text.main_text(html).split("\n"))
        mine = Counter(html_text.main_text(re.sub(r"</?(article|main)\b[^>]*>", "", html)).split("\n"))
        size = lambda c: sum(len(x) * n for x, n in c.items())
        kept, wanted, got = kept + size(right & mine), wanted + size(right), got + size(mine)
    assert kept / wanted > 0.98 and kept / got > 0.99


def test_lines_smoothing_and_clusters_by_brute_force():
    r = random.Random(4)
    for _ in range(60):
        lines = [html_text.Line("x" * r.choice([3, 9, 200, 900]), r.randint(1, 4), False, r.random() < 0.2, ()) for _ in range(r.randint(1, 30))]
        ratios = [0.0 if x.linked else math.log(1 + len(x.text) / x.tags) for x in lines]
        reach = round(3 * html_text.SIGMA)
        if len(lines) <= 2 * reach:
            reach = len(lines)
        smooth = []
        for k in range(len(lines)):
            near = [(j, math.exp(-0.5 * ((j - k) / html_text.SIGMA) ** 2)) for j in range(len(lines)) if abs(j - k) <= reach]
            smooth.append(sum(w * ratios[j] for j, w in near) / sum(w for _, w in near))
        got, border = html_text.dense(lines)
        low = [v for v in smooth if v <= border]
        high = [v for v in smooth if v > border]
        if border == 0.0:
            assert got == list(range(len(lines)))
            continue
        # a fixed point of the two means, far enough apart
        middles = sum(low) / len(low), sum(high) / len(high)
        assert abs(sum(middles) / 2 - border) < 1e-6 and middles[1] - middles[0] >= math.log(html_text.APART) - 1e-9
        good = [k for k, v in enumerate(smooth) if v >= border]
        filled = {j for a, b in zip(good, good[1:]) if b - a - 1 <= html_text.GAP for j in range(a, b)}
        assert got == sorted(filled | set(good))
