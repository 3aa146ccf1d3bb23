"""Main text: rules on small pages, consensus between pages, the given table against its generator's shape."""

from __future__ import annotations

import html as markup
import re
import time

import pytest

from tabstudy.llm import htmltext
from tabstudy.llm.queries import op5_html, table

PAGE = (
    '<html><head><title>No</title></head><body class="has-sidebar"><header class="top"><h1>Site</h1></header>'
    '<div class="sidebar">Side</div><main><div class="cookie-notice">We use</div><article class="post-12"><header><h1>Head</h1>'
    "</header><p>A &lt; b &nbsp; c<p>two<ul><li>x<li>y</ul><div class='ad-slot'>AD</div><form>f</form><!-- c --><script>s</script>"
    '<section id="comments"><article class="comment">hi</article></section></article></main><footer>F</footer></body></html>'
)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (PAGE, "Head\n\nA < b c\n\ntwo\n\nx\n\ny"),
        ("", ""),
        ("plain text only", "plain text only"),
        ("<p>&am &amp <b>x</b>y<br>z", "&am & xy z"),
        ("<article>a <b>b <p>c</b> d</p><div>e</article><footer>f", "a b\n\nc d\n\ne"),
        ("<div class=content><p>one</p></div><div class=menu>menu menu menu</div>", "one"),
        ("<article><div style='display: none'>h</div><p>v</p><p>  \n </p></article>", "v"),
        ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1\n\n2\n\n3"),
        ("<article>" + "<div>" * 3000 + "deep", "deep"),
        ("<article><p>open <!-- never closed", "open"),
        ("<article><p>open <b class='x", "open"),
        ("<article><p>1 < 2 & 3 <", "1 < 2 & 3 <"),
        ("<body><nav>n</nav></body>", ""),
        ("<div class=content><p>intro</p><div class=wp-block><p>" + "inner " * 20 + "</p></div><p>end</p></div>", "intro\n\n" + "inner " * 19 + "inner\n\nend"),
        ("<table><tr><td class=a>one cell</td><td class=b>other</td></tr></table>", "one cell\n\nother"),
        ("<article><p>t</p><h2 id='related-work'>Related</h2><p>u</p></article>", "t\n\nRelated\n\nu"),
        ("<div class='content-sidebar-wrap'><p>whole</p></div>", "whole"),
        ("<body>Skip<div class=page><div class=story><p>" + "w " * 30 + "</p></div><div class=box>b</div></div></body>", " ".join("w" * 30)),
    ],
)
def test_rules(page, text):
    assert htmltext.main_text(page, None) == text


def test_deep_pages_take_linear_time():
    began = time.process_time()
    assert htmltext.main_text("<div>x" * 100_000, None) == "\n\n".join("x" * 100_000)
    assert htmltext.main_text("<div class=share>x" * 20_000, None) == "\n\n".join("x" * 20_000)
    assert time.process_time() - began < 20


def test_paths_fold_digits():
    scores = htmltext.candidate_scores(htmltext.parse(PAGE))
    assert list(scores) == ["html>body.has-sidebar>main>article.post-#"]


def host_pages():
    """On most pages of the host the text is in div.story; one page has more text in a box beside it."""
    plain = "<body><div class=story><p>{0} story text of some length</p></div><div class=box><p>box</p></div></body>"
    rows = [(i, f"http://h.org:80/{i}", plain.format(i)) for i in range(5)]
    rows.append((9, "https://user@H.org/x", "<body><div class=story><p>short</p></div><div class=box>" + "<p>long box</p>" * 9 + "</div></body>"))
    rows.append((10, "http://other/", "<body><div class=box><p>its own</p></div></body>"))
    rows.append((11, "http://h.org/none", "<body><article><p>another template</p></article></body>"))
    return rows


@pytest.mark.parametrize("hot", [1, 2, 1000])
def test_consensus_beats_the_page(spark, monkeypatch, hot):
    """Whether no, one or each host counts as common."""
    monkeypatch.setattr(htmltext, "HOT_HOSTS", hot)
    frame = spark.createDataFrame(host_pages(), "page_id long, url string, html string").repartition(4)
    got = {r["page_id"]: (r["text"], r["path"]) for r in htmltext.extract_text(frame).collect()}
    assert got[9] == ("short", "body>div.story")
    assert got[10] == ("its own", "body>div.box")
    assert got[11] == ("another template", "body>div.story")
    votes = {r["host"]: r["path"] for r in htmltext.host_paths(frame).collect()}
    assert votes == {"h.org": "body>div.story", "other": "body>div.box"}


def test_given_pages(spark):
    pages = {r["page_id"]: r["html"] for r in table(spark, "/root/testdata/sf0.001", "pages").collect()}
    got = op5_html(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(pages)
    for r in got:
        body = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S).group(1)
        blocks = (" ".join(markup.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?p>|</?h1>|<br>", body))
        assert r["text"] == "\n\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


def test_odd_pages(spark):
    rows = [(1, None, None), (None, "http://a/", "<p>x</p>"), (2, "not a url", ""), (3, "http://a/", "<article>" + "<p>w</p>" * 20_000)]
    rows += [(4, "http://a/", "<article><p>t</p></article>")] * 2
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' AS host", "1 AS path", "'t' AS text")
    got = sorted((str(r["page_id"]), r["text"][:20], len(r["text"])) for r in htmltext.extract_text(frame).collect())
    assert got == [
        ("1", "", 0), ("2", "", 0), ("3", "\n\n".join("w" * 20)[:20], 59_998), ("4", "t", 1), ("4", "t", 1), ("None", "x", 1),
    ]
    assert htmltext.extract_text(frame.limit(0)).collect() == []
