"""HTML extraction: the parser, the field against enumeration, and pages with known text."""

import html
import itertools
import re

import numpy as np
import pytest

from tallyloom.llm import common, html_crf


@pytest.fixture(scope="module")
def field():
    return html_crf.fit()


def test_blocks():
    page = (
        "<!doctype html><html><head><title>no</title><style>p{}</style></head><body><!-- no --><p>a &amp; b&nbsp;<b>c</b>d<br>e"
        "<p>f<script>if (a < b) { x('</p>') }</script> g<div>h <a href='x>y'>i</a></div>tail 1 < 2<ul><li>j<li>k</ul>"
    )
    found = html_crf.blocks(page)
    assert [b[0] for b in found] == ["a & b cd e", "f g", "h i", "tail 1 < 2", "j", "k"]
    assert [b[2] for b in found] == ["p", "p", "div", "body", "li", "li"]
    assert found[2][3] == 1
    for broken in ("", "<", "</p>", "<p", "<!--", "<a \"", "<p><p><p>", "text", "<td>x</table>", "<script>x", "</article></nav>" * 50 + "y"):
        html_crf.blocks(broken)
    deep = "<div>" * 5000 + "x" + "</div>" * 5000 + "<p>y"
    assert [b[0] for b in html_crf.blocks(deep)] == ["x", "y"]


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(0)
    for _ in range(50):
        scores, steps = r.normal(size=(7, 2)), r.normal(size=(2, 2))
        value = lambda y: sum(scores[t, k] for t, k in enumerate(y)) + sum(steps[a, b] for a, b in zip(y, y[1:]))  # noqa: B023, E731
        assert html_crf.viterbi(scores, steps) == list(max(itertools.product((0, 1), repeat=7), key=value))


def test_labels_of_other_pages(field):
    right = total = 0
    for page in html_crf.labelled_pages(80, seed=99):
        found = html_crf.blocks(page)
        if found:
            labels = html_crf.viterbi(html_crf._scores([html_crf.features(b) for b in found], field[0]), field[1])
            right += sum(bool(b[1] & html_crf._MAIN) == bool(y) for b, y in zip(found, labels, strict=True))
            total += len(found)
    assert right > 0.97 * total


def article(page):
    inside = re.search(r"<article>(.*?)</article>", page or "", re.S)
    parts = re.split(r"</?(?:h1|p)>", inside[1].replace("<br>", " ")) if inside else []
    parts = (" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in parts)
    return "\n".join(x for x in parts if x)


def test_all_pages(spark, folder, field):
    pages = common.table(spark, folder, "pages")
    rows = html_crf.extract(pages, field).join(pages.select("page_id", "html"), "page_id").collect()
    assert len(rows) == pages.count()
    assert all(r.text == article(r.html) and r.n_chars == len(r.text) for r in rows)


def test_layouts(field):
    said = "The quick brown fox, it is told, jumped over the lazy dog and ran away. It was never seen again."
    pages = (
        f"<nav><a href=/>Home</a></nav><main><h1>Title here</h1><p>{said}</p><p>{said}</p></main><footer>&copy; 2020 Us</footer>",
        f'<div id="cookie-notice"><p>We use cookies. {said}</p></div><div class="post-content"><h1>Title here</h1><p>{said}</p><p>{said}</p></div>'
        f'<div class="comments"><p>{said}</p></div><aside><p>{said}</p></aside>',
        f'<header><h2>Site</h2><ul><li><a href=/>A</a><li><a href=/>B</a></ul></header><article><h1>Title here</h1><p>{said}</p>'
        f'<div class="ad">{said}</div><p>{said}</p></article><section id="comments"><p>{said}</p></section><form><label>Name</label><button>Go</button></form>',
    )
    for page in pages:
        assert html_crf.main_text(f"<html><body>{page}</body></html>", field) == f"Title here\n{said}\n{said}"


def test_odd_rows(spark, field):
    rows = [(1, None, None, 5), (2, "u", "", 5), (2, "u", "", 5), (None, "v", "<article><p>Some text, here it is, quite long.</p></article>", 5), (3, "w", "<p>" + "x " * 400_000, 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    found = html_crf.extract(pages, field)
    assert found.columns == ["page_id", "url", "text", "n_chars"] and found.count() == 5
    assert found.where("page_id is null").first().text == "Some text, here it is, quite long."
    assert html_crf.extract(pages.limit(0), field).count() == 0


def test_raw_text():
    for script in ("for(var i=0;i<n;i++){f(i)}", "x='<!--'", "x='<body>'", "if(a<b&&c>d)y(\"<p>no\")", "x='</scripts>'", "</p", ""):
        said = f"<SCRIPT async>{script}</Script ><article><p>a</p></article><script>{script}</script><p>b"
        assert [b[0] for b in html_crf.blocks(f"<body>{said}")] == ["a", "b"]
        assert [b[0] for b in html_crf.blocks(f"<head><script>{script}</script><title>i<n</title></head><body>{said}")] == ["a", "b"]
    for tag in ("style", "title", "textarea", "iframe", "noscript"):
        assert [b[0] for b in html_crf.blocks(f"<p>a</p><{tag}>x<y <!-- <body></{tag.upper()}><p>b")] == ["a", "b"]
    # Without an end tag the head ends at the body, as before; many such tags are looked for once.
    assert [b[0] for b in html_crf.blocks("<head>" + "<title>x" * 50_000 + "<body><p>a")] == ["a"]


def test_any_depth():
    nav, article = html_crf._ANCESTOR_BIT["nav"], html_crf._ANCESTOR_BIT["article"]
    deep = "<article>" + "<div>" * 2000 + "a<nav>b</nav>c<article>d</article>e" + "</div>" * 2000 + "f</article>g"
    found = html_crf.blocks(deep)
    assert [(b[0], bool(b[1] & nav), bool(b[1] & article)) for b in found] == [
        ("a", False, True), ("b", True, True), ("c", False, True), ("d", False, True), ("e", False, True), ("f", False, True), ("g", False, False),
    ]
    # End tags of what is not open cost nothing on a deep page.
    assert [b[0] for b in html_crf.blocks("<div>" * 50_000 + "</section>" * 50_000 + "x")] == ["x"]
