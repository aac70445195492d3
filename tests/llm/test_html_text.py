"""Main text of pages: furniture out, whole article in, page order, character references."""

from __future__ import annotations

import re

import pytest
from cases import prose

from trailspark.llm.html_text import extract, main_text

PARAGRAPH = ("It was the best of the times and it is for the people that are in it, "
             "as the story that was told to them by an old man.")
PAGES = "page_id long, url string, html string"


def page(body: str) -> str:
    return f"<!DOCTYPE html><html lang=en><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


CASES = {
    "article with furniture around": (
        "<nav><ul><li><a href=/>Home</a></ul></nav><header><h1>Site</h1></header>"
        f"<article><h1>Head</h1><p>{PARAGRAPH}</p><p>Short.</p></article>"
        f"<aside><p>{PARAGRAPH}</p></aside><footer>&copy; x</footer>", f"Head\n{PARAGRAPH}\nShort."),
    "scripts, styles, comments": (
        f"<article><script>var a='<p>x</p>'</script><!-- <p>no</p> --><p>{PARAGRAPH}<style>b</style></p></article>",
        PARAGRAPH),
    "references and white space": (
        "<article><p>a &amp; b&nbsp;&#8212;\n\t c &lt;d&gt; &eacute;<br>e</p></article>", "a & b — c <d> é e"),
    "unclosed elements": ("<article><p>one<p>two <b>bold<p>three</article>", "one\ntwo bold\nthree"),
    "lists and tables": (
        "<article><ul><li>i<li>ii</ul><table><tr><td>c<td>d</table></article>", "i\nii\nc\nd"),
    "notices, adverts, forms by class": (
        "<div class='cookie-notice'>We use cookies.</div><main><div class=ad>Buy</div>"
        f"<p>{PARAGRAPH}</p><form><p>Sign up</p></form><div id=sidebar-1>side</div></main>", PARAGRAPH),
    "reader comments": (
        f"<article class='post comments-open'><p>{PARAGRAPH}</p></article><section id=comments>"
        f"<article class=comment><p>{PARAGRAPH} Nice.</p></article></section>", PARAGRAPH),
    "no article: density rules": (
        f"<div><a href=1>One</a> <a href=2>Two</a></div><p>{PARAGRAPH}</p><p>Short.</p><p>{PARAGRAPH} End.</p>"
        f"<p>Tail</p><div>{'Xq zv wk ' * 12}</div>", f"{PARAGRAPH}\nShort.\n{PARAGRAPH} End."),
    "heading inherits from below": (f"<h2>Head</h2><p>{PARAGRAPH}</p>", f"Head\n{PARAGRAPH}"),
    "hidden": (f"<article><p hidden>no</p><p style='display: none'>no</p><p>{PARAGRAPH}</p></article>", PARAGRAPH),
    "menu inside the article": (
        f"<article><p>{PARAGRAPH}</p><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></article>", PARAGRAPH),
    "layout names": (f"<div class='page has-sidebar no-comments'><article><p>{PARAGRAPH}</p></article></div>", PARAGRAPH),
    "main part by name": (
        f"<div class=topbar>Site</div><div id=mainMenu><p>{PARAGRAPH}</p></div><div id=content><h1>Head</h1>"
        f"<p>Zq.</p><p>{'Xq zv wk ' * 12}</p><div class=commentList><p>{PARAGRAPH}</p></div></div>"
        f"<div class=cookieBanner><p>{PARAGRAPH}</p></div>", f"Head\nZq.\n{('Xq zv wk ' * 12).strip()}"),
    "odd quotes": ("<article><p title=it's>one</p><p alt=\"a > b\">two</p><p x='\"'>three</p></article>",
                   "one\ntwo\nthree"),
    "inline advert": ("<article><p>one <span class=ad>buy</span> two</p></article>", "one two"),
}


@pytest.mark.parametrize("case", list(CASES))
def test_cases(case):
    body, expected = CASES[case]
    assert main_text(page(body)) == expected


def test_odd_pages():
    for text in (None, "", "<", "<p", "<!--", "</p></div>", "<script>", "<a <b <c", "&#xFFFFFF;", "<" * 500):
        assert isinstance(main_text(text), str)
    assert main_text("<article>" + "<div>" * 50_000 + "deep") == "deep"
    assert main_text("<article>" + "<font>x" * 20_000) == "x" * 20_000


def test_query_over_edge_rows(spark):
    long = "".join(f"<p>{prose(40, i)}</p>" for i in range(400))
    rows = [(1, "u", page(CASES["references and white space"][0])), (2, None, None), (None, "v", ""),
            (3, "w", page(f"<article>{long}</article>")), (3, "w", page(f"<article>{long}</article>"))]
    table = spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = sorted((tuple(r) for r in extract(table).collect()), key=repr)
    assert [r[:2] for r in got] == [(1, "u"), (2, None), (3, "w"), (3, "w"), (None, "v")]
    assert got[2][2].count("\n") == 399 and got[2][3] == len(got[2][2])
    assert got[1][2:] == ("", 0) and got[4][2:] == ("", 0)
    assert extract(spark.createDataFrame([], PAGES)).collect() == []


def test_pages_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    texts = {r["page_id"]: r["text"] for r in extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.DOTALL)[1]
        import html

        blocks = [" ".join(html.unescape(re.sub(r"<(?!/?(?:p|h1)\b)[^>]*>", " ", b)).split())
                  for b in re.split(r"</?(?:p|h1)\b[^>]*>", inner)]
        assert texts[r["page_id"]].replace(" ", "") == "\n".join(b for b in blocks if b).replace(" ", "")


def test_the_rules_agree_with_the_markup_they_do_not_see(spark):
    """Blocks of the given pages, decided with the main part's markup and without it."""
    from trailspark.llm.html_text import GOOD, labelled

    same = both = words = found = right = 0
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        told, by_rule = labelled(r["html"]), labelled(r["html"], marks=("furniture",))
        assert [t for t, _ in told] == [t for t, _ in by_rule]
        for (text, a), (_, b) in zip(told, by_rule, strict=True):
            n, same, both = len(text.split()), same + (a == b), both + 1
            words, found = words + n * (a == GOOD), found + n * (b == GOOD)
            right += n * (a == b == GOOD)
    assert same / both > 0.8 and right / words > 0.8 and right / found > 0.99
