"""Structured conversion of web pages."""

import pytest

from corpusflow.operators import convert as CV
from corpusflow.operators import html_structure as HS

CASES = {
    "": "",
    "plain text": "plain text",
    "<h2>A <b>bold</b> title</h2><p>one<br>two</p><p>three": "## A **bold** title\n\none\ntwo\n\nthree",
    "<p>see <a href='/x?a=1&amp;b=2'>the <i>page</i></a> and <a>nothing</a></p>": "see [the *page*](/x?a=1&b=2) and nothing",
    "<img src=a.png alt='A &lt; B'><img alt=x>": "![A < B](a.png)",
    "<ul><li>one<ul><li>in<li>ner</ul><li>two</ul><p>end</p>": "- one\n  - in\n  - ner\n- two\n\nend",
    "<ol><li>a</li><li><p>b</p></li></ol>": "1. a\n2. b",
    "<pre>\n  x = 1\n\n  if a &lt; b:\n</pre>after": "```\n  x = 1\n\n  if a < b:\n```\n\nafter",
    "<p>call <code>f(x)</code> now</p>": "call `f(x)` now",
    "<table><tr><th>a<th>b<tr><td>1<td>2</table>": "| a | b |\n|---|---|\n| 1 | 2 |",
    "<table><tr><td>1</td><td><a href=u>l</a></td></tr></table>t": "| 1 | [l](u) |\n|---|---|\n\nt",
    "<script>var a='</p>';</script><style>p{}</style><!-- c --><p>kept</p></div></span>": "kept",
    "<blockquote>said<br>so</blockquote>done": "> said\n> so\n\ndone",
    "<p>a &amp;lt; b &nbsp;c &eacute;</p>": "a &lt; b \xa0c é",
    "<b>never <i>closed": "**never *closed***",
    "</p></li></table></a>x": "x",
}


@pytest.mark.parametrize("html", CASES)
def test_pages(html):
    assert HS.to_markdown(html) == CASES[html]


def test_tables_of_pages(spark):
    rows = [(1, "<p>a</p>"), (2, None), (3, "<script>x</script>"), (4, "<ul>" + "<li>item</li>" * 50_000 + "</ul>"), (None, "b")]
    df = spark.createDataFrame(rows, "page_id long, html string")
    got = {r.page_id: (r.markdown, r.error) for r in HS.convert_structured(df).collect()}
    assert got[1] == ("a", None) and got[2] == (None, "no content") and got[3] == (None, "empty conversion") and got[None] == ("b", None)
    assert got[4][0].count("- item") == 50_000
    assert HS.convert_structured(df.limit(0)).collect() == []
    files = spark.createDataFrame([("a.html", bytearray(b"<h1>T</h1>")), ("b.html", bytearray(b"caf\xe9")), ("c.html", None)], "key string, content binary")
    plug = {r.key: (r.markdown, r.error) for r in CV.convert_with(files, HS.converter).collect()}
    assert plug == {"a.html": ("# T", None), "b.html": ("café", None), "c.html": (None, "no content")}
