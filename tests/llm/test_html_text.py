from __future__ import annotations

import pytest

from contractflow.llm.html_text import extract_text, page_text
from tests.llm.support import clashing

CASES = {
    "<p>a<p>b  c<br>d": "a\n\nb c\nd",
    "<ul><li>x<li>y<ul><li>z</ul><li>w</ul>after": "- x\n- y\n  - z\n- w\n\nafter",
    "<ol start=3><li>q</li><li>r<p>s</p></ol>": "3. q\n4. r\n  s",
    "<table><caption>cap</caption><tr><th>N<th>Long name<tr><td>1<td>2<tr><td colspan=2>a wide cell</table>t": "cap\nN | Long name\n1 | 2\na wide cell\n\nt",
    "<table><tr><td>a<table><tr><td>i<td>j</table><td>b</table>": "a     | b\ni | j |",
    "<head><title>t</title></head><body>v<script>x<p></script><div hidden>h</div><i style='x:1; display: none'>n</i><b>bo</b>ld": "vbold",
    "<pre>a\n  b\n\nc</pre>z": "a\n  b\n\nc\n\nz",
    "<div>a</div><div>b</div><h1>H</h1>text": "a\nb\n\nH\n\ntext",
    "x &amp; y &lt;z&#233;": "x & y <zé",
    "a<!-- c -->b</p></div>": "ab",
    "<dl><dt>t<dd>d</dl>": "t\n  d",
    "<p>one</p> <p>two</p>": "one\n\ntwo",
    "<td>loose<li>item": "loose\n- item",
    "<dialog>shut</dialog><dialog open>shown</dialog>": "shown",
    "": "",
    "<script>only()</script>": "",
    "5 < 6 and <": "5 < 6 and <",
}


@pytest.mark.parametrize("html", CASES)
def test_pages(html):
    assert page_text(html) == CASES[html]


TABLES = {
    "<table><thead><th>Name<th>Age</thead><tr><td>Al<td>7</table>": "Name | Age\nAl   | 7",
    "<table><td>a<td>b<tr><td>c<td>d</table>": "a | b\nc | d",
    "<table><caption>cap<td>a<tr><td>b</table>": "cap\na\nb",
    "<table><colgroup><col><tr><td>a<td>b</table>": "a | b",
    "<table><colgroup>odd</colgroup><tr><td>a</table>": "odd\na",
    "<table><tr><form><td>x</td></form><td>y</td></tr></table>": "x | y",
    "<table><tr><div><b>t<td>x</td></b></div><td>y</td></tr></table>z": "t\nx | y\n\nz",
    "<table><form><tr><td>x</td></tr></form><tr><td>y</table>": "x\ny",
    "<table><tr>one<td>x</td>two</tr>three<tr><td>y</table>": "one\ntwo\nthree\nx\ny",
    "<table><tbody>in body<tr><td>x</tbody></table>": "in body\nx",
    "<table><tr><td>x</td><p>par</p><ul><li>item</ul></tr></table>": "par\n- item\nx",
    "<table><tr><td>x</td><table><tr><td>inner</table></tr></table>": "inner\nx",
    "<table><tr>only text</tr></table>": "only text",
    "<table><tr hidden><td>h</td></tr><tr><template><td>t</td></template><td>x</td><script>s</script></table>": "x",
}


@pytest.mark.parametrize("html", TABLES)
def test_no_text_of_a_table_is_lost(html):
    assert page_text(html) == TABLES[html]


HEADS = {
    "<html><head><title>T</title><p>Hello <b>you</b><p>there": "Hello you\n\nthere",
    "<head><meta charset=x><link rel=y><style>s</style><script>s</script><template><p>t</p></template>\n<div>a</div>b": "a\nb",
    "<head>\n <title>T</title>\n plain <i>text</i>": "plain text",
    "<head><title>T</title></head>\n<p>a": "a",
    "<head><title>T</title><table><tr><td>a<td>b</table>": "a | b",
    "<p>a<head>b": "ab",
    "<head><title>T</title><body>a": "a",
    "<head><noscript><p>n</p></noscript><base href=x>&nbsp;a": "\xa0a",
    "<head><title>T</title></head>": "",
}


@pytest.mark.parametrize("html", HEADS)
def test_an_open_head_ends_where_the_page_begins(html):
    assert page_text(html) == HEADS[html]


SPANS = {
    "<table><tr><td rowspan=2>A<td>B<tr><td>C</table>": "A | B\n  | C",
    "<table><tr><td>a<td rowspan=3>tall<td>c<tr><td>d<td>f<tr><td>g<td>i<tr><td>j<td>k</table>": "a | tall | c\nd |      | f\ng |      | i\nj | k",
    "<table><tbody><tr><td rowspan=0>A<td>B<tr><td>C<tbody><tr><td>D<td>E</table>": "A | B\n  | C\nD | E",
    "<table><tr><td rowspan=2 colspan=2>ab<td>c<tr><td>d<tr><td>e<td>f<td>g</table>": "ab    | c\n      | d\ne | f | g",
    "<table><tr><td>a<td rowspan=9>b</table>": "a | b",
    "<table><tr><td rowspan=2>a<td>b<tr><tr><td>c</table>": "a | b\nc",
}


@pytest.mark.parametrize("html", SPANS)
def test_cells_over_several_rows(html):
    assert page_text(html) == SPANS[html]


VEILS = {
    "<div style='visibility:hidden'>h<b style='visibility: visible'>seen</b>h</div>": "seen",
    "<p style='visibility:hidden'>h<span style='visibility:visible'>a<i style='visibility:collapse'>b</i>c</span>": "ac",
    "<div style='display:none'>h<b style='visibility:visible'>h</b></div>a": "a",
    "<table style='visibility:hidden'><caption>h</caption><tr>h<td>h<td style='visibility:visible'>x</table>": "| x",
    "<div style='visibility:hidden;visibility:visible'>a</div>": "a",
}


@pytest.mark.parametrize("html", VEILS)
def test_visible_within_hidden(html):
    assert page_text(html).strip() == VEILS[html]


def test_what_is_added_to_the_text_is_bounded():
    wide = "<table><tr><td>" + "w" * 20_000 + "<td>b" + "<tr><td>a<td>b" * 2_000 + "</table>"
    lists = "<ul><li>x" * 3_000
    columns = "<table><tr>" + "<td>" * 1_000 + "x<br>" * 1_000 + "</table>"
    steps = "<table><tr>" + "".join(f"<td>{'y' * 40}" for _ in range(10)) + "<td>" + "x<br>" * 20_000 + "</table>"
    spans = "<table>" + "<tr><td colspan=1000 rowspan=65000>z<td>q" * 1_000 + "</table>"
    deep = "<table><tr><td>a<td>" * 16 + "<br>".join(["b"] * 500)
    for page, mark, times in ((wide, "w", 20_000), (lists, "x", 3_000), (columns, "x", 1_000), (steps, "x", 20_000), (spans, "z", 1_000), (deep, "b", 500)):
        text = page_text(page)
        assert text.count(mark) == times
        assert len(text) < 16 * len(page), (page[:40], len(text), len(page))


def words_of(node):
    """The visible words of a built page, by its own plain rules: nothing of what is gone, the rest where it is not hidden."""
    tag, style, children = node
    if tag in ("script", "template") or "display" in style:
        return []
    own = []
    for child in children:
        if isinstance(child, str):
            own += [] if node_veiled(style) else child.split()
        else:
            own += words_of((child[0], child[1] or style, child[2]))
    return own


def node_veiled(style):
    return "hidden" in style


def built(node):
    tag, style, children = node
    inside = "".join(c if isinstance(c, str) else built(c) for c in children)
    return f"<{tag}{f' style={chr(39)}{style}{chr(39)}' if style else ''}>{inside}</{tag}>"


def random_page(rng, depth=0):
    tag = rng.choice(["div", "p", "ul", "b", "table", "blockquote", "pre", "script", "section", "td"]) if depth else "div"
    style = rng.choice(["", "", "", "visibility:hidden", "visibility:visible", "display:none"]) if depth else ""
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(6))
    if tag == "script":
        return (tag, style, [word()])
    inner = lambda: random_page(rng, depth + 1) if depth < 4 and rng.random() < 0.6 else word() + " "
    if tag == "table":
        return (tag, style, [("tr", "", [(rng.choice(["td", "th"]), rng.choice(["", "", "visibility:visible"]), [inner()]) for _ in range(rng.randint(1, 3))]) for _ in range(rng.randint(1, 3))])
    if tag == "ul":
        return (tag, style, [("li", "", [inner()]) for _ in range(rng.randint(1, 3))])
    tag = "div" if tag in ("td", "p") else tag
    return (tag, style, [inner() for _ in range(rng.randint(1, 3))])


@pytest.mark.parametrize("seed", range(300))
def test_all_visible_words_of_random_pages(seed):
    import random
    import re

    page = random_page(random.Random(seed))
    assert sorted(re.findall("[a-g]{6}", page_text(built(page)))) == sorted(words_of(page))


def test_deep_tables_without_cells():
    assert page_text("<table><tr>" * 3_000 + "x") == "x"
    assert page_text("<table><tr><td>a</td>" * 300).count("a") == 300
    assert page_text("<table><tr>" + "<form><td>y</td></form>" * 2_000).count("y") == 2_000


def test_deep_and_long_pages():
    assert page_text("<div>" * 50_000 + "x") == "x"
    assert page_text("<table><tr><td>" * 3_000 + "x") == "x"
    assert page_text("<b><p>" * 20_000 + "y").endswith("y")
    assert len(page_text("word " * 300_000)) == 5 * 300_000 - 1


def test_table(spark):
    pages = [(1, "<p>a"), (1, "<p>a"), (None, None), (3, ""), (4, "\x00<p>\x0b"), (5, "x" * 3_000_000)]
    df = clashing(spark.createDataFrame(pages, "page_id long, html string"), "page_text", "n_chars")
    got = {(r["page_id"], r["page_text"]) for r in extract_text(df).collect()}
    assert got == {(i, page_text(h)) for i, h in pages}
    assert extract_text(df.limit(0)).count() == 0
