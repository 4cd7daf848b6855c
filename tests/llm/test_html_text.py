import pytest

from reelstat.llm.html_text import extract, visible_text

CASES = {
    "implied ends": ("<p>one<p>two<div>three", "one\n\ntwo\n\nthree"),
    "list items without ends": ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    "numbered list": ("<ol start=9><li>x<li>y<li value=20>z</ol>", "9. x\n10. y\n20. z"),
    "table": (
        "<table><tr><th>Name<th>Qty<tr><td>Apple pie<td>10<tr><td>Fig<td>5</table>",
        "Name       Qty\nApple pie  10\nFig        5",
    ),
    "cells across and down": (
        "<table><tr><td rowspan=2>A<td>b<td>c<tr><td colspan=2>wide<tr><td>x<td>y<td>z</table>",
        "A  b  c\n   wide\nx  y  z",
    ),
    "cells without a row": ("<table><td>a<td>b</table>", "a  b"),
    "table in a cell": ("<table><tr><td>x<table><tr><td>1<td>2</table><td>y</table>", "x     y\n\n1  2"),
    "caption": ("<table><caption>Title</caption><tr><td>a</table>", "Title\na"),
    "pre": ("<pre>a\n  b\n\nc</pre>d", "a\n  b\n\nc\n\nd"),
    "space between words": ("a <b>b</b><i>c</i>\n\n d", "a bc d"),
    "line break": ("a<br>b<br><br>c", "a\nb\n\nc"),
    "character references": ("&lt;a&gt; &amp; &eacute;&#233; &copy", "<a> & éé ©"),
    "not shown": (
        "<head><title>t</title></head><script>s</script><style>p{}</style><template>x</template>"
        "<p hidden>h</p><p style='display: none'>n</p>yes", "yes",
    ),
    "hidden by a style sheet": (
        "<style>.a{display:none} #b , i{visibility:hidden}</style><p class='z a'>1</p><p id=b>2</p><i>3</i>4",
        "4",
    ),
    "visible inside invisible": ("<div style='visibility:hidden'>a<b style='visibility:visible'>b</b></div>", "b"),
    "closed details": ("<details><summary>s</summary>x</details><details open><summary>t</summary>y</details>", "s\nt\ny"),
    "selected option": ("<select><option>a<option selected>b</select>", "b"),
    "comments and declarations": ("<!doctype html><!-- <p>x --><p>y</p><!-- never closed", "y"),
    "attribute with a bracket": ("<a title='x > y'>link</a>", "link"),
    "lone signs": ("a < b > c & d", "a < b > c & d"),
    "definition list": ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    "unclosed inline": ("<p><b>x<p>y", "x\n\ny"),
    "stray end tags": ("a</div></p>b</table>c", "a\n\nbc"),
    "quote": ("<blockquote>q</blockquote>r", "  q\n\nr"),
    "inside a cell a paragraph's end stays inside": ("<p>a<table><tr><td>b</p>c</table>d", "a\n\nb\nc\n\nd"),
    "nothing": ("", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_rendering(name):
    page, expected = CASES[name]
    found = visible_text(page)
    assert [x.rstrip() for x in found.split("\n") if x.strip()] == [
        x.rstrip() for x in expected.split("\n") if x.strip()
    ]


@pytest.mark.parametrize(
    "name", ["implied ends", "list items without ends", "table", "pre", "line break", "definition list"]
)
def test_blocks_keep_their_distance(name):
    page, expected = CASES[name]
    assert visible_text(page) == expected


def test_deep_and_long_pages():
    assert visible_text("<div>" * 50_000 + "x") == "x"
    assert visible_text("<span>" * 50_000 + "x</b>" * 1000).startswith("x")
    assert visible_text("<ul><li>" * 300 + "x").endswith("- x")
    assert len(visible_text("<p>word " * 100_000).split()) == 100_000
    wide = "<table>" + "<tr><td>" + "y" * 10_000 + "<td>z" + "<tr><td>a<td>b" * 500 + "</table>"
    assert len(visible_text(wide)) < 30_000


def test_every_visible_word_is_kept():
    page = "".join(
        f"<{t}> w{i} " for i, t in enumerate("div p li td tr th b i ul ol table dd dt h1 span section".split() * 30)
    )
    words = {x for x in visible_text(page).split() if x.startswith("w")}
    assert words == {f"w{i}" for i in range(16 * 30)}


def test_edges(frame):
    rows = [(1, "<p>a", "x"), (1, "<p>a", "x"), (None, None, "x"), (2, "", None)]
    pages = frame("page_id long, html string, text string", rows)
    found = sorted((str(r["page_id"]), r["text"], r["n_words"]) for r in extract(pages).collect())
    assert found == [("1", "a", 1), ("1", "a", 1), ("2", "", 0), ("None", "", 0)]
    assert extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("sheet, shown", [
    ("@media print { .main { display:none } }", True),
    ("@media screen and (max-width: 600px) { .main { display:none } }", True),
    ("@media (min-width: 600px) { .main { display:none } }", False),
    ("@media print { p { color: red } .main { display:none } } .main { color: red }", True),
    ("@media all { @supports (display: grid) { .main { display:none } } }", False),
    ("@media not print { .main { display:none } }", False),
    ("@media (prefers-color-scheme: dark) { .main { display:none } }", True),
    ("@import url('x{}'); @font-face { src: 'a;}' } .main { display: none }", False),
    (".main { display: block !important } .main { display: none }", True),
    ("#m { display: block } .main { display: none } p { display: none }", True),
    ("#m { display: block } p { display: none !important }", False),
    (".main { display: block } @layer a { #m { display: none } }", True),
    ("p { display: block } .main { display: none } .main { display: block }", True),
])
def test_style_sheets_count_as_on_a_screen(sheet, shown):
    found = visible_text(f"<style>{sheet}</style><p id=m class=main>text</p>end")
    assert found.split() == (["text", "end"] if shown else ["end"])


def test_media_of_a_style_element_and_inline_style():
    page = "<style media=print>p{display:none}</style><style>i{display:none!important}</style>"
    assert visible_text(page + "<p>a</p><i style='display:inline'>b</i>c").split() == ["a", "c"]


def test_formulas_and_the_text_of_drawings():
    page = (
        "a <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>tex</annotation></math> <svg><title>t</title><desc>d</desc>"
        "<defs><text>no</text></defs><g><text>one</text><text>two <tspan>three</tspan></text></g>loose"
        "<g style='display:none'><text>no</text></g><path d='M0'/></svg> b"
    )
    assert visible_text(page).split() == ["a", "x=2", "one", "two", "three", "b"]
