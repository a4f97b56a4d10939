import time
from html.parser import HTMLParser

from pyspark.sql import functions as F

from tallyworks.llm import html_text
from tests.llm.conftest import SF


# The check's own lists: elements without rendering in the HTML standard, those that browsers here never fall back to, and what a head may hold.
NEVER_SHOWN = {"head", "title", "style", "script", "template", "datalist", "noscript", "iframe", "noembed", "noframes", "object", "audio", "video", "canvas"}
IN_HEAD = {"title", "style", "script", "noscript", "template", "noframes", "base", "basefont", "bgsound", "link", "meta"}


class Plain(HTMLParser):
    """Words outside of elements that are never shown; a head ends where the standard ends it."""

    def __init__(self):
        super().__init__()
        self.words, self.hidden = [], []

    def handle_starttag(self, tag, attrs):
        if self.hidden == ["head"] and tag not in IN_HEAD:
            self.hidden = []
        if tag in NEVER_SHOWN:
            self.hidden.append(tag)

    def handle_endtag(self, tag):
        if self.hidden and tag == self.hidden[-1]:
            self.hidden.pop()

    def handle_data(self, data):
        if self.hidden == ["head"] and data.strip():
            self.hidden = []
        if not self.hidden:
            self.words.append(data)


def joined(text):
    return "".join(text.split())


def test_query_holds_every_visible_character(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = html_text.op5_html(spark, SF).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        plain = Plain()
        plain.feed(pages[r.page_id])
        plain.close()
        shown = joined(r.text.replace("- ", ""))
        assert shown == joined("".join(plain.words).replace("- ", "")), r.page_id


def test_blocks_and_inline():
    assert html_text.render("<p>a  b\n<b>c</b>d<p>e<div>f</div>g<br>h<h1>i</h1>j") == "a b cd\n\ne\n\nf\ng\nh\n\ni\n\nj"
    assert html_text.render("x &lt;b&gt; &amp; 1 < 2") == "x <b> & 1 < 2"
    assert html_text.render("<pre>a\n  b\n\nc</pre>d") == "a\n  b\n\nc\n\nd"


def test_lists():
    page = "<ul><li>a<li>b<ol start=3><li>c<li>d</ol><li>e</ul><dl><dt>t<dd>u</dl>"
    assert html_text.render(page) == "- a\n- b\n 3. c\n 4. d\n- e\n\nt\n  u"


def test_tables():
    page = ("<table><caption>cap</caption><thead><tr><th>name<th>n<tbody><tr><td>longer name<td>1<tr><td rowspan=2>x<td>2"
            "<tr><td>3<tr><td colspan=2>all</table>after")
    assert html_text.render(page) == "cap\n\nname         n\nlonger name  1\nx            2\n             3\nall\n\nafter"
    assert html_text.render("<table><td>a<br>b<td><table><tr><td>c<td>d</table></table>") == "a  c  d\nb"


def test_visibility():
    page = ("<head><title>t</title><style>.no, #x {display: none} b{color:red}</style></head><p hidden>1<p style='display:none'>2"
            "<p class='a no'>3<p id=x>4<p>5<template>6</template><script>'</p>7'</script><details>8<summary>s</summary>9<p>10</details>"
            "<details open>11</details><!-- 12 --><dialog>13</dialog><textarea>a &amp; b</textarea>")
    assert html_text.render(page).split() == ["5", "s", "11", "a", "&", "b"]


def test_soup():
    assert html_text.render("</p></div>a</b>") == "a"
    assert html_text.render("<i>a<b>b</i>c</b>d") == "abcd"
    assert html_text.render("a<b") == "a"
    assert html_text.render("a<b title=\"x>y\">c</b><a href='u'>d") == "acd"
    assert html_text.render("a<script>b") == "a" and html_text.render("a<!-- b") == "a" and html_text.render("< a <1") == "< a <1"
    assert html_text.render("<div>" * 50_000 + "deep" + "<li>" * 2_000) == "deep"
    assert html_text.render("<a " * 50_000) == ""


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "  "), (4, "<p>x"), (4, "<p>x"), (None, "y"), (5, "<p>" + "word " * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("old"))
    found = [(r.page_id, r.text) for r in html_text.visible_text(pages).collect()]
    assert sorted(found[:6], key=str) == sorted([(1, ""), (2, ""), (3, ""), (4, "x"), (4, "x"), (None, "y")], key=str)
    assert len(found[6][1]) == 999_999
    assert html_text.visible_text(pages.filter("false")).collect() == []


def words(css, body):
    return html_text.render(f"<head><style>{css}</style></head>{body}").split()


def test_media_rules():
    body = "<p class=x>1<p class=side>2<p>3"
    for head in ("print", "(max-width:600px)", "not screen", "screen and (max-width: 40em)", "(width < 700px)", "(prefers-color-scheme: dark)", "speech, print",
                 "(min-width: 100px) and (max-width: 600px)", "(400px <= width <= 700px)"):
        assert words("@media %s{.x{display:none} .side{visibility:hidden}} i{}" % head, body) == ["1", "2", "3"], head
    for head in ("screen", "all", "(min-width:600px)", "only screen and (min-width: 40em)", "print, screen", "not print", "(width >= 700px)", "not all and (max-width: 600px)"):
        assert words("@media %s{.x{display:none}}" % head, body) == ["2", "3"], head
    assert words("@import url('a;b'); @font-face{display:none} @keyframes k{p{display:none}} @supports (a:b){.x{display:none}}", body) == ["2", "3"]
    assert words("@media print{@media screen{.x{display:none}} p{display:none}} /* } */ .side{display:none", body) == ["1", "3"]
    assert html_text.render("<style media=print>p{display:none}</style><template><style>p{display:none}</style></template><p>1") == "1"


def test_cascade():
    body = "<p class='d-none d-md-block'>1<p class=d-none>2<p id=a class=no>3<p>4"
    assert words(".d-none{display:none!important} @media (min-width:768px){.d-md-block{display:block!important}}", body) == ["1", "3", "4"]
    assert words(".d-none{display:none} .d-none{display:block}", body) == ["1", "2", "3", "4"]
    assert words("#a{display:block} .no{display:none} p{display:none} .d-md-block{display:flex}", body) == ["1", "3"]
    assert words("p.d-none{display:none} .d-none{display:block} .no{color:red;display:none;display:inline}", body) == ["3", "4"]
    assert words(".x{display:none}", "<p class=x style='display:block'>1<p class=x>2") == ["1"]
    assert words(".x{display:none !important}", "<p class=x style='display:block'>1<p hidden>2") == []
    assert words("p{display:block}", "<p hidden>1") == ["1"]
    assert words(".x{visibility:hidden} .y{visibility:visible}", "<div class=x>1<b>2</b><b class=y>3</b></div>4") == ["3", "4"]
    assert words(".x{color:red; .y{display:none}} .z{visibility:hidden}", "<p class=x>1<ul><li class=z>2<li>3</ul>") == ["1", "-", "3"]


def test_formulas_and_drawings():
    assert html_text.render("a <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><annotation>tex</annotation></math> b") == "a x= 1 2 b"
    page = ("<svg width=9><title>t</title><defs><text>no</text></defs><rect x=1 /><defs/>stray<g><text x=1>first <tspan>label</tspan></text>"
            "<text>second</text></g><text display='none'>z</text><foreignObject><div>html</div></foreignObject></svg>after")
    assert html_text.render(page).split("\n") == ["first label", "second", "html", "after"]
    assert html_text.render("<svg/>a<math/>b") == "ab"


def test_a_head_ends_where_it_must():
    render = html_text.render
    assert render("<head><meta charset=utf-8><title>x</title><h1>Head one</h1><p>text") == "Head one\n\ntext"
    assert render("<html><head><title>T</title><p>Hello world</p></html>") == "Hello world"
    assert render("<head> \n <link rel=x>\n text<p>more") == "text\n\nmore"
    assert render("<p>a<head><b>b</b></head>c") == "abc" and render("a<head>b") == "ab" and render("<head><head>x</head>y") == "xy"
    assert render("<head><template><p>no</p></template><noscript><p>no</p></noscript></head>yes") == "yes"
    for page in ("<head><title>a</title>b<p>c", "<html><head><meta><body>d", "<head><script>e</script><div>f</div></head>g"):
        plain = Plain()
        plain.feed(page)
        assert joined(render(page)) == joined("".join(plain.words))


def test_last_line_of_pre():
    render = html_text.render
    assert render("<pre>a\n  b</pre>c") == "a\n  b\n\nc" and render("<pre>\n  x\n y\n</pre>") == "  x\n y"
    assert render("<pre>a\n  b<div>  c</div></pre>") == "a\n  b\n  c" and render("x<pre>\n</pre>y") == "x\n\ny"


def test_list_numbers_and_markers():
    render = html_text.render
    assert render("<ol><li value=7>x<li>y</ol>") == "7. x\n8. y"
    assert render("<ol type=a start=26><li>x<li>y</ol>") == "z. x\naa. y" and render("<ol type=I start=8><li>x<li type=i>y</ol>") == "VIII. x\nix. y"
    assert render("<ol reversed><li>x<li>y<li value=9>z<li>w</ol>") == "4. x\n3. y\n9. z\n8. w"
    assert render("<ul style='list-style: none'><li>a<ul><li>b</ul></ul>") == "  a\n  - b"
    assert render("<style>.n{list-style-type:none}</style><ul class=n><li>a<li style='list-style:disc'>b</ul>") == "  a\n- b"
    assert render("<style>nav{color:red}li{display:inline-block}</style><ul><li>a</ul>") == "  a"
    assert [html_text.numbered(n, "A") for n in (1, 26, 27, 702, 703, 0)] == ["A", "Z", "AA", "ZZ", "AAA", "0"]
    assert html_text.numbered(1994, "i") == "mcmxciv" and html_text.numbered(4000, "I") == "4000"


def test_buttons_and_selects():
    render = html_text.render
    assert render("<input type=submit value=Go> <input type=button value=No style='display:none'><input value=typed>") == "Go"
    assert render("<select><option>a<option selected>b<option>c</select>d") == "b\nd"
    assert render("<select><option>a<option>b</select>") == "a" and render("<select multiple><option>a<option>b</select>") == "a\nb"
    assert render("<select size=3><option>a<option>b</select>") == "a\nb" and render("<select></select>x") == "x"


def test_wide_tables_cost_their_cells():
    page = "<table>" + "".join(f"<tr><td colspan=1000 rowspan=1000>c{i}" for i in range(300)) + "</table>"
    start = time.perf_counter()
    rows = html_text.render(page).split("\n")
    assert time.perf_counter() - start < 1
    assert [r.split() for r in rows] == [[f"c{i}"] for i in range(300)] and rows[2].index("c2") > rows[1].index("c1")
