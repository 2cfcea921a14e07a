import html.parser
import re

import pytest
from pyspark.sql import functions as F

from routecast.llm import html_text as h

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize(
    "page,want",
    [
        ("", ""),
        ("a  b\n c", "a b c"),
        ("<p>a<p>b", "a\n\nb"),
        ("<p>a<div>b</div>c", "a\n\nb\nc"),
        ("a<br>b<br/>c</br>d", "a\nb\nc\nd"),
        ("<b>a</b> <i>b</i>c", "a bc"),
        ("&lt;p&gt; &amp;amp; &eacute;&#x41;&nbsp;x", "<p> &amp; éA\xa0x"),
        ("<script>var t='</p>';<b></script>x<style>p{}</style>", "x"),
        ("<head><title>t</title><meta charset=x></head><body>b", "b"),
        ("<!doctype html><!-- a <b> -->x<!-->y<!--", "xy"),
        ("<div hidden>a</div><p style='color:red; display : none'>b</p><template>c</template>d", "d"),
        ("<div style=visibility:hidden>a<b style='visibility:visible'>b</b></div>", "b"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "- a\n- b\n  - c\n- d\n\ne"),
        ("<ol start=3><li>a<li value=9>b<p>c</ol>", "3. a\n9. b\n\n   c"),
        ("<ol reversed><li>a<li>b</ol>", "2. a\n1. b"),
        ("<pre>\n a\n  b </pre>c", " a\n  b\n\nc"),
        ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>x", "a    bb\nccc  d\n\nx"),
        ("<table><caption>T<tr><th>h<th>i<tbody><tr><td colspan=2>wide one<tfoot><tr><td>f</table>", "T\nh  i\nwide one\nf"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
        ("<table><tr><td>a<table><tr><td>x<td>y</table><td>b</table>", "a     b\nx  y"),
        ("<dl><dt>t<dd>d1<dd>d2</dl>", "t\n  d1\n  d2"),
        ("<select><option>a<option>b</select>", "a\nb"),
        ("<textarea> a <b> &amp;</textarea>", " a <b> &"),
        ("<a href='x>y' title=\"</p>\">l</a>m", "lm"),
        ("a < b <3 </ x> c<", "a < b <3 c<"),
        ("</p>a</div></b>b", "ab"),
        ("<p", ""),
        ("<h1>a<h2>b", "a\n\nb"),
        ("<p>a<table><tr><td><p>b</table>c", "a\n\nb\n\nc"),
        ("<blockquote>a<p>b</blockquote>", "  a\n\n  b"),
        ("<dialog>a</dialog><dialog open>b</dialog>", "b"),
    ],
)
def test_layout(page, want):
    assert h.render(page) == want


def test_hostile_pages():
    assert h.render("<div>" * 50000 + "x" + "</div>" * 50000) == "x"
    assert h.render("<ul><li>" * 3000 + "x").endswith("x")
    assert h.render("<table><tr><td>" * 3000 + "x").endswith("x")
    assert h.render("<b " + "a=1 " * 50000 + ">y") == "y"
    assert h.render("<" * 100000) == "<" * 100000
    assert len(h.render("<table>" + "<tr><td>" + "w" * 50000 + "<td>z" + "<tr><td>a<td>b" * 2000 + "</table>")) < 200000
    assert h.render("İ<script>a</script>İ<style>b</style>x") == "İİx"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


class Plain(html.parser.HTMLParser):
    """All words outside scripts, styles and the head, in order."""

    def __init__(self):
        super().__init__()
        self.words, self.off = [], 0

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style", "head")
        self.words.append(" " if tag not in ("b", "i", "a", "em", "strong", "span") else "")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style", "head")
        self.words.append(" " if tag not in ("b", "i", "a", "em", "strong", "span") else "")

    def handle_data(self, data):
        if not self.off:
            self.words.append(data)


def test_query_keeps_every_visible_word(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in h.op9_html_text(spark, SF).collect()}
    assert got.keys() == pages.keys()
    odd = 0
    for i, page in pages.items():
        p = Plain()
        p.feed(page)
        p.close()
        mine = [w for w in words(got[i]) if w not in ("-",) and not re.fullmatch(r"\d+\.", w)]
        theirs = [w for w in words("".join(p.words)) if w not in ("-",) and not re.fullmatch(r"\d+\.", w)]
        if mine != theirs:
            odd += 1
            if odd < 4:
                k = next((k for k, (a, b) in enumerate(zip(mine, theirs)) if a != b), min(len(mine), len(theirs)))
                print(i, mine[k - 3 : k + 6], theirs[k - 3 : k + 6])
    assert odd == 0


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "<p>x"), (3, "<p>x"), (None, "y")]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit(1))
    got = sorted(((r.page_id, r.text) for r in h.extract(df).collect()), key=str)
    assert got == sorted([(1, None), (2, ""), (3, "x"), (3, "x"), (None, "y")], key=str)
    assert h.extract(df.where("false")).collect() == []
