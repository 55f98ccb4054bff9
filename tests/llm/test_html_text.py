"""HTML extraction: layout, implied tags, visibility, broken markup."""

import random
import re
import time

import pytest

from incentiva.llm.html_text import align, extract_text, page_text

CASES = [
    ("<p>one<p>two", "one\n\ntwo"),
    ("<h1>H</h1>text<div>a</div><div>b</div>", "H\n\ntext\na\nb"),
    ("a <b> b </b> c\n\n d", "a b c d"),
    ("x<br>y<br><br>z", "x\ny\n\nz"),
    ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>", "- a\n- b\n  3. x\n  4. y\n- c"),
    ("<dl><dt>t<dd>d1<dd>d2<dt>u</dl>", "t\n  d1\n  d2\nu"),
    ("<table><tr><th>Name<th>N<tr><td>alpha<td>1<tr><td>b<td>22</table>after", "Name   N\nalpha  1\nb      22\n\nafter"),
    ("<table><tr><td colspan=2>wide<td>z<tr><td>a<td>b<td>c</table>", "wide     z\na     b  c"),
    ("<table><td>outer<table><tr><td>in<td>ner</table></table>", "outer\n\nin  ner"),
    ("<pre>  a\n   b\n\nc</pre>", "  a\n   b\n\nc"),
    ("<blockquote>q<p>r</blockquote>", "  q\n\n  r"),
    ("<head><title>no</title></head><script>var x='<p>'</script><style>p{}</style>yes<!-- no --><template>no</template>", "yes"),
    ("<style>.x, #y {display: none} p{color:red}</style><p class='a x'>no</p><p id=y>no</p><p>yes</p>", "yes"),
    ("<div hidden>no</div><div style='display:none'>no<b>no</b></div>yes", "yes"),
    ("<div style='visibility:hidden'>no<i style='visibility:visible'>yes</i></div>", "yes"),
    ("<details>no<summary>sum</summary>no</details><details open><summary>s</summary>body</details>", "sum\ns\nbody"),
    ("a &lt;b&gt; &amp; &eacute;&#233;", "a <b> & éé"),
    ("1 < 2 <3", "1 < 2 <3"), ("<", "<"), ("", ""), ("<a href='x", ""), ("<p", ""), ("</p></div>x", "x"),
    ("<select><option>a<option>b</select>", "a\nb"), ("<noscript>seen</noscript>", "seen"), ("<textarea> t </textarea>", "t"),
    ("<td>loose</td> cell", "loose cell"), ("<svg><path d=''/></svg>x", "x"), ("<![CDATA[raw]]>", "raw"),
    ("<p>a</p>\n\n\n<p>b</p>", "a\n\nb"), ("<li>x", "- x"), ("<nav><ul><li><a>l1</a></li><li><a>l2</a></li></ul></nav>t", "- l1\n- l2\n\nt"),
]


@pytest.mark.parametrize("html, text", CASES)
def test_layout(html, text):
    assert page_text(html) == text


def test_deep_and_long():
    assert page_text("<div>" * 50000 + "x" + "</div>" * 50000) == "x"
    assert page_text("<b>" * 50000 + "x") == "x"
    assert len(page_text("<p>word</p>" * 50000).split()) == 50000
    assert page_text("<table>" * 3000 + "<td>x") == "x"


def test_align():
    assert align([["a", "bb\nb"], ["ccc", ""]]) == "a    bb\n     b\nccc"
    wide = align([["x" * 500, "y"], ["z", "w"]])
    assert max(map(len, wide.split("\n"))) == 503 and len(wide.split("\n")[1]) == 63


def test_spark(spark):
    rows = [(1, "u", "<p>a", 5), (1, "u", "<p>a", 5), (2, None, None, 6), (None, "u", "", 7)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, c0 int")
    got = extract_text(df)
    assert got.columns == ["page_id", "url", "c0", "text"]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, [(1, "u", 5, "a"), (1, "u", 5, "a"), (2, None, 6, None), (None, "u", 7, "")]))
    assert extract_text(df.limit(0)).count() == 0


def test_all_visible_text_of_pages_is_kept(spark):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    for html in pages[:100]:
        import re

        body = re.sub(r"(?is)<!--.*?-->|<(script|style|title|template)\b.*?</\1\s*>", " ", html)
        plain = re.sub(r"<[^>]*>", " ", body)
        from html import unescape

        if "hidden" not in html and "display" not in html:
            assert sorted(re.findall(r"\w+", page_text(html))) == sorted(re.findall(r"\w+", unescape(plain)) + re.findall(r"(?m)^ *(\d+)\. ", page_text(html)))


def test_rules_inside_at_rules():
    page = "<style>{}</style><p class=nav>menu</p><p>text</p>"
    hidden = [".nav{display:none}", "@media screen{.nav{display:none}}", "@media print, all {.x{color:red} .nav{display:none}}",
              "@import url(a;b.css); .nav{display:none}", "@layer base{.nav{display:none}}", ".x::before{content:'}'} .nav{display:none}",
              "@media print{.x{display:none}} .nav{color:red; display:none}", "/* @media print{ */ .nav{display:none}", "@MEDIA Only Screen{.nav{display:none}}"]
    shown = ["@media print{.nav, footer{display:none}}", "@media (max-width:600px){.nav{display:none}}", "@media screen and (max-width:9px){.nav{display:none}}",
             "@supports (x:y){@media screen{.nav{display:none}}}", "@media not screen{.nav{display:none}}", ".x{color:red; .nav{display:none}}",
             "@media print{.a{color:red} .nav{display:none}}", ".x::before{content:'.nav{display:none}'}"]
    assert {page_text(page.replace("{}", css)) for css in hidden} == {"text"}
    assert {page_text(page.replace("{}", css)) for css in shown} == {"menu\n\ntext"}
    assert page_text("<style media=print>.nav{display:none}</style><p class=nav>menu</p>") == "menu"


def test_stray_quotes_in_tags():
    cases = {
        "<p title=\"5\" screen\">Visible text <a href=\"x\">link</a> and more</p><p class=\"b\">second</p>": "Visible text link and more\n\nsecond",
        "<p title=don't>Hello, it's seen</p>": "Hello, it's seen",
        "<p don't>Hello, it's seen</p>": "Hello, it's seen",
        "<p title=\"a > b\" x='c > d'>e</p>": "e",
        "<p title = \"open>one</p><p>two</p>": "one\n\ntwo",
        "<p a=>one</p><p a='\"'hidden>no</p>": "one",
        "<p a=/x/ hidden>no</p>one</p title='>'>": "one",
        "<p title=5\" hidden>no</p><p =\" class='x'>it's</p>": "it's",
        "one<p a=\"x": "one",
    }
    assert {html: page_text(html) for html in cases} == cases


def test_cascade():
    p = "<p class=a id=i>seen</p><p>end</p>"
    shown = [".a{display:none} .a{display:block}", ".a{display:none} #i{display:block} .a{display:none}", "p{display:none} *{display:none} .a{display:block}p+p{}",
             ".a{display:block!important} #i{display:none}", ".b{display:none}", "p.a{display:block} .a{display:none} p{display:block}"]
    gone = [".a{display:none}", "#i{display:none} .a{display:block}", ".a{display:none !important} #i{display:block}", "P.A{DISPLAY:NONE}", "p{display:block} .a{color:red;display:none}"]
    for css in shown:
        assert "seen" in page_text(f"<style>{css}</style>{p}"), css
    for css in gone:
        assert page_text(f"<style>{css}</style>{p.replace('<p>end', '<div>end')}") in ("end", "end\n"), css
    assert page_text("<style>.a{display:none}</style><p class=a style='display:block'>seen") == "seen"
    assert page_text("<style>.a{display:none!important}</style><p class=a style='display:block'>no") == ""
    assert page_text("<style>.a{display:block}</style><p class=a style='color:red; display:none'>no") == ""
    assert page_text("<style>.b{display:none}.a{display:block}</style><p class='a b'>seen") == "seen"
    assert page_text("<style>.a{display:block}</style><p hidden class=a>seen</p><p hidden>no</p>") == "seen"
    assert page_text("<style>.v{visibility:hidden} .w{visibility:visible}</style><p class=v>no<b class=w>seen</b> no<i style='visibility:visible'> too</i></p>") == "seen too"


def test_white_space_is_that_of_html():
    assert page_text("a&nbsp;&nbsp;&nbsp;b") == "a\u00a0\u00a0\u00a0b"
    assert page_text("a\u3000b \f\r\n\t c\u2003d") == "a\u3000b c\u2003d"
    assert page_text("<p> x&nbsp; </p><p>&nbsp;</p>") == "x\u00a0\n\n\u00a0"
    assert page_text("a\x0b b") == "a\x0b b"


def test_spans_of_rows():
    assert page_text("<table><tr><td rowspan=2>A<td>b1<tr><td>b2<tr><td>c<td>d</table>") == "A  b1\n   b2\nc  d"
    assert page_text("<table><tr><td rowspan=0>A<td>b1<tr><td>b2<tr><td>b3</table>") == "A  b1\n   b2\n   b3"
    assert page_text("<table><tr><td>a<td rowspan=2 colspan=2>B<td>c<tr><td>d<td>e</table>") == "a  B  c\nd     e"
    assert page_text("<table><tr><td colspan='3px'>w<td>x<tr><td>1<td>2<td>3<td>4</table>") == "w        x\n1  2  3  4"
    rows = "".join(f"<tr><td rowspan=65534 colspan=1000>{i}" for i in range(3000))
    assert page_text(f"<table>{rows}</table>").split() == [str(i) for i in range(3000)]


@pytest.mark.parametrize("page", [
    "<b>" * 100_000 + "x" + "</i>" * 100_000, "<b>" * 100_000 + "<div>x</div>" * 50_000, "<i>" * 50_000 + "<body>" * 50_000 + "<li>x", "<td>" + "<i>" * 50_000 + "</b>" * 50_000 + "x",
    "<b><td>" + "<i>" * 50_000 + "</b>" * 50_000 + "x", "<blockquote>" * 50_000 + "x", "<ul><li>" * 30_000 + "x", "<dl><dd>" * 30_000 + "x", "<table><tr><td>" * 10_000 + "x" * 100_000,
    "<style>" + ".a{display:none}" * 20_000 + "</style>" + "<p class=b>x</p>" * 20_000, "<p style='" + "display: a " * 20_000 + "1'>x",
])
def test_time_is_linear_in_the_page(page):
    start = time.process_time()
    assert "x" in page_text(page)
    assert time.process_time() - start < 8


def plain_lines(node):
    """(lines, ends a line) of a tree of (tag, attributes, children): blocks and list items on lines of their own."""
    tag, attrs, children = node
    if "hidden" in attrs or "none" in attrs:
        return []
    out = []
    for c in children:
        out += [c] if isinstance(c, str) else plain_lines(c)
    return out if tag in ("b", "span") else [None, *(["- "] if tag == "li" else []), *out, None]


def random_tree(rng, depth=0):
    tag = rng.choice(["div", "section", "b", "span", "ul"] if depth < 4 else ["b", "span"])
    if tag == "ul":
        children = [("li", "", [rng.choice("stuvw"), *[random_tree(rng, depth + 2) for _ in range(rng.randrange(2))]]) for _ in range(rng.randrange(1, 3))]
    else:
        children = [random_tree(rng, depth + 1) if depth < 5 and rng.random() < 0.4 else rng.choice([f"{rng.choice('abcde')} {rng.choice('fgh')}", " ", "\n"])
                    for _ in range(rng.randrange(1, 5))]
    return tag, rng.choice(["", "", "", "", " hidden", " style='display:none'"]), children


def markup(node):
    return node if isinstance(node, str) else f"<{node[0]}{node[1]}>{''.join(map(markup, node[2]))}</{node[0]}>"


def test_random_trees_against_a_plain_renderer():
    """Words and the lines they stand on, without indents and blank lines."""
    rng = random.Random(21)
    for _ in range(1500):
        tree = ("div", "", [random_tree(rng) for _ in range(3)])
        lines, now = [], ""
        for part in plain_lines(tree) + [None]:
            if part is None:
                if now.strip(" \n-"):
                    lines.append(" ".join(now.split()))
                    now = ""
                now = now if now.strip() == "-" else ""
            else:
                now += part
        got = [" ".join(x.split()) for x in page_text(markup(tree)).split("\n") if x.strip()]
        assert [re.sub(r"^(- )+", "- ", x) for x in got] == [re.sub(r"^(- )+", "- ", x) for x in lines], markup(tree)
