import random
from html.parser import HTMLParser

import pytest

from carelattice.llm import queries
from carelattice.llm.html_layout import extract, rendered

CASES = {
    "<p>One <b>two</b>\n three<p>four<br>five": "One two three\n\nfour\nfive",
    "<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>after": "- a\n- b\n    3. x\n    4. y\n- c\n\nafter",
    "<table><caption>Cap<tr><th>Name<th>Value<tr><td>alpha<td>1<tr><td rowspan=2>be<td>22<tr><td>33<tr><td colspan=2>wide</table>": "Cap\n\nName  | Value\nalpha | 1\nbe    | 22\n      | 33\nwide",
    "<table><tr><td>a<br>b<td>c</table>": "a | c\nb |",
    "<head><title>T</title><style>p{}</style></head><div hidden>no</div><div style='display: none'>no<p>no</div>yes": "yes",
    "<span style='visibility:hidden'>no<i style='visibility:visible'>yes</i></span>": "yes",
    "<pre>\n a\n   b</pre>x": " a\n   b\n\nx",
    "<script>var t='<p>no</p>';</script>a < b &lt; c &amp; d": "a < b < c & d",
    "<details><summary>S</summary>no</details><details open><summary>S</summary>yes</details>": "S\nS\nyes",
    "<div>d1</div><div>d2</div><h1>H</h1>t": "d1\nd2\n\nH\n\nt",
    "x<!-- <p>no --> y<!-- open": "x y",
    '<a title="x>y">link</a> <a href=\'": z': "link <a href='\": z",
    "<dl><dt>t<dd>d<dt>u</dl>": "t\n  d\nu",
    "<td>loose</td></table></p>end": "loose\n\nend",
    "<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>": "in | ner | out",
    "": "",
    "<p>So <math><mi>E</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><semantics><annotation>no</annotation></semantics></math>, q.e.d.": "So E = 1 2 , q.e.d.",
    "<svg><title/><desc>no</desc><defs><text>no</text></defs><rect visibility='hidden'/><text x=1>Jan</text><text display='none'>no</text><text><![CDATA[a<b]]></text></svg>end": "Jan a<b end",
    "<svg><title>no</title><foreignObject><div/>in</foreignObject></svg><desc>kept</desc>": "in\nkept",
}


@pytest.mark.parametrize("source", CASES)
def test_layout(source):
    assert rendered(source) == CASES[source]


def test_deep_and_long():
    assert rendered("<div>" * 50_000 + "x") == "x"
    assert rendered("<table><tr><td>" * 3000 + "x") == "x"
    assert rendered("<li>" * 20_000) == ""
    assert len(rendered("<p>word " * 50_000)) > 200_000


def test_extract(spark):
    pages = spark.createDataFrame([(1, "<p>a", "u"), (2, None, "u"), (3, "", None), (None, "b", "u"), (1, "<p>a", "u")], "page_id long, html string, text string")
    got = extract(pages)
    assert sorted(((r["page_id"], r["text"]) for r in got.collect()), key=repr) == sorted([(1, "a"), (2, None), (3, ""), (None, "b"), (1, "a")], key=repr)
    assert extract(pages.where("false")).collect() == []


def test_query_shows_every_word_outside_hidden_parts(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["op5_html_layout"](spark, sf).collect()
    sources = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert {r["page_id"]: r["text"] for r in got} == {i: rendered(h) for i, h in sources.items()}
    assert all("track(" not in r["text"] and "margin:0" not in r["text"] for r in got)


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<style>.h, p.x{display:none}</style><div class='a h'>no</div><p class=x>no<p>yes", "yes"),
        ("<style>#i { color: red; visibility : hidden }</style><span id=i>no<b style='visibility:visible'>yes</b></span>", "yes"),
        ("<style>.h{display:none}.h{display:block}</style><p class=h>yes", "yes"),
        ("<style>p.h{display:block}.h{display:none}</style><p class=h>yes<div class=h>no</div>", "yes"),
        ("<style>.h{display:none !important}#i{display:block}</style><p class=h id=i>no</p>yes", "yes"),
        ("<style>@media print{p{display:none}}/* p{display:none} */ @import 'x'; .a .b{display:none} .c:hover{display:none}</style><p class='a b c'>yes", "yes"),
        ("<style media=print>p{display:none}</style><p>yes<p class=h style='display:block'>so</p><style>.h{display:none}</style>", "yes\n\nso"),
        ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"),
        ("<style>p{display:none", ""),
    ],
)
def test_style_sheets_and_dialogs(source, text):
    assert rendered(source) == text


class Walker(HTMLParser):
    """Visible words of a well-formed page: a stack of (shown, seen) and nothing else."""

    def __init__(self, hidden_classes):
        super().__init__()
        self.hidden, self.stack, self.words, self.raw = hidden_classes, [(True, True)], [], False

    def handle_starttag(self, tag, attrs):
        if tag in ("br", "hr", "img"):
            return
        attrs = dict(attrs)
        shown, seen = self.stack[-1]
        style = (attrs.get("style") or "").replace(" ", "")
        gone = any(c in self.hidden for c in (attrs.get("class") or "").split()) and "display:" not in style
        shown = shown and not (tag in ("script", "style", "template", "head") or "hidden" in attrs or "display:none" in style or gone or (tag == "dialog" and "open" not in attrs))
        if "visibility:" in style:
            seen = "visibility:visible" in style
        self.stack.append((shown, seen))

    def handle_endtag(self, tag):
        self.stack.pop()

    def handle_data(self, data):
        if all(self.stack[-1]):
            self.words += data.split()


def test_visible_words_against_a_plain_walk():
    rng = random.Random(11)
    for _ in range(300):
        count = iter(range(10_000))

        def tree(depth, rng=rng, count=count):
            out = ""
            for _ in range(rng.randint(1, 4)):
                out += rng.choice((f" w{next(count)} ", f" w{next(count)}<br> ", ""))
                if depth and rng.random() < 0.8:
                    tag = rng.choice(("div", "span", "section", "b", "dialog", "template", "article", "ul"))
                    attr = rng.choice(("", "", " hidden", " style='display: none'", " style='visibility:hidden'", " style='visibility: visible'", " class='x h1'", " class=h2 style='display:block'", " open", " class=x"))
                    inner = tree(depth - 1)
                    out += f"<{tag}{attr}>" + (f"<li>{inner}</li>" if tag == "ul" else inner) + f"</{tag}>"
            return out

        source = "<html><head><style>.h1{display:none} .h2 { color:red; display : none }</style><title>no</title></head><body>" + tree(4) + "</body></html>"
        walker = Walker({"h1", "h2"})
        walker.feed(source)
        assert [w for w in rendered(source).split() if w != "-"] == [w for w in walker.words if w != "no"], source
