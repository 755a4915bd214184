import html
import random
import re

import pytest

from custodia.llm.html_page import parse
from custodia.llm.html_template import deduce_templates, equivalence_classes, extract, main_text, page_tokens

SCHEMA = "page_id long, url string, html string, text string, host string"


def texts(df):
    return {r.page_id: r.text for r in extract(df).collect()}


def plain(source):
    """Of the test tables' pages: blocks of the one article."""
    found = re.search(r"<article>(.*?)</article>", source, re.S)
    blocks = re.split(r"<br>|</?p>|</?h1>", re.sub(r"</?b>", "", found[1]))
    return " ".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").repartition(3)
    found = texts(pages)
    assert found == {r.page_id: plain(r.html) for r in pages.collect()}


def words(seed, n):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.randrange(999)}" for _ in range(n))


def div_page(i):
    """A layout without a single element that says what it is."""
    return (
        f"<html><body><div><div>Home</div><div>News {i}</div></div>"
        f"<div><h1>Title {i}</h1><div>{words(i, 60)}<br>{words(i + 100, 40)}</div><div>Read on</div></div>"
        "<div>All rights kept</div></body></html>"
    )


def test_template_without_names(spark):
    rows = [(i, f"http://a.example/{i}", div_page(i), "t", "h") for i in range(12)]
    found = texts(spark.createDataFrame(rows, SCHEMA))
    assert found == {i: f"Title {i} {words(i, 60)} {words(i + 100, 40)}" for i in range(12)}


def test_classes_and_containers(spark):
    rows = [(i, "http://a.example/", div_page(i), "t", "h") for i in range(4)]
    rows += [(9, "http://b.example/", "<body><nav>n</nav><article><p>x</article></body>", "t", "h")]
    sequences = page_tokens(spark.createDataFrame(rows, SCHEMA))
    classes = equivalence_classes(sequences)
    by_host = {r.host: r for r in classes.collect()}
    assert by_host["a.example"].n_host == 4
    assert sum(x.root for x in by_host["a.example"].known) >= 8
    templates = {r.host: r for r in deduce_templates(sequences, classes).collect()}
    page = parse(div_page(1))
    assert [e.tag for e in page.elements if e.token == templates["a.example"].container] == ["div"]
    assert templates["b.example"].template == []


PARTS = """<html><body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li>a<li>b</ul></nav>
<div class="cookie-notice">We use cookies</div><div id="ad-12">Buy</div><main><article class="post">
<header><h1>Ti&eacute;tle</h1></header><p>One <b>bo</b>ld<p>Two&nbsp;x<aside>side</aside><div class="ad">buy</div>
<script>var a = "</p><article>no</article>";</script><style>p{}</style><!-- <p>gone</p> -->
<table><tr><td>c1<td>c2</table><form>f<input value="a>b"></form><p hidden>h</p>
<section id="comments"><article class="comment">nice</article></section></article></main>
<aside>s</aside><footer>f</footer></body></html>"""


def test_other_matter_goes():
    assert main_text(parse(PARTS), 0, set()) == "Tiétle One bold Two x c1 c2"


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("plain <b>text", "plain text"),
        ("<p>a<p>b &amp c &lt;i&gt; &#233;", "a b & c <i> é"),
        ("<article>x<!-- open", "x"),
        ("<article>a < b<p class='x>y'>c</article><p>out", "a < b c"),
        ("<main>m<nav>n</nav></main>out", "m"),
        ("<title>T</title><body>b</body>", "b"),
        ("</div></p>x</p>", "x"),
        ("<article>a<script>if (a<b) {", "a"),
    ],
)
def test_broken_markup(source, text):
    assert main_text(parse(source), 0, set()) == text


def test_edge_rows(spark):
    big = "<article>" + "<p>word</p>" * 20_000 + "</article>"
    rows = [(1, None, None, None, None), (2, "no url", "", "t", "h"), (3, None, "<p>x", None, None), (4, "http://c/1", big, "", "")]
    rows += [(5, "http://c/2", "<article>same</article>", "", "")] * 2
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    found = extract(df).collect()
    assert len(found) == 6
    assert all(r.n_chars == len(r.text) for r in found)
    assert texts(df) == {1: "", 2: "", 3: "x", 4: " ".join(["word"] * 20_000), 5: "same"}
    assert extract(df.filter("page_id > 9")).count() == 0


def test_teasers_beside_the_article(spark):
    """Of several articles in a template, the one with most of the text is the page's."""
    page = "<body><article class='post'><p>{}</p></article><article class='teaser'>{}</article></body>"
    rows = [(i, "http://e.example/", page.format(words(i, 50), words(i + 50, 5)), "", "") for i in range(5)]
    assert texts(spark.createDataFrame(rows, SCHEMA)) == {i: words(i, 50) for i in range(5)}


def test_copies_of_one_page(spark):
    """Text that all pages of a host share is no template inside an article."""
    rows = [(i, "http://d.example/", "<body><article><h1>t</h1><p>same text</article></body>", "", "") for i in range(30)]
    assert set(texts(spark.createDataFrame(rows, SCHEMA)).values()) == {"t same text"}


@pytest.mark.parametrize("n", [1, 6])
@pytest.mark.parametrize(
    "wrapper",
    [
        "<div class='layout with-sidebar'><article>{}</article></div>",
        "<div id='page' class='no-sidebar'><div><article>{}</article></div></div>",
        "<article class='post comments-open'>{}</article>",
        "<div class='search-layout'><div>{}</div></div>",
    ],
)
def test_names_around_the_article(spark, n, wrapper):
    """A name never takes the page's article or most of its text away."""
    page = "<body><nav>Menu</nav>" + wrapper.format("<p>{}</p>") + "<div class='sidebar'><a>One</a> <a>Two</a></div></body>"
    rows = [(i, "http://f.example/", page.format(words(i, 60)), "", "") for i in range(n)]
    assert texts(spark.createDataFrame(rows, SCHEMA)) == {i: words(i, 60) for i in range(n)}


@pytest.mark.parametrize("n", [1, 6])
def test_names_within_the_article(spark, n):
    """Anchors and names that may be a topic stay; rotating clutter, links and comments go."""
    page = (
        "<body><article><p>{}</p><h2 id='related-work'>Related {}</h2><p>{}</p><p id='notice-3'>{}</p>"
        "<section id='discussion'>{}</section><div class='search-results'>{}</div><div class='ad'>Buy {}</div>"
        "<div class='related'><a>Read {}</a></div><section id='comments'><article class='comment'>nice {}</article></section>"
        "</article></body>"
    )
    parts = [[words(100 * k + i, 8 * k) for k in range(1, 7)] for i in range(n)]
    rows = [
        (i, "http://g.example/", page.format(p[0], i, p[1], p[2], p[3], p[4], i, i, words(i, 3)), "", "")
        for i, p in enumerate(parts)
    ]
    want = {i: f"{p[0]} Related {i} {p[1]} {p[2]} {p[3]} {p[4]}" for i, p in enumerate(parts)}
    assert texts(spark.createDataFrame(rows, SCHEMA)) == want


def section_page(i):
    """Another layout without names."""
    return (
        f"<html><body><section><div>Start</div><div>Teaser {words(i + 900, 3)}</div></section>"
        f"<section><div><h1>Head {i}</h1><div>{words(i + 500, 70)}</div></div><div>Share it</div></section>"
        "<section><div>Imprint</div></section></body></html>"
    )


def test_layouts_of_one_host(spark):
    """Empty and error pages, and a layout of fewer than half of the pages, leave the others as they are."""
    rows = [(i, f"http://h.example/{i}", div_page(i), "t", "h") for i in range(12)]
    rows += [(i, f"http://h.example/{i}", section_page(i), "t", "h") for i in range(20, 25)]
    odd = [None, "", " ", "<html><body><h1>Not found</h1></body></html>"]
    rows += [(90 + k, "http://h.example/", source, "t", "h") for k, source in enumerate(odd)]
    want = {i: f"Title {i} {words(i, 60)} {words(i + 100, 40)}" for i in range(12)}
    want |= {i: f"Head {i} {words(i + 500, 70)}" for i in range(20, 25)}
    found = texts(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert found == want | {90: "", 91: "", 92: "", 93: "Not found"}


def test_layout_of_few_pages(spark):
    """What few pages have of their own leaves them the text runs of the host."""
    rows = [(i, "http://i.example/", div_page(i), "t", "h") for i in range(8)]
    rows += [(9, "http://i.example/", div_page(9).replace("</body>", "<section>Once</section></body>"), "t", "h")]
    assert texts(spark.createDataFrame(rows, SCHEMA))[9] == f"Title 9 {words(9, 60)} {words(109, 40)}"


def test_copies_without_an_article(spark):
    """Copies count once, so their own text is no template, whether they are all pages of a host or half of them."""
    rows = [(i, "http://j.example/", div_page(1), "", "") for i in range(10)]
    rows += [(100 + i, "http://k.example/", div_page(max(i, 9)), "", "") for i in range(15)]
    found = texts(spark.createDataFrame(rows, SCHEMA).repartition(3))
    own = {i: f"Title {i} {words(i, 60)} {words(i + 100, 40)}" for i in range(20)}
    assert {found[i] for i in range(10)} == {f"Home News 1 {own[1]} Read on All rights kept"}
    assert [found[100 + i] for i in range(15)] == [own[max(i, 9)] for i in range(15)]


def test_template_within_articles(spark):
    """Blocks that a layout repeats go from articles too; sentences stay whole, and near copies keep their text."""
    page = "<body><article><h1>T{}</h1><p>Sign up here</p><p>{} <b>and</b> {}</p><p>Rights kept</p></article></body>"
    rows = [(i, "http://l.example/", page.format(i, words(i, 30), words(i + 50, 9)), "", "") for i in range(8)]
    near = "<body><article><h1>T{}</h1><p>" + words(7, 200) + "</p></article></body>"
    rows += [(20 + i, "http://m.example/", near.format(i), "", "") for i in range(5)]
    want = {i: f"T{i} {words(i, 30)} and {words(i + 50, 9)}" for i in range(8)}
    assert texts(spark.createDataFrame(rows, SCHEMA)) == want | {20 + i: f"T{i} {words(7, 200)}" for i in range(5)}
