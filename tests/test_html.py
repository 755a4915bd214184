import pytest

from core_helpers import rows
from custodia.operators import inventory
from custodia.operators.inventory import runtime_versions
from custodia.operators.keys import DuplicateKeyError
from custodia.plans.support import cluster_version_support
from custodia.sources.html_tables import extract_tables, nav_links

HEAD = "<tr><th>A</th><th>B</th></tr>"


def extract(spark, *pages, columns=None):
    df = spark.createDataFrame([(i, f"u{i}", p) for i, p in enumerate(pages)], "page_id bigint, url string, html string")
    return rows(extract_tables(df, "anchor", columns or {"A": "a", "B": "b"}))


def table(*cells, head=HEAD):
    return f"<table>{head}<tr>{''.join(f'<td>{c}</td>' for c in cells)}</tr></table>"


@pytest.mark.parametrize(
    "page, expected",
    [
        (f'<h2 id="anchor">x</h2>{table("1", "2")}', ("1", "2")),
        (f"<h2 class=c id='anchor'>x</h2><ul><li>one</li></ul><p>text</p>{table('1', '2')}", ("1", "2")),
        (f'<h2 id="anchor">x</h2>{table("1", "2")}{table("3", "4")}', ("1", "2")),
        (f'{table("0", "0")}<h2 id="anchor">x</h2>{table("1", "2")}', ("1", "2")),
        (f'<h2 id="anchor">x</h2>{table("a &amp; b&nbsp;c", "&#233;<br>x  y")}', ("a & b c", "é x y")),
        (f'<h2 id="anchor">x</h2>{table("<b>1</b> <i>x</i>", "")}', ("1 x", None)),
        (f'<h2 id="anchor">x</h2><div>{table("0", "0")}</div>{table("1", "2")}', ("1", "2")),
        (f'<h2 id="anchor">x</h2><!-- {table("0", "0")} -->{table("1", "2")}', ("1", "2")),
        ('<h2 id=anchor>x</h2><table><thead><tr><td>A<td>B</thead><tr><td>1<td>2</table>', ("1", "2")),
        (f'<h2 id="anchor">x</h2>{table("1" + table("8", "9"), "2")}', ("1AB89", "2")),
    ],
)
def test_first_sibling_table(spark, page, expected):
    assert extract(spark, page) == [(0, "u0", 0, *expected)]


@pytest.mark.parametrize(
    "page",
    [
        f'<h2 id="other">x</h2>{table("1", "2")}',
        f'<div><h2 id="anchor">x</h2></div>{table("1", "2")}',
        f'<h2 id="anchor">x</h2><div>{table("1", "2")}</div>',
        '<h2 id="anchor">x</h2>',
        "anchor",
        None,
    ],
)
def test_no_sibling_table(spark, page):
    assert extract(spark, page) == []


def test_spans_and_missing_cells(spark):
    page = (
        '<h2 id="anchor">x</h2><table><tr><th>A</th><th>B</th><th>C</th></tr>'
        '<tr><td rowspan="2">1</td><td colspan="2">2</td></tr><tr><td>3</td><td>4</td></tr><tr><td>5</td><td></td><td></td></tr></table>'
    )
    assert extract(spark, page, columns={"A": "a", "B": "b", "c": "c"}) == [
        (0, "u0", 0, "1", "2", "2"),
        (0, "u0", 1, "1", "3", "4"),
        (0, "u0", 2, "5", None, None),
    ]


def test_a_missing_header_fails(spark):
    with pytest.raises(Exception, match="no column d in the table"):
        extract(spark, f'<h2 id="anchor">x</h2>{table("1", "2")}', columns={"A": "a", "D": "d"})


def test_an_anchor_written_with_an_entity_is_found(spark):
    assert extract(spark, f'<h2 id="anch&#111;r">x</h2>{table("1", "2")}') == [(0, "u0", 0, "1", "2")]


def test_every_page_of_a_corpus(spark):
    pages = [f'<h2 id="anchor">x</h2>{table(i, i + 1)}' for i in range(50)] + ["<p>none</p>"] * 50
    expected = [(i, f"u{i}", 0, str(i), str(i + 1)) for i in range(50)]
    assert sorted(extract(spark, *pages)) == expected


def release_page(*cells, head="End-of-support date"):
    rows_ = "".join(f"<tr>{''.join(f'<td>{c}</td>' for c in row)}</tr>" for row in cells)
    return (
        '<h2 id="rel">x</h2><table><tr><th>Version</th><th>Variants</th><th>Apache Spark version</th>'
        f"<th>Release date</th><th>{head}</th></tr>{rows_}</table>"
    )


LISTED = [
    ("15.4 LTS", "all", "3.5.0", "Aug 19, 2024", "August 19, 2027"),
    ("16.0", "all", "3.5.0", "Aug 19, 2024", ""),
]


def runtimes(spark, *pages):
    df = spark.createDataFrame([(i, "u", page) for i, page in enumerate(pages)], "page_id bigint, url string, html string")
    return runtime_versions(df, "rel")


def test_runtime_versions(spark):
    df = runtimes(spark, release_page(*LISTED))
    needed = ["version", "variants", "release_date", "end_of_support_date"]
    assert df.columns == [*needed, "apache_spark_version", "spark_version_number"]
    first, second = sorted(df.collect())
    assert (first.version, first.spark_version_number, first.end_of_support_date.year) == ("15.4 LTS", "15.4", 2027)
    assert (second.end_of_support_date, second.apache_spark_version) == (None, "3.5.0")


def test_the_newest_page_counts(spark):
    """Stored copies do not multiply runtimes; a page without the table is no release page."""
    pages = [release_page(("1.0", "old", "1", "", "")), release_page(*LISTED), release_page(*LISTED), "<p>none</p>"]
    df = runtimes(spark, *pages)
    assert rows(df.select("version")) == [("15.4 LTS",), ("16.0",)]
    clusters = spark.createDataFrame([("c", "n", "o", "15.4")], "cluster_id string, cluster_name string, owner string, spark_version_number string")
    assert cluster_version_support(clusters, df).count() == 1


def parsed_batches(monkeypatch):
    """Ids of the pages that each step of the search parses."""
    batches, parse = [], inventory.table_cells

    def record(pages, anchor_id):
        batches.append(sorted(row.page_id for row in pages.select("page_id").collect()))
        return parse(pages, anchor_id)

    monkeypatch.setattr(inventory, "table_cells", record)
    return batches


def test_the_search_parses_no_page_twice_and_few_at_all(spark, monkeypatch):
    batches = parsed_batches(monkeypatch)
    monkeypatch.setattr(inventory, "FIRST_PAGES", 3)
    monkeypatch.setattr(inventory, "GROWTH", 2)
    # Pages that name the anchor only in text, newer than the release page, and ones that never do.
    in_text = "<p>see rel below</p>" + table("x", "y")
    pages = [release_page(("1.0", "old", "1", "", ""))] * 20 + [release_page(*LISTED)] + [in_text] * 5 + ["<p>none</p>"] * 30
    df = runtimes(spark, *pages)
    assert rows(df.select("version")) == [("15.4 LTS",), ("16.0",)]
    assert batches == [[23, 24, 25], [17, 18, 19, 20, 21, 22]]


def test_the_search_reads_stored_rows_afterwards(spark, monkeypatch):
    batches = parsed_batches(monkeypatch)
    df = runtimes(spark, release_page(*LISTED))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    assert (df.count(), df.count(), len(batches)) == (2, 2, 1)


@pytest.mark.parametrize("pages", [[], ["<p>none</p>", None], ["<p>rel</p>"], [release_page()]])
def test_no_release_table_at_all(spark, pages):
    assert runtimes(spark, *pages).count() == 0


def test_repeated_and_missing_ids_of_pages(spark):
    rows_ = [(None, release_page(("9.9", "a", "b", "", ""))), (4, release_page(LISTED[0])), (4, release_page(LISTED[1])), (3, "rel")]
    df = spark.createDataFrame(rows_, "page_id bigint, html string")
    assert rows(runtime_versions(df, "rel").select("version")) == [("15.4 LTS",), ("16.0",)]


def test_an_anchor_spelled_by_references_counts(spark):
    page = release_page(*LISTED).replace('id="rel"', "ID = 'r&#101;l'")
    assert runtimes(spark, release_page(("1.0", "old", "1", "", "")), page).count() == 2


def test_headers_are_matched_in_snake_case(spark):
    assert runtimes(spark, release_page(*LISTED, head="End of support date")).count() == 2


def test_a_renamed_header_fails(spark):
    with pytest.raises(Exception, match="no column end_of_support_date"):
        runtimes(spark, release_page(*LISTED, head="Supported until")).collect()


def test_a_runtime_listed_twice_fails(spark):
    with pytest.raises(DuplicateKeyError, match="15.4"):
        runtimes(spark, release_page(*LISTED, ("15.4", "ml", "3", "", "")))


def test_an_unreadable_release_date_fails(spark):
    with pytest.raises(Exception, match="not a date: soon"):
        runtimes(spark, release_page(("1.0", "a", "b", "soon", ""))).collect()


def test_nav_links(spark):
    html = '<ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul>'
    df = spark.createDataFrame([(1, html), (2, "")], "page_id bigint, html string")
    assert rows(nav_links(df)) == [(1, 0, "/a", "A"), (1, 1, "/b", "B")]
