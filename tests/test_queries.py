import duckdb
import pytest

import __spark_entry__
from conftest import DATA, same
from tidemark.plans import catalogue, lines, links, tables

QUERIES = links.QUERIES | tables.QUERIES | catalogue.QUERIES | lines.QUERIES
ORACLES = links.ORACLES | tables.ORACLES | catalogue.ORACLES | lines.ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    same(spark, duck, QUERIES[name], ORACLES[name])


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["url", "name", "source", "page_id", "pos"] and df.count() > 100


def test_all_registered():
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_filters_and_columns_reach_the_scan(spark):
    plan = tables.anti_seen(spark, DATA)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(l_quantity,40.0)" in plan and "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_type_outliers_judges_all_events(spark, tmp_path):
    rows = [(k, "view", '{"k": 1}') for k in range(3000, 3020)] + [(4001, "view", '{"k": true}'), (4003, "view", '{"k": 1.5}')]
    spark.createDataFrame(rows, "event_id long, event_type string, props string").write.parquet(f"{tmp_path}/events.parquet")
    got = tables.type_outliers(spark, str(tmp_path)).collect()
    assert sorted((r.n, r.dominant) for r in got) == [(1, "int"), (1, "int")] and len({r.kind for r in got} - {"int", "str"}) == 2


def test_bfs_follows_all_lines(spark, tmp_path):
    lines = [(1, 7, 1), (2, 8, 1), (50, 8, 2), (3, 9, 2), (51, 9, 3), (4, 10, 3), (100, 12, 5)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    want, at = {7: 0}, {7}
    for depth in range(1, 4):
        at = {y for _, p, s in lines for x, y in ((p, -s), (-s, p)) if x in at} - set(want)
        want |= dict.fromkeys(at, depth)
    assert {r.node: r.depth for r in tables.bfs_parts(spark, str(tmp_path)).collect()} == want == {7: 0, -1: 1, 8: 2, -2: 3}


def test_phone_is_of_the_whole_text(spark, tmp_path):
    rows = [(1, "call " + "x" * 300 + " +852 2345 6789"), (2, "12 " + "y" * 300 + " 34"), (3, "none")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.phone for r in links.doc_lang_flags(spark, str(tmp_path)).collect()} == {1: "23456789", 2: "1234", 3: ""}


def test_link_labels_of_large_keys(spark, tmp_path):
    keys = [0, 1, 1023, 1024, 1025, 2**20 - 1, 2**20, 2**20 + 51, 1_199_999, 5 * 2**30, None]
    spark.createDataFrame([(k, "Brand#7") for k in keys], "p_partkey long, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    assert len(same(spark, con, catalogue.link_labels, catalogue.ORACLES["link_labels"], str(tmp_path))) == len(keys)


def test_page_titles_of_odd_pages(spark, tmp_path):
    inner = ["token = &quot;5aa2&quot;", "a &amp;lt; b &eacute; &nbsp;", "<b>x</b> y", "\xa0 \n x\u3000", "a\x0bb\t c\u2028", " \x0b", " \u2003", "&amp;", "x\u0085\xa0", "&nbsp;", "<title>y", "", "\U0001f600 &#65;", "x" + "\xa0" * 50_000 + "y"]
    htmls = [f"<p><title>{t}</title>\n<h1 class=a>H {t}</h1 >" for t in inner] + [f"<TITLE\n>\n</title><h1>{t}</H1>" for t in inner]
    htmls += ["<title\u00e9>a</title>", "<title-x>b</title\x0b>", "<titles>c</title>", "<title_>c</title><h1x>d</h1>", "<title>open", "<title>a</title><title>b</title>", "", None]
    urls = [f"https://a.example/x/{t}" for t in ("my_file--1.pdf", "a%20b.html", "a+b%zz", "_-_", "a/", "a/\n", "a\n", "a.b\n", "a.b.c/", "\xa0a_", "a\tb", "a?x/y.z", "a#b/c", "a#b\n", "a#b\nc", "a#b\u2028c", "a#b\u0085", "a#\r", ".b", "\U0001f600.x")]
    urls += [None, "", "x_y.z", "https://a.example", "//h", "mailto:a-b@c.d", "https://a.example//"]
    rows = [(i, urls[i % len(urls)], h) for i, h in enumerate(htmls * len(urls))]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert len(same(spark, con, links.page_titles, links.ORACLES["page_titles"], str(tmp_path))) == len(rows)
