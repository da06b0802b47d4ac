import time
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import browse, combine, extract, keyed, quality, refresh, snapshots, traverse

ROW = "source string, url string, v int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def days(spark):
    def day(i):
        return spark.createDataFrame([("s", f"u{k}", k + (k % 4 == i)) for k in range(40) if k % (i + 3)], ROW)

    return [day(i) for i in range(3)]


def test_reconstruct_is_inverse_of_delta(days):
    base, full = days[0], days[1]
    again = snapshots.reconstruct(base, snapshots.added(base, full), snapshots.removed(base, full))
    assert rows(again.select("source", "url", "v")) == rows(full)


def test_added_and_removed_share_no_key(days):
    plus, minus = snapshots.added(days[0], days[1]), snapshots.removed(days[0], days[1])
    assert plus.join(minus, snapshots.KEY).count() == 0


def test_rebase_keeps_every_day_and_removes_nothing(days):
    base, plus, minus = snapshots.rebase(days)
    assert minus.count() == 0
    for i, d in enumerate(days):
        again = snapshots.reconstruct(base, plus.where(F.col("day") == i).drop("day"), minus.where(F.col("day") == i).drop("day"))
        assert rows(again.select("source", "url", "v")) == rows(d)


def test_merge(spark):
    prev = spark.createDataFrame([("a", "x", 1), ("a", "y", 1), ("b", "x", 1), (" ", "x", 1), ("c", None, 1)], ROW)
    fresh = spark.createDataFrame([("a", "x", 2), ("a", " z ", 2)], ROW)
    done = spark.createDataFrame([("a",)], "source string")
    one = snapshots.merge(prev, fresh, done)
    assert rows(one) == [("a", "x", 2), ("a", "z", 2), ("b", "x", 1)]
    assert rows(snapshots.merge(one, fresh, done)) == rows(one)
    assert rows(snapshots.merge(prev, fresh, done, "upsert")) == [("a", "x", 2), ("a", "y", 1), ("a", "z", 2), ("b", "x", 1)]


def test_dedup_keeps_first_or_last(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("b", 3, "y")], "k string, pos int, v string")
    assert rows(keyed.dedup(df, ["k"], F.col("pos"))) == [("a", 1, None), ("b", 3, "y")]
    assert rows(keyed.dedup(df, ["k"], F.col("pos"), "last")) == [("a", 2, "x"), ("b", 3, "y")]


def test_latest_version_ties_keep_first(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "2020", 2), ("a", "2020", 3)], "k string, d string, pos int")
    assert rows(keyed.latest_version(df, ["k"], "d", "pos")) == [("a", "2020", 2)]


def test_prefixes(spark):
    df = spark.createDataFrame([("ab/x",), ("a_/y",), ("zz",), (None,)], "u string")
    p = spark.createDataFrame([("ab",), ("a_",), ("q",)], "p string")
    assert rows(combine.starts_with_any(df, "u", p, "p")) == [("a_/y",), ("ab/x",)]
    assert rows(combine.starts_with_any(df, "u", p, "p", anti=True)) == [("zz",), (None,)]


def test_bfs_depth_and_limits(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (1, 3), (3, 1)], "src long, dst long")
    s = spark.createDataFrame([(1,)], "node long")
    assert rows(traverse.bfs(e, s, 5)) == [(1, 0, None), (2, 1, 1), (3, 1, 1), (4, 2, 3)]
    assert traverse.bfs(e, s, 5, max_nodes=2).count() == 2
    assert rows(traverse.bfs(e, s, 5, out_cap=1).select("node")) == [(1,), (2,), (3,)]


def test_until_misses(spark):
    hits = [1, 0, 1, 0, 0, 1, 1]
    df = spark.createDataFrame([("a", i, bool(h)) for i, h in enumerate(hits)], "k string, i int, hit boolean")
    assert [r[1] for r in rows(traverse.until_misses(df, ["k"], "i", "hit", 2))] == [0, 1, 2, 3, 4]


def test_due(spark):
    reg = spark.createDataFrame([("a", "p", "no", "1"), ("b", "p", None, "2"), ("c", "p", "yes", "x"), ("d", "p", "1", "1")], "source string, page string, enabled string, interval_days string")
    st = spark.createDataFrame([("b", "p", "2024-01-09"), ("c", "p", "2024-01-09"), ("d", "p", "2024-02-01")], "source string, page string, d string").selectExpr("source", "page", "cast(d as date) last_run")
    got = {r.source: (r.due, r.reason) for r in refresh.decisions(reg, st, "2024-01-10").collect()}
    assert got == {"a": (False, "disabled"), "b": (False, "too_early"), "c": (True, "interval_elapsed"), "d": (False, "in_future")}


def test_exclusive_p95(spark):
    p = lambda n: quality.exclusive_p95(spark.range(1, n + 1), "id").first()[0]
    assert p(20) == pytest.approx(19.95) and p(19) is None and p(100) == pytest.approx(95.95)


def test_value_outliers_need_rows_and_dominance(spark):
    df = spark.createDataFrame([("s", "x" if i else "odd", i) for i in range(100)], "s string, v string, i int")
    assert rows(quality.value_outliers(df, ["s"], "v", "i")) == [("s", "odd", 1)]
    assert quality.value_outliers(df.where("i < 15"), ["s"], "v", "i").count() == 0


def test_pages_clamp(spark):
    df = spark.createDataFrame([(f"u{i:02}", f"2024-01-{i:02}") for i in range(1, 12)], "url string, publish_date string")
    o = browse.ordered(df)
    assert [r.url for r in browse.page(o, 99, 5).collect()] == ["u01"] and browse.page(o, -3, 5).first().url == "u11"


HTML = """<div id=main><table><tr><th>Date</th><th>Paper</th></tr><tr><td rowspan=2>1/2020</td><td><a href="/a.pdf">A &amp; B</a></td></tr>
<tr><td><a href="/b.pdf">B</a></td></tr></table></div><ul><li>One <a href="c.pdf">C</a></li><li>none</li></ul>"""


def test_table_functions(spark):
    df = spark.createDataFrame([(1, HTML), (2, None), (3, "")], "page_id int, html string")
    cells = df.lateralJoin(extract.HtmlTables(F.col("html").outer()))
    assert cells.count() == 6
    got = extract.by_header(cells, ["page_id"], {"date": "date", "paper": "paper"})
    assert sorted((r.date.text, r.paper.href) for r in got.collect()) == [("1/2020", "/a.pdf"), ("1/2020", "/b.pdf")]
    items = df.lateralJoin(extract.HtmlItems(F.col("html").outer()))
    assert [(r.text, r.href) for r in items.collect()] == [("One C", "c.pdf")]
    scoped = df.lateralJoin(extract.HtmlScopedLinks(F.col("html").outer(), F.lit("main"), F.lit(True)))
    assert [r.href for r in scoped.where("page_id = 1").collect()] == ["/a.pdf", "/b.pdf"]


def test_union_first(spark):
    a, b = (spark.createDataFrame(r, "k string, pos int") for r in ([("x", 5)], [("x", 1), ("y", 2)]))
    assert rows(combine.union_first([a, b], ["k"])) == [("x", 5), ("y", 2)]


def test_operators_take_empty_tables(spark, days):
    e = days[0].limit(0)
    assert snapshots.added(e, e).count() == 0 and snapshots.common_base([e, e]).count() == 0
    assert reduce(DataFrame.unionByName, snapshots.rebase([e, e])[1:2]).count() == 0
    assert quality.exclusive_p95(e, "v").first()[0] is None


def test_archive_months(spark, tmp_path, days):
    from tidemark.operators import rotate

    root = str(tmp_path / "archive")
    done = [rotate.archive(spark, root, f"2024-03-{d:02}", df, refresh_day=15) for d, df in ((1, days[0]), (2, days[1]), (2, days[1]), (16, days[2]))]
    assert done == ["base", "delta", "skipped", "rebased"]
    for d, df in ((1, days[0]), (2, days[1]), (16, days[2])):
        assert rows(rotate.as_of(spark, root, f"2024-03-{d:02}").select("source", "url", "v")) == rows(df)
    assert rotate.days(spark, root, ["2024-03"]) == ["2024-03-16", "2024-03-02", "2024-03-01"]
    with pytest.raises(ValueError):
        rotate.as_of(spark, root, "2024-03-09")


def test_json_walk(spark):
    from tidemark.operators import walk

    df = spark.createDataFrame([(1, '{"a": [{"cat_id": 1}, {"b": {"cat_id": "x"}}], "cat_id": 2}'), (2, "broken{"), (3, None), (4, '{"pdf": {"u": 1}, "n": [[[{"pdf": {}}, {"pdf": 1}]]]}')], "key int, j string")
    found = walk.members(df.withColumnRenamed("key", "value"), ["value"], "j")
    assert found.columns == ["value", "path", "key", "value"]
    found = walk.members(df.withColumnRenamed("key", "i"), ["i"], "j")
    assert rows(found.where("key = 'cat_id'").select("path", "value")) == [("$", "2"), ("$.a[0]", "1"), ("$.a[1].b", '"x"')]
    every = walk.nodes(df.withColumnRenamed("key", "i"), ["i"], "j")
    assert "Python" not in every._jdf.queryExecution().toString() and every.where("i = 4").count() == 10
    assert rows(every.where(walk.holds_object(F.col("node"), "pdf")).select("i", "path")) == [(4, "$"), (4, "$.n[0][0][0]")]


def test_order_as_read(spark):
    names = ["zebra", "Éclair", "eclair", "apple", "Zürich", "étude", None, "Apple", "ecru"]
    df = spark.createDataFrame([(n, "u") for n in names], "name string, url string")
    assert [r.name for r in browse.ordered(df, "name", False, read=True).collect()] == [None, "apple", "Apple", "eclair", "Éclair", "ecru", "étude", "zebra", "Zürich"]


def test_anchors_as_a_parser_finds_them(spark):
    html = """<a href=/plain class=x>Un<b>quoted</b></a><A class="a>b" href="it's.pdf" >Quote&#8217;s</A><!-- <a href="/no">no</a> --><a name=top>x</a><a href="">none</a>
    <a href="/lost">lost <a href='/kept?a=1&amp;b="2"'>kept &eacute;</a><abbr href="/no">no</abbr><script>var x = '<a href="/no">no</a>'</script><a
    data-href="/no" href = "/last">last
    line</a><a href="/open">never closed"""
    df = spark.createDataFrame([(1, "https://h.example/d/", html)], "page_id int, url string, html string")
    got = [(r.pos, r.href, r.text) for r in extract.page_links(df).collect()]
    assert got == [(0, "/plain", "Un quoted"), (1, "it's.pdf", "Quote’s"), (2, '/kept?a=1&b="2"', "kept é"), (3, "/last", "last line")]
    long = "".join(f'<a {"x=1 " * 500}href="/{i}" title="{"t" * 2000}">{"w " * 3000}</a>' for i in range(30))
    assert extract.page_links(spark.createDataFrame([(1, "https://h/", long)], "page_id int, url string, html string")).count() == 30


NESTED = """<table><tr><th>Name</th><th>Call</th></tr><tr><td>a<table><tr><td>in <a href="/x">x</a></td></tr></table>b<td><table><tr><td rowspan="1300">deep<table><tr><td>er</table></table>
</td></tr></table><table><tr><td>next</td></tr></table>"""


def test_nested_tables(spark):
    df = spark.createDataFrame([(1, NESTED), (2, None), (3, "<table><tr><td>x")], "page_id int, html string")
    got = [(r.page_id, r.table_no, r.parent, r.row, r.col, r.text, r.href) for r in extract.html_tables(df).collect()]
    assert got == [
        (1, 0, None, 0, 0, "Name", None), (1, 0, None, 0, 1, "Call", None), (1, 0, None, 1, 0, "a b", None), (1, 0, None, 1, 1, "", None), (1, 1, 0, 0, 0, "in x", "/x"),
        (1, 2, 0, 0, 0, "deep", None), (1, 3, 2, 0, 0, "er", None), (1, 4, None, 0, 0, "next", None), (3, 0, None, 0, 0, "x", None),
    ]
    sql = df.lateralJoin(extract.HtmlTables(F.col("html").outer())).where("table_no is not null")
    assert rows(sql.drop("html")) == rows(extract.html_tables(df))


def test_long_row_spans(spark):
    html = "<table><tr><td rowspan=1201>s</td><td>0</td></tr>" + "".join(f"<tr><td>{i}</td></tr>" for i in range(1, 1201)) + "</table>"
    cells = extract.html_tables(spark.createDataFrame([(html,)], "html string"))
    assert cells.where("col = 0 and text = 's'").count() == 1201 and cells.where("col = 1").count() == 1201


def test_records_of_wide_and_narrow_tables(spark):
    html = """<table><tr><th>No.</th><th>Subject:</th><th>File</th></tr><tr><td>1</td><td>A</td><td><a href="/a">pdf</a></td></tr><tr><td>2</td><td>B</td><td></td></tr></table>
    <table><tr><th>No.</th><td>1</td></tr><tr><th>Subject</th><td>A</td></tr><tr><th>File</th><td><a href="/a">pdf</a></td></tr><tr><th>No.</th><td>2</td></tr><tr><th>Subject</th><td>B</td></tr><tr><th>No.</th><td>3</td></tr></table>"""
    df = spark.createDataFrame([(7, html)], "page int, html string")
    got = extract.one_of_each(extract.table_records(extract.html_tables(df), ["page"]), ["page"]).collect()
    assert sorted((sorted(r.fields.items()), r.href, r.tables) for r in got) == [([("file", "pdf"), ("no", "1"), ("subject", "A")], "/a", 2), ([("no", "2"), ("subject", "B")], None, 2), ([("no", "3")], None, 1)]


def test_tree_paths_in_one_pass(spark):
    items = [(1, 1, 1, "a"), (1, 2, 2, "b"), (1, 3, 4, "d"), (1, 4, 3, None), (1, 5, 4, "e"), (1, 6, 1, "f"), (1, 7, 3, "g"), (2, 1, 2, "h"), (2, 2, 0, "z"), (2, 3, None, "z"), (None, 1, 1, "n")]
    got = extract.tree_paths(spark.createDataFrame(items, "page int, pos int, depth int, text string"), ["page"])
    assert {(r.page, r.pos): r.path for r in got.collect()} == {
        (1, 1): ["a"], (1, 2): ["a", "b"], (1, 3): ["a", "b", "d"], (1, 4): ["a", "b"], (1, 5): ["a", "b", "e"], (1, 6): ["f"], (1, 7): ["f", "g"], (2, 1): ["h"], (2, 2): [], (2, 3): [], (None, 1): ["n"],
    }
    large = spark.range(100_000).selectExpr("1 page", "id pos", "cast(1 + id % 9 as int) depth", "cast(id as string) text")
    began = time.time()
    assert extract.tree_paths(large, ["page"]).agg(F.sum(F.size("path"))).first()[0] == sum(1 + i % 9 for i in range(100_000))
    assert time.time() - began < 30


def test_month_in_one_grouping(spark):
    from tidemark.operators.snapshots import KEY, common_base, reconstruct, regrouped

    month = [spark.createDataFrame([("s", f"u{k}", (k * 3 + d) // 40) for k in range(60) if (k + d) % 17], ROW) for d in range(31)]
    base, *rest = month
    plus = reduce(DataFrame.unionByName, [snapshots.added(base, x).withColumn("day", F.lit(i + 1)) for i, x in enumerate(rest)])
    minus = reduce(DataFrame.unionByName, [snapshots.removed(base, x).withColumn("day", F.lit(i + 1)) for i, x in enumerate(rest)])
    plus, minus = (spark.createDataFrame(x.collect(), x.schema) for x in (plus, minus))
    found = regrouped(list(range(31)), plus, base, minus)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(source") == 1
    found = found.collect()
    again = spark.createDataFrame(found, "kind string, day int, source string, url string, v int").cache()
    new = again.where("kind = 'base'").select(*KEY, "v")
    assert rows(new) == rows(common_base(month))
    for i in (0, 1, 15, 30):
        assert rows(reconstruct(new, again.where(f"kind = 'added' and day = {i}").select(*KEY, "v"), new.limit(0)).select(*KEY, "v")) == rows(month[i])


def test_archive_goes_on_after_a_rebase(spark, tmp_path, days, monkeypatch):
    from tidemark.operators import rotate

    root, want = str(tmp_path / "archive"), {}
    for d, df in ((1, days[0]), (2, days[1]), (16, days[2]), (17, days[0]), (18, days[1])):
        want[d] = rows(df)
        rotate.archive(spark, root, f"2024-03-{d:02}", df, refresh_day=16)
    died = rotate._note
    monkeypatch.setattr(rotate, "_note", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        rotate.rebase(spark, root, "2024-03-18")
    for d, x in want.items():
        assert rows(rotate.as_of(spark, root, f"2024-03-{d:02}").select("source", "url", "v")) == x
    monkeypatch.setattr(rotate, "_note", died)
    rotate.rebase(spark, root, "2024-03-18")
    for d, x in want.items():
        assert rows(rotate.as_of(spark, root, f"2024-03-{d:02}").select("source", "url", "v")) == x


def test_items_in_scripts(spark):
    html = r"""<style>p{margin:0}</style><script>var items = [{url:"/a", title:"x {1}"}, {"title": "it's, url: 'no'", "url": '/b'}, {title: 'q\'s', n: 3, url: "/c"}, {title: "none"}];</script>"""
    got = spark.createDataFrame([(html,)], "html string").select(F.explode(extract.script_items(F.col("html"))).alias("x")).select("x.*")
    assert [tuple(r) for r in got.collect()] == [("x {1}", "/a"), ("it's, url: 'no'", "/b"), ("q's", "/c")]
