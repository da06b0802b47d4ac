from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, documents, hashing, text, urls


def values(spark, rows, make, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_canonical_url(spark):
    given = ["HTTP://A.Example/x//", "https://a.example", "mailto:x@a", "/rel", " https://a.example/b?q=1#f ", None, "https://a.example/a b/"]
    assert values(spark, given, urls.canonical_url) == ["http://a.example/x", "https://a.example/", None, None, "https://a.example/b?q=1", None, "https://a.example/a b"]


@pytest.mark.parametrize("href", ["g", "./g", "g/", "/g", "//g/x", "?y", "g?y", "#s", "g#s", "..", "../g", "../../../g", "./../g", "g/./h", "g/../h", "http://z/y", "/a/../b", "../..", "."])
def test_resolve(spark, href):
    base = "http://a/b/c/d?q=1"
    assert values(spark, [href], lambda h: urls.resolve(F.lit(base), h)) == [urljoin(base, href)]


def test_names_and_extensions(spark):
    given = ["https://a/x/my_file-1.pdf", "https://a/b.c/d", "https://a/", "https://a/%E4%BD%A0%zz.pdf"]
    assert values(spark, given, lambda u: urls.name_from_link(F.lit(" "), u))[:3] == ["my file 1", "d", None]
    assert values(spark, given, urls.file_extension)[:3] == [".pdf", "(no_ext)", "(no_ext)"]
    assert values(spark, given, urls.path_extension)[:3] == [".pdf", ".c/d", ""]


def test_text(spark):
    assert values(spark, ["  a  b　c\n", None, ""], text.clean_text) == ["a b c", "", ""]
    assert values(spark, ["+852 2345 6789", "12", "", None], text.phone) == ["23456789", "12", None, None]
    assert values(spark, [" A@B.c ", "none"], text.email) == ["a@b.c", None]
    assert values(spark, ["<b>x</b> &amp; y<br>z"], text.strip_tags) == ["x & y z"]
    assert values(spark, [10, 2048, 5 * 1024**2], text.human_bytes, "long") == ["10 B", "2.0 KB", "5.0 MB"]
    assert values(spark, ["中文", "中 a", "abc"], text.is_chinese_only) == [True, False, False]
    assert values(spark, ["abcdefgh", "abc"], lambda c: text.truncate(c, 6)) == ["abc...", "abc"]
    assert values(spark, ["General Notes:"], lambda c: text.headings_match(c, F.lit("general notes"))) == [True]


def test_publish_date(spark):
    given = ["2024", "2024-99-99", "5 March 2024", "Sept 2021", "01.02.2003", "2024/3/5", "issued 2020-01-02 x", "2019 Edition", "31/02/2020", "", None, "March 5, 2024", "2021 May", "2024-03-05T10:00:00Z"]
    want = ["2024-01-01", "2024-99-99", "2024-03-05", "2021-09-01", "2003-02-01", "2024-03-05", "2020-01-02", "2019-01-01", "2020-01-01", None, None, "2024-03-05", "2021-05-01", "2024-03-05"]
    assert values(spark, given, dates.publish_date) == want


def test_mine_date(spark):
    given = ["Published on 5 March 2024, not 6 April 2025", "Last update: Mar 2024", "Issued in May 2021 or 3 June 2020", "2019 edition", "nothing", "Jan 2020 and Feb 2021"]
    assert values(spark, given, dates.mine_date) == ["2024-03-05", "2024-03-01", "2020-06-03", "2019-01-01", None, "2021-02-01"]


def test_serials_and_years(spark):
    assert values(spark, ["3/97", "26/2004", "7/2004", "x"], dates.serial_month) == ["1997-03-01", None, "2004-07-01", None]
    assert values(spark, ["from 1999 to 2003", ""], dates.latest_year) == [2003, None]
    assert values(spark, ["2024-02-30", "2024-02-29", "x", None], dates.is_date) == [False, True, False, False]


def test_hash_bucket(spark):
    import hashlib

    want = [int(hashlib.sha256(x.encode()).hexdigest()[:16], 16) % 10000 for x in ("a", "https://b")]
    assert values(spark, ["a", "https://b"], hashing.hash_bucket) == want


def test_value_types(spark):
    given = ["null", "true", "1", "1.5", '"x"', "{}", "[1]", "broken{"]
    assert values(spark, given, lambda c: documents.value_type(documents.parsed(c))) == ["null", "bool", "int", "float", "str", "object", "array", None]


def test_labels(spark):
    assert values(spark, ["Guide (PDF, 1.5 MB)", "Form (opens in new window)", "Plain"], text.link_label) == ["Guide", "Form", "Plain"]
    assert values(spark, ["Sr Engr (Eng Div)", "engr"], lambda c: text.expand(c, {"Sr": "Senior", "Engr": "Engineer", "Eng Div": "Engineering Division"})) == ["Senior Engineer (Engineering Division)", "engr"]
    assert values(spark, ["Notes (English) pdf", "Notes"], lambda c: text.base_name(c, ("(English)", "pdf"))) == ["Notes", "Notes"]


def test_dates_near_links(spark):
    html = "<table><tr><td>May 2020</td><td><a href=/x_2020.pdf>X</a></td></tr><tr><td>June 2021</td><td><a href=/y.pdf>Y</a></td></tr></table>"
    near = lambda h, t: values(spark, [html], lambda c: dates.date_near(c, F.lit(h), F.lit(t), 30))[0]
    row = lambda h: values(spark, [html], lambda c: dates.date_in_row(c, F.lit(h)))[0]
    assert near("/y.pdf", "issued in July 2019") == "2019-07-01" and near("/y.pdf", "") == "2021-06-01" and near("/none", "") is None
    assert row("/x_2020.pdf") == "2020-05-01" and row("/y.pdf") == "2021-06-01" and row("/none") is None
    assert values(spark, ["2020-05-01"], lambda c: dates.preferred_by_precision(c, F.lit("2020-05-17"))) == ["2020-05-17"]


def test_enquiries_by_whole_names(spark):
    from tidemark.functions.filters import is_enquiry

    rows = [("General Enquiry", None, None), ("Director-General of Trade", "Director", None), ("Chan Tai Man, General Manager", None, "/p/1"), (" enquiries ", None, None), ("Chan", " - ", None), ("Lee", "Clerk", "/service_details.jsp"), (None, None, None), ("Reception", None, None)]
    df = spark.createDataFrame(rows, "n string, p string, h string")
    assert [r[0] for r in df.select(is_enquiry(F.col("n"), F.col("p"), F.col("h"))).collect()] == [True, False, False, True, True, True, False, False]


def test_terms(spark):
    from tidemark.functions.dates import term_of_year

    df = spark.createDataFrame([(1998,), (2019,), (2022,), (2025,), (2026,), (2034,)], "y int")
    assert [r[0] for r in df.select(term_of_year(F.col("y"))).collect()] == ["07", "07", "07", "07", "08", "10"]


def test_texts_of_nested_fields(spark):
    from tidemark.functions import nested

    rows = [('[["a","b"],"c",{"value":["d"]}]',), ('{"en":"E","tc":"T"}',), ('[{"en":"E","tc":"T"},{"tc":"U"},[[{"en":" "}],7]]',), ('"x"',), ("null",), ("{}",)]
    df = spark.createDataFrame(rows, "j string").withColumn("v", F.parse_json("j"))
    got = df.select(nested.joined_text(F.col("v")), nested.localized_text(F.col("v"), "tc"), nested.localized_text(F.col("v"), "en")).collect()
    assert [tuple(r) for r in got] == [("a ; b ; c ; d", "a ; b ; c", "a ; b ; c"), ("E", "T", "E"), ("E ; 7", "T ; U ; 7", "E ; 7"), ("x", "x", "x"), ("", "", ""), ("", "", "")]


def test_entities_equal_the_standard_table(spark):
    import html

    known = [f"&{k}" for k in html.entities.html5 if k.endswith(";")]
    others = ["&#8211;", "&#x1F600;", "&#0;", "&#xD800;", "&#1114112;", "&#128;", "&#150;", "&#129;", "a &amp;lt; b", "no & entity", "&unknown;", "&", "", "x&eacute;y&#65;&copy;"]
    got = values(spark, [*known, *others, " ".join(known)], text.unescape_html)
    want = [html.unescape(t).replace("\xa0", " ") for t in [*known, *others, " ".join(known)]]
    want[len(known) + 4] = "\ufffd"
    assert [(a, b, c) for a, b, c in zip([*known, *others, "all"], got, want, strict=True) if b != c] == []
    assert values(spark, [None, "&lt"], text.unescape_html) == [None, "&lt"]


def test_sizes_and_shares(spark):
    assert values(spark, [2**40, 2**30, 1023, None], text.human_bytes, "long") == ["1024.0 GB", "1.0 GB", "1023 B", None]
    assert values(spark, [2**30, 2**20, 1023, None], lambda c: text.human_bytes(c, "MB"), "long") == ["1024.0 MB", "1.0 MB", "1023 B", None]
    assert values(spark, [3, 0, None], lambda c: text.percent(c, F.lit(200)), "long") == ["1.5%", "0.0%", None]


def test_titles_and_names_in_full_or_as_written(spark):
    from tidemark.operators import extract

    given = ["<title>a &quot;b&quot; <b>c</b></title>", "<title> </title><h1>x &eacute;\n&amp;</h1>", "none", None]
    assert values(spark, given, extract.page_title) == ['a "b" c', "x \u00e9 &", None, None]
    assert values(spark, given, lambda c: extract.page_title(c, text.marked_text)) == ["a &quot;b&quot; <b>c</b>", "x &eacute; &", None, None]
    given = ["https://a/x/my__file%201.pdf/", "https://a/", None]
    assert values(spark, given, lambda c: urls.name_from_link(F.lit(""), c)) == ["my file 1", None, None]
    assert values(spark, given, lambda c: urls.name_from_link(F.lit(""), c, as_written=True)) == ["my  file%201", None, None]
