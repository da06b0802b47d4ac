import base64
import collections
import hashlib
import http.server
import json
import threading
import urllib.request
import zipfile
import zlib
from urllib.error import HTTPError
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from tidemark.sources import archive, jsonl, paged, payloads, settings, workbook
from tidemark.sources import http as http_source
from tidemark.streaming import changes, tail


def test_jsonl(spark, tmp_path):
    f = tmp_path / "urls.jsonl"
    f.write_text('{"url":"https://a/1","source":"s","meta":{"k":1}}\n\n[1]\nbroken{\n{"url":"https://a/0","source":"s"}\n')
    got = {r.line_no: r.error for r in jsonl.scan(spark, str(f)).collect()}
    assert got == {1: None, 3: "no object", 4: "no JSON", 5: None}
    rec = jsonl.records(spark, str(f))
    assert rec.count() == 2
    out = str(tmp_path / "out")
    assert jsonl.write(rec.select("url", "source", "name"), out) == 2
    assert [json.loads(r.value)["url"] for r in spark.read.text(out).collect()] == ["https://a/0", "https://a/1"]


def test_csv(spark, tmp_path):
    out = str(tmp_path / "csv")
    jsonl.write_csv(spark.createDataFrame([('a"b', "c,d"), (None, "e")], "x string, y string"), out)
    body = "".join(p.read_text("utf-8") for p in sorted((tmp_path / "csv").glob("part-*")))
    assert body.startswith("﻿x,y") and '"a""b","c,d"' in body


def test_archive_index(spark):
    rows = [("f:/z/2024/01/02/urls.jsonl", 5), ("f:/z/2024-01/days/03/added.jsonl", 2), ("f:/z/2024-01/days/03/removed.jsonl", 1), ("f:/z/readme", 9)]
    listing = spark.createDataFrame(rows, "path string, bytes long")
    assert [(r.date, r.format, r.bytes) for r in archive.index(listing).collect()] == [("2024-01-03", "delta", 3), ("2024-01-02", "full", 5)]
    assert archive.newest(listing).first().date == "2024-01-03"


def test_files_have_digests(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/x").write_bytes(b"abc")
    r = archive.files(spark, str(tmp_path)).first()
    assert (r.bytes, r.sha256[:8]) == (3, "ba7816bf")


def test_inflated_blob(spark):
    z = zlib.compressobj(wbits=-15)
    blob = base64.b64encode(z.compress(json.dumps([{"title": "T", "link": "/x"}]).encode()) + z.flush()).decode()
    df = spark.createDataFrame([(1, f'var d = "{blob}";'), (2, 'var d = "AAAA";'), (3, None)], "i int, html string")
    df = df.withColumn("items", payloads.blob_items(F.col("html"), "d"))
    assert [(r.i, r.title, r.link) for r in payloads.unnest(df, F.col("items"), "title string, link string").collect()] == [(1, "T", "/x")]


def test_backoff_and_retry():
    assert [http_source.backoff(i, jitter=0) for i in (0, 1, 10)] == [0.5, 1.0, 30.0] and http_source.backoff(0, "7") == 7.0
    tries = []

    def fails(url, timeout):
        tries.append(url)
        raise HTTPError(url, 503, "busy", None, None)

    assert http_source.fetch("http://x", fails, lambda s: None)[0] == 503 and len(tries) == http_source.RETRIES + 1


def test_probe():
    asked = []

    class Answer:
        def __init__(self, status):
            self.status = status

        __enter__ = lambda self: self
        __exit__ = lambda self, *_: None

    def answers(**by_method):
        def open_(request, timeout):
            asked.append(request.method)
            code = by_method[request.method]
            if code is None:
                raise OSError("no route")
            if code >= 400:
                raise HTTPError("http://x", code, "", None, None)
            return Answer(code)

        return open_

    cases = [(dict(HEAD=200), True), (dict(HEAD=404), False), (dict(HEAD=204), False), (dict(HEAD=405, GET=200), True), (dict(HEAD=405, GET=405), False), (dict(HEAD=None), False)]
    assert [http_source.exists("http://x", answers(**c)) for c, _ in cases] == [want for _, want in cases]
    assert asked == ["HEAD"] * 3 + ["HEAD", "GET"] * 2 + ["HEAD"] and http_source.exists("nonsense") is False


def test_probed_column(spark):
    df = spark.createDataFrame([(1, "http://a"), (2, None), (3, "http://b"), (4, "http://a")], "i int, url string")
    assert [r.exists for r in http_source.probed(df, probe=lambda u: u.endswith("a")).orderBy("i").collect()] == [True, False, False, True]
    assert http_source.probed(df.limit(0), probe=lambda u: True).count() == 0


def sheets(path):
    space = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None and {"[Content_Types].xml", "_rels/.rels"} <= set(z.namelist())
        names = [s.get("name") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{space}sheet")]
        read = lambda i: ElementTree.fromstring(z.read(f"xl/worksheets/sheet{i}.xml"))
        return {n: [["".join(c.itertext()) for c in r] for r in read(i).iter(f"{space}row")] for i, n in enumerate(names, 1)}


def test_workbook(spark, tmp_path):
    rows = [(f"n<{i}>&", None if i == 2 else " sp\x01 é😀\n", i) for i in range(5)]
    df = spark.createDataFrame(rows, "`a.b` string, y string, z int").orderBy(F.desc("z"))
    workbook.write_xlsx(df, str(tmp_path / "a.xlsx"))
    want = [[a, (y or "").replace("\x01", ""), str(z)] for a, y, z in reversed(rows)]
    assert sheets(tmp_path / "a.xlsx") == {"links": [["a.b", "y", "z"], *want]}
    workbook.write_xlsx(df, str(tmp_path / "b.xlsx"), sheet_rows=3)
    head = [["a.b", "y", "z"]]
    assert sheets(tmp_path / "b.xlsx") == {"links": head + want[:2], "links 2": head + want[2:4], "links 3": head + want[4:]}
    workbook.write_xlsx(df.limit(0), str(tmp_path / "c.xlsx"))
    assert sheets(tmp_path / "c.xlsx") == {"links": head}
    with pytest.raises(ValueError, match="32767"):
        workbook.write_xlsx(df.select(F.repeat(F.lit("x"), 32_768).alias("x")), str(tmp_path / "d.xlsx"))


def test_settings_file(spark, tmp_path):
    pytest.importorskip("yaml")
    f = tmp_path / "settings.yaml"
    f.write_text("crawlers:\n  s:\n    delay: 1\n    pages:\n      p: {delay: 2}\n", "utf-8")
    assert [(r.source, r.page, dict(r.config)) for r in settings.registry(spark, settings.load(str(f))).collect()] == [("s", "p", {"delay": "2"})]
    f.write_text("")
    assert settings.load(str(f)) == {}
    f.write_text("- 1\n")
    with pytest.raises(ValueError, match="list"):
        settings.load(str(f))


def test_registry(spark):
    tree = {"crawlers": {"s": {"label": "S", "delay": 1, "pages": {"p": {"delay": 2}, "q": None}}}}
    got = {(r.source, r.page): dict(r.config) for r in settings.registry(spark, tree).collect()}
    assert got == {("s", "p"): {"delay": "2"}, ("s", "q"): {"delay": "1"}}


def test_change_feed(spark, tmp_path):
    folder, table = str(tmp_path / "in"), str(tmp_path / "table")
    rows = [("s", "a", "added", "1", "2024-01-01"), ("s", "a", "added", "1", "2024-01-01"), ("s", "b", "added", "1", "2024-01-01"), ("s", "b", "removed", None, "2024-01-02")]
    df = spark.createDataFrame(rows, "source string, url string, op string, payload string, d string").selectExpr("source", "url", "op", "payload", "cast(d as timestamp) at")
    df.write.parquet(folder)
    changes.apply_to(changes.feed(spark, folder), table, str(tmp_path / "c")).awaitTermination()
    assert [(r.url, r.payload) for r in spark.read.parquet(f"{table}/v0").collect()] == [("a", "1")]


def plain_loop(fetch, key, expected=None):
    out, seen, page = [], set(), 1
    while True:
        new = 0
        for pos, item in enumerate(fetch(page)):
            if item.get(key) is not None and item[key] not in seen:
                seen.add(item[key])
                out.append((page, pos, item[key], item.get("name")))
                new += 1
        if not new or expected is not None and len(seen) >= expected:
            return out
        page += 1


def listing(pages, repeat_from=None, hole=None):
    def fetch(page):
        if page == hole or repeat_from is None and page > pages:
            return []
        at = min(page, repeat_from) if repeat_from else page
        return [{"id": None if at == 3 and i == 2 else (at * 5 + i) // 2, "name": f"n{at}-{i}"} for i in range(5)]

    return fetch


@pytest.mark.parametrize("fetch, expected", [(listing(70), None), (listing(0), None), (listing(500, repeat_from=41), None), (listing(90, hole=20), None), (listing(90), 77), (listing(4), 10_000)])
def test_paged(spark, fetch, expected):
    got = paged.paged(spark, fetch, "id long, name string", "id", expected=expected, tasks=3)
    assert sorted(map(tuple, got.collect())) == plain_loop(fetch, "id", expected)


def test_paged_server_asks_for_each_page_once(spark):
    asked = collections.Counter()

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            page = int(self.path.rsplit("=", 1)[1])
            asked[page] += 1
            body = b"\xef\xbb\xbf" + json.dumps([{"id": page * 10 + i, "name": "é"} for i in range(10)] if page <= 37 else []).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    port = server.server_address[1]

    def fetch(page):
        return json.loads(urllib.request.urlopen(f"http://127.0.0.1:{port}/?page={page}").read().decode("utf-8-sig"))

    try:
        got = paged.paged(spark, fetch, "id long, name string", "id")
        assert sorted(r.id for r in got.collect()) == list(range(10, 380)) and got.count() == 370
        assert set(asked) == set(range(1, 49)) and set(asked.values()) == {1}
    finally:
        server.shutdown()


def test_lists_and_html_in_scripts(spark):
    page = r"""<script>var list = [{"t": "a]; b"}, ["x"]]; var html = "<a href=\"/x\">y\n\\n</a>"; var one = 'it\'s "it"';</script>"""
    df = spark.createDataFrame([(page,), ("var list = [1, ; var html = 5",), (None,)], "html string")
    got = df.select(F.to_json(payloads.script_list(F.col("html"), "list")), payloads.script_html(F.col("html"), "html"), payloads.script_html(F.col("html"), "one")).collect()
    assert tuple(got[0]) == ('[{"t":"a]; b"},["x"]]', '<a href="/x">y\n\\n</a>', 'it\'s "it"') and tuple(got[1]) == (None, "", "")
    long = "var list = [" + ",".join('"a\\"b"' for _ in range(50_000)) + "];"
    assert spark.createDataFrame([(long,)], "html string").select(F.size(F.try_variant_get(payloads.script_list(F.col("html"), "list"), "$", "array<string>"))).first()[0] == 50_000


def test_declared_charsets(spark):
    rows = [("é漢".encode(), None), ("漢字".encode("big5"), "big5"), ("é".encode("latin-1"), None), (b"\x81", "no-such"), (None, "utf-8")]
    df = spark.createDataFrame(rows, "body binary, declared string")
    assert [r[0] for r in df.select(payloads.decoded(F.col("body"), F.col("declared"))).collect()] == ["é漢", "漢字", "é", "�", None]


def test_manifest(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes(b"{}\n")
    listing = archive.files(spark, str(tmp_path))
    rows = listing.select("path", F.lit(1).alias("rows")).limit(1)
    assert [(r.rows, r.bytes, len(r.sha256)) for r in archive.manifest(listing, rows).collect()] == [(1, 3, 64)]


def test_digest_of_a_file_above_an_array(spark, tmp_path):
    big = tmp_path / "big"
    with open(big, "wb") as f:
        f.truncate((1 << 31) + 5)
    (tmp_path / "é x").write_bytes(b"abc")
    zeros, piece = hashlib.sha256(), bytes(1 << 20)
    for _ in range(2048):
        zeros.update(piece)
    zeros.update(bytes(5))
    got = {r.path.rsplit("/", 1)[1]: (r.bytes, r.sha256) for r in archive.files(spark, str(tmp_path)).collect()}
    assert got == {"big": ((1 << 31) + 5, zeros.hexdigest()), "é x": (3, hashlib.sha256(b"abc").hexdigest())}


def test_files_that_grow(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()

    def add(name, data):
        with open(folder / name, "ab") as f:
            f.write(data)

    def batch():
        query = tail.lines(spark, str(folder), part=10_000 if (folder / "c.jsonl").exists() else 5).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        assert query.awaitTermination(120) and query.exception() is None
        return sorted((r.file.rsplit("/", 1)[1], r.offset, r.value) for r in spark.read.parquet(out).collect())

    add("a.jsonl", '{"k": 1}\n{"k": "é"}\r\n{"k'.encode())
    add("b.txt", b"not read\n")
    first = batch()
    assert [x[2] for x in first] == ['{"k": 1}', '{"k": "é"}']
    assert batch() == first  # nothing new
    add("a.jsonl", b'": 3}\n\n')
    add("c.jsonl", b"x" * 70_000 + b"\nlast")
    second = batch()
    assert [(x[0], x[2]) for x in second if x not in first] == [("a.jsonl", ""), ("a.jsonl", '{"k": 3}')][::-1] + [("c.jsonl", "x" * 70_000)]
    add("c.jsonl", b"\n")
    assert [(x[1], x[2]) for x in batch() if x not in second] == [(70_001, "last")] and len({x[:2] for x in batch()}) == 6
