import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import numbering, quality, traverse
from tidemark.sources import jsonl


def test_numbers_of_files_that_split(spark, tmp_path):
    r = random.Random(4)
    want = {}
    for name, end in (("a.jsonl", "\n"), ("b.jsonl", "\r\n"), ("c.jsonl", "\n")):
        lines = [("", " \t", "[1]", "broken{", json.dumps({"url": "é" * r.randrange(200), "k": k}))[min(4, r.randrange(9))] for k in range(900)]
        (tmp_path / name).write_bytes((end.join(lines) + (end if name != "c.jsonl" else "")).encode())
        with open(tmp_path / name, encoding="utf-8") as f:
            want |= {(name, i): line.rstrip("\r\n") for i, line in enumerate(f, 1)}
    got = jsonl.numbered_lines(spark, str(tmp_path), split_bytes=3000)
    assert got.select(F.col("file")).distinct().count() == 3
    assert {(x.file.rsplit("/", 1)[1], x.line_no): x.raw for x in got.collect()} == want
    over = jsonl.numbered_lines(spark, str(tmp_path), split_bytes=5000, across=True)
    assert [x.line_no for x in over.orderBy("file", "line_no").collect()] == list(range(1, len(want) + 1))
    scanned = {(x.file.rsplit("/", 1)[1], x.line_no): x.error for x in jsonl.scan(spark, str(tmp_path), 2000).collect()}
    assert set(scanned) == {k for k, v in want.items() if v.strip()}
    assert all(scanned[k] == {"[1]": "no object", "broken{": "no JSON"}.get(want[k]) for k in scanned)


def test_line_issues_tell_missing_null_and_wrong_types(spark, tmp_path):
    good = {"url": "https://a/1", "name": "n", "discovered_at_utc": "2024-01-02T03:04:05Z", "publish_date": "2024-01-02", "source": "s", "meta": {"discovered_from": "https://a/"}}
    cases = [
        ({}, set()), ({"publish_date": None}, set()), ({"url": None}, {("url", "null_required_field", None)}), ({"url": 5}, {("url", "invalid_required_type_or_empty", "int")}),
        ({"url": " "}, {("url", "invalid_required_type_or_empty", "str")}), ({"url": "a/b"}, {("url", "invalid_url_format", "a/b")}), ({"name": []}, {("name", "invalid_required_type_or_empty", "array")}),
        ({"discovered_at_utc": "soon"}, {("discovered_at_utc", "invalid_datetime_format", "soon")}), ({"publish_date": 2024}, {("publish_date", "invalid_publish_date_format", "2024")}),
        ({"publish_date": "2024-02-30"}, {("publish_date", "invalid_publish_date_format", "2024-02-30")}), ({"source": True}, {("source", "invalid_required_type_or_empty", "bool")}),
        ({"meta": None}, {("meta", "null_required_field", None)}), ({"meta": "x"}, {("meta", "invalid_required_type_or_empty", "str")}), ({"meta": {}}, {("meta.discovered_from", "missing_required_field", None)}),
        ({"meta": {"discovered_from": None}}, {("meta.discovered_from", "null_required_field", None)}), ({"meta": {"discovered_from": {}}}, {("meta.discovered_from", "invalid_required_type_or_empty", "object")}),
        ({"meta": {"discovered_from": "x"}}, {("meta.discovered_from", "invalid_url_format", "x")}),
    ]
    texts = [json.dumps(good | c) for c, _ in cases] + [json.dumps({k: v for k, v in good.items() if k != drop}) for drop in good] + ["{", "3"]
    want = [w for _, w in cases] + [{(drop, "missing_required_field", None)} for drop in good] + [{("record", "parse_error", "no JSON")}, {("record", "parse_error", "no object")}]
    (tmp_path / "x.jsonl").write_text("\n".join(texts))
    issues = quality.line_issues(jsonl.scan(spark, str(tmp_path)))
    got = [set() for _ in texts]
    for x in issues.collect():
        got[x.line_no - 1].add((x.field, x.kind, x.found))
    assert got == want
    states = {(x.source, x.field): (x.missing, x.null, x.invalid) for x in quality.field_states(issues).collect()}
    assert states[("s", "url")] == (1, 1, 3) and states[("s", "meta.discovered_from")] == (2, 2, 3) and states[("(missing)", "source")] == (1, 0, 1)


@pytest.mark.parametrize("few", [3, 40, 10_000])
def test_exact_ranks(spark, few):
    r = random.Random(few)
    values = [r.choice([7, 7, 7, r.randrange(1000), -3]) for _ in range(700)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 5, "v int").repartition(6)
    ranks = [1, 2, 350, 665, 699, 700]
    assert numbering.at_ranks(df, "v", ranks, few) == [sorted(values)[k - 1] for k in ranks]
    with pytest.raises(ValueError, match="701"):
        numbering.at_ranks(df, "v", [701])


def test_numbers_along_an_order(spark):
    rows = [(x * 7919 % 1009, str(x)) for x in range(1009)]
    got, n = numbering.numbered(spark.createDataFrame(rows, "k int, v string").repartition(7), ["k"], "at", 10)
    assert n == 1009 and sorted((x.k, x["at"], x.v) for x in got.collect()) == [(k, k + 10, v) for k, v in sorted(rows)]
    assert numbering.numbered(spark.createDataFrame([], "k int"), ["k"], "at")[1] == 0


def queue(edges, seeds, max_depth, max_nodes=None, out_cap=None, scope=None):
    links = {}
    for s, t, p in sorted(edges, key=lambda e: (e[0], e[2], e[1])):
        if out_cap is None or len(links.setdefault(s, [])) < out_cap:
            links.setdefault(s, []).append(t)
    todo, found = [], {}
    for n, _ in sorted(seeds, key=lambda x: (x[1], x[0])):
        if n not in found:
            found[n] = (0, None)
            todo.append(n)
    while todo:
        at = todo.pop(0)
        for t in links.get(at, []) if found[at][0] < max_depth else []:
            if t not in found and (scope is None or t in scope):
                found[t] = (found[at][0] + 1, at)
                todo.append(t)
    return [(n, d, i, v) for i, (n, (d, v)) in enumerate(found.items()) if max_nodes is None or i < max_nodes]


@pytest.mark.parametrize("limits", [{}, {"max_nodes": 1}, {"max_nodes": 37}, {"out_cap": 2}, {"scope": set(range(0, 300, 2))}, {"max_nodes": 500, "out_cap": 3}])
def test_discovery_is_a_queue(spark, limits):
    r = random.Random(len(str(limits)))
    edges = list({(r.randrange(300), p): r.randrange(300) for p in range(4) for _ in range(200)}.items())
    edges = [(s, t, p) for (s, p), t in edges]
    seeds = [(299, 1), (5, 0), (299, 3), (77, 2)]
    e, s = spark.createDataFrame(edges, "src long, dst long, pos int"), spark.createDataFrame(seeds, "node long, pos int")
    scope = spark.createDataFrame([(x,) for x in limits["scope"]], "node long") if "scope" in limits else None
    got = traverse.discovered(e, s, 4, limits.get("max_nodes"), limits.get("out_cap"), scope).collect()
    assert sorted(map(tuple, got), key=lambda x: x[2]) == queue(edges, seeds, 4, **limits)


def test_discovery_of_nothing(spark):
    e, s = spark.createDataFrame([], "src long, dst long, pos int"), spark.createDataFrame([], "node long, pos int")
    assert traverse.discovered(e, s, 3).count() == 0
    assert [tuple(x) for x in traverse.discovered(e, spark.createDataFrame([(4, 1)], "node long, pos int"), 3).collect()] == [(4, 0, 0, None)]
