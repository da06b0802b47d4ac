import hashlib
import math
import re
import textwrap
from random import Random

import pytest
from conftest import DATA, same
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.llm import chat, licences, mixing, urls
from tidemark.llm.queries import ORACLES, QUERIES

NATIVE = ("op5_mix_sources", "op9_chat_format", "op10_licence_scan")
DOC = "doc_id long, text string, lang string, source string, n_chars long, size string"


@pytest.mark.parametrize("name", NATIVE)
def test_query_equals_sql(spark, duck, name):
    assert same(spark, duck, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", [*NATIVE, "op3_url_filter"])
def test_plan_has_no_python(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None, "clash") for i, t, s in rows], DOC)


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (i % 37 + 1), f"s{i % 3}" if i % 5 else "s0") for i in range(3000)]
    m = mixing.mix_sources(docs(spark, rows))
    per = m.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max(F.col("taken") / F.col("size")).alias("most")).collect()
    assert all(abs(r.taken - r.target) <= 0.02 * r.target and r.most <= 2 for r in per)
    total = sum(len(t.split()) for _, t, _ in rows)
    assert sum(r.target for r in per) == pytest.approx(1.5 * total)
    assert mixing.emit_mix(docs(spark, rows)).count() == m.agg(F.sum("copies")).first()[0]


def test_mix_edge_cases(spark):
    rows = [(1, None, None), (2, "", "a"), (3, "x y", "a"), (3, "x y", "a"), (None, "z", "a"), (5, "u", None), (6, None, "empty")]
    m = {(r.doc_id, r.source): r for r in mixing.mix_sources(docs(spark, rows)).collect()}
    assert m[(1, None)].size == 0 and m[(6, "empty")].target == 0 and m[(6, "empty")].copies == 0
    assert m[(5, None)].source_size == 1 and m[(3, "a")].taken in (0, 2, 4)
    again = sorted(map(str, mixing.mix_sources(docs(spark, rows).repartition(3)).collect()))
    assert again == sorted(map(str, mixing.mix_sources(docs(spark, rows)).collect()))
    assert mixing.mix_sources(docs(spark, [])).count() == 0


def test_targets_share_excess(spark):
    t = mixing.source_targets(spark.createDataFrame([("a", 100), ("b", 1000), ("c", 1000), (None, 10)], "source string, words long"))
    got = {r.source: r.target for r in t.collect()}
    # a is capped at 200 and null (weight 5) at 20; b and c share the other 2945 by 2 to 1, and b stops at its 2000 words' cap.
    assert got["a"] == 200 and got[None] == 20 and got["b"] == pytest.approx(2945 * 2 / 3) and got["c"] == pytest.approx(2945 / 3)


CHAT = "conv_id long, turn long, role string, text string, extra int"


def test_chat_round_trip(spark):
    nasty = "a<|im_end|>\n<|im_start|>user\n%3C %25 [INST] </s> \\ é"
    rows = [(1, 0, "user", nasty, 1), (1, 1, "assistant", nasty, 1), (1, 2, "user", None, 1), (2, 0, "a\nb", "", 1), (3, 0, "assistant", "x", 1), (3, 1, "assistant", "y", 1), (3, None, None, "first", 1)]
    e = chat.format_conversations(spark.createDataFrame(rows, CHAT))
    got = {r.conv_id: r for r in chat.read_back(e).collect()}
    sha = lambda *turns: hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert got[1].turns_sha256 == sha(("user", nasty), ("assistant", nasty), ("user", "")) and got[1].loss_chars == len(nasty)
    assert got[2].turns_sha256 == sha(("a\nb", "")) and got[2].loss_chars == 0
    assert got[3].turns_sha256 == sha(("", "first"), ("assistant", "x"), ("assistant", "y"))
    assert got[3].loss_sha256 == hashlib.sha256(b"xy").hexdigest() and e.where("conv_id = 3").count() == 2
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], CHAT))).count() == 0


def test_licence_cases(spark):
    body = "Something else entirely.\nLicensed under the Apache License, version 2.0\nmore"
    rows = [(1, body, "a"), (1, body, "a"), (2, None, "a"), (3, "", "a"), (4, "Released under the MIT licence.", "a"), (None, "Released under the MIT License.", "a"), (6, "x" * 100_000, "a")]
    got = sorted(licences.scan_licences(docs(spark, rows)).collect(), key=str)
    assert [(r.doc_id, r.line, r.start, r.end, r.licence) for r in got] == [(1, 2, None, None, "Apache-2.0"), (1, None, 3, 11, "Apache-2.0"), (None, 1, None, None, "MIT"), (None, None, 0, 5, "MIT")]
    assert licences.scan_licences(docs(spark, [])).count() == 0


def wrapped(text, width=60):
    return "\n".join(" * " + line for line in textwrap.wrap(text, width))


def test_licences_within_texts(spark):
    mit, bsd, apache = (max((t for name, t in licences.TEMPLATES if name == kind), key=len) for kind in ("MIT", "BSD", "Apache-2.0"))
    rows = [(i, f"Some words before.\n{wrapped(t)}\n\nint main();\n" + "code " * 500, "a") for i, t in enumerate((mit, bsd, apache))]
    rows += [(3, "Copyright 2020 X. Licensed under the MIT License. All rights reserved.", "a"), (4, f"MIT License\n\nCopyright (c) 2020 X\n\n{mit}", "a")]
    rows += [(5, f"{bsd} {mit} {bsd}", "a"), (6, "w " * 100_000 + mit, "a"), (7, "license copyright software " * 400, "a")]
    got = {}
    for r in licences.scan_windows(docs(spark, rows)).orderBy("start").collect():
        got.setdefault(r.doc_id, []).append((r.licence, r.dice))
    assert {i: [name for name, _ in found] for i, found in got.items()} == {0: ["MIT"], 1: ["BSD"], 2: ["Apache-2.0"], 3: ["MIT"], 4: ["MIT"], 5: ["BSD", "MIT", "BSD"], 6: ["MIT"]}
    assert all(d == 1 for i in (0, 1, 2, 3, 4, 5, 6) for _, d in got[i])


def windows(text, threshold=0.8):
    words, found, taken = re.findall("[a-z0-9]+", text.lower()), [], []
    for number, (name, template) in enumerate(licences.TEMPLATES):
        own, n = set(licences.pairs_of(template)), len(re.findall("[a-z0-9]+", template.lower()))
        for i in range(len(words) - 1):
            d = dice({f"{a} {b}" for a, b in zip(words[i : i + n], words[i + 1 : i + n])}, own)
            if f"{words[i]} {words[i + 1]}" in own and d >= threshold:
                found.append((-len(own & set(map(" ".join, zip(words[i : i + n], words[i + 1 : i + n])))), -d, number, i, min(i + n, len(words)), name))
    for w in sorted(found):
        if not any(w[3] < t[4] and t[3] < w[4] for t in taken):
            taken.append(w)
    return {(w[3], w[4], w[5], -w[1]) for w in taken}


def test_licence_windows_by_brute_force(spark):
    random = Random(5)
    texts = []
    for _ in range(60):
        words = []
        for _ in range(random.randint(1, 3)):
            notice = random.choice(licences.TEMPLATES)[1].split()
            notice = [w if random.random() > 0.08 else random.choice(["zz", "the", w + " " + w, ""]) for w in notice]
            words += random.choices(["the", "of", "software", "license", "permission"], k=random.randint(0, 6)) + notice[: random.randint(3, 400)]
        texts.append(" ".join(words).replace(" ", "\n", random.randint(0, 9)))
    got = {}
    for r in licences.scan_windows(docs(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect():
        got.setdefault(r.doc_id, set()).add((r.start, r.end, r.licence, r.dice))
    want = {i: windows(t) for i, t in enumerate(texts)}
    assert sum(map(len, want.values())) > 60 and got == {i: w for i, w in want.items() if w}


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b))


def test_licence_bounds_lose_nothing(spark):
    words = [licences.TEMPLATES[i][1].split() for i in (1, 4, 12)]
    lines = [" ".join(w[:k] + ["zz"] * j) for w in words for k in range(1, len(w) + 1) for j in (0, 1, 3)]
    got = {r.doc_id: r.dice for r in licences.scan_units(docs(spark, [(i, t, "a") for i, t in enumerate(lines)])).collect()}
    sets = [set(licences.pairs_of(t)) for _, t in licences.TEMPLATES]
    want = {i: max(dice(set(licences.pairs_of(t)), s) for s in sets) for i, t in enumerate(lines)}
    assert got == pytest.approx({i: d for i, d in want.items() if d >= 0.8})


def judged(spark, rows, **options):
    df = spark.createDataFrame(rows, "page_id long, url string, host int, note string")
    return {r.page_id: r for r in urls.judge_urls(df, **options).collect()}


def test_rules(spark):
    given = ["https://A.org/x", "http://example.org/es/1", "http://www.example.org/en/12", "http://notexample.org/es/1", "https://x.com/de/9", "https://x.com/fr/9", "https://x.com/es", "no url", None, "http://x.org", "http://org/?q"]
    got = judged(spark, [(i, u, 1, "n") for i, u in enumerate(given)])
    assert [got[i].rule for i in range(len(given))] == ["org/", "example.org/es/", "example.org/en/1", "org/", "com/de/", "com/fr/", None, None, None, None, "org/"]
    assert [got[i].verdict for i in range(6)] == ["allow", "block", "block", "allow", "block", "allow"]
    assert (got[0].host, got[0].path, got[7].host, got[8].path, got[0].note) == ("a.org", "/x", "", "", "n")
    assert all(r.verdict in ("allow", "block") for r in got.values())


def test_trees_learn_and_repeat(spark):
    rows = [(i, f"https://h{i % 7}.{'com' if i % 2 else 'net'}/{'de' if i % 3 else 'fr'}/{i}" + ("?a=1&b=2" if i % 3 else ""), 1, "") for i in range(300)]
    rules = tuple(r for r in urls.RULES if r[1].startswith("com"))
    a, b = judged(spark, rows, rules=rules), judged(spark, rows, rules=rules)
    rest = [r for r in a.values() if r.rule is None]
    right = [(r.verdict == "block") == bool(r.page_id % 3) for r in rest]
    assert len(rest) == 150 and sum(right) >= 145 and {k: r.block_score for k, r in a.items()} == {k: r.block_score for k, r in b.items()}


def plain_parts(url):
    """Host, path and rule of a url, by hand."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(r), v == "block", r, v) for v, r in urls.RULES if f".{host}".endswith("." + r.split("/")[0]) and path.startswith(r[r.index("/") :])]
    return host, path, max(fit)[2:] if fit else (None, None)


def plain_features(url, host, path, suffixes, share):
    url = url or ""
    n = max(1, len(url))
    query = re.split("#", url.split("?", 1)[1], maxsplit=1)[0] if "?" in url else ""
    entropy = -sum(url.count(c) / n * math.log2(url.count(c) / n) for c in set(url))
    digits = sum(c in "0123456789" for c in url)
    known = suffixes.get(host.split(".")[-1])
    mine = ((known[1] + 10 * share) / (known[0] + 10), math.log1p(known[0])) if known else (share, 0.0)
    first = [len(url), len(host), len(path), len([x for x in path.split("/") if x]), host.count(".") + 1, digits / n, entropy]
    return [*first, query.count("&") + 1 if query else 0, url.count("-") + url.count("_"), float("#" in url), *mine]


def test_filter_by_brute_force(spark, monkeypatch):
    models = []

    class Kept(urls.GBTClassifier):
        def fit(self, data):
            models.append(super().fit(data))
            return models[-1]

    monkeypatch.setattr(urls, "GBTClassifier", Kept)
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    random = Random(3)
    tails = ["?a=1&b=2#x", "#x?y", "", "/Deep/er-path_1", "?", "//"]
    more = [(-i, random.choice(["http", "HTTPS"]) + "://" + random.choice(["A.example.org", "x.com", "y.net", "z.io", "org", ""]) + random.choice(["/es/", "/de/1", "/fr", "/en/12", ""]) + random.choice(tails)) for i in range(1, 200)]
    pages = pages.unionByName(spark.createDataFrame([*more, (-1000, None), (-1001, "nothing"), (-1002, "a" * 50_000), more[0]], pages.schema))
    got = {r.page_id: r for r in urls.judge_urls(pages).collect()}
    rows = [(r.page_id, r.url, *plain_parts(r.url)) for r in pages.collect()]
    suffixes, labelled = {}, [(host, verdict == "block") for _, _, host, _, (_, verdict) in rows if verdict]
    for host, block in labelled:
        n, bad = suffixes.get(host.split(".")[-1], (0, 0))
        suffixes[host.split(".")[-1]] = (n + 1, bad + block)
    share = sum(block for _, block in labelled) / len(labelled)
    trees = models[0].trees
    for page, url, host, path, (rule, verdict) in rows:
        r = got[page]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        if verdict:
            assert r.verdict == verdict
    rest = [x for x in rows if not x[4][0]]
    assert len(rest) > 50
    for page, url, host, path, _ in rest[:: max(1, len(rest) // 60)] + [x for x in rest if x[0] <= -1000]:
        x = Vectors.dense(plain_features(url, host, path, suffixes, share))
        margin = sum(w * t.predict(x) for w, t in zip(models[0].treeWeights, trees, strict=True))
        assert got[page].block_score == pytest.approx(1 / (1 + math.exp(-2 * margin)))
        assert got[page].verdict == ("block" if got[page].block_score > 0.5 else "allow")


def test_urls_without_labels(spark):
    assert {r.verdict for r in judged(spark, [(1, "http://a.net/", 1, ""), (2, None, 1, "")]).values()} == {"allow"}
    assert judged(spark, []) == {}
