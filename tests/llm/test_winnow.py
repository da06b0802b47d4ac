import hashlib
import random

import numpy as np
from conftest import DATA
from pyspark.sql import functions as F

from tidemark.llm import vectext as vt
from tidemark.llm import winnow
from tidemark.llm.queries import QUERIES


def kept(text, k, w):
    """Winnowing gram by gram: positions, and the grams' texts."""
    if not text:
        return {}
    grams = [text[i : i + k] for i in range(max(1, len(text) - k + 1))]
    value = lambda g: int((winnow._keys(np.array([*map(ord, g), *[winnow.FILL] * (k - len(g))], np.uint32), k))[0])
    hashes, out = [value(g) for g in grams], {}
    for i in range(max(1, len(grams) - w + 1)):
        at = min(range(i, min(i + w, len(grams))), key=lambda j: (hashes[j], -j))
        out[at] = hashes[at]
    return out


def text_of(r, n):
    return "".join(r.choice(["ab", "c", " ", "é", "漢", "😀", "aaaa", "word "]) for _ in range(n))


def record(found):
    return "".join(f"{p:08x}{h:010x}" for p, h in sorted(found.items()))


def likeness(a, b):
    a, b = set(a.values()), set(b.values())
    return len(a & b) / len(a | b) if a | b else 1.0


def test_by_brute_force(monkeypatch):
    monkeypatch.setattr(winnow, "RUN", 37)  # windows of one text lie in many runs
    r = random.Random(1)
    for k, w in ((3, 4), (5, 1), (1, 6), (8, 20)):
        texts = [text_of(r, r.randrange(60)) for _ in range(60)] + ["", "a", "", "ab", "a" * 50]
        for text, (at, hashes) in zip(texts, winnow.winnowed(texts, k, w), strict=True):
            assert dict(zip(at.tolist(), hashes.tolist(), strict=True)) == kept(text, k, w)
    assert winnow.winnowed(["", ""])[0][0].size == 0 and winnow.winnowed([]) == []


def test_hashes_of_a_gram_do_not_depend_on_their_place():
    codes = np.arange(3 * vt.CHUNK, dtype=np.uint32) % 77
    keys = winnow._keys(codes, 24)
    assert (keys[: len(keys) - 77] == keys[77:]).all()


def test_shared_passages_are_found_and_short_ones_are_not():
    r = random.Random(7)
    for _ in range(50):
        passage = "".join(r.choice("abcdefghij") for _ in range(winnow.GRAM + winnow.WINDOW - 1))
        a, b = ("".join(r.choice("klmnop") for _ in range(300)) for _ in range(2))
        x, y, u, v = winnow.winnowed([a[:150] + passage + a[150:], b[:30] + passage + b[30:], a + passage[: winnow.GRAM - 1], b + passage[: winnow.GRAM - 1]])
        common = np.intersect1d(x[1], y[1])
        assert len(common) and set(x[0][np.isin(x[1], common)].tolist()) <= set(range(150, 150 + len(passage)))
        assert not len(np.intersect1d(u[1], v[1]))


def whole(rows, k=winnow.GRAM, w=winnow.WINDOW):
    order = sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode()))
    out = []
    for at, (i, t) in enumerate(order):
        other = order[(at + 1) % len(order)][1]
        q = len(t) // 4
        edited = t[: len(t) - q] + other[:q]
        a, b, c = (kept(x, k, w) for x in (t, edited, other))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), record(a), record(b), likeness(a, b), likeness(a, c)))
    return sorted(map(str, out))


def test_query_by_brute_force(spark, tmp_path):
    r = random.Random(3)
    rows = [(r.randrange(-(2**62), 2**62), text_of(r, r.choice([0, 1, 5, 40, 200]))) for _ in range(120)]
    rows += [(5, None), (6, ""), (7, "same"), (7, "same"), (7, "other"), (None, "none"), (None, "also none"), (2**63 - 1, "last " * 30), (8, "x" * 3000)]
    r.shuffle(rows)
    spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, fingerprint string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_fingerprints"](spark, str(tmp_path)).collect()
    assert sorted(str(tuple(x)) for x in got) == whole(rows)


def test_one_row_and_none(spark, tmp_path):
    for name, rows in (("one", [(4, "abcdefgh" * 20)]), ("none", []), ("null", [(None, None)])):
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = QUERIES["op13_fingerprints"](spark, f"{tmp_path}/{name}").collect()
        assert sorted(str(tuple(x)) for x in got) == whole(rows)


def test_edits_are_nearer_than_neighbours(spark):
    got = QUERIES["op13_fingerprints"](spark, DATA).agg(F.avg("near_edited"), F.avg("near_next"), F.count("*")).first()
    assert got[0] > 0.5 and got[1] < 0.2 and got[2] == spark.read.parquet(f"{DATA}/documents.parquet").count()
