import hashlib
import random
import re

import pytest
from conftest import same
from pyspark.sql import functions as F

from tidemark.llm import fim
from tidemark.llm.queries import ORACLES, QUERIES

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
PARTS = ["a", "word", "é", "漢字", "😀", " ", "  ", "\n", "\t\r", "\x0b", "\x0c", "\xa0", "　", ".", "<", "P>", "x" * 40]


def plain_form(i, text, seed=42):
    h = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    x, y, z = ("".join(units[p:q]) for p, q in ((0, a), (a, b), (b, n)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(x), len(y), f"<S>{z}<P>{x}<M>{y}"
    return n, "psm", len(x), len(y), f"<P>{x}<S>{z}<M>{y}"


def test_bits():
    for bits in (1, 2, 0b1011, 1 << 5000, (1 << 4000) - 1, 0xF0F00000000000000000001):
        places = [i for i in range(bits.bit_length()) if bits >> i & 1]
        assert [fim.place_of(bits, r) for r in range(1, len(places) + 1)] == places
    assert fim.token_ends(b"") == 0 and fim.token_ends(b" a b ") == 0b11010 and fim.token_ends(b"  ") == 0b10


def test_by_brute_force(spark):
    r = random.Random(5)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randrange(40))) for _ in range(400)]
    rows = list(enumerate(texts, -20)) + [(900, None), (901, ""), (902, " "), (903, "a<S>b"), (904, "<<P"), (904, "<<P"), (None, "no id here"), (905, "w " * 300_000)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, output string")
    found = fim.fill_in_middle(docs, most=1000).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    want = sorted([(str(i), *plain_form(i, t or ""), t or "") for i, t in rows], key=str)
    assert sorted([(str(x.doc_id), *tuple(x)[1:]) for x in found], key=str) == want
    assert {x.form for x in found} == {"plain", "spm", "psm"}


def test_marks_at_the_seams_do_not_confuse(spark):
    rows = [(i, "< <P <S < > S> M> <M" * (i % 3 + 1)) for i in range(60)]
    found = fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), share=100, spm_share=50)
    back = found.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert {r.doc_id: r.back for r in back} == dict(rows) and {r.form for r in back} == {"spm", "psm"}


def test_of_nothing(spark):
    assert fim.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("name", ["op12_fill_in_middle"])
def test_query_equals_sql(spark, duck, name):
    assert same(spark, duck, QUERIES[name], ORACLES[name])
