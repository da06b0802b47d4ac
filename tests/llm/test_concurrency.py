import random

import pytest
from conftest import same

from tidemark.llm import concurrency
from tidemark.llm.queries import ORACLES, QUERIES

ROW = "key string, start long, end long, value long, bucket int"


def swept(rows, key):
    """A plain sweep over all moments of a key."""
    mine = [(a, b, v or 0) for k, a, b, v, _ in rows if k == key and a is not None and (b is None or b > a)]
    change = {}
    for a, b, v in mine:
        for t, n in ((a, 1), (b, -1)):
            if t is not None:
                c = change.setdefault(t, [0, 0])
                c[0] += n
                c[1] += n * v
    out, n, v, high = [], 0, 0, 0
    for t in sorted(t for t, c in change.items() if any(c)):
        n, v = n + change[t][0], v + change[t][1]
        high = max(high, n)
        out.append([t, None, n, v, high])
    for x, y in zip(out, out[1:], strict=False):
        x[1] = y[0]
    most = max((x[2] for x in out), default=0)
    return [(key, *x, x[2] == most) for x in out]


@pytest.mark.parametrize("width", [7, 50, 10_000])
def test_by_brute_force(spark, width):
    r = random.Random(width)
    rows = []
    for _ in range(400):
        a = r.randrange(-200, 600)
        b = r.choice([None, a, a - 5, a + r.randrange(1, 90), (a // width + r.randrange(1, 3)) * width])
        rows.append((r.choice(["x", "x", "x", "y", None]), r.choice([a, a, a, a // width * width, None]), b, r.choice([None, 0, 5, r.randrange(100)]), 9))
    rows += rows[:50] + [("z", 0, 21, 4, 1), ("z", 21, 35, 4, 1)]  # the sum and the count stay at 21
    got = concurrency.concurrency(spark.createDataFrame(rows, ROW), "key", width=width).collect()
    want = [x for k in ("x", "y", "z", None) for x in swept(rows, k)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and sorted(x[1] for x in got if x[0] == "z") == [0, 35]


def test_of_nothing(spark):
    none = spark.createDataFrame([], ROW)
    assert concurrency.concurrency(none, "key").collect() == []
    assert concurrency.concurrency(spark.createDataFrame([("a", None, 3, 1, 1), ("a", 5, 5, 1, 1)], ROW), "key").count() == 0


def test_nations_of_hot_missing_and_repeated_clients(spark):
    sales = [(i, 1) for i in range(600)] + [(1000 + i, i) for i in range(40)] + [(2000, None), (2001, 77)]
    clients = [(1, 4), (1, 3), (2, None), (None, 9)] + [(i, i % 5) for i in range(3, 40)]
    got = concurrency.nation_of_sales(spark.createDataFrame(sales, "sale_id long, client_id long"), spark.createDataFrame(clients, "client_id long, nation_id int")).collect()
    nation = {1: 3, 2: -1, 0: -1, None: -1, 77: -1} | {i: i % 5 for i in range(3, 40)}
    assert len(got) == len(sales) and all(r.nation_id == nation[r.client_id] for r in got)


def test_times_without_a_zone_do_not_depend_on_the_session(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-31 02:30:59.9' AS t UNION ALL SELECT TIMESTAMP_NTZ'1969-12-31 23:59:30' UNION ALL SELECT NULL")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # that hour is left out there
        assert [r[0] for r in df.select(concurrency.utc_minute(df, "t")).collect()] == [1711852200, -60, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_query_equals_sql(spark, duck):
    duck.execute("SET TimeZone = 'UTC'")
    assert same(spark, duck, QUERIES["op11_peak_concurrency"], ORACLES["op11_peak_concurrency"])
