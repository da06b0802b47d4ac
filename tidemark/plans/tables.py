"""Queries on keyed selection, joins, snapshots, profiles, schedules, traversal and browsing, with the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import documents
from ..operators import browse, combine, keyed, quality, refresh, snapshots, traverse
from . import table

_REC = """rec AS (SELECT lower(o_orderpriority) AS source, 'https://d.example/' || o_orderkey || '.pdf' AS url, o_orderkey AS k,
    strftime(o_orderdate, '%Y-%m-%d') AS publish_date, o_orderstatus AS status, o_totalprice AS price FROM orders)"""
_BASE, _FULL = "base AS (SELECT * FROM rec WHERE k % 7 <> 0)", "full_ AS (SELECT source, url, k, publish_date, status, CASE WHEN k % 11 = 0 THEN price + 1 ELSE price END AS price FROM rec WHERE k % 5 <> 0)"
_COLS = "source, url, publish_date, status, price"


def rec(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(
        F.lower("o_orderpriority").alias("source"), F.concat(F.lit("https://d.example/"), F.col("o_orderkey").cast("string"), F.lit(".pdf")).alias("url"), F.col("o_orderkey").alias("k"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("publish_date"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"),
    )


def _base(spark, d):
    return rec(spark, d).where("k % 7 <> 0").drop("k")


def _full(spark, d):
    return rec(spark, d).where("k % 5 <> 0").withColumn("price", F.when(F.col("k") % 11 == 0, F.col("price") + 1).otherwise(F.col("price"))).drop("k")


def _days(spark, d):
    return [rec(spark, d).where(f"k % {i + 3} <> 0").drop("k") for i in range(3)]


def dedup_first(spark, d):
    return keyed.dedup(table(spark, d, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], F.col("event_id"))


def dedup_last(spark, d):
    return keyed.dedup(table(spark, d, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], F.col("event_id"), "last")


def latest_version(spark, d):
    o = table(spark, d, "orders").withColumn("dated", F.when(F.col("o_orderkey") % 9 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")))
    return keyed.latest_version(o.select("o_custkey", "o_orderstatus", "dated", "o_orderkey"), ["o_custkey", "o_orderstatus"], "dated", "o_orderkey")


def argmax_year(spark, d):
    o = table(spark, d, "orders").select("o_custkey", F.year("o_orderdate").cast("long").alias("year"), "o_orderkey")
    return keyed.best_by(o, ["o_custkey"], [F.col("year")], F.col("o_orderkey"))


def score_pick(spark, d):
    p = table(spark, d, "part")
    flags = [(F.contains("p_type", F.lit(w))).cast("int") for w in ("BRASS", "STEEL")]
    score = 2 * flags[0] + flags[1] + (F.col("p_size") > 25).cast("int")
    p = p.select("p_brand", "p_partkey", score.cast("long").alias("score")).where("score > 0")
    return keyed.best_by(p, ["p_brand"], [F.col("score")], F.col("p_partkey"))


def first_match_else_first(spark, d):
    p = table(spark, d, "part").select("p_brand", "p_partkey", (F.col("p_size") > 45).alias("wanted"))
    return keyed.dedup(p, ["p_brand"], F.struct(~F.col("wanted"), F.col("p_partkey")))


def topk_per_group(spark, d):
    l = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return keyed.top_k(l, ["l_suppkey"], [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")], 5)


def per_group_cap(spark, d):
    e = table(spark, d, "events").select(F.to_date("ts").alias("day"), "event_id")
    return keyed.top_k(e, ["day"], [F.asc("event_id")], 3).select(F.col("day").cast("string").alias("day"), "event_id", "rank")


def cap_before_sort(spark, d):
    return keyed.cap(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 100).orderBy("o_totalprice")


def section_carry_forward(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type")
    return keyed.carry_forward(e, ["user_id"], [F.asc("event_id")], F.when(F.col("event_type") == "signup", F.col("event_id")), "section")


def mode_with_count(spark, d):
    return keyed.counted_mode(table(spark, d, "events").select("user_id", "event_type", "event_id"), ["user_id"], "event_type", "event_id")


def lookup_default(spark, d):
    n = table(spark, d, "nation").where("n_nationkey % 3 <> 0")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return combine.lookup(c, n, "c_nationkey", "n_nationkey", "n_name", F.col("c_nationkey").cast("string"), "label").select("c_custkey", "label")


def semi_starred(spark, d):
    big = table(spark, d, "lineitem").where("l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").join(big, "o_orderkey", "left_semi").select("o_orderkey", "o_custkey")


def anti_seen(spark, d):
    seen = table(spark, d, "lineitem").where("l_quantity >= 40").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").join(seen, "o_orderkey", "left_anti").select("o_orderkey", "o_custkey")


def or_parent(spark, d):
    child = table(spark, d, "lineitem").where("l_quantity >= 48").groupBy(F.col("l_orderkey").alias("id")).agg(F.max("l_partkey").alias("ref"))
    parent = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.lit(-1).cast("long").alias("ref"))
    return combine.or_parent(child, parent, "id")


def bilingual_pairs(spark, d):
    c = table(spark, d, "conversations").withColumn("pair", F.floor(F.col("turn") / 2))
    side = lambda r: c.where(F.col("role") == r).groupBy("conv_id", "pair").agg(F.min_by("text", "turn").alias("text"))
    return combine.pair_languages(side("user"), side("assistant"), ["conv_id", "pair"]).select("conv_id", "pair", "has", F.length(F.coalesce("en", "other")).cast("long").alias("n"))


def merge_replace(spark, d):
    prev, fresh = _base(spark, d), _full(spark, d).where("source like '1%' or source like '2%'")
    return snapshots.merge(prev, fresh, fresh.select("source"))


def merge_upsert(spark, d):
    prev, fresh = _base(spark, d), _full(spark, d).where("source like '1%' or source like '2%'")
    return snapshots.merge(prev, fresh, fresh.select("source"), "upsert")


def delta_added(spark, d):
    return snapshots.added(_base(spark, d), _full(spark, d))


def delta_removed(spark, d):
    return snapshots.removed(_base(spark, d), _full(spark, d))


def reconstruct_day(spark, d):
    b, f = _base(spark, d), _full(spark, d)
    return snapshots.reconstruct(b, snapshots.added(b, f), snapshots.removed(b, f))


def common_base(spark, d):
    return snapshots.common_base(_days(spark, d))


def rebase_deltas(spark, d):
    _, plus, minus = snapshots.rebase(_days(spark, d))
    return plus.select("day", "url", F.lit("added").alias("op")).unionByName(minus.select("day", "url", F.lit("removed").alias("op")))


def union_first_wins(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("pos"), F.lit("supplier").alias("kind"))
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("pos"), F.lit("customer").alias("kind"))
    return combine.union_first([s, c], ["nation"])


_META = "CASE WHEN event_id % 500 = 7 THEN '{\"k\": \"x\", \"m\": 1}' WHEN event_id % 50 = 3 THEN '{\"k\": 1.5}' ELSE props END"


def _meta(spark, d):
    return table(spark, d, "events").withColumn("meta", F.expr(_META))


def key_signatures(spark, d):
    e = _meta(spark, d).withColumn("sig", documents.key_signature(F.col("meta")))
    return quality.frequent(e, ["event_type"], "sig", "event_id", 5)


def type_histogram(spark, d):
    e = _meta(spark, d).withColumn("kind", documents.value_type(F.variant_get(documents.parsed(F.col("meta")), "$.k", "variant")))
    return e.groupBy("event_type", "kind").agg(F.count(F.lit(1)).alias("n"))


def type_outliers(spark, d):
    # A type in four rows at most, however many events there are; all are judged.
    e = table(spark, d, "events").withColumn("meta", F.expr("CASE WHEN event_id % 500 = 7 AND event_id < 2000 THEN '{\"k\": \"x\"}' ELSE props END"))
    e = e.withColumn("kind", documents.value_type(F.variant_get(documents.parsed(F.col("meta")), "$.k", "variant")))
    return quality.type_outliers(e, ["event_type"], "kind", "event_id")


def value_outliers(spark, d):
    e = table(spark, d, "events").withColumn("v", F.expr("CASE WHEN event_id % 997 = 1 THEN 'rare' || event_id % 3 WHEN event_id % 4 = 0 THEN 'b' ELSE 'a' END"))
    return quality.value_outliers(e, ["event_type"], "v", "event_id")


def _flawed(spark, d):
    r = rec(spark, d)
    k = F.col("k")
    return r.select(
        "k", F.when(k % 13 == 0, F.lit(None)).when(k % 17 == 0, "").when(k % 19 == 0, "no url").otherwise(F.col("url")).alias("url"), F.when(k % 23 == 0, " ").otherwise(F.col("status")).alias("name"),
        F.when(k % 29 == 0, "yesterday").otherwise(F.concat("publish_date", F.lit("T00:00:00Z"))).alias("discovered_at_utc"), F.when(k % 31 == 0, "2024-99-99").when(k % 37 == 0, F.lit(None)).otherwise(F.col("publish_date")).alias("publish_date"),
        F.when(k % 41 == 0, F.lit(None)).otherwise(F.col("source")).alias("source"),
    )


_FLAWED = f"""flawed AS (SELECT k, CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN '' WHEN k % 19 = 0 THEN 'no url' ELSE url END AS url, k % 23 = 0 AS no_name, k % 29 = 0 AS bad_seen,
    k % 37 <> 0 AND k % 31 = 0 OR k % 31 = 0 AS bad_date, CASE WHEN k % 41 = 0 THEN NULL ELSE source END AS source FROM rec),
  issues AS (
    SELECT k, coalesce(source, '(missing)') AS source, 'url' AS field, CASE WHEN url IS NULL THEN 'url_null' WHEN url = '' THEN 'url_blank' ELSE 'url_invalid' END AS kind, 'error' AS severity FROM flawed WHERE url IS NULL OR url IN ('', 'no url')
    UNION ALL SELECT k, coalesce(source, '(missing)'), 'name', 'name_blank', 'warning' FROM flawed WHERE no_name
    UNION ALL SELECT k, coalesce(source, '(missing)'), 'discovered_at_utc', 'discovered_at_utc_invalid', 'error' FROM flawed WHERE bad_seen
    UNION ALL SELECT k, coalesce(source, '(missing)'), 'publish_date', 'publish_date_invalid', 'warning' FROM flawed WHERE bad_date
    UNION ALL SELECT k, '(missing)', 'source', 'source_null', 'error' FROM flawed WHERE source IS NULL)"""


def required_field_quality(spark, d):
    return quality.issues(_flawed(spark, d), "k")


def issue_rollup(spark, d):
    r = quality.issues(_flawed(spark, d), "k").rollup("source", "kind").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("long").alias("level"))
    return r.select("source", "kind", "n", "level")


def first_issues(spark, d):
    return quality.issues(_flawed(spark, d), "k").orderBy("k", "field").limit(50)


def size_stats(spark, d):
    docs = table(spark, d, "documents")
    stats = docs.agg(F.min("n_chars").alias("least"), F.max("n_chars").alias("most"), F.round(F.avg("n_chars"), 6).alias("mean"), F.percentile("n_chars", F.lit(0.5)).alias("median"))
    return stats.crossJoin(quality.exclusive_p95(docs, "n_chars").select(F.round("p95", 6).alias("p95")))


def time_range(spark, d):
    show = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return table(spark, d, "events").groupBy("event_type").agg(show(F.min("ts")).alias("first"), show(F.max("ts")).alias("last"), F.count("ts").alias("n"))


def dup_hits(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("kinds"), (F.count("user_id") - F.count_distinct("user_id")).alias("hits"))


def schedule_due(spark, d):
    state = table(spark, d, "events").where("event_type <> 'error'").groupBy(F.col("event_type").alias("source")).agg(F.max(F.to_date("ts")).alias("last_run")).withColumn("page", F.lit("all"))
    rows = [("view", "all", "yes", "1"), ("signup", "all", "off", "1"), ("purchase", "all", "x", "40"), ("error", "all", None, "1"), ("click", "all", "1", "-3")]
    return refresh.decisions(spark.createDataFrame(rows, "source string, page string, enabled string, interval_days string"), state, "2024-02-01").select("source", "due", "reason")


def refresh_needed(spark, d):
    r = rec(spark, d)
    seen = F.when(F.col("k") % 10 == 0, F.lit(None)).when(F.col("k") % 10 == 1, "bad").otherwise(F.col("publish_date"))
    return r.select("k", refresh.needs_refresh(seen, F.lit("1995-06-01").cast("date"), F.col("url"), 365, 5.0).alias("refresh"))


def facet_counts(spark, d):
    groups = spark.createDataFrame([(1, "5-low", "Low"), (2, "1-urgent", "Urgent"), (3, "none", "None"), (4, "2-high", "High")], "pos int, id string, label string")
    return browse.facets(rec(spark, d), groups)


def facet_search_page(spark, d):
    r = rec(spark, d).withColumn("name", F.col("status"))
    return browse.page(browse.ordered(browse.search(r, "1-urgent", " 12")), 2, 25).select("source", "url", "publish_date", "price")


def source_groups(spark, d):
    e = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("site."), "event_type")).when(F.col("event_id") % 3 == 1, F.concat("event_type", F.lit("_x"))).otherwise(F.col("event_type")).alias("s"))
    exact = spark.createDataFrame([("view", "pages"), ("click", "pages"), ("site.error", "ops")], "k string, v string")
    labels = spark.createDataFrame([("site", "site"), ("purchase", "purchase"), ("signup", "signup")], "k string, v string")
    dotted = F.when(F.contains("s", F.lit(".")), F.substring_index("s", ".", -1))
    keys = [F.col("s"), dotted, F.when(F.contains("s", F.lit(".")), F.substring_index("s", ".", 1)), F.col("s"), F.when(F.instr("s", "_") > 1, F.substring_index("s", "_", 1))]
    return combine.lookup_chain(e, [(exact, "k", "v"), (exact, "k", "v"), (labels, "k", "v"), (labels, "k", "v"), (labels, "k", "v")], keys, "grp").select("event_id", F.coalesce("grp", F.lit("")).alias("grp"))


def bfs_parts(spark, d):
    l = table(spark, d, "lineitem").select(F.col("l_partkey").alias("p"), (-F.col("l_suppkey")).alias("s"))
    edges = l.select(F.col("p").alias("src"), F.col("s").alias("dst")).union(l.select(F.col("s").alias("src"), F.col("p").alias("dst"))).distinct()
    seed = l.agg(F.min("p").alias("node"))
    return traverse.bfs(edges, seed, 3).select("node", F.col("depth").cast("long").alias("depth"))


def probe_miss_stop(spark, d):
    e = table(spark, d, "events").groupBy("user_id", F.dayofmonth("ts").alias("day")).agg(F.lit(True).alias("hit"))
    users = table(spark, d, "events").select("user_id").distinct().crossJoin(spark.range(1, 31).select(F.col("id").cast("int").alias("day")))
    probes = users.join(e, ["user_id", "day"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
    return traverse.until_misses(probes, ["user_id"], "day", "hit", 3).groupBy("user_id").agg(F.count(F.lit(1)).alias("probed"), F.count_if("hit").alias("hits"))


def config_inherit(spark, d):
    n = table(spark, d, "nation")
    base = F.create_map(F.lit("delay"), F.lit("1"), F.lit("label"), F.col("n_name"), F.lit("pages"), F.lit("x"))
    own = F.create_map(F.lit("delay"), F.col("n_regionkey").cast("string"), F.lit("page"), F.col("n_nationkey").cast("string"))
    merged = documents.overlay(documents.drop_keys(base, "pages", "label"), own)
    return n.select("n_nationkey", F.explode(merged).alias("k", "v"))


def localized_names(spark, d):
    n = table(spark, d, "nation")
    m = F.create_map(F.lit("en"), F.col("n_name"), F.lit("tc"), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("T"), "n_name")).otherwise("N/A"))
    return n.select("n_nationkey", documents.localized(m, "tc").alias("name"))


QUERIES = {
    f.__name__: f
    for f in (dedup_first, dedup_last, latest_version, argmax_year, score_pick, first_match_else_first, topk_per_group, per_group_cap, cap_before_sort, section_carry_forward, mode_with_count, lookup_default, semi_starred,
              anti_seen, or_parent, bilingual_pairs, merge_replace, merge_upsert, delta_added, delta_removed, reconstruct_day, common_base, rebase_deltas, union_first_wins, key_signatures, type_histogram, type_outliers, value_outliers,
              required_field_quality, issue_rollup, first_issues, size_stats, time_range, dup_hits, schedule_due, refresh_needed, facet_counts, facet_search_page, source_groups, bfs_parts, probe_miss_stop, config_inherit, localized_names)
}

_SNAP = f"WITH {_REC}, {_BASE}, {_FULL}"
_FRESH = "fresh AS (SELECT * FROM full_ WHERE source LIKE '1%' OR source LIKE '2%')"
_DAYS = ", ".join(f"d{i} AS (SELECT {_COLS} FROM rec WHERE k % {i + 3} <> 0)" for i in range(3))
_SOURCE = "CASE event_id % 3 WHEN 0 THEN 'site.' || event_type WHEN 1 THEN event_type || '_x' ELSE event_type END"
_KIND = "CASE json_type(({m})::JSON, '$.k') WHEN 'VARCHAR' THEN 'str' WHEN 'DOUBLE' THEN 'float' ELSE 'int' END".replace("{m}", _META)

ORACLES = {
    "dedup_first": "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS r FROM events) WHERE r = 1",
    "dedup_last": "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS r FROM events) WHERE r = 1",
    "latest_version": "SELECT o_custkey, o_orderstatus, dated, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY dated DESC NULLS LAST, o_orderkey) AS r FROM (SELECT *, CASE WHEN o_orderkey % 9 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS dated FROM orders)) WHERE r = 1",
    "argmax_year": "SELECT o_custkey, year, o_orderkey FROM (SELECT o_custkey, year(o_orderdate) AS year, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC, o_orderkey) AS r FROM orders) WHERE r = 1",
    "score_pick": "SELECT p_brand, p_partkey, score FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY score DESC, p_partkey) AS r FROM (SELECT p_brand, p_partkey, (2 * contains(p_type, 'BRASS')::INT + contains(p_type, 'STEEL')::INT + (p_size > 25)::INT)::BIGINT AS score FROM part) WHERE score > 0) WHERE r = 1",
    "first_match_else_first": "SELECT p_brand, p_partkey, wanted FROM (SELECT p_brand, p_partkey, p_size > 45 AS wanted, row_number() OVER (PARTITION BY p_brand ORDER BY p_size <= 45, p_partkey) AS r FROM part) WHERE r = 1",
    "topk_per_group": "SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, r::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS r FROM lineitem) WHERE r <= 5",
    "per_group_cap": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_id, r::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY ts::DATE ORDER BY event_id) AS r FROM events) WHERE r <= 3",
    "cap_before_sort": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100",
    "section_carry_forward": "SELECT user_id, event_id, event_type, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM events",
    "mode_with_count": "SELECT user_id, event_type, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) AS r FROM (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY 1, 2)) WHERE r = 1",
    "lookup_default": "SELECT c_custkey, coalesce(n_name, c_nationkey::VARCHAR) AS label FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 3 <> 0) ON c_nationkey = n_nationkey",
    "semi_starred": "SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity >= 49)",
    "anti_seen": "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity >= 40)",
    "or_parent": "WITH c AS (SELECT l_orderkey AS id, max(l_partkey) AS ref FROM lineitem WHERE l_quantity >= 48 GROUP BY 1) SELECT * FROM c UNION ALL SELECT o_orderkey, -1 FROM orders WHERE o_orderkey NOT IN (SELECT id FROM c)",
    "bilingual_pairs": "WITH c AS (SELECT conv_id, turn // 2 AS pair, role, arg_min(text, turn) AS text FROM conversations GROUP BY 1, 2, 3), a AS (SELECT * FROM c WHERE role = 'user'), b AS (SELECT * FROM c WHERE role = 'assistant') SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.pair, b.pair) AS pair, CASE WHEN a.text IS NULL THEN 'other' WHEN b.text IS NULL THEN 'en' ELSE 'both' END AS has, length(coalesce(a.text, b.text))::BIGINT AS n FROM a FULL JOIN b ON a.conv_id = b.conv_id AND a.pair = b.pair",
    "merge_replace": f"{_SNAP}, {_FRESH} SELECT {_COLS} FROM fresh UNION ALL SELECT {_COLS} FROM base WHERE source NOT IN (SELECT source FROM fresh)",
    "merge_upsert": f"{_SNAP}, {_FRESH} SELECT {_COLS} FROM fresh UNION ALL SELECT {_COLS} FROM base WHERE (source, url) NOT IN (SELECT (source, url) FROM fresh)",
    "delta_added": f"{_SNAP} SELECT {_COLS} FROM full_ EXCEPT SELECT {_COLS} FROM base",
    "delta_removed": f"{_SNAP} SELECT source, url FROM base EXCEPT SELECT source, url FROM full_",
    "reconstruct_day": f"{_SNAP} SELECT {_COLS} FROM full_",
    "common_base": f"WITH {_REC}, {_DAYS} SELECT * FROM d0 INTERSECT SELECT * FROM d1 INTERSECT SELECT * FROM d2",
    "rebase_deltas": f"WITH {_REC}, {_DAYS}, b AS (SELECT * FROM d0 INTERSECT SELECT * FROM d1 INTERSECT SELECT * FROM d2) "
    + " UNION ALL ".join(f"SELECT {i}::INT AS day, url, 'added' AS op FROM (SELECT * FROM d{i} EXCEPT SELECT * FROM b)" for i in range(3)),
    "union_first_wins": "WITH u AS (SELECT 0 AS f, s_nationkey AS nation, s_suppkey AS pos, 'supplier' AS kind FROM supplier UNION ALL SELECT 1, c_nationkey, c_custkey, 'customer' FROM customer) SELECT nation, pos, kind FROM (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY f, pos) AS r FROM u) WHERE r = 1",
    "key_signatures": f"WITH s AS (SELECT event_type, event_id, array_to_string(list_sort(json_keys(({_META})::JSON)), ',') AS sig FROM events), c AS (SELECT event_type, sig, count(*) AS n, min(event_id) AS f FROM s GROUP BY 1, 2) SELECT event_type, sig, n, r::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, f) AS r FROM c) WHERE r <= 5",
    "type_histogram": f"SELECT event_type, {_KIND} AS kind, count(*) AS n FROM events GROUP BY 1, 2",
    "type_outliers": "WITH e AS (SELECT event_type, event_id, CASE json_type((CASE WHEN event_id % 500 = 7 AND event_id < 2000 THEN '{\"k\": \"x\"}' ELSE props END)::JSON, '$.k') WHEN 'VARCHAR' THEN 'str' WHEN 'DOUBLE' THEN 'float' ELSE 'int' END AS kind FROM events), c AS (SELECT event_type, kind, count(*) AS n, min(event_id) AS f FROM e GROUP BY 1, 2), m AS (SELECT *, first_value(kind) OVER w AS dominant, first_value(n) OVER w AS most FROM c WINDOW w AS (PARTITION BY event_type ORDER BY n DESC, f)) SELECT event_type, kind, n, dominant FROM m WHERE kind <> dominant AND most >= 5 AND n <= 2",
    "value_outliers": "WITH e AS (SELECT event_type, event_id, CASE WHEN event_id % 997 = 1 THEN 'rare' || event_id % 3 WHEN event_id % 4 = 0 THEN 'b' ELSE 'a' END AS v FROM events), c AS (SELECT event_type, v, count(*) AS n, min(event_id) AS f FROM e GROUP BY 1, 2), w AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, f) AS r, sum(n) OVER (PARTITION BY event_type) AS t, count(*) OVER (PARTITION BY event_type) AS kinds, max(n) OVER (PARTITION BY event_type) AS most FROM c) SELECT event_type, v, n FROM w WHERE t >= 20 AND kinds > 1 AND kinds / t <= 0.3 AND most / t >= 0.3 AND r > 1 AND n <= greatest(1, floor(t * 0.02)) AND n < most",
    "required_field_quality": f"WITH {_REC}, {_FLAWED} SELECT * FROM issues",
    "issue_rollup": f"WITH {_REC}, {_FLAWED} SELECT source, kind, count(*) AS n, grouping(source, kind)::BIGINT AS level FROM issues GROUP BY ROLLUP (source, kind)",
    "first_issues": f"WITH {_REC}, {_FLAWED} SELECT * FROM issues ORDER BY k, field LIMIT 50",
    "size_stats": "WITH r AS (SELECT n_chars AS v, row_number() OVER (ORDER BY n_chars) AS i, count(*) OVER () AS n FROM documents WHERE n_chars IS NOT NULL), p AS (SELECT max(n) AS n, 0.95 * (max(n) + 1) AS pos FROM r) SELECT (SELECT min(v) FROM r) AS least, (SELECT max(v) FROM r) AS most, (SELECT round(avg(v), 6) FROM r) AS mean, (SELECT quantile_cont(v, 0.5)::DOUBLE FROM r) AS median, CASE WHEN n >= 20 THEN round((SELECT v FROM r WHERE i = floor(pos)) + (pos - floor(pos)) * ((SELECT v FROM r WHERE i = least(floor(pos) + 1, p.n)) - (SELECT v FROM r WHERE i = floor(pos))), 6)::DOUBLE END AS p95 FROM p",
    "time_range": "SELECT event_type, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last, count(ts) AS n FROM events GROUP BY 1",
    "dup_hits": "SELECT event_type, count(DISTINCT user_id) AS kinds, count(user_id) - count(DISTINCT user_id) AS hits FROM events GROUP BY 1",
    "schedule_due": "WITH s AS (SELECT event_type AS source, max(ts::DATE) AS last FROM events WHERE event_type <> 'error' GROUP BY 1), r(source, on_, every) AS (VALUES ('view', true, 1), ('signup', false, 1), ('purchase', true, 40), ('error', true, 1), ('click', true, 1)) SELECT r.source, on_ AND (last IS NULL OR date_diff('day', last, DATE '2024-02-01') >= every AND date_diff('day', last, DATE '2024-02-01') >= 0) AS due, CASE WHEN NOT on_ THEN 'disabled' WHEN last IS NULL THEN 'never_ran' WHEN date_diff('day', last, DATE '2024-02-01') < 0 THEN 'in_future' WHEN date_diff('day', last, DATE '2024-02-01') >= every THEN 'interval_elapsed' ELSE 'too_early' END AS reason FROM r LEFT JOIN s ON s.source = r.source",
    "refresh_needed": f"WITH {_REC} SELECT k, k % 10 IN (0, 1) OR date_diff('day', publish_date::DATE, DATE '1995-06-01') >= 365 OR (concat('0x', left(sha256(url), 16))::UBIGINT % 10000) < 500 AS refresh FROM rec",
    "facet_counts": f"WITH {_REC}, g(pos, id, label) AS (VALUES (1, '5-low', 'Low'), (2, '1-urgent', 'Urgent'), (3, 'none', 'None'), (4, '2-high', 'High')) SELECT pos::INT AS pos, id, label, count(*) AS n FROM g JOIN rec ON rec.source = id GROUP BY 1, 2, 3",
    "facet_search_page": f"WITH {_REC} SELECT source, url, publish_date, price FROM rec WHERE source = '1-urgent' AND contains(lower(status || chr(10) || url), '12') ORDER BY publish_date DESC, url DESC LIMIT 25 OFFSET 25",
    "source_groups": f"WITH e AS (SELECT event_id, {_SOURCE} AS s FROM events), x(k, v) AS (VALUES ('view', 'pages'), ('click', 'pages'), ('site.error', 'ops')), l(k) AS (VALUES ('site'), ('purchase'), ('signup')) SELECT event_id, coalesce(a.v, b.v, c.k, f.k, g.k, '') AS grp FROM e LEFT JOIN x a ON a.k = s LEFT JOIN x b ON contains(s, '.') AND b.k = split_part(s, '.', 2) LEFT JOIN l c ON contains(s, '.') AND c.k = split_part(s, '.', 1) LEFT JOIN l f ON f.k = s LEFT JOIN l g ON instr(s, '_') > 1 AND g.k = split_part(s, '_', 1)",
    "bfs_parts": "WITH RECURSIVE l AS (SELECT l_partkey AS p, -l_suppkey AS s FROM lineitem), e AS (SELECT p AS a, s AS b FROM l UNION SELECT s, p FROM l), r AS (SELECT min(p) AS node, 0 AS depth FROM l UNION SELECT e.b, r.depth + 1 FROM r JOIN e ON e.a = r.node WHERE r.depth < 3) SELECT node, min(depth)::BIGINT AS depth FROM r GROUP BY node",
    "probe_miss_stop": "WITH u AS (SELECT DISTINCT user_id FROM events), h AS (SELECT DISTINCT user_id, day(ts) AS day FROM events), p AS (SELECT u.user_id, d.day, h.day IS NOT NULL AS hit FROM u CROSS JOIN range(1, 31) d(day) LEFT JOIN h ON h.user_id = u.user_id AND h.day = d.day), m AS (SELECT *, (NOT hit) AND NOT coalesce(lag(hit, 1) OVER w, true) AND NOT coalesce(lag(hit, 2) OVER w, true) AS third FROM p WINDOW w AS (PARTITION BY user_id ORDER BY day)), s AS (SELECT user_id, min(day) FILTER (WHERE third) AS stop FROM m GROUP BY 1) SELECT m.user_id, count(*) AS probed, count(*) FILTER (WHERE hit) AS hits FROM m JOIN s ON s.user_id = m.user_id WHERE stop IS NULL OR day <= stop GROUP BY 1",
    "config_inherit": "SELECT n_nationkey, 'delay' AS k, n_regionkey::VARCHAR AS v FROM nation UNION ALL SELECT n_nationkey, 'page', n_nationkey::VARCHAR FROM nation",
    "localized_names": "SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'T' || n_name ELSE n_name END AS name FROM nation",
}
