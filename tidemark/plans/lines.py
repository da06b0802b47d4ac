"""Queries over files of JSON lines that are written from the shop's tables, and over graphs and trees of them, with the same in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.documents import value_type
from ..operators import extract, quality, snapshots, traverse, walk
from ..operators.numbering import shared_folder
from ..sources import jsonl
from . import table

_ORDER = ("click_id", "arrived_at", "ts", "kind", "value", "props")


def line_problems(spark, d):
    """What is wrong with clicks written as JSON lines: numbers run through all files, broken properties break their line."""
    c = table(spark, d, "clicks")
    quoted = lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    member = lambda name, value: F.concat(F.lit(f'"{name}": '), value)
    client = F.col("client_id")
    members = [
        F.when(client.isNotNull(), member("url", F.when(F.col("kind") == "error", F.lit('"no url"')).otherwise(F.concat(F.lit('"https://shop.example/c/'), client.cast("string"), F.lit('"'))))),
        member("name", F.coalesce(quoted(F.col("kind")), F.lit("null"))),
        member("discovered_at_utc", F.when(F.col("value").isNull(), F.lit("5")).otherwise(F.coalesce(quoted(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")), F.lit("null")))),
        member("publish_date", F.when(F.col("kind") == "signup", F.lit('"2024-99-99"')).otherwise(F.coalesce(quoted(F.date_format("arrived_at", "yyyy-MM-dd")), F.lit("null")))),
        member("source", F.coalesce(quoted(F.concat(F.lit("s"), (client % 3).cast("string"))), F.lit('" "'))),
        member("meta", F.col("props")),
    ]
    at = f"{shared_folder(spark).rstrip('/')}/lines-{uuid.uuid4().hex}"
    lines = c.orderBy(*_ORDER).select(F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}")).alias("line"))
    lines.write.option("compression", "gzip").text(at)
    return quality.line_issues(jsonl.scan(spark, at, split_bytes=4 << 20, across=True)).select("line_no", "source", "field", "kind", "found")


def discovery_order(spark, d):
    """Parts and vendors as a queue finds them from the smallest part on, along the order of lines, twelve lines of a node at most."""
    l = table(spark, d, "lineitem").select(F.col("l_partkey").alias("p"), (-F.col("l_suppkey")).alias("s"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pos"))
    edges = l.select(F.col("p").alias("src"), F.col("s").alias("dst"), "pos").union(l.select("s", "p", "pos"))
    return traverse.discovered(edges, l.agg(F.min("p").alias("node")).withColumn("pos", F.lit(0)), 3, out_cap=12).select("node", F.col("depth").cast("long").alias("depth"), "ordinal", "via")


_DAYS = list(range(1, 32))


def _month(spark, d):
    c = table(spark, d, "clients").select("source", F.col("client_id").cast("string").alias("url"), "client_id", "name", F.round("balance", 2).alias("balance"))
    days = c.withColumn("day", F.explode(F.array(*[F.lit(i) for i in _DAYS]))).where((F.col("client_id") * 7 + F.col("day")) % 97 != 0)
    changed = F.when(F.col("client_id") % 50 == F.col("day"), F.col("balance") + 1).otherwise(F.col("balance"))
    return snapshots.keyed(days.withColumn("balance", changed).drop("client_id"))


def rebase_month(spark, d):
    """A month's snapshots of the clients as one base and the days' deltas, by one grouping."""
    return snapshots.regrouped(_DAYS, _month(spark, d)).select("kind", F.col("day").cast("long").alias("day"), "source", "url", "balance")


def _vendor_pages(spark, d):
    """A page a nation: a table of its vendors whose cells hold a table each, with text before and after; and the same records for narrow screens."""
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    v = table(spark, d, "vendors").where("nation_id IS NOT NULL AND vendor_id IS NOT NULL").select("nation_id", F.col("vendor_id").alias("id"), F.coalesce(F.trim("name"), F.lit("")).alias("name"))
    i = F.col("id").cast("string")
    wide = F.concat(F.lit("<tr><td>"), "name", F.lit('</td><td>tel <table><tr><td><a href="/v/'), i, F.lit('">'), i, F.lit("</a></td><td>fax</td></tr></table> ext "), (F.col("id") % 7).cast("string"), F.lit("</td></tr>"))
    narrow = F.concat(F.lit("<tr><th>Name</th><td>"), "name", F.lit("</td></tr><tr><th>Call</th><td>tel ext "), (F.col("id") % 7).cast("string"), F.lit("</td></tr>"))
    rows = v.groupBy("nation_id").agg(F.array_sort(F.collect_list(F.struct("id", wide.alias("wide"), narrow.alias("narrow")))).alias("x"))
    joined = lambda f: F.array_join(F.transform("x", lambda y: y[f]), "")
    html = F.concat(F.lit("<h2>"), "n_name", F.lit("</h2><table><tr><th>Name</th><th>Call</th></tr>"), joined("wide"), F.lit("</table><table>"), joined("narrow"), F.lit("</table>"))
    return rows.join(n, F.col("nation_id") == F.col("n_nationkey")).select(F.col("nation_id").alias("page"), html.alias("html"))


def nested_tables(spark, d):
    cells = extract.html_tables(_vendor_pages(spark, d))
    return cells.where("not head AND (parent IS NOT NULL OR table_no = 0)").select("page", "table_no", "parent", "heading", "row", "col", "text", "href")


def paired_tables(spark, d):
    """Records of the wide and of the narrow table of a page, each once, with the number of tables that hold it."""
    records = extract.table_records(extract.html_tables(_vendor_pages(spark, d)).where("parent IS NULL"), ["page"])
    return extract.one_of_each(records, ["page"]).select("page", F.col("fields")["name"].alias("name"), F.col("fields")["call"].alias("call"), "tables", "table_no")


def item_paths(spark, d):
    """Items as the leaves of a tree of kinds and brands, a tree for each size, with the path to each."""
    i = table(spark, d, "items").select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("kind", "brand", "name")], "size", "item_id").where("item_id IS NOT NULL")
    level = lambda depth, text, *place: i.select("size", F.struct(F.col("kind").alias("a"), (place[0] if place else F.lit(None).cast("string")).alias("b"), (place[1] if place[1:] else F.lit(None).cast("long")).alias("c")).alias("pos"), F.lit(depth).alias("depth"), text.alias("text"), (place[1] if place[1:] else F.lit(None).cast("long")).alias("item_id"))
    tree = level(1, F.col("kind")).distinct().union(level(2, F.col("brand"), F.col("brand")).distinct()).union(level(3, F.col("name"), F.col("brand"), F.col("item_id")))
    return extract.tree_paths(tree, ["size"]).where("depth = 3").select("size", "item_id", F.array_join("path", " > ").alias("path"))


def json_nodes(spark, d):
    """What the clicks' properties hold at each place, by type: how many nodes, and how many of them hold a device."""
    c = table(spark, d, "clicks").select("click_id", "props")
    n = walk.nodes(c, ["click_id"], "props").withColumns({"place": F.regexp_replace("path", r"\[\d+\]", "[]"), "kind": F.coalesce(value_type(F.col("node")), F.lit("null"))})
    return n.groupBy("place", "kind").agg(F.count(F.lit(1)).alias("n"), F.count_if(walk.holds_object(F.col("node"), "device")).alias("with_device"))


QUERIES = {f.__name__: f for f in (line_problems, discovery_order, rebase_month, nested_tables, paired_tables, item_paths, json_nodes)}

_DISCOVERY = """WITH l AS (SELECT l_partkey AS p, -l_suppkey AS s, l_orderkey * 8 + l_linenumber AS pos FROM lineitem),
        a AS (SELECT p AS src, s AS dst, pos FROM l UNION ALL SELECT s, p, pos FROM l),
        e AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY pos, dst) AS k FROM a) WHERE k <= 12),
        d0 AS (SELECT min(p) AS node, 0 AS depth, 0 AS ordinal, NULL::BIGINT AS via FROM l)"""
for _i in range(1, 4):
    _DISCOVERY += f""",
        c{_i} AS (SELECT dst AS node, min(row(ordinal, pos)) AS place, arg_min(src, row(ordinal, pos)) AS via FROM d{_i - 1} JOIN e ON src = node WHERE depth = {_i - 1} AND dst NOT IN (SELECT node FROM d{_i - 1}) GROUP BY 1),
        d{_i} AS (SELECT * FROM d{_i - 1} UNION ALL SELECT node, {_i}, (SELECT count(*) FROM d{_i - 1}) + row_number() OVER (ORDER BY place, node) - 1, via FROM c{_i})"""
_DISCOVERY += " SELECT node, depth::BIGINT AS depth, ordinal::BIGINT AS ordinal, via FROM d3"

ORACLES = {
    "line_problems": """WITH c AS (SELECT *, row_number() OVER (ORDER BY click_id NULLS FIRST, arrived_at NULLS FIRST, ts NULLS FIRST, kind NULLS FIRST, value NULLS FIRST, props NULLS FIRST) AS line_no,
          props IS NOT NULL AND NOT json_valid(props) AS broken, CASE WHEN client_id IS NULL THEN '(missing)' ELSE 's' || client_id % 3 END AS source FROM clicks),
        g AS (SELECT * FROM c WHERE NOT broken)
        SELECT line_no, '(parse_error)' AS source, 'record' AS field, 'parse_error' AS kind, 'no JSON' AS found FROM c WHERE broken
        UNION ALL SELECT line_no, source, 'url', 'missing_required_field', NULL FROM g WHERE client_id IS NULL
        UNION ALL SELECT line_no, source, 'url', 'invalid_url_format', 'no url' FROM g WHERE client_id IS NOT NULL AND kind = 'error'
        UNION ALL SELECT line_no, source, 'name', 'null_required_field', NULL FROM g WHERE kind IS NULL
        UNION ALL SELECT line_no, source, 'discovered_at_utc', CASE WHEN value IS NULL THEN 'invalid_required_type_or_empty' ELSE 'null_required_field' END, CASE WHEN value IS NULL THEN 'int' END FROM g WHERE value IS NULL OR ts IS NULL
        UNION ALL SELECT line_no, source, 'publish_date', 'invalid_publish_date_format', '2024-99-99' FROM g WHERE kind = 'signup'
        UNION ALL SELECT line_no, source, 'source', 'invalid_required_type_or_empty', 'str' FROM g WHERE client_id IS NULL
        UNION ALL SELECT line_no, source, 'meta', 'missing_required_field', NULL FROM g WHERE props IS NULL
        UNION ALL SELECT line_no, source, 'meta.discovered_from', 'missing_required_field', NULL FROM g WHERE props IS NOT NULL""",
    "discovery_order": _DISCOVERY,
    "rebase_month": """WITH s AS (SELECT trim(source) AS source, client_id::VARCHAR AS url, name, round(balance, 2) + CASE WHEN client_id % 50 = day THEN 1 ELSE 0 END AS balance, day
          FROM clients, range(1, 32) r(day) WHERE (client_id * 7 + day) % 97 <> 0 AND trim(source) <> '' AND client_id IS NOT NULL),
        k AS (SELECT source, url, count(*) = 31 AND count(DISTINCT coalesce(balance::VARCHAR, '-') || '|' || coalesce(name, '')) = 1 AS shared FROM s GROUP BY 1, 2)
        SELECT CASE WHEN shared THEN 'base' ELSE 'added' END AS kind, CASE WHEN NOT shared THEN day END AS day, source, url, balance FROM s JOIN k USING (source, url) WHERE NOT shared OR day = 1""",
    "nested_tables": r"""WITH v AS (SELECT nation_id AS page, vendor_id AS id, trim(regexp_replace(coalesce(name, ''), '\s+', ' ', 'g')) AS name, n_name AS heading, row_number() OVER (PARTITION BY nation_id ORDER BY vendor_id) AS i FROM vendors JOIN nation ON nation_id = n_nationkey WHERE vendor_id IS NOT NULL)
        SELECT page, 0 AS table_no, NULL::INT AS parent, heading, i::INT AS row, 0 AS col, name AS text, NULL AS href FROM v
        UNION ALL SELECT page, 0, NULL, heading, i::INT, 1, 'tel ext ' || id % 7, NULL FROM v
        UNION ALL SELECT page, i::INT, 0, heading, 0, 0, id::VARCHAR, '/v/' || id FROM v
        UNION ALL SELECT page, i::INT, 0, heading, 0, 1, 'fax', NULL FROM v""",
    "paired_tables": r"""SELECT nation_id AS page, nullif(trim(regexp_replace(name, '\s+', ' ', 'g')), '') AS name, 'tel ext ' || vendor_id % 7 AS call, 2::BIGINT AS tables, 0 AS table_no
        FROM vendors JOIN nation ON nation_id = n_nationkey WHERE vendor_id IS NOT NULL GROUP BY ALL""",
    "item_paths": """SELECT size, item_id, array_to_string([x for x in [kind, brand, name] if coalesce(x, '') <> ''], ' > ') AS path FROM items WHERE item_id IS NOT NULL""",
    "json_nodes": r"""WITH c AS (SELECT props FROM clicks WHERE props IS NOT NULL AND json_valid(props)), n AS (SELECT regexp_replace(t.fullkey, '\[\d+\]', '[]', 'g') AS place, t.type, t.value FROM c, json_tree(c.props) t)
        SELECT place, CASE type WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'str' WHEN 'DOUBLE' THEN 'float' WHEN 'BOOLEAN' THEN 'bool' WHEN 'NULL' THEN 'null' ELSE 'int' END AS kind,
        count(*) AS n, count(*) FILTER (WHERE type = 'OBJECT' AND json_type(value, '$.device') = 'OBJECT') AS with_device FROM n GROUP BY 1, 2""",
}
