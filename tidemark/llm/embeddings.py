"""Near-duplicate embeddings by NN-descent, with an audit of recall.

Equal vectors are one node with a count.  The neighbour graph starts from random-projection orders: vectors are sorted by the sign
bits of their projections (a range partitioning, so a crowded region is cut like any other) and compared within windows of
neighbours in that order.  Then lists are refined through neighbours of neighbours: every node is a pivot at which
those that list it and those that it lists meet and are compared; a pivot that very many list is met in random parts of bounded size.
Rounds end when no list improves.  Lists hold the K best above FLOOR: two vectors linked to a third at 0.95 are 0.8 alike at least, so
less alike ones lead nowhere.

A list whose K entries are all links is saturated: links that lead out of a tight cluster may have been cut from it.  So saturated
nodes are sorted in new random orders, where runs of one component are thinned to THIN, and compared across components within windows;
what links is one component, and rounds go on until none are joined.  A saturated list is then enlarged to its whole component, in pairs
of blocks of bounded size that are counted, not listed.  An audit compares a fixed number of vectors with all others by brute force; while recall of
their links is below TARGET, twice as many more orders are added each time; a recall that stays below it is an error, never a silent result.

Similarity is the cosine in double precision.  Cases: vectors that are null, empty, zero, or hold null or non-finite components
link with nothing; vectors of different lengths do not link; repeated rows are copies of each other; a null vec_id is reported as null and never names a
component; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .graphs import components, cut, grouped_by

K, FLOOR, WINDOW, ORDERS, ROUNDS = 16, 0.7, 256, 12, 6
AUDIT, TARGET, AUDITS, PART, BLOCK = 256, 0.995, 6, 128, 512
THIN = 32
GRAPH = "u long, ids binary, sims binary"


def _unit(blobs: list[bytes]) -> np.ndarray:
    """Unit vectors in double precision of vectors of one length; scaled first, so that no square overflows."""
    x = np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _best(nodes: np.ndarray, x: np.ndarray) -> list[tuple[int, bytes, bytes]]:
    """Of each node its K best others in a group of vectors of one length, above the floor."""
    s = x @ x.T
    np.fill_diagonal(s, -2)
    out = []
    for i in np.flatnonzero(s.max(1) >= FLOOR).tolist():
        near = np.flatnonzero(s[i] >= FLOOR)
        if len(near) > K:
            near = near[np.argpartition(-s[i, near], K)[:K]]
        out.append((int(nodes[i]), nodes[near].tobytes(), s[i, near].tobytes()))
    return out


def _graph_rows(found: list[tuple]) -> pa.RecordBatch:
    u, ids, sims = zip(*found, strict=True) if found else ((), (), ())
    return pa.record_batch({"u": pa.array(u, pa.int64()), "ids": pa.array(ids, pa.binary()), "sims": pa.array(sims, pa.binary())})


def _packed(batches) -> Iterator[pa.RecordBatch]:
    """(node, copies, array) to (node, copies, dim, vec)."""
    for batch in batches:
        rows = [np.asarray(v, np.float64) for v in batch.column(2).to_pylist()]
        yield pa.record_batch(
            {
                "node": batch.column(0),
                "copies": batch.column(1),
                "dim": pa.array([len(v) for v in rows], pa.int32()),
                "vec": pa.array([v.tobytes() for v in rows], pa.binary()),
            }
        )


def _orders(first: int, orders: int, bits: int):
    def run(batches):
        for batch in batches:
            node, dim, vec = (batch.column(n).to_pylist() for n in ("node", "dim", "vec"))
            for d in sorted(set(dim)):
                at = [i for i, x in enumerate(dim) if x == d]
                x = _unit([vec[i] for i in at])
                for order in range(first, first + orders):
                    p = x @ np.random.default_rng([order, d]).normal(size=(d, bits + 1))
                    code = (p[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64))
                    yield pa.record_batch(
                        {
                            "o": pa.array([order * 100_000 + d] * len(at), pa.int64()),
                            "code": pa.array(code, pa.int64()),
                            "along": pa.array(p[:, bits]),
                            "node": pa.array([node[i] for i in at], pa.int64()),
                            "vec": pa.array([vec[i] for i in at], pa.binary()),
                        }
                    )

    return run


def _windows(batches):
    """Sorted rows to the best neighbours within windows that overlap by half."""
    held: list[tuple[int, int, bytes]] = []

    def compared(rows: list) -> pa.RecordBatch:
        return _graph_rows(_best(np.array([r[1] for r in rows], np.int64), _unit([r[2] for r in rows])))

    for batch in batches:
        for row in zip(batch.column("o").to_pylist(), batch.column("node").to_pylist(), batch.column("vec").to_pylist(), strict=True):
            if held and held[-1][0] != row[0]:
                yield compared(held)
                held = []
            held.append(row)
            if len(held) == WINDOW:
                yield compared(held)
                held = held[WINDOW // 2 :]
    if held:
        yield compared(held)


def _thinned(rows) -> Iterator[tuple]:
    """Rows (order, root, ...) without the middle of long runs of one root."""
    at, n, tail = None, 0, deque(maxlen=THIN // 2)
    for row in rows:
        if row[:2] != at:
            yield from tail
            at, n = row[:2], 0
            tail.clear()
        n += 1
        if n <= THIN // 2:
            yield row
        else:
            tail.append(row)
    yield from tail


def _across(threshold: float):
    """Sorted (o, root, node, vec) to a link for each two components that have one within a window."""

    def compared(rows: list) -> pa.RecordBatch:
        node, root = (np.array([r[i] for r in rows], np.int64) for i in (2, 1))
        x = _unit([r[3] for r in rows])
        i, j = np.nonzero(np.triu(x @ x.T >= threshold, 1) & (root[:, None] != root))
        both = np.sort(np.stack([root[i], root[j]], 1), 1)
        first = np.unique(both, axis=0, return_index=True)[1]
        return pa.record_batch({"u": pa.array(node[i[first]], pa.int64()), "v": pa.array(node[j[first]], pa.int64())})

    def run(batches):
        held: list[tuple] = []
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("o", "root", "node", "vec")), strict=True))
        for row in _thinned(rows):
            if held and held[-1][0] != row[0]:
                yield compared(held)
                held = []
            held.append(row)
            if len(held) == WINDOW:
                yield compared(held)
                held = held[WINDOW // 2 :]
        if held:
            yield compared(held)

    return run


def _joined(links: DataFrame, full: DataFrame, nodes: DataFrame, threshold: float, first: int) -> DataFrame:
    """Components of the links and of those across components of saturated nodes; orders are numbered from ``first``."""
    roots, own = components(links), cut(nodes.join(full, nodes["node"] == full["u"], "left_semi"))
    size = own.count()
    while True:
        kinds = roots.join(own.select("node"), "node", "left_semi").select("root").distinct().count()
        if kinds < 2:
            return roots
        bits = max(1, int(np.ceil(np.log2(min(size, kinds * THIN) / WINDOW))) + 1)
        dealt = own.mapInArrow(_orders(first, ORDERS, bits), "o long, code long, along double, node long, vec binary").join(roots, "node")
        dealt = dealt.repartitionByRange("o", "code", "along").sortWithinPartitions("o", "code", "along", "node")
        found = cut(dealt.mapInArrow(_across(threshold), "u long, v long").distinct())
        if found.isEmpty():
            return roots
        links, first = links.union(found), first + ORDERS
        roots = components(links)


def _merged(batches):
    """(u, lists) to each node's K best of all its lists."""
    for batch in batches:
        out = []
        for u, lists in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = np.concatenate([np.frombuffer(x["ids"], np.int64) for x in lists])
            sims = np.concatenate([np.frombuffer(x["sims"], np.float64) for x in lists])
            ids, at = np.unique(ids, return_index=True)
            order = np.lexsort((ids, -sims[at]))[:K]
            out.append((u, ids[order].tobytes(), sims[at][order].tobytes()))
        yield _graph_rows(out)


def _merge(found: DataFrame) -> DataFrame:
    return cut(found.groupBy("u").agg(F.collect_list(F.struct("ids", "sims")).alias("lists")).mapInArrow(_merged, GRAPH))


def _edges(batches):
    for batch in batches:
        ids = [np.frombuffer(x, np.int64) for x in batch.column("ids").to_pylist()]
        sims = [np.frombuffer(x, np.float64) for x in batch.column("sims").to_pylist()]
        n = [len(x) for x in ids]
        u = np.repeat(batch.column("u").to_numpy(zero_copy_only=False).astype(np.int64), n)
        empty = [np.zeros(0)]
        yield pa.record_batch(
            {
                "u": pa.array(u, pa.int64()),
                "v": pa.array(np.concatenate(ids or [np.zeros(0, np.int64)]), pa.int64()),
                "s": pa.array(np.concatenate(sims or empty), pa.float64()),
                "n": pa.array(np.repeat(np.array([(s >= 0.0).sum() for s in sims], np.int64), n), pa.int64()),
            }
        )


def _met(batches):
    """Members of a pivot's part: each one's best among the others."""
    out = []
    for _, rows in grouped_by(batches, 2):
        if len(rows) > 1:
            out += _best(np.array([r[0] for r in rows], np.int64), _unit([r[1] for r in rows]))
        if len(out) > 5000:
            yield _graph_rows(out)
            out = []
    if out:
        yield _graph_rows(out)


def _counted(threshold: float):
    """Of a pair of blocks of one component: how many copies each node of either is linked with in the other."""

    def run(batches):
        for (_, a, b), rows in grouped_by(batches, 3):
            side = {k: [r for r in rows if r[0] == k] for k in {a, b}}
            x = {k: _unit([r[3] for r in v]) for k, v in side.items() if v}
            if a not in x or b not in x:
                continue
            near = x[a] @ x[b].T >= threshold
            weight = {k: np.array([r[2] for r in side[k]], np.int64) for k in x}
            sums = [([r[1] for r in side[a]], near @ weight[b])]
            sums += [([r[1] for r in side[b]], near.T @ weight[a])] if a != b else []
            for nodes, n in sums:
                yield pa.record_batch({"node": pa.array(nodes, pa.int64()), "near": pa.array(n, pa.int64())})

    return run


def _audited(sample: list[tuple[int, int, bytes]], threshold: float):
    def run(batches):
        for batch in batches:
            node, dim, vec = (batch.column(n).to_pylist() for n in ("node", "dim", "vec"))
            for d in sorted(set(dim) & {s[1] for s in sample}):
                own = [s for s in sample if s[1] == d]
                at = [i for i, x in enumerate(dim) if x == d]
                near = _unit([s[2] for s in own]) @ _unit([vec[i] for i in at]).T >= threshold
                i, j = np.nonzero(near)
                pairs = [(own[a][0], node[at[b]]) for a, b in zip(i.tolist(), j.tolist(), strict=True) if own[a][0] != node[at[b]]]
                yield pa.record_batch({"u": pa.array([p[0] for p in pairs], pa.int64()), "v": pa.array([p[1] for p in pairs], pa.int64())})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, log=None) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``; ``log`` gets (audit, recall) of each audit."""
    if threshold < FLOOR:
        raise ValueError(f"threshold below {FLOOR}")
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    fit = F.coalesce(F.forall("embedding", number) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    vectors = vectors.withColumn("key", F.when(fit, F.sha2(F.array_join("embedding", ",").cast("binary"), 256)))
    classes = vectors.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding")
    )
    # A class is named by a hash of its vector; its smallest vec_id may be null or stand in another class too.
    classes = classes.withColumn("node", F.xxhash64("key"))
    nodes = cut(classes.select("node", "copies", "embedding").mapInArrow(_packed, "node long, copies long, dim int, vec binary"))
    names = cut(classes.select("node", "low", "copies", "key"))
    n = nodes.count()
    bits = max(1, int(np.ceil(np.log2(max(2, n) / WINDOW))) + 1)
    sample = [tuple(r) for r in nodes.orderBy(F.hash("node"), "node").limit(AUDIT).select("node", "dim", "vec").collect()]
    truth = cut(nodes.mapInArrow(_audited(sample, threshold), "u long, v long"))
    true_links = truth.count()
    graph, audit = None, 0
    while True:
        dealt = nodes.mapInArrow(_orders(ORDERS * (2**audit - 1), ORDERS * 2**audit, bits), "o long, code long, along double, node long, vec binary")
        dealt = dealt.repartitionByRange("o", "code", "along").sortWithinPartitions("o", "code", "along", "node")
        found = dealt.mapInArrow(_windows, GRAPH)
        graph = _merge(found if graph is None else found.union(graph))
        graph = _descended(graph, nodes)
        edges = cut(graph.mapInArrow(_edges, "u long, v long, s double, n long").where(F.col("s") >= threshold))
        full = cut(edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= K).select("u"))
        # Orders of its own for each audit: the graph's are numbered from 0.
        roots = _joined(edges.select("u", "v"), full, nodes, threshold, (audit + 1) * 10_000)
        crowded = cut(roots.join(full, roots["node"] == full["u"], "left_semi").select("root").distinct())
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
        hit = truth.join(both, ["u", "v"], "left_semi")
        inside = truth.join(roots.toDF("u", "ru"), "u").join(roots.toDF("v", "rv"), "v").where("ru = rv")
        inside = inside.join(crowded, inside["ru"] == crowded["root"], "left_semi").select("u", "v")
        recall = hit.union(inside).distinct().count() / true_links if true_links else 1.0
        if log is not None:
            log.append((audit, recall))
        audit += 1
        if recall >= TARGET or audit >= AUDITS:
            break
    if recall < TARGET:
        raise RuntimeError(f"recall of links is {recall:.4f} after {audit} audits, below {TARGET}: raise ORDERS or AUDITS")
    copies = names.select(F.col("node").alias("v"), "copies")
    plain = both.join(copies, "v").groupBy(F.col("u").alias("node")).agg(F.sum("copies").alias("near"))
    member = roots.join(crowded, "root", "left_semi")
    sizes = member.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    member = member.join(sizes, "root").join(nodes, "node").withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
    member = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = member.select("root", "dim", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "node", "copies", "vec")
    pair = pair.withColumn("root", F.xxhash64("root", "dim")).drop("dim").repartition("root", "a", "b").sortWithinPartitions("root", "a", "b")
    counted = pair.mapInArrow(_counted(threshold), "node long, near long").groupBy("node").agg(F.sum("near").alias("all"))
    low = names.join(roots, "node").groupBy("root").agg(F.min("low").alias("component"))
    done = names.join(roots, "node", "left").join(low, "root", "left").join(plain, "node", "left").join(counted, "node", "left")
    # Within blocks a node meets itself too.
    links = F.coalesce(F.col("all") - 1, F.coalesce("near", F.lit(0)) + F.col("copies") - 1).cast("long")
    done = done.select("key", links.alias("n_links"), F.coalesce("component", "low").alias("component"))
    out = vectors.select("vec_id", "key").join(done, "key", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _descended(graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rounds of neighbours of neighbours until no list gets better."""
    state = lambda g: tuple(g.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "ids"))).first())
    vec = nodes.select(F.col("node").alias("member"), "vec", "dim")
    before = state(graph)
    for _ in range(ROUNDS):
        edge = graph.mapInArrow(_edges, "u long, v long, s double, n long").select("u", "v")
        meet = edge.toDF("pivot", "member").union(edge.select(F.col("v").alias("pivot"), F.col("u").alias("member"))).distinct()
        parts = meet.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts"))
        meet = meet.join(parts, "pivot").withColumn("part", F.pmod(F.xxhash64("pivot", "member"), F.col("parts")))
        meet = meet.join(vec, "member").select("pivot", "part", "member", "vec")
        meet = meet.repartition("pivot", "part").sortWithinPartitions("pivot", "part", "member")
        graph = _merge(meet.mapInArrow(_met, GRAPH).union(graph))
        after = state(graph)
        if after == before:
            break
        before = after
    return graph


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP7_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0 AND len(list_filter(embedding, lambda y: y <> 0)) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
      WHERE list_cosine_similarity(a.x, b.x) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT r.a AS vec_id, coalesce(max(n.n), 0)::BIGINT AS n_links, min(r.b)::BIGINT AS component_id, min(r.b) = r.a AS kept
FROM r LEFT JOIN n ON n.a = r.a GROUP BY r.a
"""
