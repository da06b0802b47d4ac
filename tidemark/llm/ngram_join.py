"""Similarity self-join of documents on sets of word shingles by PartEnum signatures.

A document's set is its distinct n-word shingles, as 64-bit hashes.  Two sets with Jaccard similarity of at least t differ in
at most k = (1 - t) / (1 + t) * (|A| + |B|) features.  Sizes are cut into bands; at the level of a band with largest
size h, k = 2h(1 - t) / (1 + t) holds for each linked pair whose larger set is in it.  A set takes part at the level of
its own band, and at the next one if a set that large can still be similar.

At a level the feature domain is cut into n1 parts and each part into n2; of n1 = k // 2 + 1 + spare parts, spare + 1 at
least hold one difference at most, and in these one of the n2 subsets that leave out one piece is the same for both
sets.  So each (part, subset) gives a signature, and linked sets share one.  Signatures of no features at all would meet
in a few crowded groups: a set with empty ones in no more than ``spare`` parts leaves them out, since one of the spare + 1
parts is then not among them; only sets with more send them.

Signatures go to buckets as packed arrays.  Of a signature's group only (smallest node, other node) leaves a bucket, each
pair once: a node's *family* is all nodes that follow it in some group, so nodes that share a signature share a family, and a
cluster that shares hundreds of signatures costs no more rows than one that shares a few.  First each
node is compared in one of its families, in parts of bounded size with the family's first node in each; some turns of this, each with another
family whose first node is not yet connected, join most of what is linked.  Then all families stand that still have members of different
components, and only pairs across components count.  Families of a cluster are much the same: each is covered by the smallest
family that holds its first node, and only pairs with a member that is not in this one count.

A comparison has two steps.  Odd sketches are compared in blocks of bounded size: a sketch holds the parity of the number of
features of each of its bits, so two sets differ in at least as many features as their sketches in bits.  Members without
a plausible partner go; the rest, in parts joined by plausible pairs, get their sets, and a task checks pairs of a part
exactly until they are connected, so m members give m - 1 links at most, whatever their number of pairs.  Two sets count as equal by the
upper 48 bits of each shingle's hash.  Equal sets are one node throughout, so copies cost nothing beyond their first pass.
A family of m members that stays open costs m * m / BLOCK rows in the first step and as many comparisons of sketches as it has pairs: texts that
share a passage but are not similar can be such a family.

Texts are never shuffled for the sets: the scan computes those whose document may be asked for, by a bitmap of fixed size.

Cases: null and empty texts have no set and link with nothing; texts of fewer than n words have one shingle, the whole
sequence; equal ids with equal texts are copies; a null id is reported with its group's smallest id, null if the group has none;
an empty table gives an empty result; extra columns are ignored, whatever their names; a text of any length is one set in one
task, and its signatures grow with its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import vectext as vt
from .graphs import components, cut, drop_cut, grouped_by, n_buckets, small_batches, tidy

BAND = 1.35
FLUSH = 400_000
#: Members of a family that are compared at once.
BLOCK = 4096
#: Times that each node is compared in one family of its own before all families are.
TURNS = 2
#: The scan's bitmap of documents whose sets are asked for has 2 ** BITS bits (8 MB).
BITS = 26


@lru_cache(maxsize=None)
def levels(most: int, num: int, den: int) -> tuple[list[int], list[tuple[int, int, int, int]]]:
    """Largest size of each band, and (k, spare, n1, n2) of each level, up to the band of ``most``."""
    ends, plans, low = [], [], 1
    while not ends or ends[-1] < most:
        end = int(low * BAND)
        k = (den - num) * 2 * end // (den + num)
        spare = 0 if k <= 3 else 1 + k // 16
        ends.append(end)
        plans.append((k, spare, k // 2 + 1 + spare, 8 if k <= 1 else 5 if k <= 3 else 3 if k <= 12 else 2))
        low = end + 1
    return ends, plans


def shingle_sets(t: vt.Texts, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    grams = vt.ngrams(t.hashes, n)
    short = [None, *(vt.ngrams(t.hashes, m) for m in range(1, n))]
    for at, words in zip(t.first[:-1].tolist(), t.n_words.tolist(), strict=True):
        if words >= n:
            yield np.unique(grams[at : at + words - n + 1])
        elif words:
            yield vt.mix(short[words][at : at + 1] + vt.U(words))
        else:
            yield np.zeros(0, np.uint64)


def node_of(s: np.ndarray) -> int:
    """A set's own hash, as a signed 64-bit number."""
    return int(vt.mix(np.array([vt.mix(s).sum(dtype=np.uint64) + vt.U(len(s))], np.uint64)).view(np.int64)[0])


@lru_cache(maxsize=1 << 16)
def _own_levels(size: int, num: int, den: int) -> tuple[tuple[int, int, int, int, int], ...]:
    """(level, k, spare, n1, n2) of the levels at which a set of this size takes part."""
    ends, plans = levels(1 << (2 * size + 8).bit_length(), num, den)
    band = int(np.searchsorted(ends, size))
    return tuple((x, *plans[x]) for x in (band, band + 1) if plans[x][0] and (x == band or size * den // num > ends[band]))


def signatures(s: np.ndarray, num: int, den: int) -> np.ndarray:
    """All PartEnum signatures of a sorted set of hashes."""
    out = []
    scrambled = np.zeros(len(s) + 1, np.uint64)
    np.cumsum(vt.mix(s ^ vt.U(0x5851F42D4C957F2D)), out=scrambled[1:])
    top = (s >> vt.U(32)).astype(np.int64)
    for level, _, spare, n1, n2 in _own_levels(len(s), num, den):
        edges = -(-(np.arange(n1 * n2 + 1, dtype=np.int64) << 32) // (n1 * n2))
        cuts = np.searchsorted(top, edges)
        sums = (scrambled[cuts[1:]] - scrambled[cuts[:-1]]).reshape(n1, n2)
        count = np.diff(cuts).reshape(n1, n2)
        sums = sums.sum(1, dtype=np.uint64)[:, None] - sums
        filled = count.sum(1)[:, None] - count > 0
        keys = vt.mix(sums + vt.U((level + 1) * 0xA24BAED4963EE407 % 2**64)) + np.arange(1, n1 * n2 + 1, dtype=np.uint64).reshape(n1, n2)
        if (~filled).any(1).sum() <= spare:
            keys = keys[filled]
        out.append(vt.mix(keys.ravel()))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def sketch(s: np.ndarray) -> bytes:
    """Odd sketch of a set: of at least twice as many bits as it has features, 128 at least."""
    bits = 128 << max(0, int(len(s) - 1).bit_length() - 6)
    place = (vt.mix((s >> vt.U(16)) ^ vt.U(0x632BE59BD9B4E019)) & vt.U(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of equal length: a longer one is folded onto itself, which leaves a sketch of fewer bits."""
    size = min(map(len, sketches))
    if all(len(x) == size for x in sketches):
        return np.frombuffer(b"".join(sketches), np.uint64).reshape(len(sketches), -1)
    out = []
    for x in sketches:
        x = np.frombuffer(x, np.uint64)
        while len(x) * 8 > size:
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        out.append(x)
    return np.stack(out)


def _sets_pass(n: int, num: int, den: int):
    def run(batches):
        for batch in batches:
            for part in vt.pieces(batch):
                sets = list(shingle_sets(vt.texts(part, lower=True), n))
                yield pa.record_batch(
                    {
                        "doc_id": part.column(0).cast(pa.int64()),
                        "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                        "n_signatures": pa.array([sum(x[3] * x[4] for x in _own_levels(len(s), num, den)) if len(s) else 0 for s in sets], pa.int64()),
                        "node": pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                        "sketch": pa.array([sketch(s) if len(s) else None for s in sets], pa.binary()),
                    }
                )

    return vt.lean(run)


def _with_node(n: int):
    """Rows with their set's node added."""

    def run(batches):
        for batch in batches:
            for part in vt.pieces(batch):
                nodes = [node_of(s) if len(s) else None for s in shingle_sets(vt.texts(part, lower=True), n)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(nodes, pa.int64())], [*part.schema.names, "_nj_node"])

    return vt.lean(run)


def _noded(docs: DataFrame, n: int) -> DataFrame:
    schema = StructType([StructField(f.name, f.dataType) for f in docs.schema] + [StructField("_nj_node", LongType())])
    return docs.mapInArrow(_with_node(n), schema)


def _signature_pass(n: int, num: int, den: int, buckets: int):
    """(key, text) to packed signatures by bucket."""

    def packed(held: list) -> Iterator[pa.RecordBatch]:
        sig = np.concatenate([x[0] for x in held])
        node = np.repeat(np.array([x[1] for x in held], np.int64), [len(x[0]) for x in held])
        bucket = (sig >> vt.U(32)).astype(np.int64) * buckets >> 32
        order = np.argsort(bucket, kind="stable")
        at = np.searchsorted(bucket[order], np.arange(buckets + 1))
        sig, node = sig[order].astype(np.uint32), node[order]
        full = np.flatnonzero(np.diff(at)).tolist()
        yield pa.record_batch(
            {
                "bucket": pa.array(full, pa.int32()),
                "sigs": pa.array([sig[at[b] : at[b + 1]].tobytes() for b in full], pa.binary()),
                "nodes": pa.array([node[at[b] : at[b + 1]].tobytes() for b in full], pa.binary()),
            }
        )

    def run(batches):
        held, size, seen = [], 0, set()
        for batch in batches:
            for part in vt.pieces(batch):
                for s in shingle_sets(vt.texts(part, lower=True), n):
                    if len(s) and (node := node_of(s)) not in seen:
                        seen.add(node)
                        if len(x := signatures(s, num, den)):
                            held.append((x, node))
                            size += len(x)
                if size >= FLUSH:
                    yield from packed(held)
                    held, size, seen = [], 0, set()
        if held:
            yield from packed(held)

    return vt.lean(run)


def _marked(batch: pa.RecordBatch, bitmap) -> pa.RecordBatch:
    """Rows whose key, the first column, is in the bitmap."""
    bits = bitmap.value
    key = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) >> vt.U(64 - BITS)
    return batch.filter(pa.array((bits[(key >> vt.U(6)).astype(np.int64)] >> (key & vt.U(63)) & vt.U(1)).astype(bool)))


def _candidates_of_bucket(batches):
    """Rows sorted by bucket to (u, v): the smallest node of each signature's group with each other node, once a bucket.

    Within a bucket the lower 32 bits stand for a signature: a chance meeting costs one comparison."""

    def found(sigs: list, nodes: list) -> pa.RecordBatch:
        sig, node = np.frombuffer(b"".join(sigs), np.uint32), np.frombuffer(b"".join(nodes), np.int64)
        order = np.argsort(sig, kind="stable")
        sig, node = sig[order], node[order]
        same = sig[1:] == sig[:-1]
        often = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        sig, node = sig[often], node[often]
        order = np.lexsort((node, sig))
        sig, node = sig[order], node[order]
        new = np.ones(len(sig), bool)
        new[1:] = sig[1:] != sig[:-1]
        u = node[np.flatnonzero(new)][np.cumsum(new) - 1]
        u, v = u[u != node], node[u != node]
        order = np.lexsort((v, u))
        u, v = u[order], v[order]
        new = np.ones(len(u), bool)
        new[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
        return pa.record_batch({"u": pa.array(u[new]), "v": pa.array(v[new])})

    for _, rows in grouped_by(batches, 1):
        yield found([r[0] for r in rows], [r[1] for r in rows])


class _Parts:
    """Labels of things that are joined by and by."""

    def __init__(self, labels: list[int]):
        self.labels = np.unique(np.array(labels, np.int64), return_inverse=True)[1]

    def join(self, i: int, j: int) -> None:
        self.labels[self.labels == self.labels[j]] = self.labels[i]


def _fitting(i: int, at: np.ndarray, sketches: np.ndarray, sizes: np.ndarray, num: int, den: int) -> np.ndarray:
    """Those of ``at`` whose sizes and sketches allow a link with i."""
    least, most = np.minimum(sizes[i], sizes[at]), np.maximum(sizes[i], sizes[at])
    at = at[least * den >= most * num]
    return at[np.bitwise_count(sketches[i] ^ sketches[at]).sum(1, dtype=np.int64) * (den + num) <= (den - num) * (sizes[i] + sizes[at])] if len(at) else at


PART = "part long, sides int, side int, fresh int, node long, key long, root long"


def _plausible(num: int, den: int):
    """Members of pairs of blocks of one family to those with a plausible partner of another component, and the part that plausible pairs join them to."""

    def run(batches):
        out, known = [], set()

        def batch_of() -> pa.RecordBatch:
            names = ["part", "sides", "side", "fresh", "node", "key", "root"]
            return pa.record_batch([pa.array(c, pa.int32() if k in ("sides", "side", "fresh") else pa.int64()) for k, c in zip(names, zip(*out, strict=True), strict=True)], names)

        for (_, a, b), rows in grouped_by(batches, 3):
            # block, fresh, node, key, root, size, sketch
            if len(rows) < 2 or a != b and len({r[0] for r in rows}) < 2:
                continue
            side, fresh, node, root, size = (np.array([r[i] for r in rows], np.int64) for i in (0, 1, 2, 4, 5))
            marks, parts = folded([r[6] for r in rows]), _Parts(list(range(len(rows))))
            partnered = np.zeros(len(rows), bool)
            for i in range(1, len(rows)):
                at = np.flatnonzero((root[:i] != root[i]) & (fresh[:i] | fresh[i] > 0) & ((side[:i] != side[i]) if a != b else True))
                at = _fitting(i, at, marks, size, num, den)
                if len(at):
                    partnered[i] = True
                    partnered[at] = True
                    for label in np.unique(parts.labels[at]).tolist():
                        parts.labels[parts.labels == label] = parts.labels[i]
            at = np.flatnonzero(partnered)
            # Families that overlap have the same parts again and again: a part's name is its members.
            name = vt.mix(node.view(np.uint64) + (2 * side * (a != b) + fresh).astype(np.uint64) * vt.U(0x9E3779B97F4A7C15))
            for label in np.unique(parts.labels[at]).tolist():
                own = at[parts.labels[at] == label]
                part = int(vt.mix(np.array([name[own].sum(dtype=np.uint64)], np.uint64)).view(np.int64)[0])
                if part not in known:
                    known.add(part)
                    out += [(part, int(a != b), int(side[i]), *rows[i][1:5]) for i in own.tolist()]
            if len(out) > 100_000:
                yield batch_of()
                out, known = [], set()
        if out:
            yield batch_of()

    return vt.lean(run)


def _features(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // 6, 8), np.uint8)
    wide[:, 2:] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return wide.view(np.uint64).ravel()


def _sets_of_marked(n: int, bitmap):
    """(key, text) to (key, node, features) of the rows whose key is in the bitmap; features: the upper 48 bits of each hash."""

    def run(batches):
        for batch in batches:
            for part in vt.pieces(_marked(batch, bitmap)):
                sets = [(k, s) for k, s in zip(part.column(0).to_pylist(), shingle_sets(vt.texts(part, lower=True), n), strict=True) if len(s)]
                yield pa.record_batch(
                    {
                        "key": pa.array([k for k, _ in sets], pa.int64()),
                        "node": pa.array([node_of(s) for _, s in sets], pa.int64()),
                        "features": pa.array([s.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes() for _, s in sets], pa.binary()),
                    }
                )

    return vt.lean(run)


def _bitmap(wanted: DataFrame):
    """The top BITS bits of the keys as a broadcast bitmap; 2 ** (BITS - 6) words reach the driver at most."""
    place = F.shiftrightunsigned("key", 64 - BITS)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - BITS}) & 63 as int))")
    with tidy(wanted.sparkSession):
        words = wanted.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(1 << (BITS - 6), np.uint64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return wanted.sparkSession.sparkContext.broadcast(bits)


def _verified(num: int, den: int):
    """Members of parts with their sets to exact links (u, v) between components (x, y), as many as connect them."""

    def run(batches):
        for (_, sides), rows in grouped_by(batches, 2):
            # side, fresh, node, root, features
            rows = list({r[2]: r for r in rows}.values())
            if len(rows) < 2:
                continue
            sets, side, fresh = [_features(r[4]) for r in rows], np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
            size, marks = np.array([len(s) for s in sets], np.int64), folded([sketch(s) for s in sets])
            parts, out = _Parts([r[3] for r in rows]), []
            for i in range(1, len(rows)):
                at = np.flatnonzero((parts.labels[:i] != parts.labels[i]) & (fresh[:i] | fresh[i] > 0) & ((side[:i] != side[i]) if sides else True))
                for j in _fitting(i, at, marks, size, num, den).tolist():
                    if parts.labels[i] != parts.labels[j]:
                        both = np.sort(np.concatenate([sets[i], sets[j]]))
                        common = int((both[1:] == both[:-1]).sum())
                        if den * common >= num * (len(both) - common):
                            parts.join(i, j)
                            out.append((rows[i][2], rows[j][2], rows[i][3], rows[j][3]))
            if out:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["u", "v", "x", "y"])

    return vt.lean(run)


def _linked(families: DataFrame, nodes: DataFrame, docs: DataFrame, n: int, num: int, den: int, stars: bool) -> DataFrame:
    """Exact links between components (root) within families (family, node, fresh, root): (u, v) between nodes, (x, y) between their roots.
    Pairs without a fresh member are left to another family.  With ``stars`` a family's parts are compared with its first node and within themselves, else with each other too."""
    blocks = F.ceil(F.count(F.lit(1)) / BLOCK).cast("int")
    open_ = cut(families.groupBy("family").agg(blocks.alias("blocks"), F.min("root").alias("x"), F.max("root").alias("y"), F.max("fresh").alias("z")).where("x < y and z > 0").select("family", "blocks"))
    rows = families.join(open_, "family").join(nodes.select("node", "key", "size", "sketch"), "node")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    rows = rows.withColumn("other", F.explode(F.when(F.col("family") == F.col("node"), every).otherwise(F.array("block")) if stars else every))
    rows = rows.withColumn("block", F.col("other")) if stars else rows
    rows = rows.select("family", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "fresh", "node", "key", "root", "size", "sketch")
    members = cut(rows.repartition("family", "a", "b").sortWithinPartitions("family", "a", "b", "node").mapInArrow(_plausible(num, den), PART).distinct())
    bitmap = _bitmap(members.select("key").distinct())
    sets = docs.mapInArrow(_sets_of_marked(n, bitmap), "key long, node long, features binary")
    full = members.join(sets.groupBy("node", "key").agg(F.first("features").alias("features")), ["node", "key"])
    full = full.select("part", "sides", "side", "fresh", "node", "root", "features").repartition("part")
    with small_batches(docs.sparkSession):
        found = cut(full.sortWithinPartitions("part", "sides", "node").mapInArrow(_verified(num, den), "u long, v long, x long, y long"))
    drop_cut(open_, members)
    bitmap.destroy()
    return found


def similar_documents(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """Documents and links for similarity num/den on n-word shingles: (doc_id, n_shingles, node, root, component_id), one row per row
    of ``docs``, with the smallest node of its component, and (u, v): the verified links between nodes.  The links hold a spanning forest of every component."""
    spark, docs = docs.sparkSession, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    of = cut(docs.mapInArrow(_sets_pass(n, num, den), "doc_id long, n_shingles long, n_signatures long, node long, sketch binary"))
    nodes = of.where("node is not null").groupBy("node")
    nodes = cut(nodes.agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("size"), F.first("sketch").alias("sketch")).withColumn("key", F.xxhash64("rep")))
    docs = docs.select(F.xxhash64("doc_id").alias("key"), "text")

    links, roots = [], nodes.select("node", F.col("node").alias("root"))

    def compare(families: DataFrame, stars: bool) -> None:
        """Adds the links within families (family, node, fresh) and what they join."""
        nonlocal roots
        families = cut(families.join(roots, "node"))
        found = _linked(families, nodes, docs, n, num, den, stars)
        drop_cut(families)
        if not found.isEmpty():
            above = components(found.select(F.col("x").alias("u"), F.col("y").alias("v"))).toDF("root", "to")
            before, roots = roots, cut(roots.join(above, "root", "left").select("node", F.coalesce("to", "root").alias("root")))
            if links:  # before the first links, each node's root is read off the table of nodes
                drop_cut(before)
            links.append(found.select("u", "v"))

    def open_pairs(pairs: DataFrame) -> DataFrame:
        both = pairs.join(roots.toDF("u", "x"), "u").join(roots.toDF("v", "y"), "v")
        return both.where("x <> y").select("u", "v")

    def one_family_each(pairs: DataFrame, turn: int) -> DataFrame:
        least = pairs.groupBy("v").agg(F.min_by("u", F.struct(F.xxhash64(F.lit(turn), "u"), "u")).alias("u"))
        return members_of(least).withColumn("fresh", F.lit(1))

    def members_of(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("u").alias("family"), F.col("v").alias("node")).union(pairs.select("u", "u").distinct())

    with tidy(spark):
        buckets = n_buckets(spark, of.agg(F.sum("n_signatures")).first()[0] or 0)
    packed = docs.mapInArrow(_signature_pass(n, num, den, buckets), "bucket int, sigs binary, nodes binary")
    packed = packed.repartition("bucket").sortWithinPartitions("bucket")
    star = cut(packed.mapInArrow(vt.lean(_candidates_of_bucket), "u long, v long").distinct())
    left = star
    for turn in range(TURNS):
        compare(one_family_each(left, turn), True)
        before, left = left, cut(open_pairs(left))
        if turn:
            drop_cut(before)
    last = star.join(left.select("u").distinct(), "u", "left_semi")
    cover = star.groupBy(F.col("v").alias("family")).agg(F.min("u").alias("cover"))
    covered = star.select(F.col("u").alias("cover"), F.col("v").alias("node"), F.lit(0).alias("fresh"))
    rows = members_of(last).join(cover, "family", "left").join(covered, ["cover", "node"], "left")
    compare(rows.select("family", "node", F.coalesce("fresh", F.lit(1)).alias("fresh")), False)
    drop_cut(star, left)
    links = reduce(DataFrame.union, links) if links else spark.createDataFrame([], "u long, v long")
    placed = nodes.select("node", "rep").join(roots, "node")
    low = cut(placed.groupBy("root").agg(F.min("rep").alias("low")))
    lows = placed.join(low, "root").select("node", "root", "low")
    placed = of.select("doc_id", "n_shingles", "node").join(lows, "node", "left")
    return placed.select("doc_id", "n_shingles", "node", "root", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("low")).alias("component_id")), links.select("u", "v")


def drop_similar(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each group of similar documents, that with the smallest id (null ids come last); of rows without a set, equal
    texts of one id stay once."""
    placed, _ = similar_documents(docs, n, num, den)
    placed = cut(placed.select("doc_id", "node", "root"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")).alias("x")
    stay = placed.where("node is not null").groupBy("root").agg(first).select(F.col("x.doc_id").alias("_nj_id"), F.col("x.node").alias("_nj_at"))
    # An id with one row leads to it; rows of other ids, and of none, are found by their own node.
    kinds = placed.where("doc_id is not null").groupBy(F.col("doc_id").alias("_nj_id")).agg(F.min("node").alias("_nj_node"), F.count(F.lit(1)).alias("rows"))
    id_ = F.col("doc_id").cast("long")
    single = kinds.where("rows = 1").join(stay.where("_nj_id is not null"), "_nj_id", "left").where("_nj_node is null or _nj_node = _nj_at")
    kept = docs.join(single.select("_nj_id"), id_ == F.col("_nj_id"), "left_semi")
    again = cut(kinds.where("rows > 1").select("_nj_id"))
    odd = [docs.where(id_.isNull())] if not placed.where("doc_id is null").isEmpty() else []
    odd += [docs.join(again, id_ == F.col("_nj_id"), "left_semi")] if not again.isEmpty() else []
    for rows in odd:
        rows = _noded(rows, n)
        found = (F.col("_nj_node") == F.col("_nj_at")) & id_.eqNullSafe(F.col("_nj_id"))
        rows = rows.join(stay, found, "left_semi").union(rows.where("_nj_node is null"))
        text = F.xxhash64("text")
        same = Window.partitionBy("doc_id", "_nj_node", F.when(F.col("_nj_node").isNull(), text)).orderBy(text)
        kept = kept.union(rows.withColumn("_nj_row", F.row_number().over(same)).where("_nj_row = 1").drop("_nj_row", "_nj_node"))
    return kept


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, _ = similar_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), 4, 85, 100)
    return placed.select("doc_id", "n_shingles", "component_id")


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                                  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.b)::BIGINT AS component_id
FROM documents d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""
