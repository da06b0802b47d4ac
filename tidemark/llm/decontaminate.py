"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact weighted-shingle check.

Words are case-folded runs without white space and ASCII marks.  An item of n words is compared with windows of n words,
and a document of fewer words as a whole with every longer item that it shares a shingle with.
Both have a fingerprint of 256 bits over their five-word shingles (an item of fewer words has one shingle).  The fingerprints
of all items are cut into 16 blocks of 16 bits, each an index of its own: two fingerprints within RADIUS = 63 bits
differ by three bits at most in some block, so looking up all 697 values within three bits of each of a window's blocks finds
every item fingerprint within the radius.  At a similarity of 0.8 fingerprints differ by 39 bits with a deviation of 6.
Candidates are then decided exactly: weighted Jaccard similarity of the shingle multisets, where a shingle weighs
log(1 + items / items that have it), of at least 0.8.

Only windows that hold a shingle of some item of that size are fingerprinted; others have similarity 0 with all items.

Items go to the executors in blocks of at most BLOCK words; more blocks mean more passes over the documents.  Weights are those of
the whole benchmark in every block: beside its items a block gets the counts of all shingles that two or more items of any block
have (12 bytes each, the one part that grows with the benchmark); all others weigh what a shingle of one item does.

Cases: null and empty texts match nothing; items without words are left out; items with equal words are reported each;
repeated documents are reported each; a null id of a document or an item is reported as null; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vectext as vt

SHINGLE, BITS, BLOCKS, NEAR = 5, 256, 16, 3
RADIUS = BLOCKS * (NEAR + 1) - 1
BLOCK = 2_000_000
SCHEMA = "doc_id long, item_id long, start long, n_words long, similarity double"
_MASKS = np.array([sum(1 << b for b in c) for n in range(NEAR + 1) for c in combinations(range(BITS // BLOCKS), n)], np.int64)


def _signs(shingles: np.ndarray) -> np.ndarray:
    """256 pseudo-random signs of each shingle, as a matrix of -1 and 1."""
    words = np.stack([vt.mix(shingles ^ vt.U(0x9E3779B97F4A7C15 * (i + 1) % 2**64)) for i in range(BITS // 64)], 1)
    return np.unpackbits(words.view(np.uint8), axis=1).astype(np.float64) * 2 - 1


def _blocks(bits: np.ndarray) -> np.ndarray:
    """Rows of 256 bits to rows of 16 numbers."""
    return np.packbits(bits, axis=1).view(np.uint16).astype(np.int64)


def _folded(texts: pa.Array) -> pa.RecordBatch:
    return pa.record_batch({"text": pc.replace_substring(pc.utf8_lower(texts), "\u00df", "ss")})


def _shingles(words: np.ndarray) -> np.ndarray:
    return vt.ngrams(words, min(SHINGLE, len(words))) if len(words) else words


def _listed(texts: list[str]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Items' numbers of words, their shingles, and the distinct (shingle, place of item)."""
    t = vt.texts(_folded(pa.array(texts, pa.string())), breaks=vt.MARKS)
    lists = [_shingles(t.hashes[a:b]) for a, b in zip(t.first[:-1], t.first[1:], strict=True)]
    of = np.repeat(np.arange(len(texts)), [len(x) for x in lists])
    every = np.concatenate([*lists, np.zeros(0, np.uint64)])
    pairs = np.unique(np.stack([every, of.astype(np.uint64)], 1), axis=0) if len(every) else np.zeros((0, 2), np.uint64)
    return t.n_words, lists, pairs


class Weights:
    """log(1 + items / items that have it) of each shingle, over all blocks of items."""

    def __init__(self, blocks: list[list[str]]):
        known, count, items = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        for texts in blocks:
            more, n = np.unique(_listed(texts)[2][:, 0], return_counts=True)
            known, of = np.unique(np.concatenate([known, more]), return_inverse=True)
            count = np.bincount(of, np.concatenate([count, n]), len(known)).astype(np.int64)
            items += len(texts)
        self.items, self.shared, self.count = items, known[count > 1], count[count > 1].astype(np.int32)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.shared >> vt.U(44)).astype(np.int64)] = True

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        have = np.ones(len(shingles), np.int64)
        some = np.flatnonzero(self.seen[(shingles >> vt.U(44)).astype(np.int64)])
        if len(some):
            at = np.minimum(np.searchsorted(self.shared, shingles[some]), len(self.shared) - 1)
            have[some] = np.where(self.shared[at] == shingles[some], self.count[at], 1)
        return np.log1p(self.items / have)


class Items:
    """The items of one block, the weights of all blocks, and the multi-index of fingerprints."""

    def __init__(self, ids: list[int | None], texts: list[str], threshold: float, weights: Weights | None = None):
        self.threshold = threshold
        self.weights = weights or Weights([texts])
        self.ids = list(ids)
        self.size, self.lists, pairs = _listed(texts)
        self.known, count = np.unique(pairs[:, 0], return_counts=True)
        self.owners = pairs[np.argsort(pairs[:, 0], kind="stable"), 1].astype(np.int64)
        self.owner_at = np.concatenate([[0], np.cumsum(count)])
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.known >> vt.U(44)).astype(np.int64)] = True
        bits = [(self.weights(x)[:, None] * _signs(x)).sum(0) > 0 if len(x) else np.zeros(BITS, bool) for x in self.lists]
        self.bits = np.array(bits, bool).reshape(len(ids), BITS)
        blocks = _blocks(self.bits) if len(ids) else np.zeros((0, BLOCKS), np.int64)
        full = np.flatnonzero(self.size > 0)
        self.index = []
        for b in range(BLOCKS):
            order = full[np.argsort(blocks[full, b], kind="stable")]
            self.index.append((order, np.searchsorted(blocks[order, b], np.arange((1 << 16) + 1))))

    def place(self, shingles: np.ndarray) -> np.ndarray:
        """Place of each shingle among the known ones, -1 for others."""
        out = np.full(len(shingles), -1, np.int64)
        some = np.flatnonzero(self.seen[(shingles >> vt.U(44)).astype(np.int64)])
        if len(self.known) and len(some):
            at = np.minimum(np.searchsorted(self.known, shingles[some]), len(self.known) - 1)
            out[some] = np.where(self.known[at] == shingles[some], at, -1)
        return out

    def within(self, bits: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window, item) with fingerprints within the radius."""
        blocks, pairs = _blocks(bits), []
        for b, (order, at) in enumerate(self.index):
            values = blocks[:, b, None] ^ _MASKS
            n = at[values + 1] - at[values]
            w, m = np.nonzero(n)
            first, count = at[values[w, m]], n[w, m]
            place = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
            pairs.append(np.repeat(w, count) * np.int64(len(self.ids)) + order[place])
        for pair in np.unique(np.concatenate(pairs)).tolist():
            w, i = divmod(pair, len(self.ids))
            if np.count_nonzero(bits[w] != self.bits[i]) <= RADIUS:
                yield w, i

    def similarity(self, shingles: np.ndarray, item: int) -> float:
        a, na = np.unique(shingles, return_counts=True)
        b, nb = np.unique(self.lists[item], return_counts=True)
        every = np.unique(np.concatenate([a, b]))
        ca, cb = np.zeros(len(every)), np.zeros(len(every))
        ca[np.searchsorted(every, a)], cb[np.searchsorted(every, b)] = na, nb
        w = self.weights(every)
        return float((w * np.minimum(ca, cb)).sum() / (w * np.maximum(ca, cb)).sum())

    def found(self, words: np.ndarray, hits: dict[int, np.ndarray]) -> dict[int, tuple[float, int]]:
        """item -> (similarity, first word) of its best window in one document; hits: shingle length -> places in it."""
        best: dict[int, tuple[float, int]] = {}
        for k, places in hits.items():
            grams = vt.ngrams(words, k)
            known = self.place(grams[places])
            sizes = {int(self.size[o]) for p in set(known.tolist()) for o in self.owners[self.owner_at[p] : self.owner_at[p + 1]]}
            of_shingle = {s for s in sizes if min(s, SHINGLE) == k}
            # For items longer than the document there is one window, the document itself.
            for n in sorted({min(s, len(words)) for s in of_shingle}):
                fit = {s for s in of_shingle if min(s, len(words)) == n}
                length = n - k + 1
                near = (places[:, None] - np.arange(length)).ravel()
                starts = np.unique(near[(near >= 0) & (near <= len(words) - n)])
                if not len(starts):
                    continue
                for chunk in np.array_split(starts, -(-len(starts) // 256)):
                    low, high = chunk[0], chunk[-1] + length
                    part = grams[low:high]
                    sums = np.concatenate([np.zeros((1, BITS)), np.cumsum(self.weights(part)[:, None] * _signs(part), 0)])
                    bits = sums[chunk - low + length] - sums[chunk - low] > 1e-9
                    for w, i in self.within(bits):
                        if int(self.size[i]) in fit:
                            at = int(chunk[w])
                            s = self.similarity(grams[at : at + length], i)
                            if s >= self.threshold - 1e-12 and (-s, at) < (-best.get(i, (0.0, 0))[0], best.get(i, (0.0, 0))[1]):
                                best[i] = (s, at)
        return best


def _search(items):
    def run(batches):
        index: Items = items.value
        lengths = sorted({min(SHINGLE, int(n)) for n in index.size if n})
        for batch in batches:
            for part in vt.pieces(batch):
                t = vt.texts(_folded(part.column(1)), breaks=vt.MARKS)
                doc = t.text_of_words()
                hits: dict[int, dict[int, np.ndarray]] = {}
                for k in lengths:
                    grams = vt.ngrams(t.hashes, k)
                    at = np.flatnonzero(vt.inside(t.first, k, len(grams)) & (index.place(grams) >= 0))
                    for d in np.unique(doc[at]).tolist():
                        hits.setdefault(d, {})[k] = at[doc[at] == d] - t.first[d]
                rows = []
                for d, own in hits.items():
                    found = index.found(t.hashes[t.first[d] : t.first[d + 1]], own)
                    rows += [(d, index.ids[i], at, min(int(index.size[i]), int(t.n_words[d])), s) for i, (s, at) in sorted(found.items())]
                if rows:
                    d, item, at, n, s = zip(*rows, strict=True)
                    yield pa.record_batch(
                        {
                            "doc_id": part.column(0).take(pa.array(d)),
                            "item_id": pa.array(item, pa.int64()),
                            "start": pa.array(at, pa.int64()),
                            "n_words": pa.array(n, pa.int64()),
                            "similarity": pa.array(s, pa.float64()),
                        }
                    )

    return vt.lean(run)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(doc_id, item_id, start, n_words, similarity): the best window of each document for each item that it holds."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found, ids, texts, words = [], [], [], 0
    rows = benchmark.where("text is not null").select(F.col("item_id").cast("long"), "text").orderBy("item_id", "text")
    for item, text in rows.toLocalIterator():
        ids.append(item)
        texts.append(text)
        words += len(text.split())
        if words >= BLOCK:
            found.append((ids, texts))
            ids, texts, words = [], [], 0
    if ids:
        found.append((ids, texts))
    weights = Weights([x for _, x in found])
    parts = [docs.mapInArrow(_search(spark.sparkContext.broadcast(Items(i, x, threshold, weights))), SCHEMA) for i, x in found]
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], SCHEMA)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item.  Rows are known by 64 bits of their text's hash, not by their
    ids, so that a clean row stays whatever other rows share its id or have none."""
    text = F.xxhash64("text")
    bad = contaminated(docs.select(text.alias("doc_id"), "text"), benchmark, threshold).select(F.col("doc_id").alias("_dc_of")).distinct()
    return docs.join(bad, text == F.col("_dc_of"), "left_anti")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
