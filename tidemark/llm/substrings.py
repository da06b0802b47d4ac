"""Substring dedup: suffix automata of reference shards, matching statistics, removal of maximal spans.

A span of a document is removed if it is covered by windows of ``window`` words each of which also starts in a document
with a smaller id.  ``window`` is the length threshold: overlapping windows join to maximal spans.

With a bounded reference (``remove_spans``) the reference's automata are broadcast, shard by shard, and documents stream
past them.  Within one corpus (``first_owners``) the reference is the corpus, which no broadcast holds, so the shards are
dealt out instead, and each carries only what it can match:

1. Documents are cut into units of about 4 MB and written once.  Of each window the smallest k-gram hash (its minimizer) is
   its anchor; equal windows have equal anchors.  Each unit sends its distinct anchors, packed, to buckets by anchor.
2. A bucket answers each unit with one bit per anchor: does another document have it?  Windows with no such anchor
   occur once and are done.  These are most of the corpus.
3. A unit sends each run of repeated windows with one anchor (a segment, with its words) to the anchor's shard, once per
   distinct segment and with the smallest id that has it.  An anchor in very many segments would crowd one shard: such
   anchors, counted in step 2, deal out each of their windows by its own hash instead.
4. A shard builds the suffix automaton of its distinct segments, keeps at every state the smallest owner, and streams the
   segments for matching statistics: at each word the state that holds exactly ``window`` words gives the smallest
   document with that window.  The owners go back to the unit, which removes what is covered.

Only step 3 moves text, and only repeated text.  No group is gathered whole: equal segments meet as one row per unit.

Cases: null and empty texts have no words; shorter texts than ``window`` lose nothing; of rows with equal ids none removes
from the other; a null id counts as larger than any other; an empty table gives an empty result; extra columns do not
matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import vectext as vt
from .graphs import cut, n_buckets

#: Words of an anchor: shorter ones recur by chance more often, longer ones are denser.
ANCHOR = 6
UNIT = 4 << 20
#: Bytes of text for each distinct anchor that a unit sends, roughly: the number of buckets follows from it.
ANCHOR_BYTES = 32
#: An anchor with more segments than this deals its windows out one by one.
CROWD = 4096
NO_ID = np.iinfo(np.int64).max


class Automaton:
    """Suffix automaton of word sequences; ``owner`` of a state is the smallest document with its words."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.owner = [-1], [0], [NO_ID]

    def add(self, words: list[int], document: int) -> None:
        nxt, link, length, owner = self.next, self.link, self.length, self.owner
        last = 0
        for w in words:
            at = nxt[last].get(w)
            if at is not None and length[at] == length[last] + 1:
                last = at  # the words so far are a state already
                if document < owner[at]:
                    owner[at] = document
                continue
            if at is not None:
                new = self._clone(last, w, at)
                if document < owner[new]:
                    owner[new] = document
                last = new
                continue
            new = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            owner.append(document)
            link.append(0)
            p = last
            while p >= 0 and w not in nxt[p]:
                nxt[p][w] = new
                p = link[p]
            if p >= 0:
                q = nxt[p][w]
                link[new] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
            last = new

    def _clone(self, p: int, w: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        self.owner.append(self.owner[q])
        link[q] = new
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = new
            p = link[p]
        return new

    def finish(self) -> None:
        """A shorter suffix is owned by all that own the longer ones."""
        link, owner = self.link, self.owner
        for s in np.argsort(self.length, kind="stable")[::-1].tolist():
            if s and owner[s] < owner[link[s]]:
                owner[link[s]] = owner[s]

    def owners(self, words: list[int], window: int) -> list[int]:
        """For each window of ``words`` the smallest document that holds it, NO_ID if none does."""
        nxt, link, length, owner = self.next, self.link, self.length, self.owner
        out, state, matched = [], 0, 0
        for i, w in enumerate(words):
            while state and w not in nxt[state]:
                state = link[state]
                matched = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                matched += 1
            while state and length[link[state]] >= window:
                state = link[state]
                matched = min(matched, length[state])
            if i >= window - 1:
                out.append(owner[state] if matched >= window else NO_ID)
        return out


def _packed(x: np.ndarray | bytes) -> bytes:
    return zstandard.compress(x if isinstance(x, bytes) else x.tobytes(), 3)


def _array(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(x), kind)


class Unit:
    """Some documents with their windows' anchors."""

    def __init__(self, blob: bytes, window: int):
        table = pa.ipc.open_stream(zstandard.decompress(blob)).read_all().combine_chunks()
        self.ids = table.column("doc_id").to_numpy()
        self.window, k = window, min(ANCHOR, window)
        data, offsets = vt.column(table.column("text"))
        self.t = t = vt.Texts(data, offsets)
        grams = vt.ngrams(t.hashes, k)
        m = max(0, len(t.hashes) - window + 1)
        width = window - k + 1
        # The smallest of `width` neighbours, by doubling.
        low, have = grams[: m + width - 1].copy(), 1
        while have * 2 <= width:
            low = np.minimum(low[:-have], low[have:])
            have *= 2
        low = np.minimum(low[:m], low[width - have : width - have + m]) if m else low[:0]
        self.inside = vt.inside(t.first, window, m)
        low = vt.mix(low ^ vt.U(0x2545F4914F6CDD1D))  # minima are small numbers: spread them over the buckets
        self.anchor = low
        self.doc = t.text_of_words()[:m]
        at = np.flatnonzero(self.inside)
        self.windows = at
        self.distinct, self.which = np.unique(low[at], return_inverse=True)

    def counts(self) -> np.ndarray:
        """Of each distinct anchor: 1 if one document of this unit has it, else its number of runs of windows, up to 255."""
        d = self.doc[self.windows]
        low = np.full(len(self.distinct), len(self.ids), np.int64)
        high = np.full(len(self.distinct), -1, np.int64)
        np.minimum.at(low, self.which, d)
        np.maximum.at(high, self.which, d)
        new = np.ones(len(d), bool)
        new[1:] = (self.which[1:] != self.which[:-1]) | (d[1:] != d[:-1])
        runs = np.bincount(self.which[new], minlength=len(self.distinct))
        return np.where(low < high, np.clip(runs, 2, 255), 1).astype(np.uint8)

    def buckets(self, n: int) -> np.ndarray:
        """Where each bucket's distinct anchors begin."""
        return np.searchsorted(_bucket(self.distinct, n), np.arange(n + 1))

    def segments(self, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of windows with one repeated anchor, in one document, as (first word, windows, key that deals it out)."""
        mark = marks[self.which]
        at, key = self.windows[mark > 0], self.anchor[self.windows][mark > 0]
        alone = mark[mark > 0] > 1
        if not len(at):
            return at, at, key
        grams = vt.ngrams(self.t.hashes, self.window)
        key = np.where(alone, grams[at], key)
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (key[1:] != key[:-1]) | alone[1:] | (self.doc[at[1:]] != self.doc[at[:-1]])
        start = np.flatnonzero(new)
        return at[start], np.diff(np.append(start, len(at))), key[start]

    def distinct_segments(self, marks: np.ndarray):
        """Segments of different words, ordered by key: (first words, windows, keys, smallest ids), and of each segment of
        ``segments()`` which of these it equals."""
        at, count, key = self.segments(marks)
        size = count + self.window - 1
        sums = np.zeros(len(self.t.hashes) + 1, np.uint64)
        powers = vt._powers(0xD1342543DE82EF95, max(1, len(self.t.hashes)))
        np.cumsum(self.t.hashes * powers[: len(self.t.hashes)], out=sums[1:])
        back = vt._powers(pow(0xD1342543DE82EF95, -1, 2**64), max(1, len(self.t.hashes)))
        content = vt.mix((sums[at + size] - sums[at]) * back[at] + size.astype(np.uint64)) if len(at) else key
        ids = self.ids[self.doc[at]] if len(at) else np.zeros(0, np.int64)
        order = np.lexsort((ids, content, key))
        k, c = key[order], content[order]
        new = np.ones(len(order), bool)
        new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        pick = order[new]
        return at[pick], count[pick], key[pick], ids[pick], (at, count, which)


def _bucket(keys: np.ndarray, n: int) -> np.ndarray:
    return (keys >> vt.U(32)).astype(np.int64) * n >> 32


ROW = "unit long, bucket int, part int, blob binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    unit, bucket, part, blob = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.record_batch({"unit": pa.array(unit, pa.int64()), "bucket": pa.array(bucket, pa.int32()), "part": pa.array(part, pa.int32()), "blob": pa.array(blob, pa.binary())})


def _units(batches) -> Iterator[pa.RecordBatch]:
    """Documents to units: (unit, blob).  A unit's number is that of its task and its place in it."""
    task, count = TaskContext.get().partitionId() << 32, 0
    held, size = [], 0

    def whole() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as w:
            w.write_table(table)
        return _rows([(task + count, -1, 0, _packed(sink.getvalue().to_pybytes()))])

    for batch in batches:
        ids = batch.column(0).cast(pa.int64()).fill_null(NO_ID)
        batch = pa.record_batch({"doc_id": ids, "text": batch.column(1).fill_null("").cast(pa.large_string())})
        for part in vt.pieces(batch, most=UNIT // 4):
            held.append(part)
            size += len(vt.column(part.column(1))[0])
            if size >= UNIT:
                yield whole()
                held, size, count = [], 0, count + 1
    if held:
        yield whole()


def _anchors(window: int, buckets: int):
    def run(batches):
        for batch in batches:
            for unit, blob in zip(batch.column("unit").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                u = Unit(blob, window)
                cuts, runs = u.buckets(buckets), u.counts()
                low = (u.distinct & vt.U(0xFFFFFFFF)).astype(np.uint32)
                rows = [
                    (unit, b, 0, _packed(low[cuts[b] : cuts[b + 1]].tobytes() + runs[cuts[b] : cuts[b + 1]].tobytes()))
                    for b in range(buckets)
                    if cuts[b + 1] > cuts[b]
                ]
                yield _rows(rows)

    return vt.lean(run)


def _grouped(batches, column: str) -> Iterator[tuple[int, list[tuple]]]:
    """Consecutive rows with one value of ``column``; partitions are sorted by it."""
    at, held = None, []
    for batch in batches:
        names = batch.schema.names
        for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            key = row[names.index(column)]
            if key != at and held:
                yield at, held
                held = []
            at = key
            held.append(row)
    if held:
        yield at, held


def _repeated(crowd: int):
    """Of a bucket's anchors from all units: for each unit one mark per anchor; 0 once, 1 repeated, 2 in a crowd."""

    def run(batches):
        for bucket, rows in _grouped(batches, "bucket"):
            lows, runs = [], []
            for _, _, _, blob in rows:
                raw = zstandard.decompress(blob)
                lows.append(np.frombuffer(raw, np.uint32, len(raw) // 5))
                runs.append(np.frombuffer(raw, np.uint8, len(raw) // 5, len(raw) // 5 * 4))
            value, which = np.unique(np.concatenate(lows), return_inverse=True)
            total = np.bincount(which, np.concatenate(runs), len(value))
            mark = np.where(total > crowd, 2, total > 1).astype(np.uint8)[which]
            cuts = np.cumsum([0, *map(len, lows)])
            yield _rows([(row[0], bucket, 1, _packed(mark[a:b])) for row, a, b in zip(rows, cuts[:-1], cuts[1:], strict=True)])

    return vt.lean(run)


def _marks(u: Unit, buckets: int, rows: list[tuple]) -> np.ndarray:
    cuts, marks = u.buckets(buckets), np.zeros(len(u.distinct), np.uint8)
    for _, b, part, blob in rows:
        if part == 1:
            marks[cuts[b] : cuts[b + 1]] = _array(blob, np.uint8)
    return marks


def _segments(window: int, buckets: int):
    def run(batches):
        for unit, rows in _grouped(batches, "unit"):
            u = Unit(next(r[3] for r in rows if r[2] == 0), window)
            at, count, key, ids, _ = u.distinct_segments(_marks(u, buckets, rows))
            starts, ends, data = u.t.starts, u.t.ends, u.t.data
            cuts = np.searchsorted(_bucket(key, buckets), np.arange(buckets + 1))
            out = []
            for b in range(buckets):
                some = range(cuts[b], cuts[b + 1])
                if some:
                    lines = b"\n".join(b" ".join(data[starts[at[i]] : ends[at[i] + count[i] + window - 2]].tobytes().split()) for i in some)
                    out.append((unit, b, 0, _packed(np.int64(len(some)).tobytes() + ids[some.start : some.stop].tobytes() + key[some.start : some.stop].tobytes() + lines)))
            if out:
                yield _rows(out)

    return vt.lean(run)


#: Words that one automaton takes in before the next is begun; segments of one key always share one.
SHARD = 60_000


def _matched(window: int):
    """A shard's segments from all units: for each unit the smallest owner of each of its windows."""

    def run(batches):
        for bucket, rows in _grouped(batches, "bucket"):
            texts: dict[bytes, int] = {}
            keys, owners, lists = [], [], []
            for _, _, _, blob in rows:
                raw = zstandard.decompress(blob)
                n = int(np.frombuffer(raw, np.int64, 1)[0])
                ids = np.frombuffer(raw, np.int64, n, 8).tolist()
                key = np.frombuffer(raw, np.uint64, n, 8 + 8 * n).tolist()
                mine = []
                for line, d, k in zip(raw[8 + 16 * n :].split(b"\n"), ids, key, strict=True):
                    i = texts.setdefault(line, len(owners))
                    if i == len(owners):
                        owners.append(d)
                        keys.append(k)
                    elif d < owners[i]:
                        owners[i] = d
                    mine.append(i)
                lists.append(mine)
            lines, answers = list(texts), [None] * len(owners)
            order = sorted(range(len(owners)), key=keys.__getitem__)
            at = 0
            while at < len(order):
                shard, numbers, size, to = Automaton(), {}, 0, at
                held = []
                while to < len(order) and (size < SHARD or keys[order[to]] == keys[order[to - 1]]):
                    i = order[to]
                    words = [numbers.setdefault(w, len(numbers)) for w in lines[i].split(b" ")]
                    shard.add(words, owners[i])
                    held.append((i, words))
                    size += len(words)
                    to += 1
                shard.finish()
                for i, words in held:
                    answers[i] = np.array(shard.owners(words, window), np.int64)
                at = to
            yield _rows([(row[0], bucket, 2, _packed(np.concatenate([answers[i] for i in mine]))) for row, mine in zip(rows, lists, strict=True)])

    return vt.lean(run)


def _decided(window: int, buckets: int, finish):
    def run(batches):
        for _, rows in _grouped(batches, "unit"):
            u = Unit(next(r[3] for r in rows if r[2] == 0), window)
            at, count, key, _, (all_at, all_count, which) = u.distinct_segments(_marks(u, buckets, rows))
            cuts = np.searchsorted(_bucket(key, buckets), np.arange(buckets + 1))
            begin = np.concatenate([[0], np.cumsum(count)])
            owner = np.full(begin[-1], NO_ID, np.int64)
            for _, b, part, blob in rows:
                if part == 2:
                    owner[begin[cuts[b]] : begin[cuts[b + 1]]] = _array(blob, np.int64)
            gone = np.zeros(len(u.t.hashes) + 1, np.int64)
            if len(all_at):
                step = np.arange(all_count.sum()) - np.repeat(np.cumsum(all_count) - all_count, all_count)
                window_at = np.repeat(all_at, all_count) + step
                low = owner[np.repeat(begin[which], all_count) + step]
                hit = window_at[low < u.ids[u.doc[window_at]]]
                gone += np.bincount(hit, minlength=len(gone)) - np.bincount(hit + window, minlength=len(gone))
            yield from finish(u, np.cumsum(gone[:-1]) == 0)

    return vt.lean(run)


def _removed(docs: DataFrame, window: int, finish, schema: str, crowd: int = CROWD) -> DataFrame:
    spark = docs.sparkSession
    size = Observation()
    seen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").observe(size, F.sum(F.octet_length("text")).alias("n"))
    units = cut(seen.mapInArrow(vt.lean(_units), ROW))
    buckets = n_buckets(spark, (size.get["n"] or 0) // ANCHOR_BYTES)
    by_bucket = units.mapInArrow(_anchors(window, buckets), ROW).repartition("bucket").sortWithinPartitions("bucket")
    marks = cut(by_bucket.mapInArrow(_repeated(crowd), ROW))
    of_unit = units.union(marks).repartition("unit").sortWithinPartitions("unit")
    segments = of_unit.mapInArrow(_segments(window, buckets), ROW).repartition("bucket").sortWithinPartitions("bucket")
    owners = segments.mapInArrow(_matched(window), ROW)
    return units.union(marks).union(owners).repartition("unit").sortWithinPartitions("unit").mapInArrow(_decided(window, buckets, finish), schema)


def _digest(u: Unit, keep: np.ndarray):
    out, at = u.t.joined(keep)
    raw = out.tobytes()
    kept = np.add.reduceat(np.append(keep, False).astype(np.int64), u.t.first[:-1]) if len(u.ids) else np.zeros(0, np.int64)
    kept = np.where(u.t.n_words > 0, kept, 0)
    sums = [hashlib.sha256(raw[a : max(a, b - 1)]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    ids = pa.array(u.ids, mask=u.ids == NO_ID)
    yield pa.record_batch({"doc_id": ids, "n_words": pa.array(u.t.n_words, pa.int64()), "n_removed": pa.array(u.t.n_words - kept, pa.int64()), "kept_sha256": pa.array(sums, pa.string())})


def substring_digest(docs: DataFrame, window: int = 13, crowd: int = CROWD) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256): one row per row of ``docs``."""
    return _removed(docs, window, _digest, "doc_id long, n_words long, n_removed long, kept_sha256 string", crowd)


def _texts(u: Unit, keep: np.ndarray):
    """(doc_id, hash of the text, kept text) of the documents that lose words."""
    out, at = u.t.joined(keep)
    lost = np.add.reduceat(np.append(~keep, False).astype(np.int64), u.t.first[:-1])
    lost = np.where(u.t.n_words > 0, lost, 0)
    pick = np.flatnonzero(lost)
    raw = out.tobytes()
    texts = [raw[at[i] : max(at[i], at[i + 1] - 1)].decode("utf-8", "replace") for i in pick.tolist()]
    was = [u.t.data[u.t.offsets[i] : u.t.offsets[i + 1]].tobytes() for i in pick.tolist()]
    hashes = np.array([xxhash.xxh64_intdigest(x, 42) for x in was], np.uint64).view(np.int64)
    yield pa.record_batch(
        {"doc_id": pa.array(u.ids[pick], mask=u.ids[pick] == NO_ID), "was": pa.array(hashes), "kept": pa.array(texts, pa.string())}
    )


def remove_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """``docs`` without the repeated spans, in the same columns; n_chars follows the text.  A document that loses nothing keeps its text as it is;
    in others the words that stay are joined by one space."""
    lost = _removed(docs, window, _texts, "doc_id long, was long, kept string")
    lost = lost.groupBy(F.col("doc_id").alias("_sd_id"), F.col("was").alias("_sd_was")).agg(F.min("kept").alias("_sd_kept"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_sd_id")) & (F.xxhash64("text") == F.col("_sd_was"))
    joined = docs.join(lost, same, "left")
    text = F.coalesce("_sd_kept", "text")
    new = {"text": text} | ({"n_chars": F.when(F.col("_sd_kept").isNotNull(), F.length("_sd_kept").cast("long")).otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {})
    return joined.withColumns(new).select(*docs.columns)


def remove_spans(docs: DataFrame, reference: DataFrame, window: int = 13, shard: int = SHARD, most: int = 64 << 20) -> DataFrame:
    """``docs`` (doc_id, text) against a bounded ``reference`` (text): (doc_id, n_words, n_removed, kept_sha256).

    The reference's size is checked first: above ``most`` bytes it is not broadcast, and the call is refused; such a reference belongs
    in one corpus with the documents, under smaller ids.  Its automata are built shard by shard and broadcast."""
    spark = docs.sparkSession
    size = reference.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size > most:
        raise ValueError(f"the reference has {size} bytes; at most {most} are broadcast")
    lines = [r[0].encode().split() for r in reference.where("text is not null").select("text").toLocalIterator()]
    shards, at = [], 0
    while at < len(lines):
        auto, numbers, held = Automaton(), {}, 0
        while at < len(lines) and (not held or held + len(lines[at]) <= shard):
            auto.add([numbers.setdefault(w, len(numbers)) for w in lines[at]], -1)
            held += len(lines[at])
            at += 1
        auto.finish()
        shards.append(spark.sparkContext.broadcast((auto, numbers)))

    def run(batches):
        for batch in batches:
            for part in vt.pieces(batch):
                t = vt.texts(part)
                keep = np.ones(len(t.hashes), bool)
                words = [t.data[a:b].tobytes() for a, b in zip(t.starts.tolist(), t.ends.tolist(), strict=True)]
                for a, b in zip(t.first[:-1].tolist(), t.first[1:].tolist(), strict=True):
                    for one in shards:
                        auto, numbers = one.value
                        for i, owner in enumerate(auto.owners([numbers.get(w, -1) for w in words[a:b]], window)):
                            if owner < NO_ID:
                                keep[a + i : a + i + window] = False
                u = type("Part", (), {"t": t, "ids": part.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)})
                yield from _digest(u, keep)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_digest(spark.read.parquet(f"{sf_dir}/documents.parquet"), 13)


OP2_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
g AS (SELECT doc_id, w, unnest(CASE WHEN len(w) >= 13 THEN range(1, len(w) - 11) ELSE [] END) AS i FROM d),
x AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM g),
f AS (SELECT s, min(doc_id) AS low FROM x GROUP BY s),
c AS (SELECT DISTINCT x.doc_id, unnest(range(x.i, x.i + 13)) AS i FROM x JOIN f ON x.s = f.s WHERE f.low < x.doc_id),
r AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda y, j: NOT list_contains(gone, j)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN r ON r.doc_id = d.doc_id
"""
