"""Language-model scores by prediction by partial matching, pretrained on the corpus's own training fold.

The model is a trie of byte contexts up to five bytes.  In a context with T counted bytes of q kinds a seen byte has n / (T + q)
and an escape q / (T + q) (method C); after an escape the next shorter context counts without the bytes that the
longer one has seen (symbol exclusion); below the empty context all other bytes are equally likely.  A text is coded
as its bytes, A-Z lower-cased, from a start mark to an end mark, so the scores are a distribution over texts.

The trie is not broadcast: it grows with the corpus.  Each unit of documents sends its distinct six-byte sequences with
their training counts to the bucket of the two bytes before the last; there all contexts of two to five bytes that end in these
meet, so a bucket has whole sub-tries and answers with the probability of each sequence asked for.  Contexts of one byte
and none are one table of 256 x 256 counts, a size that cannot grow, and are broadcast.  Two bytes that make up more than one
in CROWD of all pairs are dealt out by the byte before them too; what follows these two, CROWD x 256 counts at most, is counted
in a pass of its own and broadcast with the table.  Buckets grow in number with the training bytes.  Word counts for the base
score travel the same way.  ``score`` adds up logarithms that are sent as 32-bit floats.

Cases: null text is empty and has the end token and end mark alone; null ids belong to the training fold; equal ids are
scored each for itself; without training rows all bytes are equally likely and the base score is 0; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vectext as vt
from .graphs import cut, n_buckets
from .units import NO_ID, ROW, grouped, pack_units, packed, rows, unit_table, unpacked

ORDER = 5
#: Pairs of bytes that are more than one in so many are dealt out by three bytes.
CROWD = 1024
#: Larger units ask for fewer sequences in all.
UNIT = 8 << 20
START, END, ALPHABET = 0xFF, 0xFE, 256  # bytes that UTF-8 never has stand for a text's start and end


def byte_grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each byte and end mark with the ORDER bytes before it, packed to an integer; and where each text's begin."""
    n = len(offsets) - 1
    begin = offsets + (ORDER + 1) * np.arange(n + 1)
    line = np.full(int(begin[-1]), START, np.uint8)
    mark = np.ones(len(line), bool)
    mark[(begin[:-1, None] + np.arange(ORDER)).ravel()] = False
    line[begin[1:] - 1] = END
    body = mark.copy()
    body[begin[1:] - 1] = False
    line[body] = data
    wide = line.astype(np.uint64)
    keys = wide[ORDER:].copy()
    for back in range(1, ORDER + 1):
        keys |= wide[ORDER - back : len(wide) - back] << vt.U(8 * back)
    return keys[mark[ORDER:]], offsets + np.arange(n + 1)


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a sorted table, and whether they are there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(values, at)


class Level:
    """Counts of one context length: sequences (context and byte), and per context T and q."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts
        context = keys >> vt.U(8)
        self.contexts, self.kinds = _sums(context, np.ones(len(keys), np.int64))
        _, self.totals = _sums(context, counts)

    def number(self, keys: np.ndarray) -> np.ndarray:
        at, there = _find(self.keys, keys)
        return np.where(there, self.counts[at], 0) if len(self.counts) else np.zeros(len(keys), np.int64)

    def stats(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, there = _find(self.contexts, contexts)
        if not len(self.contexts):
            return np.zeros(len(contexts), np.int64), np.zeros(len(contexts), np.int64), there
        return np.where(there, self.totals[at], 0), np.where(there, self.kinds[at], 0), there

    def without(self, upper: Level) -> tuple[np.ndarray, np.ndarray]:
        """For each context of the next longer level: T and q here, without the bytes seen there."""
        suffix = (vt.U(1) << vt.U(8 * self.order)) - vt.U(1)
        low = self.number(upper.keys & ((vt.U(1) << vt.U(8 * (self.order + 1))) - vt.U(1)))
        _, gone = _sums(upper.keys >> vt.U(8), low)
        total, kinds, _ = self.stats(upper.contexts & suffix)
        return total - gone, kinds - upper.kinds


def log_probabilities(asked: np.ndarray, keys: np.ndarray, counts: np.ndarray, pairs: np.ndarray, crowded: tuple | None = None) -> np.ndarray:
    """log10 probability of the last byte of each sequence in ``asked`` after the others.

    keys, counts: training sequences of the contexts asked for; pairs: 256 x 256 training counts of (byte before, byte); crowded: sorted
    three-byte sequences that begin with a crowded pair, and their training counts, which are those of the whole corpus."""
    levels: dict[int, Level] = {}
    for order in range(ORDER, 1, -1):
        mask = (vt.U(1) << vt.U(8 * (order + 1))) - vt.U(1)
        found = _sums(keys & mask, counts)
        if order == 2 and crowded is not None:
            found = _with_crowded(*found, asked, *crowded)
        levels[order] = Level(*found)
    flat = np.flatnonzero(pairs.ravel())
    levels[1] = Level(flat.astype(np.uint64), pairs.ravel()[flat])
    single = pairs.sum(0)
    flat = np.flatnonzero(single)
    levels[0] = Level(flat.astype(np.uint64), single[flat])
    for order, level in levels.items():
        level.order = order
    out, open_ = np.zeros(len(asked)), np.ones(len(asked), bool)
    upper: Level | None = None
    for order in range(ORDER, -1, -1):
        level = levels[order]
        key = asked & ((vt.U(1) << vt.U(8 * (order + 1))) - vt.U(1))
        total, kinds, seen = level.stats(key >> vt.U(8))
        if upper is not None and len(upper.contexts):
            at, longer = _find(upper.contexts, (asked & ((vt.U(1) << vt.U(8 * (order + 2))) - vt.U(1))) >> vt.U(8))
            less_total, less_kinds = level.without(upper)
            total = np.where(longer, less_total[at], total)
            kinds = np.where(longer, less_kinds[at], kinds)
        n = level.number(key)
        whole = np.maximum(total + kinds, 1)
        hit = open_ & (n > 0)
        out[hit] += np.log10(n[hit] / whole[hit])
        escape = open_ & ~hit & seen & (kinds > 0)
        out[escape] += np.log10(kinds[escape] / whole[escape])
        open_ &= ~hit
        upper = level
    out[open_] -= np.log10(max(1, ALPHABET - len(levels[0].keys)))
    return out


def _with_crowded(keys: np.ndarray, counts: np.ndarray, asked: np.ndarray, crowd_keys: np.ndarray, crowd_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Three-byte sequences of a bucket, those after a crowded pair that is asked for with the counts of the whole corpus."""
    pairs = np.unique((asked >> vt.U(8)) & vt.U(0xFFFF))
    known = crowd_keys >> vt.U(8)
    own, whole = ~np.isin(keys >> vt.U(8), known), np.isin(known, pairs)
    keys, counts = np.concatenate([keys[own], crowd_keys[whole]]), np.concatenate([counts[own], crowd_counts[whole]])
    order = np.argsort(keys)
    return keys[order], counts[order]


class _Deal:
    """The bucket of each word and byte sequence; crowded: which of the 256 x 256 pairs are dealt out by three bytes."""

    def __init__(self, buckets: int, crowded: np.ndarray):
        self.buckets, self.crowded = buckets, crowded

    def grams(self, keys: np.ndarray) -> np.ndarray:
        pair = (keys >> vt.U(8)) & vt.U(0xFFFF)
        context = np.where(self.crowded[pair.astype(np.int64)], (keys >> vt.U(8)) & vt.U(0xFFFFFF), pair)
        return ((vt.mix(context) >> vt.U(32)).astype(np.int64) * self.buckets) >> 32

    def words(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> vt.U(32)).astype(np.int64) * self.buckets >> 32


class _Asked:
    """What a unit asks for: its distinct words and byte sequences with their training counts, ordered by bucket."""

    def __init__(self, table: pa.Table, deal: _Deal):
        words, grams = [], []
        for batch in table.to_batches():
            for part in vt.pieces(batch):
                t = vt.texts(part, lower=True)
                train = ~np.array(part.column(2).fill_null(False).to_numpy(zero_copy_only=False), bool)
                weight = np.repeat(train, t.n_words)
                words.append(self._counted(t.hashes, weight))
                keys, begin = byte_grams(t.data, t.offsets)
                grams.append(self._counted(keys, np.repeat(train, np.diff(begin))))
        self.words, self.word_counts, self.word_cuts = self._dealt(words, deal.words, deal.buckets)
        self.grams, self.gram_counts, self.gram_cuts = self._dealt(grams, deal.grams, deal.buckets)

    @staticmethod
    def _counted(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if weight.all():
            return np.unique(keys, return_counts=True)
        train, counts = np.unique(keys[weight], return_counts=True)
        rest = np.unique(keys[~weight])
        rest = rest[~np.isin(rest, train, assume_unique=True)]
        return np.concatenate([train, rest]), np.concatenate([counts, np.zeros(len(rest), np.int64)])

    @staticmethod
    def _dealt(found: list, bucket, buckets: int):
        keys, counts = _sums(np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]))
        b = bucket(keys)
        order = np.argsort(b, kind="stable")
        return keys[order], counts[order], np.searchsorted(b[order], np.arange(buckets + 1))


def _ask(deal: _Deal):
    buckets = deal.buckets

    def run(batches):
        for batch in batches:
            for unit, blob in zip(batch.column("unit").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                a = _Asked(unit_table(blob), deal)
                for first, keys, counts, cuts in ((0, a.words, a.word_counts, a.word_cuts), (buckets, a.grams, a.gram_counts, a.gram_cuts)):
                    yield rows(
                        [
                            (unit, first + b, 1, int(i), packed(keys[at:to].tobytes() + counts[at:to].astype(np.uint32).tobytes()))
                            for b, (at, to) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
                            if (i := to - at)
                        ]
                    )

    return vt.lean(run)


def _answer(buckets: int, shortest):
    def run(batches):
        for bucket, held in grouped(batches, "bucket"):
            keys, counts = [], []
            for _, _, _, n, blob in held:
                raw = unpacked(blob, np.uint8)
                keys.append(raw[: 8 * n].view(np.uint64))
                counts.append(raw[8 * n :].view(np.uint32).astype(np.int64))
            cuts = np.cumsum([0, *map(len, keys)])
            every = np.concatenate(keys)
            distinct, total = _sums(every, np.concatenate(counts))
            if bucket < buckets:
                answer = total
                yield rows([(int(total.sum()), bucket, 7, int((total > 0).sum()), b"")])
            else:
                train = total > 0
                answer = log_probabilities(distinct, distinct[train], total[train], *shortest.value).astype(np.float32)
            answer = answer[np.searchsorted(distinct, every)]
            yield rows([(row[0], bucket, 2, row[3], packed(answer[a:b])) for row, a, b in zip(held, cuts[:-1], cuts[1:], strict=True)])

    return vt.lean(run)


class _Lookup:
    """Values of sorted distinct keys by a sparse hash table, where keys are asked for many times over."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.shift = vt.U(64 - max(8, int(len(keys) * 8).bit_length()))
        self.slots = np.zeros(1 << int(64 - self.shift), np.int32)
        self.slots[self._slot(self.keys)] = np.arange(len(keys), dtype=np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * vt.U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys):
            return self.values[:0]
        at = self.slots[self._slot(keys)]
        missed = np.flatnonzero(self.keys[at] != keys)
        at[missed] = np.searchsorted(self.keys, keys[missed])
        return self.values[at]


def _per_text(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    sums = np.add.reduceat(np.append(values, 0.0), begin[:-1]) if len(begin) > 1 else np.zeros(0)
    return np.where(np.diff(begin) > 0, sums, 0.0)


def _score(deal: _Deal, tokens: int, distinct: int, train_texts: int):
    buckets = deal.buckets

    def run(batches):
        for _, held in grouped(batches, "unit"):
            table = unit_table(next(r[4] for r in held if r[2] == 0))
            a = _Asked(table, deal)
            counts, logs = np.zeros(len(a.words), np.int64), np.zeros(len(a.grams))
            for _, b, part, _, blob in held:
                if part == 2 and b < buckets:
                    counts[a.word_cuts[b] : a.word_cuts[b + 1]] = unpacked(blob, np.int64)
                elif part == 2:
                    logs[a.gram_cuts[b - buckets] : a.gram_cuts[b - buckets + 1]] = unpacked(blob, np.float32)
            count, log = _Lookup(a.words, counts), _Lookup(a.grams, logs)
            whole = np.log10(tokens + 1.0 * (distinct + 1))
            for batch in table.to_batches():
                for part in vt.pieces(batch):
                    t = vt.texts(part, lower=True)
                    c = count(t.hashes)
                    end = np.log10(train_texts + 1.0) - whole
                    keys, begin = byte_grams(t.data, t.offsets)
                    ids = part.column(0).to_numpy(zero_copy_only=False)
                    yield pa.record_batch(
                        {
                            "doc_id": pa.array(ids, pa.int64(), mask=ids == NO_ID),
                            "held_out": part.column(2).fill_null(False),
                            "n_tokens": pa.array(t.n_words + 1, pa.int64()),
                            "n_known": pa.array(_per_text((c > 0).astype(float), t.first).astype(np.int64) + (train_texts > 0), pa.int64()),
                            "train_tokens": pa.array(np.full(len(t), tokens), pa.int64()),
                            "base_score": pa.array(_per_text(np.log10(c + 1.0), t.first) - t.n_words * whole + end),
                            "score": pa.array(_per_text(log(keys), begin)),
                            "n_bytes": pa.array(np.diff(t.offsets), pa.int64()),
                        }
                    )

    return vt.lean(run)


def _train_grams(batches):
    """Packed sequences of the training texts, and how many texts these are, of each part of the batches of (text, held_out)."""
    for batch in batches:
        for part in vt.pieces(batch):
            train = part.filter(pa.array(~np.array(part.column(1).fill_null(False).to_numpy(zero_copy_only=False), bool)))
            if train.num_rows:
                t = vt.column(train.column(0))
                yield byte_grams(vt._LOWER[t[0]], t[1])[0], train.num_rows


def _pairs(batches):
    """Counts of (byte before, byte) in training texts, as one row for each pair that a task has; last the number of texts."""
    total, texts = np.zeros(1 << 16, np.int64), 0
    for keys, n in _train_grams(batches):
        total += np.bincount((keys & vt.U(0xFFFF)).astype(np.int64), minlength=1 << 16)
        texts += n
    at = np.flatnonzero(total)
    yield pa.record_batch({"pair": pa.array([*at.tolist(), -1], pa.int32()), "n": pa.array([*total[at].tolist(), texts], pa.int64())})


def _after_crowded(crowded: np.ndarray):
    """Counts of (crowded pair, byte after it) in training texts, as one row for each that a task has."""
    place = np.where(crowded, np.cumsum(crowded) - 1, -1)
    pairs = np.flatnonzero(crowded)

    def run(batches):
        total = np.zeros(256 * len(pairs), np.int64)
        for keys, _ in _train_grams(batches):
            at = place[((keys >> vt.U(8)) & vt.U(0xFFFF)).astype(np.int64)]
            total += np.bincount((at * 256 + (keys & vt.U(0xFF)).astype(np.int64))[at >= 0], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.record_batch({"gram": pa.array(pairs[at >> 8] * 256 + (at & 0xFF), pa.int32()), "n": pa.array(total[at], pa.int64())})

    return run


def score_documents(docs: DataFrame, held_out, crowd: int = CROWD) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes), one row per row of ``docs``.

    held_out: boolean column; rows where it is true are scored but not learned from."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    found = docs.select("text", "held_out").mapInArrow(_pairs, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    table, texts = np.zeros(1 << 16, np.int64), 0
    for pair, n in found.collect():  # 65,537 rows at most
        if pair < 0:
            texts = n
        else:
            table[pair] = n
    crowded = table * crowd > table.sum()
    triples = docs.select("text", "held_out").mapInArrow(_after_crowded(crowded), "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    triples = sorted(map(tuple, triples.collect())) if crowded.any() else []  # crowd x 256 rows at most
    after = tuple(np.array([x[i] for x in triples], kind) for i, kind in enumerate((np.uint64, np.int64)))
    shortest = spark.sparkContext.broadcast((table.reshape(256, 256), after))
    # A unit asks for about one distinct sequence in eight bytes.
    deal = _Deal(n_buckets(spark, int(table.sum()) // 8), crowded)
    units = cut(docs.mapInArrow(pack_units(UNIT), ROW))
    asked = units.mapInArrow(_ask(deal), ROW).repartition("bucket").sortWithinPartitions("bucket")
    answers = cut(asked.mapInArrow(_answer(deal.buckets, shortest), ROW))
    known = answers.where("part = 7").agg(F.coalesce(F.sum("unit"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    back = units.union(answers.where("part = 2")).repartition("unit").sortWithinPartitions("unit")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long"
    return back.mapInArrow(_score(deal, known[0] + texts, known[1] + (texts > 0), texts), schema)


def op4_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_documents(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2)
