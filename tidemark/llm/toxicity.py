"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding: compatibility decomposition without marks, case folding, look-alike letters of other scripts and digits that stand
for letters to Latin ones, ``l`` and ``1`` to ``i``, invisible characters dropped, everything between words to one space.

Learning, from labelled rows of a training fold only (labels and texts; no other column): a bounded sample of SAMPLE
rows, those with the smallest hashes of doc_id, of each distinct text one.  Entries are words and beginnings of words (``stem*``).
One is in the lexicon if its log-odds between toxic and clean texts are MIN_WEIGHT or more and so many toxic texts
have it that no clean entry would be expected to be in as many by chance; these odds are its weight.  A pair of
neighbouring words that holds a lexicon word and stands in clean texts at least as much as in toxic ones is an exception phrase: the
lexicon word does not count in it.  Two numbers per text, the sum of weights by length and its logarithm, go
through a logistic function fitted on the sample.

Every document is then matched whole, in one pass without a shuffle.

Cases: null and empty texts have no hit and score the base rate; equal ids and repeated rows are scored each; a label that is null,
or of no document, is not learned from; a doc_id labelled twice differently counts with both; without labels of both kinds the lexicon is empty
and all scores are 0; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vectext as vt
from .graphs import cut, smallest_hashes

SAMPLE, MIN_TEXTS, MIN_WEIGHT, MIN_CLEAN = 20_000, 4, 2.5, 5
STEMS = (4, 5, 6)

# Look-alike letters of other scripts, and digits and signs that stand for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "i", "һ": "h",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ɑ": "a", "ɡ": "g", "ı": "i", "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "i",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "l": "i",
}
INVISIBLE = "­​‌‍⁠﻿"


class _Folding(dict):
    """Translation that decides each code point once: letters and digits stay or are folded, marks go, the rest is a space."""

    def __missing__(self, code: int):
        c = chr(code)
        if c in LOOKALIKES:
            new = LOOKALIKES[c]
        elif c in INVISIBLE or unicodedata.combining(c):
            new = ""
        else:
            plain = "".join(x for x in unicodedata.normalize("NFKD", c).casefold() if not unicodedata.combining(x))
            new = "".join(LOOKALIKES.get(x, x) for x in plain) if c.isalnum() else " "
        self[code] = new
        return new


_FOLDING = _Folding()


def fold(text: str | None) -> str:
    return " ".join((text or "").translate(_FOLDING).split())


def lexicon_automaton(weights: dict[str, float], exceptions: set[str]) -> ahocorasick.Automaton:
    """Whole words, stems and phrases, with the spaces around them, so that no hit begins inside a word."""
    found = ahocorasick.Automaton()
    for word, weight in weights.items():
        if word.endswith("*"):
            found.add_word(f" {word[:-1]}", (len(word) - 2, weight))
        else:
            found.add_word(f" {word} ", (len(word), weight))
    for phrase in exceptions:
        found.add_word(f" {phrase} ", (len(phrase), None))
    if len(found):
        found.make_automaton()
    return found


def features(folded: str, found: ahocorasick.Automaton) -> tuple[float, float]:
    """Sum of the weights of hits outside exception phrases, of each word its largest: by length, and its logarithm."""
    hits: dict[int, float] = {}
    quiet = []
    if len(found):
        for end, (size, weight) in found.iter(f" {folded} "):
            if weight is None:
                quiet.append((end - size, end))
            else:
                hits[end - size] = max(weight, hits.get(end - size, 0.0))
    total = sum(w for at, w in hits.items() if not any(a <= at < b for a, b in quiet))
    return total / (folded.count(" ") + 20.0), math.log1p(total)


def entries(folded: str) -> set[str]:
    """The words of a text and their beginnings."""
    words = set(folded.split())
    return words | {f"{w[:n]}*" for w in words for n in STEMS if len(w) > n}


def _words_of(batches):
    """(word, toxic texts, clean texts) of a task's part of the sample."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            counts[toxic].update(entries(fold(text)))
    words = list(counts[1])  # a word in no toxic text cannot be in the lexicon; clean counts of the others follow
    rest = [w for w in counts[0] if w not in counts[1]]
    yield pa.record_batch(
        {
            "word": pa.array(words + rest, pa.string()),
            "bad": pa.array([counts[1][w] for w in words] + [0] * len(rest), pa.int64()),
            "good": pa.array([counts[0][w] for w in words + rest], pa.int64()),
        }
    )


def _pairs_of(weights: dict[str, float]):
    def run(batches):
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                words = fold(text).split()
                at = [i for i, w in enumerate(words) if any(x in weights for x in entries(w))]
                counts[toxic].update({f"{words[i]} {words[i + 1]}" for j in at for i in (j - 1, j) if 0 <= i < len(words) - 1})
        pairs = list(counts[0] | counts[1])
        yield pa.record_batch(
            {
                "pair": pa.array(pairs, pa.string()),
                "bad": pa.array([counts[1][p] for p in pairs], pa.int64()),
                "good": pa.array([counts[0][p] for p in pairs], pa.int64()),
            }
        )

    return vt.lean(run)


def _features_of(weights: dict[str, float], exceptions: set[str]):
    def run(batches):
        found = lexicon_automaton(weights, exceptions)
        for batch in batches:
            x = [features(fold(text), found) for text in batch.column("text").to_pylist()]
            yield pa.record_batch(
                {"a": pa.array([v[0] for v in x], pa.float64()), "b": pa.array([v[1] for v in x], pa.float64()), "toxic": batch.column("toxic").cast(pa.int32())}
            )

    return vt.lean(run)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Newton's method for a logistic function with a constant; ridge keeps separable data finite."""
    z = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(b)), z.T @ (y - p) - ridge * b)
        b += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return b


def learn(docs: DataFrame, labels: DataFrame, train, sample: int = SAMPLE) -> tuple[dict[str, float], set[str], list[float]]:
    """Lexicon weights, exception phrases and the logistic function's coefficients; all are bounded by the sample."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    rows = rows.where(F.col("toxic").isin(0, 1) & train).distinct()
    picked = smallest_hashes(rows, ["doc_id"], ["doc_id", "toxic"], sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = texts.join(F.broadcast(picked), "doc_id").where("text is not null")  # `sample` rows of two numbers
    chosen = cut(chosen.groupBy(F.xxhash64("text").alias("h"), "toxic").agg(F.min("text").alias("text")).select("text", "toxic"))
    bad, good = chosen.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))).first()
    if not bad or not good:
        return {}, set(), [-1e3, 0.0, 0.0]
    words = chosen.mapInArrow(_words_of, "word string, bad long, good long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    words = cut(words.where(F.col("bad") >= MIN_TEXTS).withColumn("odds", odds))
    # Of this many entries, one of a clean kind is in so many toxic texts and in no clean one with odds of a tenth at most.
    least = max(MIN_TEXTS, math.ceil(math.log(10 * max(1, words.count())) / -math.log(bad / (bad + good))))
    found = {r.word: (r.bad, r.odds) for r in words.where((F.col("bad") >= least) & (F.col("odds") >= MIN_WEIGHT)).collect()}
    # A stem that one longer entry accounts for says no more than that entry, and could hit other words.
    longer: dict[str, int] = {}
    for word, (n, _) in found.items():
        for size in STEMS:
            if len(word.rstrip("*")) > size:
                longer[f"{word[:size]}*"] = max(n, longer.get(f"{word[:size]}*", 0))
    weights = {word: odds for word, (n, odds) in sorted(found.items()) if longer.get(word, 0) < n}
    pairs = chosen.mapInArrow(_pairs_of(weights), "pair string, bad long, good long").groupBy("pair")
    pairs = pairs.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    exceptions = {r.pair for r in pairs.where((F.col("good") >= MIN_CLEAN) & (odds <= 0)).select("pair").collect()}
    x = chosen.mapInArrow(_features_of(weights, exceptions), "a double, b double, toxic int").collect()
    x = np.array(sorted(tuple(r) for r in x), float)  # in one order, for equal sums
    return weights, exceptions, fit_logistic(x[:, :2], x[:, 2]).tolist()


def score_toxicity(docs: DataFrame, model: tuple[dict[str, float], set[str], list[float]]) -> DataFrame:
    """``docs`` with doc_id and text to (doc_id, toxicity_score, hits), one row per row."""
    weights, exceptions, (b0, b1, b2) = model

    def run(batches):
        found = lexicon_automaton(weights, exceptions)
        for batch in batches:
            scores, sums = [], []
            for text in batch.column(1).to_pylist():
                a, b = features(fold(text), found)
                scores.append(1 / (1 + math.exp(-max(-700.0, min(700.0, b0 + b1 * a + b2 * b)))))
                sums.append(math.expm1(b))
            yield pa.record_batch({"doc_id": batch.column(0), "score": pa.array(scores, pa.float64()), "weight": pa.array(sums, pa.float64())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(vt.lean(run), "doc_id long, score double, weight double")


def drop_toxic(docs: DataFrame, labels: DataFrame, train=None) -> DataFrame:
    """``docs`` without the documents predicted to be toxic, scored in the same pass that filters them."""
    weights, exceptions, (b0, b1, b2) = learn(docs, labels, F.lit(True) if train is None else train)
    columns = docs.columns
    at = columns.index("text")

    def run(batches):
        found = lexicon_automaton(weights, exceptions)
        for batch in batches:
            keep = []
            for text in batch.column(at).to_pylist():
                a, b = features(fold(text), found)
                keep.append(b0 + b1 * a + b2 * b < 0)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(vt.lean(run), docs.schema)


def fold_of(doc_id, folds: int = 5):
    return F.crc32(doc_id.cast("string")) % folds


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held = F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False))
    scored = score_toxicity(docs, learn(docs, labels, ~held))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "weight")
