"""Document fingerprints by winnowing: of every window of consecutive k-gram hashes the smallest is kept, of equal ones the rightmost.

A text of n code points has n - k + 1 grams; a shorter one has itself as its only gram, an empty one none.  Hashes roll: those of a whole
batch are differences of running sums.  A window is ``w`` grams (all of them in a text that has fewer).  Any passage of k + w - 1 code
points that two texts share leaves them a common hash, and none shorter than k does; kept positions tell where.

A fingerprint is a string of records of 18 hexadecimal digits: 8 of the position (in code points from 0), 10 of the hash, by position.
The likeness of two is the share of common hashes among all that either has (Jaccard); two empty ones are alike (1).

Cases: a null text is empty; equal texts have equal fingerprints; texts of any length are read whole; repeated rows are each a row.  The
next document is the next row by (doc_id, text), null ids first, and after the last one the first; a single row is its own next.
Empty tables give empty results; only the columns named are kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import vectext as vt
from .graphs import n_buckets

#: Code points of a gram, grams of a window: passages of 87 code points are found, none shorter than 24.
GRAM, WINDOW = 24, 64
#: Bits of a hash; the rest of 64 holds the position within a run, so that equal hashes order by it.
BITS = 40
RUN = 1 << 22
#: No code point: fills up texts that are shorter than a gram or a window.
FILL = 0x110000
RECORD = 18


def _keys(codes: np.ndarray, k: int) -> np.ndarray:
    """The hashes of all k-grams, the upper BITS of 64."""
    return vt.ngrams(vt.mix(codes.astype(np.uint64) + vt.U(1)), k) >> vt.U(64 - BITS)


def _least(keys: np.ndarray, w: int) -> np.ndarray:
    """Smallest key of each w consecutive ones: running minima from both ends of blocks of w meet in every window."""
    m = len(keys)
    blocks = np.full(-(-m // w) * w, np.iinfo(np.uint64).max, np.uint64)
    blocks[:m] = keys
    blocks = blocks.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: m - w + 1], ahead[w - 1 : m])


def winnowed(texts: list[str], k: int = GRAM, w: int = WINDOW) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, hashes) of each text, by position."""
    least, most = k + w - 1, np.iinfo(np.uint64).max
    sizes = np.array([len(t) for t in texts], np.int64)
    slots = np.where(sizes > 0, np.maximum(sizes, least), 0)
    begins = np.concatenate([[0], np.cumsum(slots)])
    codes = np.full(begins[-1], FILL, np.uint32)
    for t, at, n in zip(texts, begins, sizes, strict=False):
        codes[at : at + n] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    found: list[list[np.ndarray]] = [[] for _ in texts]
    if len(codes):
        hashes = _keys(codes, k)
        real = np.zeros(len(hashes), bool)  # grams that begin in a text and end in it
        for at, n in zip(begins, sizes, strict=False):
            if n:
                real[at : at + max(1, n - k + 1)] = True
        for low in range(0, len(hashes) - w + 1, RUN):  # windows that begin in this run
            own = hashes[low : low + RUN + w - 1]
            place = np.arange(len(own), dtype=np.uint64)
            keys = np.where(real[low : low + RUN + w - 1], own << vt.U(64 - BITS) | (vt.U((1 << 64 - BITS) - 1) - place), most)
            picked = low + (vt.U((1 << 64 - BITS) - 1) - (_least(keys, w) & vt.U((1 << 64 - BITS) - 1))).astype(np.int64)
            first, last = np.searchsorted(begins, [low, low + len(picked)], "left")
            for i in range(max(0, first - 1), min(len(texts), last)):
                a, b = max(begins[i] - low, 0), min(begins[i + 1] - least + 1 - low, len(picked))
                if sizes[i] and a < b:
                    found[i].append(picked[a:b])
    out = []
    for i, parts in enumerate(found):
        at = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        if len(at):
            at = at[np.concatenate([[True], np.diff(at) != 0])]  # windows move right, and so do the places they keep
        out.append((at - begins[i], hashes[at] if len(at) else np.zeros(0, np.uint64)))
    return out


def written(positions: np.ndarray, hashes: np.ndarray) -> str:
    raw = np.zeros((len(positions), 9), np.uint8)
    raw[:, :4] = positions.astype(">u4").view(np.uint8).reshape(-1, 4)
    raw[:, 4:] = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:]
    return raw.tobytes().hex()


def alike(a: np.ndarray, b: np.ndarray) -> float:
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def fingerprints(docs: DataFrame, keep: list[str], texts: dict[str, str], pairs: dict[str, tuple[str, str]], k: int = GRAM, w: int = WINDOW, most: int = 1 << 20) -> DataFrame:
    """``keep``, a fingerprint of each text column of ``texts`` (column -> name) and the likeness of each pair of text columns (name -> two).

    A text that stands in several columns or rows of a run, as one that is also its neighbour's next, is fingerprinted once."""
    columns = list(dict.fromkeys([*texts, *(c for p in pairs.values() for c in p)]))
    where = {c: i for i, c in enumerate(columns)}
    kinds = docs.select(*keep).schema

    @vt.lean
    def run(batches):
        for batch in batches:
            for part in vt.pieces(batch, columns[0], most):
                values = [part.column(len(keep) + i).fill_null("").to_pylist() for i in range(len(columns))]
                number: dict[str, int] = {}
                at = [[number.setdefault(t, len(number)) for t in v] for v in values]
                marks = winnowed(list(number), k, w)
                lines: dict[int, str] = {}
                said = lambda j: lines[j] if j in lines else lines.setdefault(j, written(*marks[j]))  # noqa: B023, E731
                out = [part.column(i) for i in range(len(keep))]
                out += [pa.array([said(j) for j in at[where[c]]], pa.large_string()).cast(pa.string()) for c in texts]
                out += [pa.array([alike(marks[i][1], marks[j][1]) for i, j in zip(at[where[a]], at[where[b]], strict=True)], pa.float64()) for a, b in pairs.values()]
                yield pa.record_batch(out, [*keep, *texts.values(), *pairs])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds), *(f"`{n}` string" for n in texts.values()), *(f"`{n}` double" for n in pairs)])
    return docs.select(*keep, *columns).mapInArrow(run, schema)


def with_next(docs: DataFrame, key: str, text: str, name: str) -> DataFrame:
    """(key, text) with the next row's text, by (key, text), and the first one's after the last.

    Rows are dealt to ranges of the key; bounds and smallest keys of the ranges are all that the driver sees, and their number is that of
    shuffle partitions, not of rows.  The row with the smallest key of a range goes as a guest to the range before too, so each range
    knows its rows' next ones, and texts are shuffled once.  Rows of one key lie in one range."""
    spark, rows = docs.sparkSession, docs.select(F.col(key).cast("long").alias("_k"), F.col(text).alias("_t"))
    n = n_buckets(spark)
    bounds = rows.select(F.percentile_approx("_k", F.array(*[F.lit(i / n) for i in range(1, n)]), 10 * n)).first()[0]
    bounds = np.array(sorted(set(bounds or [])), np.int64)

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.fillna(np.iinfo(np.int64).min).to_numpy().astype(np.int64), "left"))

    known = F.coalesce("_k", F.lit(np.iinfo(np.int64).min)).alias("_k")
    firsts = sorted(tuple(r) for r in rows.select(place(known).alias("_range"), known).groupBy("_range").agg(F.min("_k")).collect())
    before = [(k, firsts[i - 1][0]) for i, (_, k) in enumerate(firsts)]
    guests = spark.createDataFrame(before, "_first long, _before int")
    ranged = rows.withColumns({"_key": F.coalesce("_k", F.lit(np.iinfo(np.int64).min))}).withColumn("_range", place(F.col("_key")))
    twice = ranged.join(F.broadcast(guests), F.col("_key") == F.col("_first"), "left")
    own, guest = F.struct(F.col("_range").alias("at"), F.lit(False).alias("guest")), F.struct(F.col("_before").alias("at"), F.lit(True).alias("guest"))
    twice = twice.select("_k", "_key", "_t", F.inline(F.when(F.col("_first").isNull(), F.array(own)).otherwise(F.array(own, guest))))
    order = Window.partitionBy("at").orderBy("guest", "_key", "_t")
    found = twice.withColumn("_next", F.lead("_t").over(order)).where("not guest")
    return found.select(F.col("_k").alias(key), F.col("_t").alias(text), F.col("_next").alias(name))


def tail_replaced(text: Column, other: Column, parts: int = 4) -> Column:
    """The last 1 / parts of the code points, rounded down, replaced by as many first ones of another text, or all that it has."""
    n = F.floor(F.length(text) / parts).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - n), F.substring(other, F.lit(1), n))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs, "doc_id", "text", "next").withColumn("edited", tail_replaced(F.col("text"), F.col("next")))
    rows = rows.withColumns({"n_chars": F.length("text").cast("long"), "edited_sha256": F.sha2("edited", 256)})
    texts = {"text": "fingerprint", "edited": "edited_fingerprint"}
    return fingerprints(rows, ["doc_id", "n_chars", "edited_sha256"], texts, {"near_edited": ("text", "edited"), "near_next": ("text", "next")})
