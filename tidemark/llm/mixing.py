"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Targets: the word budget is ``ratio`` times all words.  It is shared by weight; a source's target stops at ``cap``
times its own words and the excess is shared again by weight.  The fixed point is a water level L with
target = min(cap * words, L * weight); sources are sorted by cap * words / weight, and L is the first level that does
not lift the source it is computed at above its cap, so no iteration is needed.

Sampling: every document of a source expects factor = target / words copies.  Documents are put in an order, their
expected copies are summed up along it, one random offset per source is added, and a document is emitted once for
each integer that its interval crosses.  The order is (band of size, hash of id): neighbours are alike in size, so the
words taken come near the target with a few documents too.

The running sum is not one window per source, which a hot source would put into one task.  Documents are dealt by
(source, band, first hex digits of the hash); a window numbers the documents within such a cell, and a window over the
table of cell counts gives the cell's start.  The counts are taken in a pass of their own and written.  Cells grow with the input only by 1/16**digits of a band.

Cases: null text has size 0; null sources are one source, last in order; a source without words has target 0 and is not
emitted; an empty table gives an empty result; equal ids are ordered by a hash of the text, and wholly equal rows are
interchangeable.  Input columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .graphs import cut
from .words import n_words

WEIGHTS = (5, 2, 1)
OUTPUT = ("size", "source_size", "target", "copies", "taken")


def _unit(text: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of the MD5 digest."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(per_source: DataFrame, weights: tuple[int, ...] = WEIGHTS, ratio: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, words) to (source, words, weight, target); one row per source, in a single small task."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    everything = Window.partitionBy(F.lit(0))
    by_cap = Window.partitionBy(F.lit(0)).orderBy("_room", F.col("source").asc_nulls_last())
    t = per_source.withColumn("_n", F.row_number().over(by_name))
    t = t.withColumn("weight", F.element_at(cycle, ((F.col("_n") - 1) % len(weights) + 1).cast("int")))
    t = t.withColumn("_cap", F.lit(cap) * F.col("words")).withColumn("_room", F.col("_cap") / F.col("weight"))
    before = F.coalesce(F.sum("_cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    t = t.withColumn("_rank", F.row_number().over(by_cap))
    t = t.withColumn("_level", (F.lit(ratio) * F.sum("words").over(everything) - before) / after)
    level = F.min_by("_level", F.when(F.col("_level") <= F.col("_room"), F.col("_rank"))).over(everything)
    t = t.withColumn("target", F.when(level.isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), level * F.col("weight"))))
    return t.select("source", "words", "weight", "target")


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, ratio: float = 1.5, cap: float = 2.0, seed: int = 7, digits: int = 2
) -> DataFrame:
    """Each row of ``docs`` with size, source_size, target, copies (how often the mix holds it) and taken = copies * size."""
    size = n_words(F.col("text"))
    d = docs.drop(*OUTPUT)
    kept = d.columns
    # All that is made of the text is made before the shuffle: a caller that does not ask for the text does not move it.
    d = d.withColumns(
        {
            "size": size,
            "_mx_band": F.floor(F.sqrt(size.cast("double"))),
            "_mx_hash": F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))),
            "_mx_tie": F.xxhash64("text"),
        }
    ).withColumn("_mx_sub", F.substring("_mx_hash", 1, digits))
    cell = ["source", "_mx_band", "_mx_sub"]
    cells = cut(d.groupBy(*cell).agg(F.count(F.lit(1)).alias("_mx_n"), F.sum("size").alias("_mx_words")))
    d = d.repartition(*cell)
    targets = source_targets(cells.groupBy("source").agg(F.sum("_mx_words").alias("words")), weights, ratio, cap)
    along = Window.partitionBy("source").orderBy("_mx_band", "_mx_sub").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = cells.withColumn("_mx_start", F.sum("_mx_n").over(along) - F.col("_mx_n")).drop("_mx_n", "_mx_words")
    start = start.withColumnRenamed("source", "_s")
    targets = targets.select(F.col("source").alias("_t"), F.col("words").alias("source_size"), "target")
    start = start.join(targets, F.col("_s").eqNullSafe(F.col("_t")))
    start = start.select(F.col("_s"), F.col("_mx_band").alias("_b"), F.col("_mx_sub").alias("_u"), "_mx_start", "source_size", "target")
    tie = [c for c in ("doc_id",) if c in kept]
    inside = Window.partitionBy(*cell).orderBy("_mx_hash", *tie, "_mx_tie")
    d = d.withColumn("_mx_rank", F.row_number().over(inside))
    joined = d.join(start, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_mx_band") == F.col("_b")) & (F.col("_mx_sub") == F.col("_u")))
    factor = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _unit(F.concat(F.lit(f"{seed}|"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))))
    at = F.col("_mx_start") + F.col("_mx_rank")
    copies = (F.floor(factor * at + offset) - F.floor(factor * (at - 1) + offset)).cast("long")
    return joined.withColumn("copies", copies).select(*kept, *OUTPUT[:4], (F.col("copies") * F.col("size")).alias("taken"))


def emit_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus itself: each document as often as it is taken, numbered by ``copy`` from 1."""
    mixed = mix_sources(docs.drop("copy"), **options).where(F.col("copies") > 0)
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, 'null')) AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS words FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight FROM s),
r AS (SELECT *, 2.0::DOUBLE * words AS room_words, 2.0::DOUBLE * words / weight AS room FROM w),
l AS (
  SELECT *, row_number() OVER o AS rk,
         (1.5::DOUBLE * sum(words) OVER () - coalesce(sum(room_words) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM r WINDOW o AS (ORDER BY room, source ASC NULLS LAST)),
f AS (SELECT level FROM l WHERE level <= room ORDER BY rk LIMIT 1),
t AS (SELECT source, words, CASE WHEN f.level IS NULL THEN room_words ELSE least(room_words, f.level * weight) END AS target
      FROM l LEFT JOIN f ON true),
p AS (
  SELECT d.doc_id, d.size, d.source, t.words AS source_size, t.target,
         row_number() OVER (PARTITION BY d.source ORDER BY floor(sqrt(d.size::DOUBLE)), d.h, d.doc_id) AS pos,
         CASE WHEN t.words > 0 THEN t.target / t.words ELSE 0 END AS factor,
         ('0x' || substr(md5('7|' || coalesce('s' || d.source, 'n')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (floor(factor * pos + u) - floor(factor * (pos - 1) + u))::BIGINT * size AS taken, source,
       (floor(factor * pos + u) - floor(factor * (pos - 1) + u))::BIGINT AS copies
FROM p
"""
