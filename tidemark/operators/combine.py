"""Joins with the fallbacks that link catalogues need."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a side that is broadcast by hint; a larger one is left to the planner.
SMALL = 100_000


def small(df: DataFrame, most: int = SMALL) -> DataFrame:
    """Broadcast a lookup table if a count says that it is small."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def lookup(df: DataFrame, table: DataFrame, key: str, table_key: str, value: str, default: Column, name: str) -> DataFrame:
    """A label for each row; what the table does not know gets the default."""
    found = small(table.select(F.col(table_key).alias("_k"), F.col(value).alias("_v")))
    return df.join(found, F.col(key) == F.col("_k"), "left").withColumn(name, F.coalesce("_v", default)).drop("_k", "_v")


def starts_with_any(df: DataFrame, column: str, prefixes: DataFrame, prefix: str, anti: bool = False) -> DataFrame:
    """Rows whose value starts with some prefix of a table, or with none.  Prefixes are grouped by length and each length is an
    equality join on that many characters: a row goes to the first length that fits, so none is doubled and no nested loop compares all with all."""
    lengths = [r[0] for r in prefixes.select(F.length(prefix)).distinct().collect()]
    p = prefixes.select(F.col(prefix).alias("_p")).distinct()
    inside, rest = [], df
    for n in sorted(lengths):
        own = small(p.where(F.length("_p") == n).select(F.col("_p").alias("_sw_prefix")))
        hit = F.left(F.col(column), F.lit(n)) == F.col("_sw_prefix")
        inside.append(rest.join(own, hit, "left_semi"))
        rest = rest.join(own, hit, "left_anti")
    return rest if anti else reduce(DataFrame.union, inside) if inside else df.limit(0)


def lookup_chain(df: DataFrame, tables: list[tuple[DataFrame, str, str]], keys: list[Column], name: str) -> DataFrame:
    """The first of several lookups that knows its key."""
    out, found = df, []
    for i, ((table, k, v), key) in enumerate(zip(tables, keys, strict=True)):
        out = out.join(small(table.select(F.col(k).alias(f"_k{i}"), F.col(v).alias(f"_v{i}"))), key == F.col(f"_k{i}"), "left")
        found.append(F.col(f"_v{i}"))
    drop = [f"_{x}{i}" for i in range(len(tables)) for x in "kv"]
    return out.withColumn(name, F.coalesce(*found)).drop(*drop)


def pair_languages(en: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Both sides by key, with which of them there are."""
    a, b = en.select(*keys, F.col("text").alias("en")), other.select(*keys, F.col("text").alias("other"))
    has = F.when(F.col("en").isNull(), "other").when(F.col("other").isNull(), "en").otherwise("both")
    return a.join(b, keys, "full").withColumn("has", has)


def or_parent(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """The children, and each parent without any."""
    return children.unionByName(parents.join(children.select(key), key, "left_anti"))


def union_first(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """All rows of all frames; of equal keys that of the first frame, by ``pos`` within it."""
    from .keyed import dedup

    marked = [f.withColumn("_frame", F.lit(i)) for i, f in enumerate(frames)]
    return dedup(reduce(DataFrame.unionByName, marked), keys, F.struct("_frame", "pos")).drop("_frame")
