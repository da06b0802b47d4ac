"""Selection by key.  Frames have no order, so every operator takes the order that decides, and ``keep`` where both ends are asked for.

Selections that need one row per key are aggregates (max_by/min_by over a struct): they combine before the shuffle, so a hot key sends
one row from each task, where a window would bring all its rows together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup(df: DataFrame, keys: list[str], order: Column | list[Column], keep: str = "first") -> DataFrame:
    """One row per key: the first or last in ``order``."""
    order = F.struct(*order) if isinstance(order, list) else order
    rest = [c for c in df.columns if c not in keys]
    pick = F.min_by if keep == "first" else F.max_by
    one = df.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("_row"))
    return one.select(*keys, "_row.*").select(*df.columns)


def latest_version(df: DataFrame, keys: list[str], date: str, position: str) -> DataFrame:
    """The newest row per key; undated rows are oldest, of equal dates the first position stays."""
    return dedup(df, keys, F.struct(F.col(date).isNotNull(), F.col(date), -F.col(position)), "last")


def best_by(df: DataFrame, keys: list[str], scores: list[Column], position: Column) -> DataFrame:
    """The row with the greatest tuple of scores per key; of equals the first."""
    return dedup(df, keys, F.struct(*scores, -position), "last")


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """At most k rows per key.  Spark keeps only k per task before the shuffle (WindowGroupLimit)."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)


def counted_mode(df: DataFrame, keys: list[str], value: str, position: str) -> DataFrame:
    """The most frequent value per key with its count; of equals the one seen first."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("_first"))
    best = F.max_by(F.struct(F.col(value), F.col("n")), F.struct("n", -F.col("_first")))
    return counts.groupBy(*keys).agg(best.alias("_b")).select(*keys, F.col(f"_b.{value}").alias(value), F.col("_b.n").alias("n"))


def carry_forward(df: DataFrame, keys: list[str], order: list[Column], value: Column, name: str) -> DataFrame:
    """The last value that is not null, up to each row."""
    along = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(along))


def cap(df: DataFrame, position: str, n: int) -> DataFrame:
    """The first n rows in discovery order, whatever order follows."""
    return df.orderBy(position).limit(n)


def by_preference(df: DataFrame, keys: list[str], value: str, wanted: list[str], position: str) -> DataFrame:
    """Per key the row whose value comes first in a list of wanted ones, the rest after them; of equal ranks the first."""
    rank = F.coalesce(*[F.when(F.col(value) == w, F.lit(i)) for i, w in enumerate(wanted)], F.lit(len(wanted)))
    return dedup(df, keys, F.struct(rank, F.col(position)))
