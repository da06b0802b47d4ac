"""Snapshots: merge, delta, reconstruction and rebase.

A record's key is (source, url), both trimmed and not blank; ``payload`` is a hash of all its other columns.  All operators join or group on
the key alone, so tables written by ``bucketed`` need no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keyed import dedup

KEY = ["source", "url"]


def keyed(df: DataFrame) -> DataFrame:
    """Rows that have a key, with the key trimmed."""
    return df.withColumns({c: F.trim(c) for c in KEY}).where((F.col("source") != "") & (F.col("url") != ""))


def payload(df: DataFrame) -> Column:
    return F.sha2(F.to_json(F.struct(*sorted(c for c in df.columns if c not in KEY))), 256)


def merge(previous: DataFrame, fresh: DataFrame, succeeded: DataFrame, mode: str = "replace") -> DataFrame:
    """The next full snapshot.  ``replace``: sources that succeeded are carried by their fresh rows alone; ``upsert``: their earlier
    rows stay unless a fresh one has the key.  Of equal keys the last row (by ``ord`` if there is one) wins; fresh ones are last."""
    carried = previous.join(succeeded.select("source").distinct(), "source", "left_anti") if mode == "replace" else previous
    order = lambda df: F.col("ord") if "ord" in df.columns else F.lit(0)
    rows = carried.withColumn("_o", F.struct(F.lit(0).alias("a"), order(carried).alias("b")))
    rows = rows.unionByName(fresh.withColumn("_o", F.struct(F.lit(1).alias("a"), order(fresh).alias("b"))))
    return dedup(keyed(rows), KEY, F.col("_o"), "last").drop("_o")


def added(base: DataFrame, full: DataFrame) -> DataFrame:
    """Rows of ``full`` that the base lacks or has with another payload."""
    old = base.select(*KEY, payload(base).alias("_old"))
    return full.withColumn("_new", payload(full)).join(old, KEY, "left").where("_old IS NULL OR _old <> _new").drop("_old", "_new")


def removed(base: DataFrame, full: DataFrame) -> DataFrame:
    """Keys of the base that ``full`` lacks."""
    return base.select(*KEY).join(full.select(*KEY), KEY, "left_anti")


def reconstruct(base: DataFrame, plus: DataFrame, minus: DataFrame) -> DataFrame:
    """A day's snapshot: the base without what was removed, overlaid by what was added."""
    gone = minus.select(*KEY).union(plus.select(*KEY)).distinct()
    return base.join(gone, KEY, "left_anti").unionByName(plus)


def common_base(days: list[DataFrame]) -> DataFrame:
    """Rows that all days hold with one payload, in one grouping however many days there are."""
    rows = reduce(DataFrame.unionByName, [d.withColumns({"_day": F.lit(i), "_hash": payload(d)}) for i, d in enumerate(days)])
    both = rows.groupBy(*KEY, "_hash").agg(F.count_distinct("_day").alias("_n"), F.any_value(F.struct(*days[0].columns)).alias("_row"))
    return both.where(F.col("_n") == len(days)).select("_row.*")


def regrouped(days: list, plus: DataFrame, base: DataFrame | None = None, minus: DataFrame | None = None, day: str = "day") -> DataFrame:
    """(kind, day, record): the archive of some days anew, in one grouping by key, however many days there are.

    A day's snapshot is the base without the keys of ``minus`` and overlaid by ``plus``, both with ``day``; without a base, ``plus`` holds
    whole snapshots.  Rows that all days hold with one payload become ``base`` (their day is null), all others ``added`` of each day that
    has them.  Nothing is ever removed from such a base.  A key's group holds a row for each of its days and versions at most; of a day's
    repeated keys the row with the largest payload hash counts.  Only keys of ``days`` are kept."""
    columns = [c for c in plus.columns if c != day]
    row = F.struct(*columns)

    def part(df: DataFrame, kind: str, at: Column, held: bool) -> DataFrame:
        state = F.struct(payload(df.drop(day)).alias("hash"), row.alias("row")) if held else F.lit(None).cast(state_type)
        return df.select(*KEY, F.lit(kind).alias("_kind"), at.cast(day_type).alias("_day"), state.alias("_state"))

    day_type = plus.schema[day].dataType
    state_type = plus.select(F.struct(F.lit("").alias("hash"), row.alias("row")).alias("s")).schema["s"].dataType
    rows = part(plus, "plus", F.col(day), True)
    if base is not None:
        rows = rows.unionByName(part(base.select(*columns), "base", F.lit(None), True))
    if minus is not None:
        rows = rows.unionByName(part(minus, "minus", F.col(day), False))
    at = lambda kind, x: F.when(F.col("_kind") == kind, x)
    one = rows.groupBy(*KEY).agg(F.max(at("base", F.col("_state"))).alias("_base"), F.collect_list(at("plus", F.struct("_day", "_state"))).alias("_plus"), F.collect_set(at("minus", F.col("_day"))).alias("_minus"))
    of_day = lambda d: F.coalesce(F.array_max(F.transform(F.filter("_plus", lambda x: x["_day"] == d), lambda x: x["_state"])), F.when(~F.array_contains("_minus", d), F.col("_base")))
    states = F.transform(F.array(*[F.lit(d).cast(day_type) for d in days]), lambda d: F.struct(d.alias("day"), of_day(d).alias("state")))
    one = one.select(F.filter(states, lambda x: x["state"].isNotNull()).alias("_held"))
    shared = (F.size("_held") == len(days)) & (F.size(F.array_distinct(F.transform("_held", lambda x: x["state"]["hash"]))) == 1)
    said = lambda kind, d, x: F.struct(F.lit(kind).alias("kind"), d.alias(day), x["state"]["row"].alias("row"))
    first = F.get("_held", F.lit(0))
    out = F.when(shared, F.array(said("base", F.lit(None).cast(day_type), first))).otherwise(F.transform("_held", lambda x: said("added", x["day"], x)))
    return one.select(F.inline(out)).select("kind", day, "row.*")


def rebase(days: list[DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New base, and added and removed of all days (with ``day``): a base common to all days leaves nothing to remove."""
    rows = reduce(DataFrame.unionByName, [d.withColumn("day", F.lit(i)) for i, d in enumerate(days)])
    found = regrouped(list(range(len(days))), rows)
    minus = found.where("false").select(*KEY, "day")
    return found.where("kind = 'base'").drop("kind", "day"), found.where("kind = 'added'").drop("kind").select(*days[0].columns, "day"), minus


def bucketed(df: DataFrame, table: str, buckets: int) -> None:
    """Write so that joins and groupings on the key need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, *KEY).sortBy(*KEY).saveAsTable(table)
