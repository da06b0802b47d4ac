"""The archive on disk: a month's base and daily deltas, as Parquet folders.

``root/YYYY-MM/base-v1`` and ``root/YYYY-MM/days/DD/vN/{added,removed}`` with a small ``meta`` table beside each.  Nothing is changed in place: a
rebase writes base and deltas of all days as ``rebased-vN``, partitioned by kind and day, in one job, and readers take the version that
``meta`` names last, so a job that dies leaves the former state readable and is run again over its own remains.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import snapshots

META = "kind string, date string, version int, rows_added long, rows_removed long, seq long"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _meta(spark: SparkSession, month: str) -> list:
    if not _exists(spark, f"{month}/meta"):
        return []
    return sorted(spark.read.schema(META).json(f"{month}/meta").collect(), key=lambda r: r.seq)


def _note(spark: SparkSession, month: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, META).coalesce(1).write.mode("append").json(f"{month}/meta")


def _write_day(spark: SparkSession, month: str, date: str, version: int, base: DataFrame, full: DataFrame, seq: int) -> tuple:
    folder = f"{month}/days/{date[8:]}/v{version}"
    snapshots.added(base, full).write.mode("overwrite").parquet(f"{folder}/added")
    snapshots.removed(base, full).write.mode("overwrite").parquet(f"{folder}/removed")
    counts = [spark.read.parquet(f"{folder}/{k}").count() for k in ("added", "removed")]
    return ("day", date, version, *counts, seq)


def archive(spark: SparkSession, root: str, date: str, snapshot: DataFrame, refresh_day: int | None = None) -> str:
    """Archive a day's snapshot; returns what was done: skipped, base, delta or rebased.

    The month's first snapshot becomes its base.  Others are deltas against it; on ``refresh_day`` or later the month is rebased once."""
    month = f"{root}/{date[:7]}"
    meta = _meta(spark, month)
    if any(r.date == date and r.kind in ("day", "base") for r in meta):
        return "skipped"
    seq = meta[-1].seq + 1 if meta else 0
    if not meta:
        snapshots.keyed(snapshot).write.mode("overwrite").parquet(f"{month}/base-v1")
        base = spark.read.parquet(f"{month}/base-v1")
        _note(spark, month, [("base", date, 1, base.count(), 0, seq), _write_day(spark, month, date, 1, base, base, seq + 1)])
        return "base"
    version = max(r.version for r in meta if r.kind in ("base", "rebase"))
    base = _base(spark, month, version)
    _note(spark, month, [_write_day(spark, month, date, version, base, snapshots.keyed(snapshot), seq)])
    if refresh_day and int(date[8:]) >= refresh_day and not any(r.kind == "rebase" for r in meta):
        rebase(spark, root, date)
        return "rebased"
    return "delta"


def _base(spark: SparkSession, month: str, version: int) -> DataFrame:
    whole = f"{month}/rebased-v{version}"
    if _exists(spark, whole):
        return spark.read.parquet(whole).where("kind = 'base'").drop("kind", "day")
    return spark.read.parquet(f"{month}/base-v{version}")


def rebase(spark: SparkSession, root: str, date: str) -> None:
    """A new base of what all days of the month share, and all days' deltas against it, in one grouping of the present base and deltas."""
    month = f"{root}/{date[:7]}"
    meta = _meta(spark, month)
    held = {r.date: r.version for r in sorted((r for r in meta if r.kind == "day"), key=lambda r: r.seq)}
    version = max(r.version for r in meta if r.kind in ("base", "rebase"))
    if set(held.values()) != {version}:
        raise ValueError(f"{month} has days of several base versions")
    base = _base(spark, month, version)
    whole = f"{month}/rebased-v{version}"
    if _exists(spark, whole):
        plus, minus = [spark.read.parquet(whole).where("kind = 'added'").drop("kind").select(*base.columns, "day")], []
    else:
        plus, minus = [], []
    own = [d for d in sorted(held) if _exists(spark, f"{month}/days/{d[8:]}/v{version}")]
    for kind, parts in (("added", plus), ("removed", minus)):
        parts += [spark.read.parquet(f"{month}/days/{d[8:]}/v{version}/{kind}").withColumn("day", F.lit(int(d[8:]))) for d in own]
    of_all = lambda parts: reduce(DataFrame.unionByName, parts) if parts else None
    found = snapshots.regrouped([int(d[8:]) for d in sorted(held)], of_all(plus), base, of_all(minus))
    out = f"{month}/rebased-v{version + 1}"
    found.withColumn("day", F.coalesce("day", F.lit(0))).write.mode("overwrite").partitionBy("kind", "day").parquet(out)
    sizes = {(r.kind, r.day): r["count"] for r in spark.read.parquet(out).groupBy("kind", "day").count().collect()}
    seq = meta[-1].seq + 1
    rows = [("day", d, version + 1, sizes.get(("added", int(d[8:])), 0), 0, seq + 1 + i) for i, d in enumerate(sorted(held))]
    _note(spark, month, [("rebase", date, version + 1, sizes.get(("base", 0), 0), 0, seq), *rows])


def as_of(spark: SparkSession, root: str, date: str) -> DataFrame:
    """The snapshot of an archived day."""
    month = f"{root}/{date[:7]}"
    versions = [r.version for r in _meta(spark, month) if r.kind == "day" and r.date == date]
    if not versions:
        raise ValueError(f"{date} is not archived")
    version = max(versions)
    base, folder = _base(spark, month, version), f"{month}/days/{date[8:]}/v{version}"
    if _exists(spark, folder):
        plus, minus = (spark.read.parquet(f"{folder}/{k}") for k in ("added", "removed"))
        return snapshots.reconstruct(base, plus, minus)
    return base.unionByName(spark.read.parquet(f"{month}/rebased-v{version}").where((F.col("kind") == "added") & (F.col("day") == int(date[8:]))).drop("kind", "day"))


def days(spark: SparkSession, root: str, months: list[str]) -> list[str]:
    """All archived days of some months, newest first."""
    return sorted({r.date for m in months for r in _meta(spark, f"{root}/{m}") if r.kind == "day"}, reverse=True)
