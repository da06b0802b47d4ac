"""Numbers along an order, and exact ranks, without a task that sees all rows."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that is set, or the one in spark.checkpoint.dir; a temporary one only where neither is and Spark runs on one machine."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """The table, computed once and written to the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def numbered(df: DataFrame, order: list[str], name: str, start: int = 0) -> tuple[DataFrame, int]:
    """``df`` with numbers from ``start`` on along ``order``, and how many rows there are.

    Rows are sorted by ranges and written once with their place in their range; the ranges' sizes, one for each partition, are added up
    on the driver and give each range its first number.  Equal keys lie in one range, so keys should differ."""
    # Above 33 bits such an id is its partition's number, below them its place there.
    along = F.monotonically_increasing_id()
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut(spread.withColumn("_id", along).withColumns({"_part": F.shiftright("_id", 33).cast("int"), "_at": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_id"))
    sizes = sorted(tuple(r) for r in placed.groupBy("_part").count().collect())
    first, total = {}, start
    for part, n in sizes:
        first[part] = total
        total += n
    firsts = F.broadcast(df.sparkSession.createDataFrame(list(first.items()), "_part int, _before long"))
    return placed.join(firsts, "_part").withColumn(name, F.col("_before") + F.col("_at")).drop("_part", "_at", "_before"), total - start


def at_ranks(df: DataFrame, column: str, ranks: list[int], few: int = 10_000) -> list:
    """The values at some ranks (from 1 on) of a column's non-null values in order; ranks beyond the last are an error.

    Each pass counts the rows in ranges between approximate percentiles and keeps the one range that holds a rank, until that has ``few``
    rows at most or one value.  The driver sees counts per range and, at the end, the counts of those few values.  Runs jobs when called."""
    c = F.col(column)
    found = []
    for rank in ranks:
        rows, before = df.where(c.isNotNull()).select(column), 0
        while True:
            n, least, most = rows.agg(F.count(c), F.min(c), F.max(c)).first()
            if not 1 <= rank - before <= n:
                raise ValueError(f"there is no rank {rank}")
            if least == most:
                found.append(least)
                break
            if n <= few:
                for value, k in sorted(tuple(r) for r in rows.groupBy(column).count().collect()):
                    before += k
                    if before >= rank:
                        found.append(value)
                        break
                break
            bounds = sorted(set(rows.select(F.percentile_approx(c, F.array(*[F.lit(i / 64) for i in range(1, 64)]), 10_000)).first()[0]) - {most})
            bounds = bounds or [least]
            place = F.size(F.filter(F.lit(bounds), lambda b: b < c))  # ranges are closed at their upper end
            sizes = dict(tuple(r) for r in rows.groupBy(place).count().collect())
            k = 0
            while before + sizes.get(k, 0) < rank:
                before += sizes.get(k, 0)
                k += 1
            rows = rows.where(c > F.lit(bounds[k - 1])) if k else rows
            rows = rows.where(c <= F.lit(bounds[k])) if k < len(bounds) else rows
    return found

