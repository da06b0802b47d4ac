"""Connected components of an edge table, and the checkpoint folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that is set, or the one in spark.checkpoint.dir; a temporary one only where neither is and Spark runs on one machine, as in tests."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return context._jsc.sc().getCheckpointDir().get()


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A setting of the session for what runs inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def tidy(spark: SparkSession):
    """Shuffle files go with the end of each action that runs inside."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def cut(df: DataFrame) -> DataFrame:
    """The table computed once and written to the shared folder.

    Its files stay until ``drop_cut``, or until the last reference goes if Spark is told so (spark.cleaner.referenceTracking.cleanCheckpoints)."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_cut(*tables: DataFrame) -> None:
    """Deletes the files of tables from ``cut`` that nothing reads any more; what was cut after them does not need them."""
    for df in tables:
        at = df._jdf.queryExecution().logical().rdd().getCheckpointFile().get()
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession, rows: int = 500):
    """Arrow batches of few rows for what runs inside: for tables whose rows are long."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def n_buckets(spark: SparkSession, values: int = 0, each: int = 250_000) -> int:
    """How many buckets hashed values are dealt to: four for each shuffle partition, and one for each ``each`` values.

    A unit sends a row to each bucket at most and one per value at most, so rows stay in proportion to the values."""
    return max(16, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")), values // each)


def smallest_hashes(rows: DataFrame, keys: list[str], ties: list[str], most: int) -> DataFrame:
    """The ``most`` rows with the smallest hashes of their keys: a sample that depends on nothing else.

    The rows are counted first, and all with hashes above the share that holds twice as many go before the sort, so what the last
    task gets does not grow with the number of tasks.  Should too few stay, as with few and often repeated keys, all are sorted."""
    place = F.shiftrightunsigned(F.xxhash64(*keys), 1)
    order = [place, *ties]
    n = rows.count()
    if n > 4 * most:
        few = rows.where(place < int(2 * most / n * 2**63))
        if few.count() >= most:
            rows = few
    return rows.orderBy(*order).limit(most)


def grouped_by(batches, keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows with equal first columns, without these; partitions are sorted by them."""
    at, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
            if row[:keys] != at and held:
                yield at, held
                held = []
            at = row[:keys]
            held.append(row[keys:])
    if held:
        yield at, held


def _flattened(batches):
    """Edges (u, v) of each batch to (node, smallest node that the batch's edges lead to): fewer edges and shorter paths between the same nodes."""
    for batch in batches:
        above: dict[int, int] = {}

        def top(x: int) -> int:
            while (y := above.setdefault(x, x)) != x:
                above[x] = x = above[y]
            return x

        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            u, v = top(u), top(v)
            above[max(u, v)] = min(u, v)
        found = [(x, top(x)) for x in above]
        yield pa.record_batch([pa.array([r[i] for r in found if r[0] != r[1]], pa.int64()) for i in (0, 1)], ["u", "v"])


def _are_stars(edges: DataFrame) -> bool:
    """Whether each u leads to one v alone, and no v leads on."""
    ends = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("low"), F.lit(False).alias("end")), F.struct(F.col("v").alias("node"), F.lit(None).cast("long").alias("low"), F.lit(True).alias("end")))
    nodes = edges.select(F.inline(ends)).groupBy("node").agg(F.min("low").alias("low"), F.max("low").alias("high"), F.max("end").alias("end"))
    with tidy(edges.sparkSession):
        return nodes.where("low < high or low is not null and end").agg(F.count(F.lit(1))).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """(u, v) edges of longs to (node, root): root is the smallest node reachable.

    Edges lead from the larger node to the smaller.  In each round first the smaller end gives way to the smallest that it leads to
    (large star), then all ends of a node are tied to its smallest (small star).  Each is a minimum per node, combined before the shuffle, and a join
    back, so no neighbour list is ever held in one row or task; the edge table is written once a round, and rounds end when it is a forest of stars."""
    edges = edges.where("u <> v").select("u", "v").mapInArrow(_flattened, "u long, v long")
    edges = cut(edges.distinct())
    while not _are_stars(edges):
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        large = edges.join(low.withColumnRenamed("u", "v"), "v", "left").select("u", F.coalesce("m", "v").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v"))))
        before, edges = edges, cut(large.join(low, "u").select(tied).where("u <> v").distinct())
        drop_cut(before)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
