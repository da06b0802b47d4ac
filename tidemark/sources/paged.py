"""Interfaces that are read page by page, by tasks: a Python data source over a range of pages, read in waves until they end."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..operators.numbering import cut

#: Pages of the first wave and of the largest.
FIRST, MOST = 16, 1024


class _Pages(InputPartition):
    def __init__(self, numbers: list[int]):
        self.numbers = numbers


class _Reader(DataSourceReader):
    def __init__(self, fetch, fields, first, last, tasks, wait):
        self.fetch, self.fields, self.numbers, self.tasks, self.wait = fetch, fields, list(range(first, last)), tasks, wait

    def partitions(self):
        return [_Pages(self.numbers[i :: self.tasks]) for i in range(min(self.tasks, len(self.numbers)))]

    def read(self, partition):
        for page in partition.numbers:
            time.sleep(self.wait)
            for pos, item in enumerate(self.fetch(page)):
                yield (page, pos, *(item.get(f) for f in self.fields))


def page_range(spark: SparkSession, fetch: Callable[[int], list[dict]], schema: str, first: int, last: int, tasks: int = 8, wait: float = 0.0) -> DataFrame:
    """(page, pos, fields of ``schema``) of the items of pages from ``first`` to before ``last``; each task reads every so many-th page."""
    fields = StructType.fromDDL(schema)

    class Source(DataSource):
        @classmethod
        def name(cls):
            return "tidemark_pages"

        def schema(self):
            return StructType([StructField("page", LongType()), StructField("pos", IntegerType()), *fields.fields])

        def reader(self, schema):
            return _Reader(fetch, fields.names, first, last, tasks, wait)

    spark.dataSource.register(Source)
    return spark.read.format("tidemark_pages").load()


def paged(spark: SparkSession, fetch: Callable[[int], list[dict]], schema: str, key: str, first: int = 1, expected: int | None = None, tasks: int = 8, wait: float = 0.0) -> DataFrame:
    """(page, pos, fields): each item of a paged interface once, where its key is met first, as a loop over the pages gives them.

    Reading ends with the first page that has no key that was not met before, as an empty or repeated one, or with the page that brings the
    ``expected`` number of keys.  Pages are read in waves, each twice as long as the one before, and a wave's pages by tasks at once; what a
    wave reads past the end is dropped.  A wave is written before it is judged, so no page is asked for again.  The driver sees how many new
    keys each page of a wave has, which is bounded by MOST.  Items without a key are left out.  ``fetch`` runs on executors: a page's
    number to its items; what it raises fails the task, and Spark tries that again."""
    waves, wave, at, got = [], FIRST, first, 0
    while True:
        rows = cut(page_range(spark, fetch, schema, at, at + wave, tasks, wait).where(F.col(key).isNotNull()))
        new = rows.join(reduce(DataFrame.union, [w.select(key) for w in waves]), key, "left_anti") if waves else rows
        new = new.groupBy(key).agg(F.min_by(F.struct(*rows.columns), F.struct("page", "pos")).alias("r")).select("r.*")
        sizes = dict(tuple(r) for r in new.groupBy("page").count().collect())
        last = None
        for page in range(at, at + wave):
            got += sizes.get(page, 0)
            if not sizes.get(page) or expected is not None and got >= expected:
                last = page
                break
        waves.append(cut(new if last is None else new.where(F.col("page") <= last)))
        if last is not None:
            return reduce(DataFrame.union, waves)
        at, wave = at + wave, min(2 * wave, MOST)
