"""The archive's files: index, manifest and the newest snapshot."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Two layouts: one full file a day, or a month's base with a day's added and removed.
FULL_DAY = r"/(\d{4})/(\d{2})/(\d{2})/urls\.jsonl$"
DELTA_DAY = r"/(\d{4}-\d{2})/days/(\d{2})/(added|removed)\.jsonl$"


#: Bytes of a file that are held at a time.
CHUNK = 8 << 20


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes) of all files below a folder; no content is read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("bytes"))


def opened(path: str):
    """(file system, path there) of a path as Spark writes it: local files, and the stores that Arrow knows."""
    local = re.sub("^file:/+", "/", path)
    return (LocalFileSystem(), local) if local.startswith("/") else FileSystem.from_uri(path)


def _digests(batches):
    for batch in batches:
        found = []
        for path in batch.column(0).to_pylist():
            store, at = opened(path)
            digest = hashlib.sha256()
            with store.open_input_stream(at) as f:
                while piece := f.read(CHUNK):
                    digest.update(piece)
            found.append(digest.hexdigest())
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found, pa.string())], ["path", "bytes", "sha256"])


def files(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes, sha256) of all files below a folder: files of any size, read by the tasks in pieces of a few MB.

    The store must be one that Arrow can open from its url: a shared folder, HDFS, S3 or GCS."""
    return listing(spark, root).mapInArrow(_digests, "path string, bytes long, sha256 string")


def index(listing: DataFrame) -> DataFrame:
    """(date, format, bytes, paths) of each archived day, newest first; listing: (path, bytes)."""
    p = F.col("path")
    full = listing.where(p.rlike(FULL_DAY)).select(F.concat_ws("-", *[F.regexp_extract(p, FULL_DAY, i) for i in (1, 2, 3)]).alias("date"), F.lit("full").alias("format"), "bytes", "path")
    day = F.concat_ws("-", F.regexp_extract(p, DELTA_DAY, 1), F.regexp_extract(p, DELTA_DAY, 2))
    delta = listing.where(p.rlike(DELTA_DAY)).select(day.alias("date"), F.lit("delta").alias("format"), "bytes", "path")
    days = full.unionByName(delta).groupBy("date", "format").agg(F.sum("bytes").alias("bytes"), F.array_join(F.sort_array(F.collect_list("path")), ",").alias("paths"))
    return days.orderBy(F.desc("date"), "format")


def newest(listing: DataFrame) -> DataFrame:
    """The newest day that can be read; of one day the delta before the full file."""
    return index(listing).orderBy(F.desc("date"), F.col("format") != "delta").limit(1)


def manifest(listing: DataFrame, rows: DataFrame) -> DataFrame:
    """Outputs with bytes and digest, and their rows (path, rows) where these are known."""
    return listing.join(rows, "path", "left").select("path", "rows", "bytes", "sha256").orderBy("path")
