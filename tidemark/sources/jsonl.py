"""JSON lines: tolerant scan, scan with line numbers and errors, sorted sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.documents import is_object, parsed
from ..functions.text import clean_text
from ..operators.combine import small
from ..operators.numbering import cut

ENVELOPE = ("url", "name", "discovered_at_utc", "publish_date", "source", "source_id")


def numbered_lines(spark: SparkSession, path: str, split_bytes: int | None = None, across: bool = False) -> DataFrame:
    """(file, line_no, raw): all lines with their numbers, from 1 in each file, or through all files in the order of their paths (``across``).

    Files are read by splits.  A first pass counts the lines of each split, the counts are summed up along a file, and the second pass adds
    a line's place in its split.  So that both passes meet the same splits, they depend on the files and the split size alone, not on how
    many executors there are: the scan has a session of its own, in which that is set.  Counts are written once, one row for each split."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    if split_bytes:
        own.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    rows = own.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_id"), F.col("value").alias("raw"))
    splits = cut(rows.groupBy("file", "_split").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first")))
    before = Window.partitionBy("file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1
    found = splits.select("file", "_split", shift.alias("_shift"))
    if across:  # one row for each file, which the driver lists anyway
        files = splits.groupBy("file").agg(F.sum("_n").alias("_n"))
        files = files.select("file", F.coalesce(F.sum("_n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
        found = found.join(files, "file").select("file", "_split", (F.col("_shift") + F.col("_before")).alias("_shift"))
    return rows.join(small(found), ["file", "_split"]).select("file", (F.col("_id") + F.col("_shift")).alias("line_no"), "raw")


def scan(spark: SparkSession, path: str, split_bytes: int | None = None, across: bool = False) -> DataFrame:
    """(file, line_no, raw, rec, error): all lines that are not blank, rec as VARIANT; numbers as ``numbered_lines`` gives them."""
    rows = numbered_lines(spark, path, split_bytes, across).where(clean_text(F.col("raw")) != "").withColumn("rec", parsed(F.col("raw")))
    opens = F.regexp_replace("raw", r"^[\ufeff\s]+", "").startswith("{")  # JSON that begins so is an object
    bad = F.when(F.col("rec").isNull(), "no JSON").when(~opens, "no object")
    return rows.select("file", "line_no", "raw", "rec", bad.alias("error"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """The envelope's columns and meta as VARIANT of all lines that hold an object; others are skipped."""
    rec = spark.read.text(path).select(parsed(F.col("value")).alias("r")).where(is_object(F.col("r")))
    columns = [F.try_variant_get("r", f"$.{c}", "string").alias(c) for c in ENVELOPE]
    return rec.select(*columns, F.try_variant_get("r", "$.meta", "variant").alias("meta"))


def write(df: DataFrame, path: str, order: tuple[str, ...] = ("url", "source")) -> int:
    """One object a line, keys and lines sorted; returns how many.  Ranges are written in order: part files follow each other."""
    keys = [F.coalesce(c, F.lit("")) for c in order if c in df.columns]
    rows = df.orderBy(*keys) if keys else df
    rows.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)
    return df.sparkSession.read.text(path).count()


def write_csv(df: DataFrame, path: str) -> None:
    """RFC 4180 quoting, a header and a byte-order mark, for spreadsheets; rows keep their order."""
    quoted = [F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in df.columns]
    plain = [F.when(F.coalesce(F.col(c).cast("string"), F.lit("")).rlike('[",\r\n]'), q).otherwise(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c, q in zip(df.columns, quoted, strict=True)]
    head = df.sparkSession.createDataFrame([("﻿" + ",".join(df.columns),)], "value string")
    # A union keeps the order of its parts: the header is the first part file, the rows' files follow in the order that they have.
    lines = head.coalesce(1).union(df.select(F.concat_ws(",", *plain).alias("value")))
    lines.write.mode("overwrite").option("lineSep", "\r\n").text(path)
