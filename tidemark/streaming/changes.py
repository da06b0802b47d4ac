"""A change feed of snapshots: day deltas as they arrive, each key once within the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "source string, url string, op string, payload string, at timestamp"


def feed(spark: SparkSession, folder: str, delay: str = "2 days") -> DataFrame:
    """Changes from Parquet files that land in a folder; a change seen again within the delay is dropped."""
    changes = spark.readStream.schema(SCHEMA).parquet(folder).withWatermark("at", delay)
    return changes.dropDuplicatesWithinWatermark(["source", "url", "op", "payload"])


def counts(changes: DataFrame, window: str = "1 day") -> DataFrame:
    """Changes per source, operation and window, once the watermark has passed."""
    return changes.groupBy(F.window("at", window), "source", "op").agg(F.count(F.lit(1)).alias("n"))


def apply_to(changes: DataFrame, table: str, checkpoint: str, once: bool = True):
    """Keep a table of the current state: each batch is written as a new version beside the old, which readers swap to."""

    def step(batch: DataFrame, number: int) -> None:
        from ..operators.keyed import dedup

        spark = batch.sparkSession
        new = dedup(batch.select("source", "url", "op", "payload", "at"), ["source", "url"], F.struct("at", "op"), "last")
        try:
            old = spark.read.parquet(f"{table}/v{number - 1}")
        except Exception as e:  # the first batch has nothing before it
            if "PATH_NOT_FOUND" not in str(e):
                raise
            old = new.limit(0).drop("op")
        kept = old.join(new.select("source", "url"), ["source", "url"], "left_anti")
        kept.unionByName(new.where("op <> 'removed'").drop("op")).write.mode("overwrite").parquet(f"{table}/v{number}")

    writer = changes.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
