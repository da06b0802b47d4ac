"""Search through nested JSON of any depth, by Spark's own expressions: a level of nodes is exploded to the next until none is left."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.documents import is_object, parsed


def nodes(df: DataFrame, keys: list[str], json: str) -> DataFrame:
    """(keys, parent, path, key, node): every node of a column of JSON texts as VARIANT, the root with path ``$`` and no parent.

    ``key`` is a member's name, null for the root and for items of lists.  Texts that are no JSON, or repeat a key, give no row.  All is
    one narrow plan with a branch for each level that the texts have; one pass over them, when this is called, finds how many.  Plain values
    explode to nothing, so they need no test."""
    spark, own = df.sparkSession, [f"_k{i}" for i in range(len(keys))]
    none = F.lit(None).cast("string")
    level = df.select(*[F.col(k).alias(o) for k, o in zip(keys, own, strict=True)], none.alias("parent"), F.lit("$").alias("path"), none.alias("name"), parsed(F.col(json)).alias("node")).where("node is not null")
    levels = [level]
    while True:
        inside = level.select(*own, F.col("path").alias("parent"), F.col("node").alias("_node"))
        step = F.when(F.col("key").isNull(), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]"))).otherwise(F.concat(F.lit("."), "key"))
        level = inside.lateralJoin(spark.tvf.variant_explode(F.col("_node").outer())).select(*own, "parent", F.concat("parent", step).alias("path"), F.col("key").alias("name"), F.col("value").alias("node"))
        if level.isEmpty():
            break
        levels.append(level)
    every = reduce(DataFrame.union, levels)
    return every.select(*[F.col(o).alias(k) for k, o in zip(keys, own, strict=True)], "parent", "path", F.col("name").alias("key"), "node")


def members(df: DataFrame, keys: list[str], json: str) -> DataFrame:
    """(keys, path, key, value): each member of each object at any depth, with the path to its object and its value as JSON text."""
    return nodes(df, keys, json).where("key is not null").select(*keys, F.col("parent").alias("path"), "key", F.to_json("node").alias("value"))


def holds_object(node: Column, name: str) -> Column:
    """Is a node an object that has an object under some name?"""
    return is_object(F.try_variant_get(node, f"$.{name}", "variant"))
