"""Settings trees: source defaults inherited by pages, flattened to a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.documents import drop_keys, overlay


def load(path: str) -> dict:
    """The settings tree of a YAML file (JSON is YAML, too); an empty file is an empty tree, anything but a mapping an error."""
    import yaml  # only who reads YAML needs the package

    with open(path, encoding="utf-8") as f:
        tree = yaml.safe_load(f) or {}
    if not isinstance(tree, dict):
        raise ValueError(f"{path} holds a {type(tree).__name__}, not a mapping")
    return tree


def registry(spark: SparkSession, settings: dict) -> DataFrame:
    """(source, page, config): each page with its source's settings, overlaid by its own."""
    flat = lambda tree: {k: str(v) for k, v in tree.items() if not isinstance(v, dict)}
    rows = [(name, flat(s), {p: flat(c or {}) for p, c in (s.get("pages") or {}).items()}) for name, s in settings.get("crawlers", {}).items()]
    df = spark.createDataFrame(rows, "source string, own map<string,string>, pages map<string,map<string,string>>")
    pages = df.select("source", "own", F.explode("pages").alias("page", "cfg"))
    return pages.select("source", "page", overlay(drop_keys(F.col("own"), "pages", "label"), F.col("cfg")).alias("config"))
