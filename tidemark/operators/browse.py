"""Facets, search, sort, pages and export of a snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def search(df: DataFrame, source: str | None = None, text: str | None = None) -> DataFrame:
    """Rows of a source whose name or url holds the text, whatever the case."""
    if source:
        df = df.where(F.col("source") == source)
    if text:
        said = F.lower(F.concat(F.coalesce("name", F.lit("")), F.lit("\n"), F.coalesce("url", F.lit(""))))
        df = df.where(F.contains(said, F.lit(text.strip().lower())))
    return df


def as_read(column: str) -> Column:
    """A text as a key that sorts as readers expect: case and accents count only between texts that are equal without them; null is empty."""
    return F.collate(F.coalesce(F.col(column), F.lit("")), "UNICODE")


def ordered(df: DataFrame, by: str = "publish_date", descending: bool = True, read: bool = False) -> DataFrame:
    """Nulls lowest; the direction holds for the tie-break by url too.  ``read``: texts sort as readers expect, not by their bytes."""
    key, url = (as_read(by), as_read("url")) if read else (F.col(by), F.col("url"))
    return df.orderBy(key.desc_nulls_last(), url.desc()) if descending else df.orderBy(key.asc_nulls_first(), url.asc())


def page(df: DataFrame, number: int, size: int = 50) -> DataFrame:
    """A page of an ordered frame; a number out of range gives the nearest page."""
    pages = max(1, -(-df.count() // size))
    at = min(max(1, number), pages)
    return df.offset((at - 1) * size).limit(size)


def facets(df: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows per configured group, in the configured order, without empty ones; groups: (pos, id, label)."""
    counts = df.groupBy(F.col("source").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return groups.join(counts, "id").orderBy("pos").select("pos", "id", "label", "n")


def export_rows(df: DataFrame) -> DataFrame:
    """The seven columns of an export, in its order; nulls as empty texts, metadata as JSON text."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    domain = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    return df.select(text("name"), text("url"), domain.alias("domain"), text("source"), text("publish_date"), text("discovered_at_utc"), F.coalesce(F.to_json("meta"), F.lit("")).alias("meta_json"))
