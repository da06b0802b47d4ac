"""Data inside other data: compressed blobs, lists in scripts, wrongly declared character sets."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


@pandas_udf(StringType())
def inflated(blobs: pd.Series) -> pd.Series:
    """Raw deflate to text; null for what is none.  Spark has no function for it."""

    def one(b):
        try:
            return zlib.decompress(bytes(b), -15).decode("utf-8") if b is not None else None
        except (zlib.error, UnicodeDecodeError):
            return None

    return blobs.map(one)


def blob_items(html: Column, name: str) -> Column:
    """The JSON array that a script holds as ``name = "base64 of raw deflate"``, as VARIANT."""
    found = F.regexp_extract(html, rf"""\b{name}\s*=\s*["']([A-Za-z0-9+/=]+)["']""", 1)
    return F.try_parse_json(inflated(F.unbase64(found)))


#: What stands between two equal quotes, passed as a whole: backslashes escape what follows them.
DOUBLE, SINGLE = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', r"'[^'\\]*+(?:\\.[^'\\]*+)*+'"


def script_list(html: Column, name: str) -> Column:
    """The array literal assigned to a variable, as VARIANT; null if it is no JSON.  It ends with the first ``];`` that is in no string."""
    return F.try_parse_json(F.regexp_extract(html, rf"""(?s)\b{name}\s*=\s*(\[(?:[^\]"']++|{DOUBLE}|{SINGLE}|\](?!\s*;))*+\])\s*;""", 1))


def unnest(df: DataFrame, items: Column, schema: str) -> DataFrame:
    """One row per element of a VARIANT array, with the fields of ``schema``."""
    return df.withColumn("_i", F.explode(F.try_variant_get(items, "$", f"array<struct<{schema}>>"))).select(*df.columns, "_i.*")


@pandas_udf(StringType())
def _by_charset(body: pd.Series, declared: pd.Series) -> pd.Series:
    def one(b, name):
        if b is None:
            return None
        for charset in (name, "windows-1252"):
            try:
                return bytes(b).decode(charset or "windows-1252")
            except (LookupError, UnicodeDecodeError):
                continue
        return bytes(b).decode("windows-1252", "replace")

    return pd.Series([one(b, n) for b, n in zip(body, declared, strict=True)])


def decoded(body: Column, declared: Column) -> Column:
    """Bytes as text: UTF-8 if they are, else the declared set if they are that, else Windows-1252.  Only bytes that are no UTF-8 leave the JVM."""
    utf8 = F.try_validate_utf8(body)
    return F.coalesce(utf8, _by_charset(F.when(utf8.isNull(), body), declared))


def script_html(html: Column, name: str) -> Column:
    """The HTML that a script holds as a quoted string, with its escapes undone; '' without one."""
    said = F.regexp_extract(html, rf"(?s)\b{name}\s*=\s*({DOUBLE}|{SINGLE})", 1)
    inner = F.regexp_replace(said, r"(?s)^.|.$", "")
    # A mark that no page holds stands for an escaped backslash while the other escapes are undone.
    lines = F.regexp_replace(F.replace(inner, F.lit("\\\\"), F.lit("\ufdd0")), r"\\n", "\n")
    return F.replace(F.regexp_replace(F.regexp_replace(lines, r"\\t", "\t"), r"(?s)\\(.)", "$1"), F.lit("\ufdd0"), F.lit("\\"))
