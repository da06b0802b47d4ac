"""Expressions on JSON text and on records' metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

#: Type names of the profile.
KINDS = {"VOID": "null", "BOOLEAN": "bool", "BIGINT": "int", "DOUBLE": "float", "STRING": "str"}


def parsed(text: Column) -> Column:
    """JSON text as VARIANT; null if it is no JSON (also for repeated keys)."""
    return F.try_parse_json(F.regexp_replace(F.trim(text), "^\\uFEFF", ""))


def is_object(variant: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(variant), F.lit("OBJECT")), F.lit(False))


def value_type(variant: Column) -> Column:
    """null, bool, int, float, str, object or array; the schema that tells it is read once."""

    def named(schema: Column) -> Column:
        found = F.when(F.startswith(schema, F.lit("OBJECT")), "object").when(F.startswith(schema, F.lit("ARRAY")), "array")
        found = found.when(F.startswith(schema, F.lit("DECIMAL")), "float")
        for schema_name, name in KINDS.items():
            found = found.when(schema == schema_name, name)
        return found

    return let(F.schema_of_variant(variant), named)


def key_signature(text: Column) -> Column:
    """The sorted keys of a JSON object, joined by commas."""
    return F.array_join(F.array_sort(F.json_object_keys(text)), ",")


def drop_keys(meta: Column, *keys: str) -> Column:
    return F.map_filter(meta, lambda k, _: ~k.isin(*keys))


def overlay(base: Column, top: Column) -> Column:
    """All keys of both maps; ``top`` wins."""
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(top, k)), top)


def localized(values: Column, locale: str) -> Column:
    """A map's value for a locale, else the English one; blank and N/A count as absent."""
    pick = lambda k: F.when(~F.upper(F.trim(values[k])).isin("", "N/A", "NA"), F.trim(values[k]))
    return F.coalesce(pick(locale), pick("en"))
