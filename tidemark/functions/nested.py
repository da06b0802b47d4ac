"""Expressions on nested JSON fields, lists and maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import publish_date
from .documents import is_object, parsed, value_type


def as_list(variant: Column) -> Column:
    """A string or a list of strings as a list of trimmed, non-blank strings; [] for anything else."""
    one = F.array(F.try_variant_get(variant, "$", "string"))
    many = F.try_variant_get(variant, "$", "array<string>")
    found = F.when(value_type(variant) == "array", many).when(value_type(variant) == "str", one).otherwise(F.array().cast("array<string>"))
    return F.filter(F.transform(F.coalesce(found, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))


#: Lists in lists are followed so deep; what lies deeper is left out.
DEEPEST = 4


def texts_of(variant: Column, *keys: str, deep: int = DEEPEST) -> Column:
    """Texts of a string or number, of an object's first member of some names (``value``, ``en``), and of all members of a list, in order."""
    keys = keys or ("value", "en")
    none = F.array().cast("array<string>")
    kind = value_type(variant)
    found = F.when(kind.isin("str", "int", "float", "bool"), F.array(F.try_variant_get(variant, "$", "string")))
    if deep:
        inside = F.coalesce(*[F.try_variant_get(variant, f"$.{k}", "variant") for k in keys])
        found = found.when(kind == "object", _texts_in(inside, keys, deep)).when(kind == "array", F.flatten(F.transform(F.try_variant_get(variant, "$", "array<variant>"), lambda x: texts_of(x, *keys, deep=deep - 1))))
    return F.filter(F.transform(F.coalesce(found, none), lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))


def _texts_in(variant: Column, keys: tuple[str, ...], deep: int) -> Column:
    """A member of an object: a plain value, or a list of these."""
    kind = value_type(variant)
    plain = lambda v: F.when(value_type(v).isin("str", "int", "float", "bool"), F.try_variant_get(v, "$", "string"))
    return F.when(kind == "array", F.transform(F.try_variant_get(variant, "$", "array<variant>"), plain)).otherwise(F.array(plain(variant)))


def localized_text(variant: Column, locale: str) -> Column:
    """A field's texts in a locale, joined: a plain text stands for all locales, an object for what its member of that name says."""
    return F.array_join(texts_of(variant, locale), " ; ")


def joined_text(variant: Column, *keys: str) -> Column:
    return F.array_join(texts_of(variant, *keys), " ; ")


def first_date(variant: Column, *keys: str) -> Column:
    """The first of a field's texts that is a date."""
    return F.get(F.filter(F.transform(texts_of(variant, *keys), publish_date), lambda d: d.isNotNull()), F.lit(0))


def first_text(variant: Column) -> Column:
    """The string itself, or the first of a list."""
    return F.get(as_list(variant), F.lit(0))


def languages(variant: Column, keys: tuple[str, ...] = ("en", "tc")) -> Column:
    """A document of several languages as [(lang, url)], without those it lacks."""
    found = F.array(*[F.struct(F.lit(k).alias("lang"), F.try_variant_get(variant, f"$.{k}", "string").alias("url")) for k in keys])
    return F.filter(found, lambda x: F.coalesce(F.trim(x["url"]) != "", F.lit(False)))


def topics(settings: Column) -> Column:
    """{programme: {name, topics: {id: name}}} as [(programme, name, topic, topic_name)], one for each topic."""
    tree = F.from_json(settings, "map<string, struct<name: string, topics: map<string, string>>>")
    rows = F.transform(F.map_entries(tree), lambda p: F.transform(F.map_entries(p["value"]["topics"]), lambda t: F.struct(p["key"].alias("programme"), p["value"]["name"].alias("name"), t["key"].alias("topic"), t["value"].alias("topic_name"))))
    return F.flatten(rows)


def canonical_json(text: Column) -> Column:
    """JSON text in compact form with sorted keys, null if it is none."""
    return F.to_json(parsed(text))


def appended(path: Column, name: Column) -> Column:
    """A path with a name at its end, unless it ends with it already, whatever the case."""
    last = F.try_element_at(path, F.lit(-1))
    return F.when(F.lower(last) == F.lower(name), path).otherwise(F.array_append(path, name))


def without_last(items: Column, n: int) -> Column:
    return F.slice(items, F.lit(1), F.greatest(F.size(items) - n, F.lit(0)))


def shown(paths: Column) -> Column:
    """Lists of lists as an export shows them: ``a -> b; c``."""
    return F.array_join(F.transform(paths, lambda p: F.array_join(p, " -> ")), "; ")


def matched_years(texts: Column) -> Column:
    """All years named in a list of texts, each once, the latest first."""
    found = F.flatten(F.transform(texts, lambda t: F.regexp_extract_all(t, F.lit(r"\b((?:19|20)\d{2})\b"), F.lit(1))))
    return F.sort_array(F.array_distinct(F.transform(found, lambda y: y.cast("int"))), False)


def same_set(a: Column, b: Column) -> Column:
    """Do two lists hold the same values?  A listing that shows the same page twice has ended."""
    return (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)


def display_name(*parts: Column, mark: str = " - ") -> Column:
    """The parts that are not blank, joined; a part that repeats the one before it is left out."""
    kept = F.filter(F.array(*[F.trim(p) for p in parts]), lambda p: F.coalesce(p != "", F.lit(False)))
    return F.array_join(F.filter(kept, lambda p, i: (i == 0) | ~F.coalesce(F.get(kept, i - 1) == p, F.lit(False))), mark)


def field_value(meta: Column, keys: tuple[str, ...], kind: str = "text") -> Column:
    """A detail field: the first of its keys that a map has; kind: text, date or count."""
    found = F.coalesce(*[F.when(F.trim(meta[k]) != "", F.trim(meta[k])) for k in keys])
    return publish_date(found) if kind == "date" else found.try_cast("long").cast("string") if kind == "count" else found
