"""Profiles and rules per source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import is_date, is_timestamp
from ..functions.urls import is_absolute
from .keyed import top_k

#: When a rare value is an outlier.
MIN_ROWS, RARE_RATIO, MAX_DISTINCT, MIN_DOMINANT = 20, 0.02, 0.30, 0.30
#: When a rare type is an outlier.
MIN_DOMINANT_TYPE, MAX_RARE_TYPE = 5, 2


def frequent(df: DataFrame, keys: list[str], value: str, position: str, k: int) -> DataFrame:
    """The k most frequent values per key; of equal counts the one seen first comes first."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("_first"))
    return top_k(counts, keys, [F.desc("n"), F.asc("_first")], k).drop("_first")


def value_outliers(df: DataFrame, keys: list[str], value: str, position: str) -> DataFrame:
    """(keys, value, n): rare values of keys with enough rows, few different values and a dominant one."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("_first"))
    # Per key an aggregate that is joined back: a key with very many values is never sorted in one task.
    per = counts.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        F.sum("n").alias("_total"), F.count(F.lit(1)).alias("_kinds"), F.max(F.struct("n", -F.col("_first"), F.struct(value).alias("v"))).alias("_top")
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    ranked = counts.join(per, same).withColumn("_most", F.col("_top.n"))
    rare = F.greatest(F.lit(1), F.floor(F.col("_total") * RARE_RATIO))
    fit = (F.col("_total") >= MIN_ROWS) & (F.col("_kinds") > 1) & (F.col("_kinds") / F.col("_total") <= MAX_DISTINCT) & (F.col("_most") / F.col("_total") >= MIN_DOMINANT)
    other = ~F.col(value).eqNullSafe(F.col(f"_top.v.{value}"))
    return ranked.where(fit & other & (F.col("n") <= rare) & (F.col("n") < F.col("_most"))).select(*keys, value, "n")


def type_outliers(df: DataFrame, keys: list[str], kind: str, position: str) -> DataFrame:
    """(keys, kind, n, dominant): types other than a dominant one of five rows or more that two rows at most have."""
    counts = df.groupBy(*keys, kind).agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("_first"))
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), F.asc("_first")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    top = counts.withColumns({"dominant": F.first(kind).over(w), "_most": F.first("n").over(w)})
    return top.where((F.col(kind) != F.col("dominant")) & (F.col("_most") >= MIN_DOMINANT_TYPE) & (F.col("n") <= MAX_RARE_TYPE)).select(*keys, kind, "n", "dominant")


def exclusive_p95(df: DataFrame, column: str) -> DataFrame:
    """The 95th percentile at rank 0.95 (n + 1), null below 20 rows: exact, by ``numbering.at_ranks``, whose jobs run when this is called."""
    from .numbering import at_ranks

    n = df.where(F.col(column).isNotNull()).count()
    found = None
    if n >= 20:
        place = 0.95 * (n + 1)
        low, high = at_ranks(df, column, [int(place), min(int(place) + 1, n)])
        found = float(low) + (place - int(place)) * (float(high) - float(low))
    return df.sparkSession.createDataFrame([(found,)], "p95 double")


def _field(column: str, blank: bool, format_: Column | None, null_kind: str | None = "null") -> Column:
    """One issue at most: missing or null, then blank, then a bad format."""
    c = F.col(column)
    found = F.when(c.isNull(), F.lit(f"{column}_{null_kind}")) if null_kind else F.when(c.isNull(), F.lit(None).cast("string"))
    if blank:
        found = found.when(F.trim(c) == "", F.lit(f"{column}_blank"))
    if format_ is not None:
        found = found.when(~format_, F.lit(f"{column}_invalid"))
    return found


def issues(df: DataFrame, position: str) -> DataFrame:
    """(position, source, field, kind, severity): what is wrong with each record's required fields."""
    rules = {
        "url": _field("url", True, is_absolute(F.col("url"))),
        "name": _field("name", True, None),
        "discovered_at_utc": _field("discovered_at_utc", True, is_timestamp(F.col("discovered_at_utc"))),
        "publish_date": _field("publish_date", False, is_date(F.col("publish_date")), None),
        "source": _field("source", True, None),
    }
    found = F.filter(F.array(*[F.struct(F.lit(f).alias("field"), k.alias("kind")) for f, k in rules.items()]), lambda x: x["kind"].isNotNull())
    rows = df.select(F.col(position), F.coalesce(F.when(F.trim("source") != "", F.col("source")), F.lit("(missing)")).alias("source"), F.explode(found).alias("i"))
    severity = F.when(F.col("i.field").isin("name", "publish_date"), "warning").otherwise("error")
    return rows.select(position, "source", "i.field", "i.kind", severity.alias("severity"))


def line_issues(lines: DataFrame) -> DataFrame:
    """(file, line_no, source, field, kind, found) of lines (file, line_no, rec, error) as ``jsonl.scan`` gives them.

    A line that holds no object is a parse_error and nothing else.  Of each required field one thing at most is wrong: it is missing, null,
    of another type or blank (``found`` is the type), or has a bad format (``found`` is the value).  A publish date may be null."""
    from ..functions.documents import value_type
    from ..functions.text import clean_text, let, truncate

    wrong = lambda field, kind, found: F.struct(F.lit(field).alias("field"), F.lit(kind).alias("kind"), found.alias("found"))
    nothing = F.lit(None).cast("string")
    value = lambda of, name: F.try_variant_get(of, f"$.{name}", "variant")

    def read(v: Column, use) -> Column:
        """``use`` of a value, its type and its text, each found once."""
        kind = lambda k: F.struct(k.alias("kind"), F.when(k == "str", F.try_variant_get(v, "$", "string")).alias("text"))
        return let(let(value_type(v), kind), lambda x: use(x["kind"], x["text"]))

    def judged(v: Column, field: str, format_, kind: str) -> Column:
        def use(k: Column, t: Column) -> Column:
            out = F.when(k.isNull(), wrong(field, "missing_required_field", nothing)).when(k == "null", wrong(field, "null_required_field", nothing))
            out = out.when(t.isNull() | (clean_text(t) == ""), wrong(field, "invalid_required_type_or_empty", k))
            return out.when(~F.coalesce(format_(t), F.lit(False)), wrong(field, kind, truncate(t, 80))) if format_ else out

        return read(v, use)

    def dated(k: Column, t: Column) -> Column:
        said = truncate(F.coalesce(t, F.to_json(value(F.col("rec"), "publish_date"))), 80)
        return F.when(k.isNull(), wrong("publish_date", "missing_required_field", nothing)).when((k != "null") & ~F.coalesce(is_date(t), F.lit(False)), wrong("publish_date", "invalid_publish_date_format", said))

    def whole(k: Column, t: Column) -> Column:
        out = F.when(k.isNull(), wrong("meta", "missing_required_field", nothing)).when(k == "null", wrong("meta", "null_required_field", nothing))
        return out.when(k != "object", wrong("meta", "invalid_required_type_or_empty", k)).otherwise(judged(F.try_variant_get("rec", "$.meta.discovered_from", "variant"), "meta.discovered_from", is_absolute, "invalid_url_format"))

    of = lambda name: value(F.col("rec"), name)
    checks = [
        judged(of("url"), "url", is_absolute, "invalid_url_format"),
        judged(of("name"), "name", None, ""),
        judged(of("discovered_at_utc"), "discovered_at_utc", is_timestamp, "invalid_datetime_format"),
        read(of("publish_date"), dated),
        judged(of("source"), "source", None, ""),
        read(of("meta"), whole),
    ]
    broken = F.array(wrong("record", "parse_error", F.col("error")))
    found = F.when(F.col("error").isNotNull(), broken).otherwise(F.filter(F.array(*checks), lambda x: x.isNotNull()))
    said = read(of("source"), lambda k, t: clean_text(t))
    source = F.when(F.col("error").isNotNull(), "(parse_error)").when(said != "", said).otherwise("(missing)")
    return lines.select("file", "line_no", source.alias("source"), F.inline(found))


def field_states(issues: DataFrame) -> DataFrame:
    """Per source and required field how often it is missing, null and invalid; an issue of meta counts for what it should hold."""
    field = F.when(F.col("field") == "meta", "meta.discovered_from").otherwise(F.col("field"))
    counts = [F.count_if(F.startswith("kind", F.lit(k))).alias(k) for k in ("missing", "null", "invalid")]
    return issues.where("kind <> 'parse_error'").groupBy("source", field.alias("field")).agg(*counts)


def meta_entries(rows: DataFrame, meta: str, keys: list[str]) -> DataFrame:
    """(keys, key, value text, kind): each member of a JSON object, whatever its name; lists and objects as JSON text."""
    from ..functions.documents import is_object, parsed, value_type

    objects = rows.select(*keys, parsed(F.col(meta)).alias("_v")).where(is_object(F.col("_v")))
    members = F.explode(F.map_entries(F.try_variant_get("_v", "$", "map<string, variant>")))
    found = objects.select(*keys, members.alias("_m")).select(*keys, F.col("_m.key").alias("key"), F.col("_m.value").alias("_x"))
    kind = value_type(F.col("_x"))
    text = F.when(kind.isin("array", "object"), F.to_json("_x")).otherwise(F.coalesce(F.try_variant_get("_x", "$", "string"), F.lit("null")))
    return found.select(*keys, "key", text.alias("value"), F.coalesce(kind, F.lit("null")).alias("kind"))


def key_frequency(entries: DataFrame, groups: list[str], order: str, k: int = 12) -> DataFrame:
    return frequent(entries, groups, "key", order, k)


def type_histogram(entries: DataFrame, groups: list[str]) -> DataFrame:
    """Per key how often each type stands, and whether the key varies."""
    from pyspark.sql import Window

    counts = entries.groupBy(*groups, "key", "kind").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("varies", F.count(F.lit(1)).over(Window.partitionBy(*groups, "key")) > 1)


def value_frequency(entries: DataFrame, groups: list[str], order: str, k: int = 5) -> DataFrame:
    """The most frequent scalar values of each key; a value's type is part of it."""
    scalars = entries.where(~F.col("kind").isin("array", "object")).withColumn("value", F.concat("kind", F.lit(":"), "value"))
    return frequent(scalars, [*groups, "key"], "value", order, k)


def meta_issues(rows: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, kind): the rule that a record's meta breaks, one at most.  A member that is absent and one that is null are told apart."""
    from ..functions.documents import is_object, parsed, value_type
    from ..functions.urls import is_absolute

    record, meta = parsed(F.col(text)), F.col("_meta")
    has = F.coalesce(F.array_contains(F.json_object_keys(text), "meta"), F.lit(False))
    inner = F.coalesce(F.array_contains(F.json_object_keys(F.to_json("_meta")), "discovered_from"), F.lit(False))
    rows = rows.withColumn("_meta", F.try_variant_get(record, "$.meta", "variant")).withColumn("_from", F.try_variant_get(meta, "$.discovered_from", "variant"))
    kind = (
        F.when(~has, "meta_missing").when(meta.isNull() | (value_type(meta) == "null"), "meta_null").when(~is_object(meta), "meta_invalid")
        .when(~inner, "discovered_from_missing").when(F.col("_from").isNull() | (value_type(F.col("_from")) == "null"), "discovered_from_null")
        .when(value_type(F.col("_from")) != "str", "discovered_from_invalid").when(~is_absolute(F.try_variant_get("_from", "$", "string")), "discovered_from_not_url")
    )
    return rows.withColumn("kind", kind).where(F.col("kind").isNotNull()).select(*keys, "kind")


def report(issues: DataFrame, most: int = 50) -> str:
    """The first issues and the counts per kind as text, for people; what reaches the driver is bounded by ``most`` and the kinds."""
    counts = issues.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "kind").collect()
    return "\n".join([*(f"{r.kind}: {r.n}" for r in counts), *(" ".join(map(str, r)) for r in issues.orderBy(*issues.columns).limit(most).collect())])
