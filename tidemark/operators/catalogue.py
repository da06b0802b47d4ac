"""Records and runs of a catalogue: making records, what a run did, and walks that end by rules."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import infer_publish_date, publish_date
from .traverse import bfs, until_misses

RECORD = ("url", "name", "discovered_at_utc", "publish_date", "source", "source_id", "meta")


def make_records(rows: DataFrame, source: str, seen_at: Column, given: Column | None = None) -> DataFrame:
    """Catalogue records of rows (url, name, meta map): the publish date is the given one, normalised, else inferred from meta."""
    date = infer_publish_date(F.col("meta")) if given is None else F.coalesce(publish_date(given), F.when(given.isNull(), infer_publish_date(F.col("meta"))))
    made = {"discovered_at_utc": seen_at, "publish_date": date, "source": F.lit(source), "source_id": F.coalesce(F.col("meta")["id"], F.lit(""))}
    return rows.withColumns(made).select(*RECORD)


def output_rows(records: DataFrame) -> DataFrame:
    """What a run writes: the record's columns and nothing else."""
    return records.select(*[c for c in RECORD if c in records.columns])


def viewer_rows(records: DataFrame) -> DataFrame:
    """Rows as a viewer shows them: texts never null, domain and publish year beside them."""
    text = lambda c: F.coalesce(F.trim(F.col(c)), F.lit(""))
    domain = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    return records.select(text("url").alias("url"), F.coalesce(F.when(text("name") != "", text("name")), text("url")).alias("name"), text("source").alias("source"), domain.alias("domain"), F.col("publish_date").alias("publish_date"), F.substring("publish_date", 1, 4).try_cast("int").alias("year"))


def line_counts(lines: DataFrame, text: str, record: str) -> DataFrame:
    """Lines, records and parse errors of a scan, in one row."""
    blank = F.coalesce(F.trim(text) == "", F.lit(True))
    return lines.agg(F.count(F.lit(1)).alias("lines"), F.count_if(~blank & F.col(record).isNotNull()).alias("records"), F.count_if(~blank & F.col(record).isNull()).alias("errors"))


def run_summary(states: DataFrame) -> DataFrame:
    """(source, due, ran, ok) to one row of sorted lists: due, skipped, succeeded, failed."""
    names = lambda on: F.sort_array(F.collect_set(F.when(on, F.col("source"))))
    return states.agg(names(F.col("due")).alias("due"), names(~F.col("due")).alias("skipped"), names(F.col("ran") & F.col("ok")).alias("succeeded"), names(F.col("ran") & ~F.col("ok")).alias("failed"))


def chosen_to_run(schedule: DataFrame, only: tuple[str, ...] = ()) -> DataFrame:
    """Sources to run: those that are due, or exactly those named by hand, due or not."""
    return schedule.where(F.col("source").isin(*only)) if only else schedule.where("due")


def updated_state(state: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """(source, last_success) after a run: sources that succeeded get its time, all others keep theirs."""
    good = results.where("ok").select("source", now.alias("_now")).distinct()
    return state.join(good, "source", "full_outer").select("source", F.coalesce("_now", "last_success").alias("last_success"))


def carried_sources(previous: DataFrame, results: DataFrame) -> DataFrame:
    """Sources of the previous snapshot that neither succeeded nor failed in this run."""
    return previous.select("source").distinct().join(results.select("source").distinct(), "source", "left_anti")


def reuse_or_rebuild(current: DataFrame, prior: DataFrame, key: str, refresh: Column, columns: list[str]) -> DataFrame:
    """Rows of this run where a refresh is needed or no prior row is known, else the prior row's values."""
    old = prior.select(F.col(key).alias("_k"), F.lit(True).alias("_known"), *[F.col(c).alias(f"_old_{c}") for c in columns])
    joined = current.join(old, current[key] == F.col("_k"), "left")
    new = F.col("_known").isNull() | refresh
    return joined.select(key, *[F.when(new, F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c) for c in columns], F.when(new, "rebuilt").otherwise("reused").alias("how"))


def years_by_items(items: DataFrame, years: list[int], first: str, last: str) -> DataFrame:
    """Each item in each year of its span; the list of years is the caller's and short."""
    inside = F.filter(F.array(*[F.lit(y) for y in sorted(years)]), lambda y: (y >= F.col(first)) & (y <= F.coalesce(F.col(last), y)))
    return items.withColumn("year", F.explode(inside))


def papers_by_meeting(meetings: DataFrame, papers: DataFrame, keys: list[str], token: Column) -> DataFrame:
    """Papers of meetings by term, year and the token that a meeting's name gives."""
    return meetings.withColumn("token", token).join(papers, [*keys, "token"])


def section_sort(rows: DataFrame, section: str) -> DataFrame:
    """By the numbers of a section such as 2.10.1, part by part; rows without numbers last."""
    return rows.withColumn("section_key", section_key(F.col(section))).orderBy("section_key", section)


def section_key(section: Column) -> Column:
    parts = F.transform(F.regexp_extract_all(section, F.lit(r"(\d{1,9})"), F.lit(1)), lambda x: F.lpad(x, 9, "0"))
    return F.when(F.size(parts) > 0, F.array_join(parts, ".")).otherwise(F.lit("~"))


def crawl(edges: DataFrame, seeds: DataFrame, max_depth: int, emit: str = "pages", leaf: DataFrame | None = None, scope: DataFrame | None = None) -> DataFrame:
    """Walk (src, dst, is_document) edges: pages are followed, documents are not.  ``emit``: pages, documents or both.

    Pages of ``leaf`` (node) are reached but not left, and pages outside ``scope`` (node) are not entered."""
    pages = edges.where("not is_document").select("src", "dst")
    if leaf is not None:
        pages = pages.join(leaf.select(F.col("node").alias("src")), "src", "left_anti")
    if scope is not None:
        pages = pages.join(scope.select(F.col("node").alias("dst")), "dst", "left_semi").select("src", "dst")
    walked = bfs(pages, seeds, max_depth)
    if emit == "pages":
        return walked.select("node", "depth", F.lit("page").alias("kind"))
    reached = walked if leaf is None else walked.join(leaf.select("node"), "node", "left_anti")
    documents = edges.where("is_document").join(reached.select(F.col("node").alias("src"), "depth"), "src")
    documents = documents.groupBy(F.col("dst").alias("node")).agg(F.min("depth").alias("depth")).select("node", "depth", F.lit("document").alias("kind"))
    return documents if emit == "documents" else walked.select("node", "depth", F.lit("page").alias("kind")).union(documents)


def childless_pages(walked: DataFrame, edges: DataFrame) -> DataFrame:
    """Pages that lead to no document: they stand for themselves."""
    with_documents = edges.where("is_document").select(F.col("src").alias("node"))
    return walked.join(with_documents, "node", "left_anti")


def with_paths(walked: DataFrame, names: DataFrame) -> DataFrame:
    """(node, depth, via) of a walk to the path of names from its seed: as many joins as the walk has levels."""
    from .traverse import cut

    named = walked.join(names.select("node", "name"), "node", "left")
    done = cut(named.where("depth = 0").select("node", F.array("name").alias("path")))
    for depth in range(1, (walked.agg(F.max("depth")).first()[0] or 0) + 1):
        step = named.where(F.col("depth") == depth).join(done.toDF("via", "_above"), "via")
        done = cut(done.union(step.select("node", F.concat("_above", F.array("name")).alias("path"))))
    return done


def with_sections(walked: DataFrame, sections: DataFrame) -> DataFrame:
    """The section of the page that a walk began with, carried to all that it reaches; a page with a section of its own keeps that."""
    from .traverse import cut

    named = walked.join(sections.select("node", "section"), "node", "left")
    done = cut(named.where("depth = 0").select("node", "section"))
    for depth in range(1, (walked.agg(F.max("depth")).first()[0] or 0) + 1):
        step = named.where(F.col("depth") == depth).join(done.toDF("via", "_above"), "via")
        done = cut(done.union(step.select("node", F.coalesce("section", "_above").alias("section"))))
    return done


def pages_until_end(pages: DataFrame, keys: list[str], number: str, items: str) -> DataFrame:
    """Pages of listings up to the first that is empty or shows the same items as the page before."""
    along = Window.partitionBy(*keys).orderBy(number)
    before = F.lag(items).over(along)
    same = F.coalesce((F.size(F.array_except(items, before)) == 0) & (F.size(F.array_except(before, items)) == 0), F.lit(False))
    marked = pages.withColumn("_go", (F.coalesce(F.size(items), F.lit(0)) > 0) & ~same)
    return until_misses(marked, keys, number, "_go", 1).where("_go").drop("_go")


def two_hops(hubs: DataFrame, edges: DataFrame, rank: Column, documents: DataFrame) -> DataFrame:
    """From each hub to its best subpage, and from there to the documents: (hub, sub, document)."""
    best = hubs.join(edges, hubs["hub"] == edges["src"]).groupBy("hub").agg(F.max_by("dst", rank).alias("sub"))
    return best.join(documents.select(F.col("src").alias("sub"), F.col("dst").alias("document")), "sub").select("hub", "sub", "document")


class Registry:
    """Extractors by name: functions (spark, context) -> DataFrame of records.  ``dispatch`` picks a parser by the longest path prefix of a page."""

    def __init__(self) -> None:
        self.known: dict[str, Callable[[SparkSession, dict], DataFrame]] = {}

    def add(self, name: str):
        def of(f):
            if name in self.known:
                raise ValueError(f"{name} is registered already")
            self.known[name] = f
            return f

        return of

    def run(self, spark: SparkSession, name: str, context: dict) -> DataFrame:
        return output_rows(self.known[name](spark, context))


def dispatch(pages: DataFrame, path: Column, parsers: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Each page to the parser of the longest prefix that its path starts with; pages that none takes are left out."""
    order = sorted(parsers, key=lambda p: (-len(p), p))
    taken = reduce(lambda other, p: F.when(F.startswith(path, F.lit(p)), F.lit(p)).otherwise(other), reversed(order), F.lit(None).cast("string"))
    marked = pages.withColumn("_parser", taken)
    parts = [parsers[p](marked.where(F.col("_parser") == p).drop("_parser")).withColumn("parser", F.lit(p)) for p in order]
    return reduce(lambda a, b: a.unionByName(b), parts)
