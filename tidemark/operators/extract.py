"""Rows out of HTML.  What is regular is read by patterns in the plan; tables, lists and trees need a parser and are table functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from ..functions.text import clean_text, let, strip_tags, unescape_html
from ..functions.urls import canonical_url, name_from_link, resolve

#: An attribute other than href, with its value in quotes or without; then href; then the rest of the tag, and a text without another anchor.
_VALUE = r"""(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?"""
ANCHOR = rf"""(?is)<a(?=[\s/])(?:[\s/]*(?!href\s*=)[^\s"'>/=]++{_VALUE})*+[\s/]*href\s*=\s*(?:"([^"]+)"|'([^']+)'|([^\s"'>][^\s>]*))(?:[^>"']++|"[^"]*"|'[^']*')*+>((?:(?!</?a[\s/>]).)*+)</a\s*>"""
#: What is text to a browser, or nothing, whatever it looks like.
UNREAD = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"


def page_links(pages: DataFrame) -> DataFrame:
    """(page columns, pos, href, text, url): each anchor with a target, in the order of the document; url is resolved and canonical.

    Attributes stand in any order, with either quotes or none; anchors in comments, scripts and styles are none; an anchor that another
    one interrupts, or that nothing closes, is left out."""
    whole = F.regexp_extract_all(F.regexp_replace("html", UNREAD, ""), F.lit(ANCHOR), F.lit(0))
    rows = pages.select(*[c for c in pages.columns if c != "html"], F.posexplode(whole).alias("pos", "a"))
    part = lambda i: F.regexp_extract("a", ANCHOR, i)
    rows = rows.withColumns({"href": unescape_html(F.concat(part(1), part(2), part(3))), "text": strip_tags(part(4))}).drop("a")
    return rows.withColumn("link", canonical_url(resolve(F.col("url"), F.col("href"))))


def page_title(html: Column, read: Callable[[Column], Column] = strip_tags) -> Column:
    """The title, else the first heading; ``read`` makes a text of what stands in the element."""
    inner = lambda tag: read(F.regexp_extract(html, rf"(?is)<{tag}(?![A-Za-z0-9_])[^>]*>(.*?)</{tag}[\t\n\f\r ]*>", 1))
    return F.coalesce(*[let(inner(tag), lambda t: F.when(t != "", t)) for tag in ("title", "h1")])


def last_updated(html: Column) -> Column:
    from ..functions.dates import mine_date

    return mine_date(F.regexp_extract(html, r"(?is)last\s+(?:updated?|revised|review(?:ed)?)[^<]{0,80}", 0))


def document_urls(html: Column, extension: str = "pdf") -> Column:
    """Absolute urls of a kind anywhere in a page, each once, in order."""
    found = F.regexp_extract_all(unescape_html(html), F.lit(rf"(?i)(https?://[^\s\"'<>\\]+?\.{extension})\b"), F.lit(1))
    return F.array_distinct(found)


#: Elements without an end tag.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCKS = {"p", "li", "dt", "dd", "option"}
#: Columns and rows that one cell may span, as HTML bounds them.
MOST_COLUMNS, MOST_ROWS = 1000, 65_534


class _Tree(HTMLParser):
    """Collects tables, blocks, list items and anchors while it keeps the open elements.

    Tables are numbered as they open.  Each open table has its own open cell: what follows a table inside a cell belongs to that cell again,
    and what stands in the inner table's cells to these alone.

    An element ends with its own end tag, which also ends what was left open in it; void elements hold nothing.  So a scope is what
    stands within its element, whatever is left open or void inside."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables, self.items, self.links, self.blocks = [], [], [], []
        self.open: list[tuple[str, str | None, dict | None]] = []
        self.open_tables: list[dict] = []
        self.link: dict | None = None
        self.heading = ""

    def ids(self) -> list[str]:
        return [i for _, i, _ in self.open if i]

    def handle_starttag(self, tag, attrs):
        a, block = dict(attrs), None
        if tag == "table":
            outer = self._cell()
            if outer is not None:
                outer["text"] += " "
            table = {"no": len(self.tables), "parent": self.open_tables[-1]["no"] if outer is not None else None, "rows": [], "cell": None, "heading": self.heading, "ids": self.ids() + ([a["id"]] if a.get("id") else [])}
            self.tables.append(table)
            self.open_tables.append(table)
        elif tag == "tr" and self.open_tables:
            self.open_tables[-1]["rows"].append([])
            self.open_tables[-1]["cell"] = None
        elif tag in ("td", "th") and self.open_tables and self.open_tables[-1]["rows"]:
            span = lambda n, most: min(most, max(1, int(a.get(n) or 1))) if str(a.get(n) or 1).isdecimal() else 1
            cell = {"text": "", "links": [], "rowspan": span("rowspan", MOST_ROWS), "colspan": span("colspan", MOST_COLUMNS), "head": tag == "th"}
            self.open_tables[-1]["cell"] = cell
            self.open_tables[-1]["rows"][-1].append(cell)
        elif tag in BLOCKS or tag in HEADINGS:
            depth = sum(t in ("ul", "ol") for t, _, _ in self.open)
            block = {"tag": tag, "text": "", "links": [], "value": a.get("value"), "heading": self.heading, "ids": self.ids(), "depth": depth}
            self.blocks.append(block)
            if tag == "li":
                self.items.append(block)
        elif tag == "img":
            self.blocks.append({"tag": "img", "text": a.get("alt") or "", "links": [], "value": a.get("src"), "heading": self.heading, "ids": self.ids(), "depth": 0})
        elif tag == "a" and a.get("href"):
            self.link = {"href": a["href"], "text": "", "ids": self.ids()}
            self.links.append(self.link)
            for holder in (self._cell(), self._block()):
                if holder is not None:
                    holder["links"].append(self.link)
        if tag not in VOID:
            self.open.append((tag, a.get("id"), block))

    def _cell(self) -> dict | None:
        return self.open_tables[-1]["cell"] if self.open_tables else None

    def _block(self) -> dict | None:
        return next((x for _, _, x in reversed(self.open) if x is not None), None)

    def handle_endtag(self, tag):
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if at is not None:
            if tag in HEADINGS and self.open[at][2]:
                self.heading = " ".join(self.open[at][2]["text"].split())
            del self.open[at:]
        if tag == "table" and self.open_tables:
            self.open_tables.pop()
        elif tag in ("td", "th") and self.open_tables:
            self.open_tables[-1]["cell"] = None
        elif tag == "a":
            self.link = None

    def handle_data(self, data):
        for holder in (self._cell(), self._block(), self.link):
            if holder is not None:
                holder["text"] += data


def parse(html: str | None) -> _Tree:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree


def spread(rows: list[list[dict]]) -> list[list[dict]]:
    """Cells on a grid: a cell stands at each place that its row and column spans cover."""
    grid: list[dict[int, dict]] = [{} for _ in rows]
    for r, row in enumerate(rows):
        c = 0
        for cell in row:
            while c in grid[r]:
                c += 1
            for dr in range(min(cell["rowspan"], len(rows) - r)):
                for dc in range(cell["colspan"]):
                    grid[r + dr].setdefault(c + dc, cell)
            c += cell["colspan"]
    return [[g[c] for c in sorted(g)] for g in grid]


CELLS = "table_no int, parent int, heading string, ids array<string>, row int, col int, head boolean, text string, href string"
BLOCK = "pos int, tag string, heading string, ids array<string>, depth int, text string, value string, hrefs array<string>"
ITEMS, LINKS = "pos int, text string, href string", "pos int, href string, text string"


def _said(x: dict) -> str:
    return " ".join(x["text"].split())


def _cells(html: str | None) -> Iterator[tuple]:
    for table in parse(html).tables:
        for r, row in enumerate(spread(table["rows"])):
            for c, cell in enumerate(row):
                yield table["no"], table["parent"], table["heading"], table["ids"], r, c, cell["head"], _said(cell), cell["links"][0]["href"] if cell["links"] else None


def _blocks(html: str | None) -> Iterator[tuple]:
    for i, x in enumerate(parse(html).blocks):
        yield i, x["tag"], x["heading"], x["ids"], x["depth"], _said(x), x["value"], [k["href"] for k in x["links"]]


def _items(html: str | None) -> Iterator[tuple]:
    for i, item in enumerate(parse(html).items):
        for link in item["links"]:
            yield i, _said(item), link["href"]


def _scoped(html: str | None, scope: str, fallback: bool) -> Iterator[tuple]:
    links = parse(html).links
    own = [x for x in links if scope in x["ids"]]
    for i, x in enumerate(own or (links if fallback else [])):
        yield i, x["href"], _said(x)


def _rows(pages: DataFrame, html: str, rows: Callable[[str | None], Iterator[tuple]], schema: str, most: int = 10_000) -> DataFrame:
    """The other columns of ``pages`` with each row that a page gives: Arrow batches in and out, of ``most`` rows at most."""
    keep = [c for c in pages.columns if c != html]
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            kept, texts = batch.select(keep), batch.column(batch.schema.get_field_index(html))
            at, found = [], []

            def whole():
                columns = zip(*found, strict=True) if found else [()] * len(kinds)  # noqa: B023
                made = [pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)]
                return pa.record_batch([*kept.take(pa.array(at, pa.int64())).columns, *made], [*keep, *kinds.names])  # noqa: B023

            for i in range(batch.num_rows):
                for row in rows(texts[i].as_py()):
                    at.append(i)
                    found.append(row)
                    if len(at) >= most:
                        yield whole()
                        at, found = [], []
            yield whole()

    own = pages.select(*keep).schema
    return pages.select(*keep, html).mapInArrow(run, StructType([*own.fields, *StructType.fromDDL(schema).fields]))


def html_tables(pages: DataFrame, html: str = "html") -> DataFrame:
    """Each cell of each table, spans spread out, with the first link in it, the heading before the table and the ids around it.

    ``parent`` is the number of the table in whose cell a table stands.  A cell's text is what stands in it outside inner tables."""
    return _rows(pages, html, _cells, CELLS)


def html_blocks(pages: DataFrame, html: str = "html") -> DataFrame:
    """Paragraphs, list items, terms, options, headings and images in order, with the heading before and the ids around them."""
    return _rows(pages, html, _blocks, BLOCK)


def html_items(pages: DataFrame, html: str = "html") -> DataFrame:
    """List items that hold links, one row per link."""
    return _rows(pages, html, _items, ITEMS)


def html_scoped_links(pages: DataFrame, scope: str, fallback: bool = True, html: str = "html") -> DataFrame:
    """Anchors inside the element with an id; all anchors of a page that has none there, if ``fallback`` is set."""
    return _rows(pages, html, lambda text: _scoped(text, scope, fallback), LINKS)


@udtf(returnType=CELLS)
class HtmlTables:
    """``html_tables`` for SQL, called for each page."""

    def eval(self, html: str):
        yield from _cells(html)


@udtf(returnType=BLOCK)
class HtmlBlocks:
    """``html_blocks`` for SQL, called for each page."""

    def eval(self, html: str):
        yield from _blocks(html)


@udtf(returnType=ITEMS)
class HtmlItems:
    """``html_items`` for SQL, called for each page."""

    def eval(self, html: str):
        yield from _items(html)


@udtf(returnType=LINKS)
class HtmlScopedLinks:
    """``html_scoped_links`` for SQL, called for each page."""

    def eval(self, html: str, scope: str, fallback: bool):
        yield from _scoped(html, scope, fallback)


def register(spark: SparkSession) -> None:
    """Make the table functions known to SQL: html_tables, html_blocks, html_items, html_scoped_links."""
    for name, f in (("html_tables", HtmlTables), ("html_blocks", HtmlBlocks), ("html_items", HtmlItems), ("html_scoped_links", HtmlScopedLinks)):
        spark.udtf.register(name, f)


def by_header(cells: DataFrame, keys: list[str], wanted: dict[str, str]) -> DataFrame:
    """Cells of tables with header rows to one row per body row: name -> pattern that a column's header matches."""
    head = cells.where("head").groupBy(*keys, "table_no", "col").agg(F.min_by("text", "row").alias("header"))
    body = cells.where("not head").join(head, [*keys, "table_no", "col"])
    named = [F.max(F.when(F.col("header").rlike(f"(?i){p}"), F.struct("text", "href"))).alias(n) for n, p in wanted.items()]
    return body.groupBy(*keys, "table_no", "row").agg(*named)


def under_heading(cells: DataFrame, heading: str) -> DataFrame:
    """Cells of the tables whose heading matches, once both are folded."""
    from ..functions.text import headings_match

    return cells.where(headings_match(F.col("heading"), F.lit(heading)))


def first_table(cells: DataFrame, keys: list[str]) -> DataFrame:
    first = cells.groupBy(*keys).agg(F.min("table_no").alias("_first"))
    return cells.join(first, keys).where(F.col("table_no") == F.col("_first")).drop("_first")


def in_panes(rows: DataFrame, panes: dict[str, str]) -> DataFrame:
    """Rows inside elements with the given ids, with the pane's label."""
    label = F.coalesce(*[F.when(F.array_contains("ids", i), F.lit(name)) for i, name in panes.items()])
    return rows.withColumn("pane", label).where(F.col("pane").isNotNull())


def since_year(rows: DataFrame, least: int) -> DataFrame:
    """Rows of sections whose heading names a year from ``least`` on."""
    year = F.regexp_extract("heading", r"\b((?:19|20)\d{2})\b", 1).try_cast("int")
    return rows.withColumn("year", year).where(F.col("year") >= least)


def label_values(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Two-column tables to (keys, label, text, href); the first row of a label wins."""
    from .keyed import dedup

    label = cells.where("col = 0").select(*keys, "table_no", "row", F.regexp_replace("text", r"\s*:$", "").alias("label"))
    value = cells.where("col = 1").select(*keys, "table_no", "row", "text", "href")
    found = label.join(value, [*keys, "table_no", "row"]).where("label <> ''")
    return dedup(found, [*keys, "label"], F.struct("table_no", "row")).select(*keys, "label", "text", "href")


def preferred_links(cells: DataFrame, keys: list[str], ranks: list[str]) -> DataFrame:
    """Of each row's links that of the first column rule that its header matches, the rightmost column without any."""
    head = cells.where("head").groupBy(*keys, "table_no", "col").agg(F.min_by("text", "row").alias("header"))
    links = cells.where("href is not null").join(head, [*keys, "table_no", "col"], "left")
    rank = F.coalesce(*[F.when(F.col("header").rlike(f"(?i){p}"), F.lit(i)) for i, p in enumerate(ranks)], F.lit(len(ranks)))
    return links.groupBy(*keys, "table_no", "row").agg(F.min_by("href", F.struct(rank, -F.col("col"))).alias("href"))


def dates_by_link(cells: DataFrame, keys: list[str], header: str = "date") -> DataFrame:
    """(keys, href, date): the date column's value for every link of its row."""
    from ..functions.dates import publish_date

    head = cells.where("head").where(F.col("text").rlike(f"(?i){header}")).select(*keys, "table_no", "col").distinct()
    dated = cells.where("not head").join(head, [*keys, "table_no", "col"], "left_semi").groupBy(*keys, "table_no", "row").agg(F.min("text").alias("_d"))
    links = cells.where("href is not null").select(*keys, "table_no", "row", "href").distinct()
    return links.join(dated, [*keys, "table_no", "row"]).groupBy(*keys, "href").agg(F.min(publish_date(F.col("_d"))).alias("date"))


def people(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (name, post, phone) of directories: blank and vacant names go, and those without a phone."""
    from ..functions.filters import is_person
    from ..functions.text import phone

    at = lambda c: F.max(F.when(F.col("col") == c, F.col("text")))
    rows = cells.where("not head").groupBy(*keys, "table_no", "row").agg(at(0).alias("name"), at(1).alias("post"), phone(at(2)).alias("phone"))
    return rows.where(is_person(F.col("name"), F.col("phone")))


def table_records(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells to (keys, table_no, record, fields, href): tables with a header row give a record a row; tables whose rows are a label and its
    value, as narrow layouts write the same, begin a record wherever their first label comes again.  Labels are folded; blank fields go."""
    from pyspark.sql import Window

    from ..functions.text import fold_heading

    at, row = [*keys, "table_no"], [*keys, "table_no", "row"]
    shape = cells.groupBy(*row).agg(F.count(F.lit(1)).alias("_n"), F.count_if("head").alias("_heads"), F.max(F.when(F.col("col") == 0, F.col("head"))).alias("_label"))
    shape = shape.select(*row, F.when(F.col("_heads") == F.col("_n"), "head").when((F.col("_n") == 2) & (F.col("_heads") == 1) & F.col("_label"), "pair").otherwise("body").alias("_kind"))
    known = cells.join(shape, row)
    named = known.where("_kind = 'head'").groupBy(*at, "col").agg(F.min_by(fold_heading(F.col("text")), "row").alias("label"))
    wide = known.where("_kind = 'body'").join(named, [*at, "col"]).select(*at, F.col("row").alias("record"), "label", "text", "href")
    pairs = known.where("_kind = 'pair'").groupBy(*row).agg(
        fold_heading(F.max(F.when(F.col("col") == 0, F.col("text")))).alias("label"), F.max(F.when(F.col("col") == 1, F.col("text"))).alias("text"), F.max("href").alias("href")
    )
    along = Window.partitionBy(*at).orderBy("row")
    pairs = pairs.withColumn("_first", F.first("label").over(along)).withColumn("record", F.count_if(F.col("label") == F.col("_first")).over(along).cast("int"))
    every = wide.unionByName(pairs.select(*at, "record", "label", "text", "href")).where("label <> '' AND text <> ''")
    fields = F.map_from_entries(F.array_sort(F.collect_set(F.struct("label", "text"))))
    one = every.groupBy(*at, "record", "label").agg(F.min("text").alias("text"), F.max("href").alias("href"))
    return one.groupBy(*at, "record").agg(fields.alias("fields"), F.max("href").alias("href"))


def one_of_each(records: DataFrame, keys: list[str]) -> DataFrame:
    """Records that several tables of a page hold, as for wide and narrow screens, once: (keys, fields, href, table_no, record, tables)."""
    same = F.to_json(F.array_sort(F.map_entries("fields")))
    found = records.groupBy(*keys, same.alias("_same")).agg(F.min_by(F.struct("fields", "href", "table_no", "record"), F.struct("table_no", "record")).alias("_r"), F.count_distinct("table_no").alias("tables"))
    return found.select(*keys, "_r.*", "tables")


def tree_paths(items: DataFrame, keys: list[str]) -> DataFrame:
    """Nested list items (pos, depth, text) to the path of texts from the root; depths count from 1, and blank texts are left out of paths.

    Items are dealt by ``keys``, sorted by ``pos`` and passed once, with the open ancestors of the last item as all that is held."""
    from pyspark.sql.types import ArrayType, StringType, StructField, StructType

    def run(batches):
        at, open_ = None, []
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name)).to_pylist()  # noqa: B023, E731
            paths = []
            for key, depth, text in zip(zip(*[column(k) for k in keys], strict=True), column("depth"), column("text"), strict=True):
                if key != at:
                    at, open_ = key, []
                up = max(0, (depth or 0) - 1)
                del open_[up:]
                open_ += [None] * (up - len(open_)) + [text]
                paths.append([x for x in open_ if x] if depth else [])
            yield batch.append_column("path", pa.array(paths, pa.list_(pa.string())))

    spread_ = items.repartition(*keys).sortWithinPartitions(*keys, "pos")
    return spread_.mapInArrow(run, StructType([*items.schema.fields, StructField("path", ArrayType(StringType()))]))


def questions(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Terms and their definitions as (keys, section, number, question, answer), numbered along the page."""
    from pyspark.sql import Window

    along = Window.partitionBy(*keys).orderBy("pos")
    entry = blocks.where(F.col("tag").isin("dt", "dd")).withColumn("number", F.count_if(F.col("tag") == "dt").over(along))
    answer = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("tag") == "dd", F.struct("pos", "text")))), lambda x: x["text"]), " ")
    return entry.where("number > 0").groupBy(*keys, "number").agg(F.min_by("heading", "pos").alias("section"), F.min_by("text", "pos").alias("question"), answer.alias("answer"))


def script_items(html: Column, title: str = "title", url: str = "url") -> Column:
    """Items of arrays in scripts as [(title, url)]: objects first, then the two members of each.  What stands in quotes is passed as a whole,
    braces, brackets and the other quote too; a backslash before a character stands for that character."""
    double, single = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', r"'[^'\\]*+(?:\\.[^'\\]*+)*+'"
    objects = F.regexp_extract_all(html, F.lit(rf"(?s)\{{(?:[^{{}}\"']++|{double}|{single})*+\}}"), F.lit(0))
    key = lambda name: rf"""\s*["']?{name}["']?\s*:\s*"""
    past = lambda name: rf"""(?:(?:[^{{}}\"',]++|,(?!{key(name)})|{double}|{single})*+,)?"""
    raw = lambda x, name: F.regexp_extract(x, rf"(?s)^\{{{past(name)}{key(name)}({double}|{single})", 1)
    member = lambda x, name: F.regexp_replace(F.regexp_replace(raw(x, name), r"(?s)^.|.$", ""), r"(?s)\\(.)", "$1")
    pairs = F.transform(objects, lambda x: F.struct(member(x, title).alias("title"), member(x, url).alias("url")))
    return F.filter(pairs, lambda x: x["url"] != "")


def last_page(html: Column, parameter: str = "page") -> Column:
    """The largest page number that a listing's links name, 1 without any."""
    found = F.transform(F.regexp_extract_all(html, F.lit(rf"[?&]{parameter}=(\d{{1,9}})"), F.lit(1)), lambda x: x.cast("int"))
    return F.coalesce(F.array_max(found), F.lit(1))


def records(links: DataFrame, source: str) -> DataFrame:
    """Links to catalogue records, the first of each url in document order."""
    from .keyed import dedup

    found = links.where(F.col("link").isNotNull())
    found = dedup(found.select(F.col("link").alias("url"), name_from_link(F.col("text"), F.col("link")).alias("name"), "page_id", "pos"), ["url"], F.struct("page_id", "pos"))
    return found.select("url", clean_text(F.col("name")).alias("name"), F.lit(source).alias("source"), "page_id", "pos")
