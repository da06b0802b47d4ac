"""Predicates on links, pages and directory rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_text, let
from .urls import AUTHORITY, PATH, part, path_extension

# Link texts that say nothing, extensions of pages, of documents and of sheets, and words of enquiry rows.
GENERIC = ("here", "click here", "more", "read more", "details", "download", "home", "back", "top", "pdf", "english", "next", "previous")
PAGES = ("", ".htm", ".html", ".asp", ".aspx", ".php", ".jsp")
DOCUMENTS = (".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".zip")
SHEETS = (".xls", ".xlsx", ".csv", ".doc", ".docx")
ENQUIRY, ENQUIRY_POSTS = ("enquiry", "general enquiry", "general inquiry", "enquiries"), ("-", "enquiry", "general enquiry")


def link_contains(text: Column, href: Column, in_text: str | None = None, in_href: str | None = None) -> Column:
    """Both parts that are given must be there, whatever the case."""
    found = F.lit(True)
    for column, want in ((text, in_text), (href, in_href)):
        if want:
            found = found & F.coalesce(F.contains(F.lower(column), F.lit(want.lower())), F.lit(False))
    return found


def has_extension(url: Column, allowed: tuple[str, ...] = DOCUMENTS) -> Column:
    return F.coalesce(path_extension(url).isin(*allowed), F.lit(False))


def lacks_extension(url: Column, denied: tuple[str, ...] = SHEETS) -> Column:
    return ~has_extension(url, denied)


def path_excluded(url: Column, prefixes: tuple[str, ...]) -> Column:
    """Is the path one of the prefixes or below it?  A prefix ends at a slash, and ``_`` and ``%`` mean themselves."""

    def of(path: Column) -> Column:
        found = F.lit(False)
        for p in prefixes:
            base = "/" + p.strip("/")
            found = found | (path == base) | F.startswith(path, F.lit(base + "/"))
        return found

    return F.coalesce(let(F.lower(part(url, PATH)), of), F.lit(False))


def is_child(url: Column, parent: Column) -> Column:
    """Below the folder of another url, and not that url itself."""
    return F.coalesce(F.startswith(url, F.regexp_extract(parent, r"^([^?#]*/)", 1)) & (url != parent), F.lit(False))


def is_page(url: Column) -> Column:
    return url.isNotNull() & path_extension(url).isin(*PAGES)


def is_generic(text: Column) -> Column:
    return let(F.lower(clean_text(text)), lambda t: (F.length(t) <= 1) | t.isin(*GENERIC))


def is_amendment(text: Column) -> Column:
    return F.coalesce(F.lower(text).rlike(r"\b(addend(um|a)|corrigend(um|a)|errat(um|a)|amendments?|track(ed)?[ -]?changes?)\b"), F.lit(False))


def is_detail_page(url: Column, shape: str) -> Column:
    return F.coalesce(part(url, PATH).rlike(shape), F.lit(False))


def in_years(year: Column, run_year: int, back: int = 0, least: int | None = None) -> Column:
    """One of the run's year and the ``back`` years before it, and not before ``least``."""
    found = year.between(run_year - back, run_year)
    return F.coalesce(found & (year >= least) if least is not None else found, F.lit(False))


def in_either_year(issued: Column, revised: Column, run_year: int, back: int = 0) -> Column:
    return in_years(issued, run_year, back) | in_years(revised, run_year, back)


def enough_cells(cells: Column, least: int) -> Column:
    """So many cells, and text in the first."""
    return (F.size(cells) >= least) & F.coalesce(F.trim(F.get(cells, F.lit(0))) != "", F.lit(False))


def is_person(name: Column, phone: Column) -> Column:
    low = F.lower(clean_text(name))
    return (low != "") & ~low.rlike(r"^\(?vacant\)?$") & F.coalesce(phone != "", F.lit(False))


def is_enquiry(name: Column, post: Column | None = None, href: Column | None = None) -> Column:
    """A line for enquiries, not a person: by the whole name, by the whole post, or because its link leads to a service."""
    whole = lambda text, values: F.coalesce(F.lower(clean_text(text)).isin(*values), F.lit(False))
    found = whole(name, ENQUIRY)
    if post is not None:
        found = found | whole(post, ENQUIRY_POSTS)
    return found | F.coalesce(F.contains(F.lower(href), F.lit("service")), F.lit(False)) if href is not None else found


def is_crawlable(url: Column, host: str, helpers: tuple[str, ...] = ()) -> Column:
    """On the host, a page, and in no helper folder."""
    return F.coalesce(F.lower(part(url, AUTHORITY)) == host, F.lit(False)) & is_page(url) & ~path_excluded(url, helpers)


def language_matches(text: Column, lang: str) -> Column:
    """zh: some ideograph; en: none."""
    found = F.coalesce(text.rlike("[\\u4e00-\\u9fff]"), F.lit(False))
    return found if lang == "zh" else ~found
