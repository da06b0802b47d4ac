"""Dates in free text, as ISO strings.  All parsing is lenient: what is no date gives null, never an error.

A form is a pattern made of day, month and year pieces, and the order of its pieces.  A form's match is cut out once, split into its
pieces and made a date; so forms are data, and a text is searched once for each form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_text, let, strip_tags

# Metadata keys that hold a date, in the order they are asked.
DATE_KEYS = ("publish_date", "date_utc", "date", "publication_date", "published_date", "date_of_issue", "issue_date", "issue_date_raw", "edition_date", "year")
NAMES = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
#: Whole names, their first three letters, and Sept: a word that only begins like a month is none.
MONTH = "(?:" + "|".join(sorted({*NAMES, *(n[:3] for n in NAMES), "Sept"}, key=lambda n: (-len(n), n))) + ")"
DAY, NUMBER, YEAR = r"\d{1,2}", r"\d{1,2}", r"\d{4}"
_STARTS = " ".join(n[:3].lower() for n in NAMES)

#: Forms of a publication date, as (pattern, order of its pieces), the surest first.
FORMS = (
    (rf"{YEAR}-{NUMBER}-{DAY}", "ymd"),
    (rf"{YEAR}/{NUMBER}/{DAY}", "ymd"),
    (rf"{DAY}[./-]{NUMBER}[./-]{YEAR}", "dmy"),
    (rf"{DAY}\s+{MONTH},?\s+{YEAR}", "dmy"),
    (rf"{MONTH}\s+{DAY},?\s+{YEAR}", "mdy"),
    (rf"{MONTH}\s+{YEAR}", "my"),
    (rf"{YEAR}\s+{MONTH}", "ym"),
)


def month_number(token: Column) -> Column:
    """1-12 of a number or a month's name, null for any other word."""
    named = F.when(token.rlike(f"(?i)^{MONTH}$"), F.floor((F.position(F.lower(F.left(token, F.lit(3))), F.lit(_STARTS)) - 1) / 4 + 1).cast("int"))
    return F.coalesce(named, token.try_cast("int"))


def iso(year: Column, month: Column, day: Column) -> Column:
    """The date if there is such a day."""
    made = F.try_to_date(F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")), "yyyy-MM-dd")
    return F.date_format(made, "yyyy-MM-dd")


def _made(span: Column, order: str) -> Column:
    """The date of a span of a form; what the order does not name is 1."""
    piece = lambda parts, kind: F.get(parts, F.lit(order.index(kind))) if kind in order else F.lit("1")
    return let(F.split(F.trim(span), "[^0-9A-Za-z]+"), lambda p: F.when(F.size(p) >= len(order), iso(piece(p, "y"), month_number(piece(p, "m")), piece(p, "d"))))


def _first(text: Column, pattern: str, order: str) -> Column:
    return let(F.regexp_extract(text, f"(?i){pattern}", 0), lambda m: F.when(m != "", _made(m, order)))


def publish_date(text: Column) -> Column:
    """A publication date from a field: a whole field of some form, then the first form found inside, a bare year last.

    ``YYYY-MM-DD`` is taken as it stands, even if there is no such day; ``is_date`` tells."""

    def of(t: Column) -> Column:
        whole = [_first(t, f"^{p}$", order) for p, order in FORMS]
        within = [_first(t, rf"\b{p}\b", order) for p, order in FORMS]
        return F.when(t.rlike(r"^\d{4}$"), F.concat(t, F.lit("-01-01"))).when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), t).otherwise(
            F.coalesce(
                F.when(t.rlike(r"^\d{8}$"), iso(F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2))),
                F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"), _first(t, rf"^{YEAR}-\d\d-\d\d", "ymd")),
                *whole,
                *within,
                _first(t, rf"\b{YEAR}\b", "y"),
            )
        )

    return let(clean_text(text), lambda t: F.when(t != "", of(t)))


def infer_publish_date(meta: Column) -> Column:
    """From the first key of a map that holds a date."""
    return F.coalesce(*[publish_date(meta[k]) for k in DATE_KEYS])


#: What running text says of its date: words before it, pattern and order; the first that is found counts, at its last place.
SAYINGS = (
    (r"published\s+on\s+", rf"{DAY}\s+{MONTH}\s*,?\s*{YEAR}", "dmy"),
    ("", rf"{DAY}\s+{MONTH}\s*,?\s*{YEAR}", "dmy"),
    (r"last\s+update\s*:\s*", rf"{MONTH}\s+{YEAR}", "my"),
    (r"issued\s+in\s+", rf"{MONTH}\s+{YEAR}", "my"),
    ("", rf"{MONTH}\s+{YEAR}", "my"),
)
EDITION = ("", rf"{YEAR}(?=\s+edition\b)", "y")


def mine_date(text: Column, edition: bool = True) -> Column:
    """A date in running text: published-on, full date, last-update, issued-in, month and year, edition; of each the last."""

    def last(t: Column, before: str, pattern: str, order: str) -> Column:
        spans = F.regexp_extract_all(t, F.lit(rf"(?i)\b{before}({pattern})\b"), F.lit(1))
        return let(F.try_element_at(spans, F.lit(-1)), lambda m: F.when(m.isNotNull(), _made(m, order)))

    sayings = [*SAYINGS, EDITION] if edition else SAYINGS
    return let(strip_tags(text), lambda t: F.when(t.rlike(r"\d{4}"), F.coalesce(*[last(t, *s) for s in sayings])))


def two_digit_year(yy: Column, pivot: int = 70) -> Column:
    """yy as a year: from the pivot on 19yy, below it 20yy."""
    n = yy.cast("int")
    return F.when(n >= 100, n).when(n >= pivot, n + 1900).otherwise(n + 2000)


def serial_month(text: Column, pivot: int = 70, bad_month_to_january: bool = False) -> Column:
    """``month/year`` serials such as 3/97 or 26/2004 to the month's first day."""
    p = r"^\s*(\d{1,3})/(\d{4}|\d{2})\s*$"
    month = F.regexp_extract(text, p, 1).try_cast("int")
    year = two_digit_year(F.regexp_extract(text, p, 2).try_cast("int"), pivot)
    good = month.between(1, 12)
    month = F.when(good, month).when(F.lit(bad_month_to_january), F.lit(1))
    return F.when(text.rlike(p), F.date_format(F.make_date(year, month, F.lit(1)), "yyyy-MM-dd"))


def latest_year(text: Column) -> Column:
    return F.array_max(F.transform(F.regexp_extract_all(text, F.lit(r"\b((?:19|20)\d{2})\b"), F.lit(1)), lambda y: y.cast("int")))


def is_date(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(text, "yyyy-MM-dd").isNotNull(), F.lit(False))


def is_timestamp(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2})?") & F.try_to_timestamp(text).isNotNull(), F.lit(False))


def date_near(html: Column, href: Column, text: Column, width: int = 700) -> Column:
    """A date in a link's text, its target, or the page around the target, in this order."""
    at = F.position(href, html)
    around = F.substring(html, F.greatest(F.lit(1), at - width), F.length(href) + 2 * width)
    return F.coalesce(mine_date(text), mine_date(F.translate(href, "_-/", "   ")), F.when(at > 0, mine_date(around)))


def date_in_row(html: Column, href: Column) -> Column:
    """A date in the table row that holds a link; editions do not count."""
    at = F.position(href, html)
    before = F.substring_index(F.lower(F.substring(html, F.lit(1), at)), "<tr", -1)
    after = F.substring_index(F.lower(F.substring(html, at, F.length(html))), "</tr", 1)
    return F.when(at > 0, mine_date(F.concat(before, F.lit(" "), after), edition=False))


def preferred_by_precision(a: Column, b: Column, a_has_day: Column | None = None, b_has_day: Column | None = None) -> Column:
    """Of two dates that whose text named a day, else the first that there is; where nothing is told, the first of a month stands for a month."""
    told = lambda d, has: has & d.isNotNull() if has is not None else d.isNotNull() & ~F.endswith(d, F.lit("-01"))
    return F.when(told(a, a_has_day), a).when(told(b, b_has_day), b).otherwise(F.coalesce(a, b))


def edition_date(text: Column) -> Column:
    """Edition, issue or corrigendum with a month or a year: its first day."""
    month = _first(text, rf"(?<=edition |issue |corrigendum ){MONTH}\s+{YEAR}", "my")
    return F.coalesce(month, _first(text, rf"{YEAR}(?=\s+(?:edition|issue|corrigendum)\b)", "y"), _first(text, rf"(?<=edition |issue |corrigendum ){YEAR}", "y"))


def dotted_date(text: Column) -> Column:
    """``Y.M.D`` to ISO."""
    return _first(F.trim(text), rf"^{YEAR}\.{NUMBER}\.{DAY}$", "ymd")


def display_date(date: Column, lang: str = "en") -> Column:
    """An ISO date as people write it: 5 March 2024 or 2024年3月5日."""
    d = F.try_to_date(date, "yyyy-MM-dd")
    return F.date_format(d, "d MMMM yyyy") if lang == "en" else F.concat(F.year(d).cast("string"), F.lit("年"), F.month(d).cast("string"), F.lit("月"), F.day(d).cast("string"), F.lit("日"))


def short_date(timestamp: Column) -> Column:
    """A timestamp as Mar 5, 2024, in the session's time zone."""
    return F.date_format(timestamp, "MMM d, yyyy")


def name_or_url_date(name: Column, url: Column) -> Column:
    """A date in the name, else the url's eight digits that are one."""
    token = F.regexp_extract(url, r"(?:^|[^0-9])((?:19|20)\d{6})(?:[^0-9]|$)", 1)
    return F.coalesce(publish_date(F.regexp_extract(name, rf"(?i){DAY}\s+{MONTH},?\s+{YEAR}", 0)), F.when(token != "", iso(F.substring(token, 1, 4), F.substring(token, 5, 2), F.substring(token, 7, 2))))


def term_of_year(year: Column, first_year: int = 2022, first_term: int = 7, length: int = 4) -> Column:
    """Two digits: the term, ``length`` years each, that a year is in; years before the first term count for it."""
    return F.lpad((F.floor(F.greatest(year - first_year, F.lit(0)) / length) + first_term).cast("string"), 2, "0")


def days_back(end: Column, days: Column) -> Column:
    """The days of a range, the newest first."""
    return F.sequence(end, F.date_sub(end, days), F.expr("interval -1 day"))
