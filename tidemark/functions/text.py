"""Text expressions, for all of Unicode's white space where Java's ``\\s`` knows ASCII only."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The entities that most texts hold alone.
COMMON = {"&amp;": "&", "&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'"}
#: A reference ends with its semicolon; what begins like one and has none stays as it is.
REFERENCE = r"&(?:#[0-9]{1,9}|#[xX][0-9A-Fa-f]{1,8}|[A-Za-z][A-Za-z0-9]{1,31});|&|[^&]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def clean_text(text: Column) -> Column:
    """Trimmed, runs of white space as one space; null as ''."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


def character(code: Column) -> Column:
    """The character of a number as HTML reads it: 128 to 159 as Windows-1252 has them, U+FFFD for what is none."""
    old = F.decode(F.unhex(F.lpad(F.hex(code), 2, "0")), "ISO-8859-1")
    for c in range(128, 160):
        said = bytes([c]).decode("windows-1252", "ignore")
        if said:
            old = F.when(code == c, F.lit(said)).otherwise(old)
    none = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    return F.when(none, F.lit("\ufffd")).when(code.between(128, 159), old).otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def unescape_html(text: Column) -> Column:
    """Entities and numeric references undone in one pass, so that what they give is not read again; a non-breaking space becomes a space.

    Names are those of HTML that stand for one or two characters and end with a semicolon, in a map that the plan holds once for each use;
    the most frequent are tried first.  A text without ``&`` is passed on as it is."""
    names = F.str_to_map(F.lit("\x02".join(f"&{k}\x01{v}" for k, v in html5.items() if k.endswith(";"))), F.lit("\x02"), F.lit("\x01"))

    def one(t: Column) -> Column:
        out = F.when(~F.startswith(t, F.lit("&")) | (t == "&"), t)
        for k, v in COMMON.items():
            out = out.when(t == k, F.lit(v))
        number = F.coalesce(F.regexp_extract(t, "^&#([0-9]+);$", 1).try_cast("long"), F.conv(F.nullif(F.regexp_extract(t, "^&#[xX]([0-9A-Fa-f]+);$", 1), F.lit("")), 16, 10).cast("long"))
        out = out.when(F.startswith(t, F.lit("&#")), let(number, lambda n: F.when(n == 160, F.lit(" ")).otherwise(character(n))))
        return out.otherwise(F.coalesce(F.translate(F.try_element_at(names, t), "\xa0", " "), t))

    parts = lambda t: F.array_join(F.transform(F.regexp_extract_all(t, F.lit(REFERENCE), F.lit(0)), one), "")
    return let(text, lambda t: F.when(F.contains(t, F.lit("&")), parts(t)).otherwise(t))


def strip_comments(html: Column) -> Column:
    return F.regexp_replace(html, r"(?s)<!--.*?-->", "")


def strip_tags(html: Column) -> Column:
    return clean_text(unescape_html(F.regexp_replace(html, r"<[^>]+>", " ")))


def trim_spaces(text: Column) -> Column:
    """Without the spaces of Unicode (its class Zs) at both ends; tabs and line ends stay."""
    return F.regexp_replace(text, r"^\p{Zs}+|(?<!\p{Zs})\p{Zs}++\z", "")


def marked_text(html: Column) -> Column:
    """A text as it is written: tags and entities stay, all but ``&amp;``; runs of HTML's white space as one space."""
    return F.replace(trim_spaces(F.regexp_replace(html, r"[\t\n\f\r ]+", " ")), F.lit("&amp;"), F.lit("&"))


def truncate(text: Column, n: int) -> Column:
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n - 3)), F.lit("..."))).otherwise(text)


def percent(part: Column, whole: Column) -> Column:
    return F.when(part.isNull(), None).when(whole > 0, F.format_string("%.1f%%", part * 100.0 / whole)).otherwise(F.lit("0.0%"))


def fold_heading(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def headings_match(actual: Column, expected: Column) -> Column:
    """Either contains the other once both are folded."""
    a, e = fold_heading(actual), fold_heading(expected)
    return (a != "") & (e != "") & (F.contains(a, e) | F.contains(e, a))


def escape_html(text: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def human_bytes(n: Column, largest: str = "GB") -> Column:
    """A size in steps of 1024, in the largest unit (KB, MB or GB) from there on; null stays null."""
    n = n.cast("double")
    steps = F.when(n < 1024, F.format_string("%.0f B", n))
    for power, unit in enumerate(("KB", "MB", "GB"), 1):
        v = n / (1024.0**power)
        steps = steps.when(v.isNotNull() if unit == largest else v < 1024, F.format_string(f"%.1f {unit}", v))
        if unit == largest:
            return steps
    raise ValueError(f"no such unit: {largest}")


def phone(text: Column, country: str = "852") -> Column:
    """Digits only; the country code goes if more than eight are left."""
    digits = F.regexp_replace(text, "[^0-9]", "")
    local = F.when((F.length(digits) > 8) & F.startswith(digits, F.lit(country)), digits.substr(F.lit(len(country) + 1), F.length(digits))).otherwise(digits)
    return F.when(local != "", local)


def email(text: Column) -> Column:
    found = F.lower(F.trim(text))
    return F.when(F.contains(found, F.lit("@")), found)


def strip_prefix(text: Column, prefix: str) -> Column:
    import re

    return F.trim(F.regexp_replace(text, "(?i)^" + re.escape(prefix) + r"\s*", ""))


def tagged(kind: Column, value: Column) -> Column:
    """A scalar with its type, ``type:value``, so that 1 and "1" stay apart."""
    return F.concat(kind, F.lit(":"), F.trim(value))


def expand(text: Column, abbreviations: dict[str, str]) -> Column:
    """Abbreviations that stand alone and begin with a capital, the longest first, in one fold over the table."""
    import re

    for short in sorted(abbreviations, key=lambda s: (-len(s), s)):
        if short[:1].isupper():
            long_ = abbreviations[short].replace("\\", "\\\\").replace("$", "\\$")
            text = F.regexp_replace(text, rf"(?<![A-Za-z0-9]){re.escape(short)}(?![A-Za-z0-9])", long_)
    return text


def base_name(text: Column, tokens: tuple[str, ...]) -> Column:
    """What stands before the first of some tokens (language labels, say)."""
    import re

    return F.trim(F.regexp_extract(text, "(?i)^(.*?)(?:" + "|".join(map(re.escape, tokens)) + "|$)", 1))


def link_label(text: Column) -> Column:
    """A link's text without window notices, the word pdf and file sizes in brackets."""
    t = F.regexp_replace(text, r"(?i)\(?\s*(?:opens? in|this\s*link\s*will\s*open\s*in)\s*(?:a\s*)?new\s*window\s*\)?", " ")
    t = F.regexp_replace(F.regexp_replace(t, r"(?i)\bpdf\b", " "), r"(?i)\(?[\s,:-]*\d[\d.,]*\s*[kmg]b\s*\)?", " ")
    return clean_text(F.regexp_replace(t, r"\(\s*\)", " "))


def first_non_blank(*options: Column) -> Column:
    return F.coalesce(*[F.when(F.trim(o) != "", o) for o in options])


def is_chinese_only(text: Column) -> Column:
    return text.rlike("[\\u4e00-\\u9fff]") & ~text.rlike("[A-Za-z]")


def link_language(text: Column) -> Column:
    """zh, other or en by the scripts in a link's text."""
    return F.when(text.rlike("[\\u4e00-\\u9fff]"), "zh").when(text.rlike("[^\\x00-\\x{24f}]"), "other").otherwise("en")


def locale_of_path(url: Column, default: str = "en") -> Column:
    found = F.lower(F.regexp_extract(url, r"(?i)/(en|tc|sc|zh|fr|de|es)(?:/|$)", 1))
    return F.when(found != "", found).otherwise(F.lit(default))


def reference_number(text: Column, label: str) -> Column:
    """The number after a label such as Circular No., Item, Version or Issue, '' without one."""
    return F.upper(F.regexp_extract(text, rf"(?i)\b{label}\.?\s*(?:no\.?|number)?\s*:?\s*([0-9]+(?:[./][0-9]+)*[A-Za-z]?)\b", 1))


def title_before(text: Column, marks: tuple[str, ...], site: str = "") -> Column:
    """A title without the site's label in front and without what follows a mark."""
    import re

    title = strip_prefix(clean_text(text), site) if site else clean_text(text)
    return F.trim(F.regexp_replace(title, "(?i)\\s*(?:" + "|".join(map(re.escape, marks)) + ").*$", ""))


def untagged(tag: Column) -> Column:
    """The value of ``tagged``."""
    return F.regexp_replace(tag, "^[^:]*:", "")


def segment(text: Column, skip: tuple[str, ...] = ("home", "index")) -> Column:
    """A part of a directory path, null for letters of an index and for names to skip."""
    t = clean_text(text)
    return F.when(~t.rlike("(?i)^[a-z](?:\\s*-\\s*[a-z])?$") & ~F.lower(t).isin("", *skip), t)


def used_abbreviations(text: Column, abbreviations: dict[str, str]) -> Column:
    """The abbreviations that ``expand`` finds, in order of length."""
    import re

    known = [s for s in sorted(abbreviations, key=lambda s: (-len(s), s)) if s[:1].isupper()]
    return F.filter(F.array(*[F.when(text.rlike(rf"(?<![A-Za-z0-9]){re.escape(s)}(?![A-Za-z0-9])"), F.lit(s)) for s in known]), lambda x: x.isNotNull())
