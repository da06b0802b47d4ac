"""URL expressions.  Java's URI parser rejects urls that real pages hold, so parts come from the pattern of RFC 3986, appendix B."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_text, let, trim_spaces

PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
#: The same up to the last character: line ends are part of a url, but a line feed in the fragment makes it none.
WHOLE = PARTS.removesuffix("(?:#(.*))?$") + r"(?:#([^\n]*))?\z"
SCHEME, AUTHORITY, PATH, QUERY, FRAGMENT = 1, 2, 3, 4, 5
#: Schemes that never name a document.
REJECTED = ("javascript", "mailto", "tel")


def part(url: Column, number: int) -> Column:
    return F.regexp_extract(url, PARTS, number)


def is_absolute(url: Column) -> Column:
    return F.coalesce(F.trim(url).rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+"), F.lit(False))


def split_url(url: Column) -> Column:
    """(scheme, authority, path, query, fragment) as an array from one match; '' where a part is absent.  A line break ends a url."""
    clean = F.regexp_extract(F.translate(url, "\x01", ""), r"^[^\r\n\u0085\u2028\u2029]*", 0)
    return F.split(F.regexp_replace(clean, PARTS, "$1\x01$2\x01$3\x01$4\x01$5"), "\x01")


def canonical_url(url: Column, allowed_host: str | None = None, encode_spaces: bool = False) -> Column:
    """Scheme and host in lower case, no fragment, no slashes at the path's end; null if not absolute or of a rejected scheme."""
    s = F.trim(url)
    if encode_spaces:
        s = F.replace(s, F.lit(" "), F.lit("%20"))

    def of(p: Column) -> Column:
        scheme, host, path, query = F.lower(p[0]), F.lower(p[1]), p[2], p[3]
        path = F.when(path.isin("", "/"), F.lit("/")).otherwise(F.regexp_replace(path, "/+$", ""))
        good = (scheme != "") & (host != "") & ~scheme.isin(*REJECTED)
        if allowed_host is not None:
            good &= host == allowed_host.lower()
        return F.when(good, F.concat(scheme, F.lit("://"), host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit(""))))

    return let(split_url(s), of)


def remove_dots(path: Column) -> Column:
    """Dot segments of an absolute path, by one fold over its segments (RFC 3986, 5.2.4)."""
    segments = F.slice(F.split(path, "/"), F.lit(2), F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0)))
    start = F.array().cast("array<string>")
    kept = F.aggregate(
        segments,
        start,
        lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(s == ".", done).otherwise(F.array_append(done, s)),
    )
    end = F.when(path.rlike(r"/\.{1,2}$"), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(F.size(kept) > 0, end).otherwise(F.lit("")))


def resolve(base: Column, href: Column) -> Column:
    """Reference resolution of RFC 3986, 5.2, with the fragment kept; each url is matched once."""

    def of(b: Column, h: Column, p: Column) -> Column:
        root = F.concat(b[0], F.lit("://"), b[1])
        folder = F.regexp_extract(b[2], "^(.*/)", 1)
        folder = F.when(folder == "", F.lit("/")).otherwise(folder)
        tail = F.regexp_extract(h, r"[?#].*$", 0)
        query = F.when(b[3] != "", F.concat(F.lit("?"), b[3])).otherwise(F.lit(""))
        path = F.when(F.startswith(p[2], F.lit("/")), p[2]).otherwise(F.concat(folder, p[2]))
        return (
            F.when(h == "", F.concat(root, b[2], query))
            .when(p[0] != "", h)
            .when(F.startswith(h, F.lit("//")), F.concat(b[0], F.lit(":"), h))
            .when(F.startswith(h, F.lit("?")), F.concat(root, b[2], h))
            .when(F.startswith(h, F.lit("#")), F.concat(root, b[2], query, h))
            .otherwise(F.concat(root, remove_dots(path), tail))
        )

    return let(split_url(base), lambda b: let(F.trim(href), lambda h: let(split_url(h), lambda p: of(b, h, p))))


def path_extension(url: Column) -> Column:
    """What follows the last dot anywhere in the path, with the dot; '' without one."""
    found = F.regexp_extract(F.lower(part(url, PATH)), r"\.([^.]*)$", 1)
    return F.when(F.contains(part(url, PATH), F.lit(".")), F.concat(F.lit("."), found)).otherwise(F.lit(""))


def file_extension(url: Column) -> Column:
    """Extension of the last segment, '(no_ext)' without one."""
    found = F.lower(F.regexp_extract(part(url, PATH), r"(\.[^./]+)$", 1))
    return F.when(found == "", F.lit("(no_ext)")).otherwise(found)


def percent_decode(text: Column) -> Column:
    """Percent escapes decoded, ``+`` kept; text with broken escapes stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def name_from_link(text: Column, url: Column, as_written: bool = False) -> Column:
    """The link's text, else the last path segment without extension and with its marks as spaces.

    As written, percent escapes and runs of white space in the segment stay, and so do line ends of the url."""
    path, end = (F.regexp_extract(url, WHOLE, PATH), r"\z") if as_written else (part(url, PATH), "$")
    tail = F.regexp_extract(F.regexp_replace(path, f"/+{end}", ""), f"([^/]*){end}", 1)
    tail = F.regexp_replace(tail if as_written else percent_decode(tail), rf"\.[^.]*{end}", "")
    tail = F.translate(tail, "_-", "  ")
    tail = trim_spaces(tail) if as_written else clean_text(tail)
    said = clean_text(text)
    return F.coalesce(F.when(said != "", said), F.when(tail != "", tail))


def in_scope(url: Column, prefixes: tuple[str, ...]) -> Column:
    """Is the url one of the prefixes or below it?  Prefixes are literals: ``_`` and ``%`` mean themselves."""
    found = F.lit(False)
    for p in prefixes:
        base = p.rstrip("/")
        found = found | (url == base) | F.startswith(url, F.lit(base + "/"))
    return found


def swap_language(url: Column, old: str, new: str) -> Column:
    """The first ``/old/`` as ``/new/``."""
    return F.regexp_replace(url, f"^(.*?)/{old}/", f"$1/{new}/")


def redirect_target(url: Column, parameter: str) -> Column:
    """The url that a query parameter names, resolved against the url itself; the url without one."""
    said = percent_decode(F.regexp_extract(part(url, QUERY), rf"(?:^|&){parameter}=([^&]*)", 1))
    return F.when(said != "", canonical_url(resolve(url, said))).otherwise(url)


def scope_prefix(path: Column) -> Column:
    """A path as a scope: one slash in front, none behind; the root stays."""
    inner = F.regexp_replace(F.trim(path), "^/+|/+$", "")
    return F.concat(F.lit("/"), F.lower(inner))


def templated(template: str, **parts: Column) -> Column:
    """A url template's ``{name}`` places filled in."""
    out = F.lit(template)
    for name, value in parts.items():
        out = F.replace(out, F.lit("{" + name + "}"), value.cast("string"))
    return out


def title_by_folder(url: Column, titles: Column, default: str = "en") -> Column:
    """Of a map of titles that of the url's language folder, else the default's."""
    folder = F.lower(F.regexp_extract(url, r"(?i)/(en|tc|sc|zh)/", 1))
    return F.coalesce(titles[F.when(folder == "zh", F.lit("tc")).otherwise(folder)], titles[default])


def locale_tag(tag: Column) -> Column:
    """en, tc or sc of the many ways to write a locale; null for others."""
    low = F.lower(F.replace(F.trim(tag), F.lit("_"), F.lit("-")))
    return F.when(low.isin("en", "en-us", "en-gb", "eng", "english"), "en").when(low.isin("tc", "zh-hk", "zh-tw", "zh-hant", "chi"), "tc").when(low.isin("sc", "zh-cn", "zh-hans"), "sc")
