"""Links of listing pages -> rows (page, position, href, absolute url, file name).

Comments, scripts and styles are removed first (an anchor inside them is not a link). The URL join
follows RFC 3986 reference resolution for the cases listing pages use: absolute, scheme-relative,
root-relative, query-only, fragment-only, empty and path-relative references; dot segments are
collapsed. Attributes are read by their exact names, with or without quotes, and character references
in a link are resolved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltline.functions.names import percent_decode

_STRIP = (r"(?s)<!--.*?-->", r"(?is)<script\b[^>]*>.*?</script\s*>", r"(?is)<style\b[^>]*>.*?</style\s*>")
# An anchor's attributes up to the one named href, and its value with its quotes if any.
_HREF = r"""(?i)<a(?=[\s/])(?:[\s/]+[^\s"'>/=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?)*?[\s/]+href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
# The named character references that links hold in practice.
_NAMED = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}
# A link's text cut into references and what lies between them.
_REFERENCES = r"&(?:lt|gt|quot|apos|amp);|&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|[^&]+|&"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_markup_noise(html: Column | str) -> Column:
    """Remove comments, scripts and styles in one regex pass (leftmost block wins, as in a parser)."""
    combined = "(?is)" + "|".join(p.split(")", 1)[1] for p in _STRIP)
    return F.regexp_replace(_col(html), combined, "")


def _referred(piece: Column) -> Column:
    """The character that a reference stands for; other pieces as they are."""
    hexa, number = piece.rlike(r"^&#[xX]"), piece.rlike(r"^&#.*;$")
    digits = F.substring(piece, F.when(hexa, 4).otherwise(3), F.length(piece) - F.when(hexa, 4).otherwise(3))
    code = F.when(hexa, F.conv(digits, 16, 10)).otherwise(digits).cast("int")
    real = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    out = F.when(number, F.when(real, char).otherwise("\ufffd")).otherwise(piece)
    for name, c in _NAMED.items():
        out = F.when(piece == name, c).otherwise(out)
    return out


def _plain_value(raw: Column) -> Column:
    """An attribute's value without its quotes, character references (named and numeric) resolved once, left to right."""
    quoted = raw.startswith('"') | raw.startswith("'")
    value = F.when(quoted, F.substring(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)
    pieces = F.regexp_extract_all(value, F.lit(_REFERENCES), F.lit(0))
    return F.when(value.contains("&"), F.array_join(F.transform(pieces, _referred), "")).otherwise(value)


def collapse_dots(url: Column) -> Column:
    """``url`` without ``.`` and ``..`` segments in its path."""
    split = r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)?([^?#]*)(.*)$"
    path = F.regexp_extract(url, split, 2)
    parts = F.split(path, "/")
    kept = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(s == ".", acc).otherwise(F.concat(acc, F.array(s))),
    )
    tail = F.when(F.element_at(parts, -1).isin(".", ".."), "/").otherwise("")
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(F.size(kept) > 0, tail).otherwise(""))
    clean = F.concat(F.regexp_extract(url, split, 1), joined, F.regexp_extract(url, split, 3))
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), clean).otherwise(url)


def resolve_url(base: Column | str, href: Column | str) -> Column:
    """Absolute URL of ``href`` seen from page ``base``."""
    b, h = _col(base), F.trim(_col(href))
    scheme = F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.\-]*):", 1)
    origin = F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)
    no_frag = F.regexp_replace(b, r"#.*$", "")
    no_query = F.regexp_replace(no_frag, r"\?.*$", "")
    path = F.substring(no_query, F.length(origin) + 1, 1 << 30)
    base_dir = F.concat(origin, F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, r"[^/]*$", "")))
    return (
        F.when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("/"), collapse_dots(F.concat(origin, h)))
        .when(h.startswith("?"), F.concat(no_query, h))
        .when(h.startswith("#"), F.concat(no_frag, h))
        .when(h == "", b)
        .otherwise(collapse_dots(F.concat(base_dir, h)))
    )


def page_links(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", suffix: str | None = ".zip") -> DataFrame:
    """One row per anchor, nothing resolved yet: page_id, page_url, position (1-based, document order), href, file_name.

    ``suffix`` keeps only hrefs ending with it (any case); ``None`` keeps all. ``file_name`` is the
    percent-decoded last path segment, upper-cased. A link's value is a generator output, so that tests
    on it above don't read it again.
    """
    hrefs = F.regexp_extract_all(strip_markup_noise(html), F.lit(_HREF), 1)
    out = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("page_url"), F.posexplode(hrefs).alias("pos", "raw"))
    out = out.select("page_id", "page_url", (F.col("pos") + 1).alias("position"), F.explode(F.array(_plain_value(F.col("raw")))).alias("href"))
    if suffix:
        out = out.filter(F.lower("href").endswith(suffix.lower()))
    return out.select("*", F.upper(F.substring_index(percent_decode("href"), "/", -1)).alias("file_name"))


def extract_links(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", suffix: str | None = ".zip") -> DataFrame:
    """``page_links`` with the absolute url: page_id, position, href, url, file_name."""
    return page_links(pages, page_id, url, html, suffix).select("page_id", "position", "href", resolve_url("page_url", "href").alias("url"), "file_name")
