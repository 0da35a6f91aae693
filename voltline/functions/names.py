"""File-name rules as Column expressions: routing (F1), periods (F2, F3), period window.

All of them work on a string column holding a bare file name, so they can run on a listing of
millions of paths before any file is opened (that is the pruning step of every job).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltline import catalog

# Period patterns: R1 needs a valid month, R2 takes the first 8-digit run as it is.
_PERIOD_STRICT = r"(\d{4})(0[1-9]|1[0-2])\d{2}"
_PERIOD_FIRST8 = r"(\d{4})(\d{2})\d{2}"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base_name(path: Column | str) -> Column:
    """Last path segment of a path or URL."""
    return F.substring_index(_col(path), "/", -1)


def percent_decode(name: Column | str) -> Column:
    """Decode %XX escapes, keeping '+' as is; text with a malformed escape is returned unchanged."""
    c = _col(name)
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def strip_extension(name: Column | str) -> Column:
    """Drop the last '.ext'; a name made only of leading dots plus a stem keeps its stem."""
    return F.regexp_replace(_col(name), r"^(\.*[^.].*)\.[^.]*$", "$1")


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body`` (keeps generated code small)."""
    return F.get(F.transform(F.array(value), body), 0)


def route_table(name: Column | str, decode: bool = False) -> Column:
    """target table for a report file name (OTHER_DATA when unrecognised).

    ``decode=False`` routes the name as it is, so ``PUBLIC_ARCHIVE%23T%23...`` falls to OTHER_DATA
    as in the original; ``decode=True`` decodes first (deviation V2).
    """
    n = _col(name)
    if decode:
        n = percent_decode(n)

    def part_of(stem: Column) -> Column:
        dvd = F.regexp_replace(F.substring(stem, len(catalog.DVD_PREFIX) + 1, 1 << 30), r"_\d{8,12}$", "")
        return (
            F.when(stem.startswith(catalog.DVD_PREFIX), dvd)
            .when(stem.contains(catalog.ARCHIVE_MARKER), F.split_part(stem, F.lit("#"), F.lit(2)))
            .otherwise(stem)
        )

    part = _let(F.upper(strip_extension(n)), part_of)
    routes = F.create_map(*[x for t in catalog.ROUTABLE_TABLES for x in (F.lit(t), F.lit(t))])
    return F.coalesce(F.try_element_at(routes, part), F.lit(catalog.FALLBACK_TABLE))


def _period(name: Column | str, pattern: str) -> Column:
    def fields(decoded: Column) -> Column:
        year = F.regexp_extract(decoded, pattern, 1)
        month = F.regexp_extract(decoded, pattern, 2)
        return F.struct(
            F.when(year != "", year.cast("int")).alias("year"),
            F.when(month != "", month.cast("int")).alias("month"),
        )

    return _let(percent_decode(F.upper(_col(name))), fields)


def period_strict(name: Column | str) -> Column:
    """struct(year, month) of the first 8-digit window whose month is 1-12, else NULLs."""
    return _period(name, _PERIOD_STRICT)


def period_first8(name: Column | str) -> Column:
    """struct(year, month) of the first 8-digit run, month unchecked (may be 0 or 13+)."""
    return _period(name, _PERIOD_FIRST8)


def in_period(
    year: Column | str,
    month: Column | str,
    start_year: int,
    end_year: int,
    months: Iterable[int],
    zero_is_unknown: bool = False,
) -> Column:
    """period window test; an unknown period passes.

    With ``zero_is_unknown`` a year or month of 0 also counts as unknown (the first-8 callers).
    """
    y, m = _col(year), _col(month)
    unknown = y.isNull() | m.isNull()
    if zero_is_unknown:
        unknown = unknown | (y == 0) | (m == 0)
    inside = y.between(start_year, end_year) & m.isin(*list(months))
    return unknown | inside
