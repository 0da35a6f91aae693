"""Line-level text expressions for the report format (P1, P2, P7, NULL tokens)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltline import catalog

# Fixed value: the characters str.strip() removes (Unicode White_Space plus the C0 separators).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds (back-ticks are doubled)."""
    return F.col("`" + name.replace("`", "``") + "`")


def drop_invalid_utf8(value: Column | str) -> Column:
    """Invalid UTF-8 bytes are dropped (a genuine U+FFFD in such a line goes too).

    Valid text (nearly every line) takes the fast path and is returned as it is.
    """
    c = _col(value)
    return F.when(F.is_valid_utf8(c), c).otherwise(F.replace(F.make_valid_utf8(c), F.lit("\ufffd"), F.lit("")))


def strip_right(value: Column | str) -> Column:
    """Remove trailing white space (the str.strip() set); no regex."""
    return F.rtrim(_col(value), F.lit(WHITESPACE))


def _commas(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(","), F.lit("")))


def field_count(value: Column | str) -> Column:
    """Number of CSV fields, counting quoted commas and doubled quotes correctly.

    Lines without a quote (the common case) are counted without a regex.
    """
    c = _col(value)
    unquoted = F.regexp_replace(c, r'"[^"]*"', "")
    return F.when(c.contains('"'), _commas(unquoted)).otherwise(_commas(c)) + 1


def null_if_token(value: Column | str) -> Column:
    """A field that reads as a NULL marker becomes NULL."""
    c = _col(value)
    return F.when(c.isNull() | c.isin(*catalog.NULL_TOKENS), F.lit(None).cast("string")).otherwise(c)
