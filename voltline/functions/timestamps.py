"""Zone-free parsing of report timestamps (market time, no daylight saving)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted shapes: yyyy/MM/dd or yyyy-MM-dd, optionally followed by HH:mm:ss and a fraction.
_TS_SHAPE = r"^\s*\d{4}[-/]\d{1,2}[-/]\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?\s*$"


def parse_market_timestamp(value: Column | str) -> Column:
    """Text -> TIMESTAMP_NTZ; NULL when the text is not one of the accepted shapes or not a real time.

    The cast never consults the session time zone, so the stored value is the wall-clock text.
    """
    c = F.col(value) if isinstance(value, str) else value
    norm = F.replace(F.trim(c), F.lit("/"), F.lit("-"))
    # single-digit month/day are zero padded so the ANSI cast accepts them
    norm = F.regexp_replace(norm, r"^(\d{4})-(\d)-", "$1-0$2-")
    norm = F.regexp_replace(norm, r"^(\d{4}-\d{2})-(\d)(?!\d)", "$1-0$2")
    return F.when(c.rlike(_TS_SHAPE), norm.try_cast("timestamp_ntz"))


def timestamp_layout(value: Column | str) -> Column:
    """Which layout an accepted time is written in, as text (``9/9/9 9:9:9.6``: separators, parts, digits of the fraction).

    NULL when the text is not of an accepted shape. Two texts of one layout are read by one format."""
    c = F.col(value) if isinstance(value, str) else value
    whole = F.trim(c)
    parts = F.regexp_replace(F.substring_index(whole, ".", 1), r"\d+", "9")
    fraction = F.regexp_extract(whole, r"\.(\d+)$", 1)
    return F.when(c.rlike(_TS_SHAPE), F.when(fraction != "", F.concat(parts, F.lit("."), F.length(fraction).cast("string"))).otherwise(parts))
