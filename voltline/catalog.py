"""Table catalogue and the fixed values the report format and the routing rules depend on."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the original behaviour for identical results).
# ---------------------------------------------------------------------------------------------

# Table names a file can be routed to; anything else goes to OTHER_DATA.
ROUTABLE_TABLES = (
    "DISPATCHPRICE",
    "DISPATCHLOAD",
    "DISPATCHREGIONSUM",
    "TRADINGPRICE",
    "TRADINGREGIONSUM",
    "DUDETAIL",
    "DUDETAILSUMMARY",
    "DISPATCHINTERCONNECTORRES",
    "TRADINGINTERCONNECT",
    "TRANSMISSIONLOSSFACTOR",
    "ROOFTOP_PV_ACTUAL",
    "ROOFTOP_PV_FORECAST",
)
FALLBACK_TABLE = "OTHER_DATA"

# Tables planned for download by default (the four others are routable but not fetched).
DEFAULT_WANTED_TABLES = (
    "DISPATCHPRICE",
    "DISPATCHREGIONSUM",
    "TRADINGPRICE",
    "DUDETAIL",
    "DUDETAILSUMMARY",
    "DISPATCHINTERCONNECTORRES",
    "TRANSMISSIONLOSSFACTOR",
    "ROOFTOP_PV_ACTUAL",
)

# Primary keys per table (insert-only: an existing key wins).
PRIMARY_KEYS = {
    "DISPATCHPRICE": ("SETTLEMENTDATE", "RUNNO", "REGIONID", "DISPATCHINTERVAL", "INTERVENTION"),
    "DISPATCHREGIONSUM": ("SETTLEMENTDATE", "RUNNO", "REGIONID", "DISPATCHINTERVAL", "INTERVENTION"),
    "TRADINGPRICE": ("SETTLEMENTDATE", "RUNNO", "REGIONID", "PERIODID"),
    "DUDETAIL": ("DUID", "EFFECTIVEDATE", "VERSIONNO"),
    "DUDETAILSUMMARY": ("DUID", "START_DATE"),
    "DISPATCHINTERCONNECTORRES": ("SETTLEMENTDATE", "RUNNO", "INTERCONNECTORID", "INTERVENTION", "DISPATCHINTERVAL"),
    "TRANSMISSIONLOSSFACTOR": ("CONNECTIONPOINTID", "EFFECTIVEDATE", "VERSIONNO"),
    "ROOFTOP_PV_ACTUAL": ("INTERVAL_DATETIME", "TYPE", "REGIONID"),
}

# File-name markers.
DVD_PREFIX = "PUBLIC_DVD_"
ARCHIVE_MARKER = "PUBLIC_ARCHIVE#"
ARCHIVE_MARKER_ENCODED = "PUBLIC_ARCHIVE%23"

# Line tags of the report format.
HEADER_TAG = "I,"
DATA_TAG = "D,"

# Text that reads as NULL in a data or header field (the pandas read_csv default set).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
TRUE_TOKENS = ("True", "TRUE", "true")
FALSE_TOKENS = ("False", "FALSE", "false")

# A column whose upper-cased name contains one of these is coerced to a timestamp.
DATETIME_NAME_MARKERS = ("DATE", "TIME")

# Default period window and poll intervals.
DEFAULT_START_YEAR = 2026
DEFAULT_END_YEAR = 2026
DEFAULT_MONTHS = (1, 2, 3)
LOADER_POLL_SECONDS = 30
CURRENT_FEED_POLL_SECONDS = 300

# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class TableModel:
    """A target table: name, primary key, and (once known) its schema."""

    name: str
    primary_key: tuple[str, ...] = ()
    schema: T.StructType | None = field(default=None, compare=False)

    @property
    def key_columns(self) -> list[str]:
        return list(self.primary_key)


def table_model(name: str, schema: T.StructType | None = None) -> TableModel:
    upper = name.upper()
    return TableModel(upper, PRIMARY_KEYS.get(upper, ()), schema)
