"""Column expressions: everything here returns a ``pyspark.sql.Column`` and stays JVM-side."""

from voltline.functions.names import (  # noqa: F401
    base_name,
    in_period,
    percent_decode,
    period_first8,
    period_strict,
    route_table,
    strip_extension,
)
from voltline.functions.text import drop_invalid_utf8, field_count, null_if_token, quoted  # noqa: F401
from voltline.functions.timestamps import parse_market_timestamp  # noqa: F401
