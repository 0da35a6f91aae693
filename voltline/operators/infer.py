"""P8 + P9: infer column types of all-string report rows, then cast.

Inference is one global aggregate (partial aggregation on every partition, one row to the driver).
Rules, per column, over its non-NULL values:

    no values at all                  -> DOUBLE (TIMESTAMP_NTZ for a date/time-named column)
    every value an integer (64 bit)   -> BIGINT (a wider integer makes the column STRING)
    every value a decimal number      -> DOUBLE
    every value a true/false word     -> BOOLEAN
    otherwise                         -> STRING

A column whose upper-cased name contains DATE or TIME and would otherwise be STRING becomes
TIMESTAMP_NTZ (unparseable text -> NULL); numeric and boolean columns keep their type (V7).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltline import catalog
from voltline.functions.text import quoted
from voltline.functions.timestamps import parse_market_timestamp, timestamp_layout

# Shapes of integer and decimal text (every integer is a decimal). The pattern is checked before the cast: a failed cast
# costs an exception inside the JVM, and the pattern also refuses Java-only forms the cast would take (1d, 0x1p3).
_INT = r"^\s*[+-]?\d+\s*$"
_FLOAT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|inf|Inf|INF|infinity|Infinity|nan|NaN)\s*$"


def _is_decimal(c):
    return c.rlike(_FLOAT) & c.try_cast("double").isNotNull()


# Value classes as bits; a column's type is the AND over its values (NULL is neutral).
_INT_BIT, _NUM_BIT, _BOOL_BIT = 1, 2, 4


# Text of so many characters that reads as an integer fits 64 bits, whatever its digits are.
_SAFE_LENGTH = 18
_PLAIN_DECIMAL = r"^-?\d+\.\d+$"


def value_class(c):
    """Small integer class of one text value: integer 3, other number 2, true/false word 4, other 0.

    A pattern costs more than a search for a character, the wide pattern more than the others, so the usual values
    (plain integers and decimals, times) are told by one pattern at most; other text meets the patterns in turn.
    """
    integer = c.rlike(_INT)
    return (
        F.when(c.isNull(), F.lit(_INT_BIT | _NUM_BIT | _BOOL_BIT))
        .when(c.contains("/") | c.contains(":"), F.lit(0))  # no number or word has these
        .when(c.contains("."), F.when(c.rlike(_PLAIN_DECIMAL) | _is_decimal(c), F.lit(_NUM_BIT)).otherwise(F.lit(0)))
        .when(integer & (F.length(c) <= _SAFE_LENGTH), F.lit(_INT_BIT | _NUM_BIT))
        .when(integer, F.when(c.try_cast("bigint").isNotNull(), F.lit(_INT_BIT | _NUM_BIT)).otherwise(F.lit(0)))  # one beyond 64 bit keeps its digits as text
        .when(c.isin(*catalog.TRUE_TOKENS, *catalog.FALSE_TOKENS), F.lit(_BOOL_BIT))
        .when(_is_decimal(c), F.lit(_NUM_BIT))
        .otherwise(F.lit(0))
    )


def is_datetime_name(name: str) -> bool:
    upper = name.upper()
    return any(marker in upper for marker in catalog.DATETIME_NAME_MARKERS)


def column_classes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, n, m) of each column: its place in ``columns``, how many values it has, the AND of their classes; no rows, none.

    The values of a row are put below each other, so the rules stand in the plan once, however many columns there are.
    """
    values = df.select(F.posexplode(F.array(*[quoted(c) for c in columns])).alias("i", "v"))
    return values.groupBy("i").agg(F.count("v").alias("n"), F.bit_and(value_class(F.col("v"))).alias("m"))


def infer_types(df: DataFrame, columns: Sequence[str]) -> dict[str, T.DataType]:
    """Infer a type per string column with a single aggregate over ``df`` (two small buffers per column)."""
    if not columns:
        return {}
    rows = {r["i"]: (r["n"], r["m"]) for r in column_classes(df, columns).collect()}
    return {name: _type_of(name, *rows.get(i, (0, None))) for i, name in enumerate(columns)}


def _type_of(name: str, values: int, mask: int | None) -> T.DataType:
    mask = mask or 0
    if not values:
        return T.TimestampNTZType() if is_datetime_name(name) else T.DoubleType()
    if mask & _INT_BIT:
        return T.LongType()
    if mask & _NUM_BIT:
        return T.DoubleType()
    if mask & _BOOL_BIT:
        return T.BooleanType()
    return T.TimestampNTZType() if is_datetime_name(name) else T.StringType()


_TYPES: dict[str, T.DataType] = {t.simpleString(): t for t in (T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampNTZType(), T.StringType())}


def infer_types_by_file(df: DataFrame, columns: Sequence[str], file_column: str = "_source_file") -> DataFrame:
    """P8 as each file alone would have it: (source_file, position, column_name, values, inferred_type), one aggregate by file.

    Two small buffers per column and file are combined in each task before they move; a file of very many rows is read by
    many tasks. The type of a column without values in a file is that of ``infer_types``.
    """
    per = df.groupBy(quoted(file_column).alias("source_file")).agg(
        *[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(columns)], *[F.bit_and(value_class(quoted(c))).alias(f"m{i}") for i, c in enumerate(columns)])

    def named(i: int, name: str):
        n, m = F.col(f"n{i}"), F.col(f"m{i}")
        text = "timestamp_ntz" if is_datetime_name(name) else "string"
        found = (F.when(n == 0, "timestamp_ntz" if is_datetime_name(name) else "double").when(m.bitwiseAND(_INT_BIT) != 0, "bigint")
                 .when(m.bitwiseAND(_NUM_BIT) != 0, "double").when(m.bitwiseAND(_BOOL_BIT) != 0, "boolean").otherwise(text))
        return F.struct(F.lit(i + 1).alias("position"), F.lit(name).alias("column_name"), n.alias("values"), found.alias("inferred_type"))

    return per.select("source_file", F.inline(F.array(*[named(i, c) for i, c in enumerate(columns)])))


def types_of_first_file(by_file: DataFrame) -> dict[str, T.DataType]:
    """Type of each column in the first file, in path order, that has a value there (any file's without one): a row per column."""
    first = F.min_by("inferred_type", F.struct(F.col("values") == 0, "source_file"))
    rows = by_file.groupBy("column_name").agg(first.alias("t")).collect()
    return {r["column_name"]: _TYPES[r["t"]] for r in rows}


def coerce_first_format(df: DataFrame, columns: Sequence[str], order: Sequence[str], file_column: str = "_source_file") -> DataFrame:
    """P9 by the rule of one format: in each file the first value of a column that is there decides its layout; others are NULL.

    ``order`` orders a file's rows. The first values come from one aggregate by file, combined in each task, and return
    by a join on the file; all rows and other columns stay, the listed columns become TIMESTAMP_NTZ.
    """
    at = F.struct(*[quoted(c) for c in order])
    firsts = df.groupBy(quoted(file_column).alias("_f")).agg(
        *[F.min_by(quoted(c), F.when(quoted(c).isNotNull(), at)).alias(f"_first{i}") for i, c in enumerate(columns)])
    formats = firsts.select("_f", *[timestamp_layout(f"_first{i}").alias(f"_layout{i}") for i in range(len(columns))])
    joined = df.join(formats, quoted(file_column).eqNullSafe(F.col("_f")), "left")
    place = {c: i for i, c in enumerate(columns)}
    kept = lambda c: F.when(timestamp_layout(quoted(c)) == F.col(f"_layout{place[c]}"), parse_market_timestamp(quoted(c)))
    return joined.select(*[kept(c).alias(c) if c in place else quoted(c) for c in df.columns])


def cast_string_column(name: str, target: T.DataType, strict: bool = False):
    """String column -> ``target``; unconvertible text becomes NULL (or fails with ``strict``)."""
    c = quoted(name)
    if isinstance(target, T.StringType):
        return c.alias(name)
    if isinstance(target, (T.TimestampNTZType, T.TimestampType)):
        v = parse_market_timestamp(c)
        return (v if isinstance(target, T.TimestampNTZType) else v.cast("timestamp")).alias(name)
    if isinstance(target, T.BooleanType):
        return (
            F.when(c.isin(*catalog.TRUE_TOKENS), F.lit(True)).when(c.isin(*catalog.FALSE_TOKENS), F.lit(False))
        ).alias(name)
    trimmed = F.trim(c)
    return (trimmed.cast(target) if strict else trimmed.try_cast(target)).alias(name)


def apply_types(df: DataFrame, types: dict[str, T.DataType], strict: bool = False) -> DataFrame:
    """Cast the listed string columns, keep every other column as it is."""
    return df.select(*[cast_string_column(c, types[c], strict) if c in types else quoted(c) for c in df.columns])
