"""Q1-Q3 + A1: SQL access to loaded tables.

``run_sql`` is read-only pass-through to Spark SQL: tables are handed in as DataFrames or found by their
names in a warehouse folder, and bound with ``spark.sql``'s DataFrame arguments, so nothing stays
registered in the session. A warehouse is listed by its folders alone, never by its data files.
"""

from __future__ import annotations

import re

from py4j.java_gateway import is_instance_of
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltline.operators.store import read_table

_LOGICAL = "org.apache.spark.sql.catalyst.plans.logical."
# Plan nodes that are no commands by type but run or write something all the same.
_RUNS = re.compile(r"Insert|\.Call$|ExecuteImmediate|CompoundBody|\.command\.")


def is_query(spark: SparkSession, sql: str) -> bool:
    """Whether Spark's parser reads ``sql`` as one query, without a command or write anywhere in it."""
    gateway = spark.sparkContext._gateway
    todo = [spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)]
    while todo:  # writes also stand below WITH and FROM clauses
        node = todo.pop()
        if any(is_instance_of(gateway, node, _LOGICAL + t) for t in ("Command", "ParsedStatement")) or _RUNS.search(node.getClass().getName()):
            return False
        for group in (node.children(), node.innerChildren()):
            todo += [c for c in (group.apply(i) for i in range(group.size())) if hasattr(c, "innerChildren")]
    return True


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def stored_names(spark: SparkSession, sql: str) -> set[str]:
    """The one-part table names that ``sql`` reads, as written, but for those a WITH clause in scope defines.

    The scopes are Spark's: a WITH names its later entries and its body (itself too when recursive), subqueries
    of expressions see the names around them, and names compare without case.
    """
    gateway = spark.sparkContext._gateway
    is_a = lambda node, name: is_instance_of(gateway, node, "org.apache.spark.sql.catalyst." + name)
    found: set[str] = set()
    todo: list[tuple] = [(spark._jsparkSession.sessionState().sqlParser().parsePlan(sql), frozenset())]
    while todo:
        node, hidden = todo.pop()
        if is_a(node, "analysis.UnresolvedRelation"):
            parts = _items(node.multipartIdentifier())
            if len(parts) == 1 and parts[0].lower() not in hidden:
                found.add(parts[0])
            continue
        if is_a(node, "plans.logical.UnresolvedWith"):
            for entry in _items(node.cteRelations()):
                own = frozenset([entry._1().lower()])
                todo.append((entry._2(), hidden | own if node.allowRecursion() else hidden))
                hidden = hidden | own
            todo.append((node.child(), hidden))
            continue
        if is_a(node, "expressions.PlanExpression"):
            todo.append((node.plan(), hidden))
        if is_a(node, "plans.QueryPlan"):
            todo += [(e, hidden) for e in _items(node.expressions())]
        todo += [(c, hidden) for c in _items(node.children())]
    return found


def _bind(sql: str, tables: dict[str, DataFrame], prefix: dict[str, str]) -> str:
    """``sql`` for ``spark.sql``'s formatter: braces that hold no given name are literal; ``prefix`` names (WITH entry -> placeholder) go in front."""
    text = re.sub(r"\{(\w+)\}|[{}]", lambda m: m.group(0) if m.group(1) in tables else m.group(0).replace("{", "{{").replace("}", "}}"), sql)
    if not prefix:
        return text
    entries = ", ".join("`%s` AS (SELECT * FROM {%s})" % (name.replace("`", "``").replace("{", "{{").replace("}", "}}"), arg) for name, arg in prefix.items())
    return f"WITH {entries} SELECT * FROM (\n{text.rstrip().rstrip(';')}\n)"


def run_sql(spark: SparkSession, sql: str, warehouse: str | None = None, **tables: DataFrame) -> DataFrame:
    """Q1: run a query; writes and commands are refused.

    ``{name}`` placeholders are bound to the given DataFrames. With ``warehouse``, a bare name that no WITH clause
    defines is the stored table of that name (without case, if only one fits); it wins over a session view, and a
    name that the warehouse lacks is left to the session. Only tables that the query names are opened.
    """
    # placeholders are no SQL yet: for the test each is a plain name
    bare = re.sub(r"\{(\w+)\}", lambda m: m.group(1) if m.group(1) in tables else m.group(0), sql)
    if not is_query(spark, bare):
        raise PermissionError("run_sql is read-only: queries only")
    stored: dict[str, DataFrame] = {}
    if warehouse is not None:
        folders = table_names(spark, warehouse)
        for name in sorted(stored_names(spark, bare) - set(tables)):
            fits = [name] if name in folders else [f for f in folders if f.lower() == name.lower()]
            if len(fits) > 1:
                raise ValueError(f"table {name!r} could be any of {fits}")
            if fits and name.lower() not in {n.lower() for n in stored}:
                stored[name] = read_table(spark, f"{warehouse.rstrip('/')}/{fits[0]}")
    if not tables and not stored:
        return spark.sql(sql)
    args = {f"_stored_{i}": df for i, df in enumerate(stored.values())}
    return spark.sql(_bind(sql, tables, dict(zip(stored, args))), **tables, **args)


def table_paths(warehouse: str, names: list[str]) -> dict[str, str]:
    return {n: f"{warehouse.rstrip('/')}/{n}" for n in names}


def table_names(spark: SparkSession, warehouse: str) -> list[str]:
    """Names of a warehouse's tables: one listing of its sub-folders; names that start with ``_`` or ``.`` are no tables."""
    where = spark._jvm.org.apache.hadoop.fs.Path(warehouse)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(where):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(where) if s.isDirectory() and s.getPath().getName()[0] not in "_.")


def list_tables(spark: SparkSession, warehouse: str) -> DataFrame:
    """Q2: (table_name) of the Parquet tables of a warehouse folder; data files are not listed."""
    return spark.createDataFrame([(n,) for n in table_names(spark, warehouse)], "table_name string")


def warehouse_tables(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """Every table of a warehouse folder as a DataFrame (for ``run_sql`` and ``table_counts``)."""
    return {n: read_table(spark, p) for n, p in table_paths(warehouse, table_names(spark, warehouse)).items()}


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """A1 + Q2: (table_name, rows) for every table, in one job (a union of per-table counts)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def describe_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Q3 + S7: (table_name, position, column_name, data_type) from the tables' schemas."""
    rows = [
        (name, i + 1, f.name, f.dataType.simpleString())
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    schema = T.StructType([
        T.StructField("table_name", T.StringType()), T.StructField("position", T.IntegerType()),
        T.StructField("column_name", T.StringType()), T.StructField("data_type", T.StringType()),
    ])
    return spark.createDataFrame(rows, schema)
