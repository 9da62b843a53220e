"""Readers for the freight source tables.

Each family lives under its own root (one database per family in the source
job); the stage switch of the source job becomes the ``root`` / ``database``
argument. Any Spark source works: parquet (default), ORC, Delta, a catalog
table or JDBC. Every table is conformed to its declared schema: columns are
selected by name (case-insensitive), cast to the declared type, and a missing
column fails fast.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .schemas import ALL_SCHEMAS, CODE_COLUMNS, CW_SCHEMAS, WT_SCHEMAS


class SchemaError(ValueError):
    """A source table lacks a column the feeds need."""


def conform(df: DataFrame, name: str, trim_codes: bool = True) -> DataFrame:
    """Select and cast ``df`` to the declared schema of table ``name``."""
    schema: T.StructType = ALL_SCHEMAS[name]
    actual = {f.name.lower(): f for f in df.schema.fields}  # one analysis, not one per column
    missing = [f.name for f in schema.fields if f.name.lower() not in actual]
    if missing:
        raise SchemaError(f"table {name!r} lacks columns {missing}; has {df.columns}")
    trimmed = set(CODE_COLUMNS.get(name, ())) if trim_codes else set()
    exprs: list[str] = []
    for f in schema.fields:
        src_field = actual[f.name.lower()]
        e = f"`{src_field.name}`"
        # a stored timestamp keeps its type (sessions run in UTC): a cast would
        # keep the load window from reaching the scan
        stored_ts = isinstance(f.dataType, T.TimestampNTZType) and isinstance(src_field.dataType, T.TimestampType)
        if src_field.dataType != f.dataType and not stored_ts:
            e =f"CAST({e} AS {f.dataType.simpleString()})"
        if f.name in trimmed:
            e = f"rtrim({e})"
        exprs.append(f"{e} AS {f.name}")
    return df.selectExpr(*exprs)  # one JVM call per table


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet",
               options: Mapping[str, str] | None = None, trim_codes: bool = True) -> DataFrame:
    """Read one table ``name`` stored at ``{root}/{name}`` (file formats) or
    ``{root}.{name}`` (``fmt='table'``: a catalog database)."""
    if fmt == "table":
        df = spark.table(f"{root}.{name}")
    elif fmt == "jdbc":
        opts = dict(options or {})
        opts.setdefault("dbtable", f"{root}.{name}" if root else name)
        df = spark.read.format("jdbc").options(**opts).load()
    else:
        reader = spark.read.format(fmt)
        if options:
            reader = reader.options(**options)
        df = reader.load(f"{root.rstrip('/')}/{name}")
    return conform(df, name, trim_codes)


def read_family(spark: SparkSession, root: str, family: str, fmt: str = "parquet",
                options: Mapping[str, str] | None = None,
                names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """Read all tables of ``family`` ('wt' or 'cw').

    ``options`` go to the reader of every table; one named ``<table>.<option>``
    goes to that table alone (for JDBC its ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions``, without which one task reads it whole).
    """
    schemas = WT_SCHEMAS if family == "wt" else CW_SCHEMAS
    wanted = list(names) if names is not None else list(schemas)
    return {n: read_table(spark, root, n, fmt, table_options(options, n)) for n in wanted}


def table_options(options: Mapping[str, str] | None, name: str) -> dict[str, str]:
    """The reader options of table ``name``: the shared ones and its own."""
    shared, own = {}, {}
    for key, value in (options or {}).items():
        table, dot, option = key.partition(".")
        if not dot or table not in ALL_SCHEMAS:
            shared[key] = value
        elif table == name:
            own[option] = value
    return {**shared, **own}


def conform_all(tables: Mapping[str, DataFrame], trim_codes: bool = True) -> dict[str, DataFrame]:
    return {n: conform(df, n, trim_codes) for n, df in tables.items()}
