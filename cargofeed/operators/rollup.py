"""Per-key rollups (M3, A2)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sum_by_key(df: DataFrame, key: str, sums: Mapping[str, str]) -> DataFrame:
    """``groupBy(key)`` with one ``sum`` per output column (``out -> input``).

    A plain aggregate: partial sums are combined map-side, so a hot key
    ships one row per map task.
    """
    return df.groupBy(key).agg(*[F.sum(src).alias(out) for out, src in sums.items()])


def rollup_per_key_and_unit(df: DataFrame, key: str, sums: Mapping[str, str],
                            unit: str) -> DataFrame:
    """One row per (``key``, distinct non-empty ``unit``), each carrying the
    totals of the **whole** key (over all rows with a non-empty unit).

    Rows with a NULL or empty unit are excluded from the output and from the
    totals. A key with two units yields two rows with the same totals.

    Plan: aggregate per (key, unit) with map-side partial sums, then add the
    per-unit sums of each key with a window over the *aggregated* rows
    (a few rows per key), instead of a window over the raw rows followed by
    DISTINCT.
    """
    base = df.filter(F.col(unit) != "")
    per_unit = base.groupBy(key, unit).agg(*[F.sum(src).alias(out) for out, src in sums.items()])
    types = {f.name: f.dataType for f in per_unit.schema.fields}
    w = Window.partitionBy(key)
    return per_unit.select(
        key, *[F.sum(out).over(w).cast(types[out]).alias(out) for out in sums], unit)
