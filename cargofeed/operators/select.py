"""Row selection per key: latest-by-sequence (M1) and first-by-time (M2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def latest_by_sequence(df: DataFrame, key: str, seq: str, keep: Column | None = None,
                       strategy: str = "max_join") -> DataFrame:
    """Rows of ``df`` whose ``seq`` equals the maximum ``seq`` of their ``key``.

    Ties on the maximum are all kept; rows with a NULL key or a NULL ``seq``
    never qualify. The maximum is taken over **all** rows of the key;
    ``keep`` is a filter applied to the returned rows only (for example a
    date window), so a key whose latest row falls outside the window yields
    nothing rather than an older row.

    strategy
        ``"max_join"`` (default): ``max(seq)`` per key over a two-column
        projection (partial aggregation before the shuffle, the columnar
        scan reads only ``key`` and ``seq``), joined back to the rows that
        pass ``keep``. ``keep`` is pushed into the row-side scan, so only
        the wanted rows are read in full.

        ``"window"``: ``rank() over (partition by key order by seq desc) = 1``.
        Spark plans a partial ``WindowGroupLimit`` before the shuffle, so
        every map task already drops all but the top-ranked rows of each
        key. Best when no ``keep`` filter narrows the rows.
    """
    valid = df.filter(F.col(key).isNotNull() & F.col(seq).isNotNull())
    if strategy == "window":
        ranked = valid.withColumn(
            _RANK, F.rank().over(Window.partitionBy(key).orderBy(F.col(seq).desc())))
        out = ranked.filter(F.col(_RANK) == 1).drop(_RANK)
        return out if keep is None else out.filter(keep)
    if strategy != "max_join":
        raise ValueError(f"unknown strategy {strategy!r}")
    rows = valid if keep is None else valid.filter(keep)
    latest = valid.groupBy(key).agg(F.max(seq).alias(seq))
    return rows.join(latest, on=[key, seq], how="inner")


def first_by_time(df: DataFrame, parent: str, time: str, tie: Sequence[str]) -> DataFrame:
    """Exactly one row per ``parent``: the earliest ``time``, ties broken by
    ``tie`` columns ascending with NULLs last.

    Rows with a NULL ``parent`` or ``time`` are dropped. One ``row_number``
    window replaces "join to the minimum, then rank": Spark plans a partial
    ``WindowGroupLimit`` before the shuffle, so a parent holding a large
    share of rows sends one row per map task, not all of them.
    """
    order = [F.col(time).asc()] + [F.col(c).asc_nulls_last() for c in tie]
    w = Window.partitionBy(parent).orderBy(*order)
    valid = df.filter(F.col(parent).isNotNull() & F.col(time).isNotNull())
    return valid.withColumn(_RANK, F.row_number().over(w)).filter(F.col(_RANK) == 1).drop(_RANK)
