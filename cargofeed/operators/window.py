"""Load window (M13): full load or N-day lookback on a timestamp column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import LoadWindow


def load_window(df: DataFrame, ts: str, window: LoadWindow) -> DataFrame:
    """Rows whose ``ts`` falls on or after ``window.start`` (NULL dropped).

    ``to_date(ts) >= date`` is rewritten by Catalyst into a timestamp bound
    that is pushed into the Parquet scan (row-group skipping, and partition
    pruning when the source is partitioned by that column).
    """
    return df.filter(F.to_date(F.col(ts)) >= F.lit(window.start))
