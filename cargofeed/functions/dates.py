"""Date expressions: day keys, sentinel dates, feed date text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value that must equal the source job's: the "unknown" departure date.
SENTINEL_DATE = dt.date(1900, 1, 1)
# Feed date text, YYYY-MM-DD
FEED_DATE_FORMAT = "yyyy-MM-dd"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(ts: Column | str) -> Column:
    """Calendar day of a timestamp (session time zone UTC)."""
    return F.to_date(_col(ts))


def null_if_sentinel(ts: Column | str, sentinel: dt.date = SENTINEL_DATE) -> Column:
    """``ts``, or NULL when it falls on the sentinel day."""
    ts = _col(ts)
    return F.when(day(ts) == F.lit(sentinel), F.lit(None)).otherwise(ts)


def feed_date(c: Column | str) -> Column:
    """Date text as written to the feeds."""
    return F.date_format(_col(c), FEED_DATE_FORMAT)
