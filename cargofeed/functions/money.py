"""Currency conversion of one charge line (M8, per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.schemas import DEC, RATE

# Fixed value that must equal the source job's: the reporting currency.
REPORTING_CURRENCY = "USD"
# Which day's rate converts a line.
PRE, POST = "PRE", "POST"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rate_needed(local_cur: Column | str, post_date: Column | str,
                reporting_currency: str = REPORTING_CURRENCY) -> Column:
    """``PRE`` (the shipment's creation day), ``POST`` (the invoice day) or NULL: whose rate :func:`converted_cost` reads."""
    same = F.coalesce(_col(local_cur) == reporting_currency, F.lit(False))
    return F.when(~same, F.when(_col(post_date).isNull(), F.lit(PRE)).otherwise(F.lit(POST)))


def converted_cost(local_cur: Column | str, local_amt: Column | str,
                   post_date: Column | str, os_amt: Column | str,
                   pre_rate: Column | str, post_rate: Column | str,
                   reporting_currency: str = REPORTING_CURRENCY) -> Column:
    """Cost of one charge line in the reporting currency.

    * company books in the reporting currency -> the local cost as is;
    * payable not yet posted (no post date, also when there is no payable
      header) -> local cost / rate of the shipment's creation day; **no rate
      -> NULL**, which a later sum skips;
    * posted -> minus the overseas amount / rate of the invoice day; **no
      rate -> divided by 1**.

    A zero rate raises under ANSI mode (as the source dialect did).
    """
    local_amt = _col(local_amt).cast(DEC)
    pre = _col(pre_rate).cast(RATE)
    post = F.coalesce(_col(post_rate).cast(RATE), F.lit(1).cast(RATE))
    unposted = local_amt / pre
    posted = (-_col(os_amt).cast(DEC)) / post
    return (F.when(_col(local_cur) == reporting_currency, local_amt)
             .otherwise(F.when(_col(post_date).isNull(), unposted).otherwise(posted)))
