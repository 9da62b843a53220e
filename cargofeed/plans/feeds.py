"""Feed projections (P6-P9): query rows -> labelled feed columns.

Inside the library all columns are snake_case; the labels below appear only
here, at the sink. Dates are written as ``YYYY-MM-DD`` text; rows need a
non-empty MAWB number (F16).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import feed_date
from ..functions.validity import non_empty

# Fixed values that must equal the source job's: feed column labels.
# WT MAWB feed, as written by the source job (its lower-case row keys):
WT_MAWB_OBSERVED = [
    ("mawb", "mawb"), ("date", "date"), ("origin", "origin"),
    ("destination", "destination"), ("flight number", "flight_number"),
    ("actual weight", "actual_weight"), ("chargeable weight", "chargeable_weight"),
    ("weight unit", "weight_unit"), ("volume", "volume"), ("volume unit", "volume_unit"),
    ("currency", "currency"), ("airline_rate", "airline_rate"),
    ("total cost to airline", "total_cost_to_airline"),
    ("total fuel surcharge", "total_fuel_surcharge"),
    ("total security surcharge", "total_security_surcharge"),
]
# WT MAWB feed, the label list the source job declared (but did not apply):
WT_MAWB_DECLARED = [
    ("MAWB Number", "mawb"), ("Date", "date"), ("Origin", "origin"),
    ("Destination", "destination"), ("Flight Number", "flight_number"),
    ("Actual Weight", "actual_weight"), ("Chargeable Weight", "chargeable_weight"),
    ("Weight Unit", "weight_unit"), ("Volume", "volume"), ("Volume Unit", "volume_unit"),
    ("Currency", "currency"), ("Airlines Rate", "airline_rate"),
    ("Total Cost to Carrier", "total_cost_to_airline"),
    ("Total Fuel Surcharge", "total_fuel_surcharge"),
    ("Total Security Surcharge", "total_security_surcharge"),
]
# HAWB feeds (WT, and the optional CW one):
HAWB_LABELS = [
    ("HAWB Number", "hawb"), ("MAWB Number", "mawb"), ("Date", "date"),
    ("Origin", "origin"), ("Destination", "destination"),
    ("Flight Number", "flight_number"), ("Actual Weight", "actual_weight"),
    ("Chargeable Weight", "chargeable_weight"), ("Weight Unit", "weight_unit"),
    ("Volume", "volume"), ("Volume Unit", "volume_unit"),
]
# CW MAWB feed:
CW_MAWB_LABELS = [
    ("MAWB Number", "mawb"), ("Date", "date"), ("Origin", "origin"),
    ("Destination", "destination"), ("Flight Number", "flight_number"),
    ("Actual Weight", "actual_weight"), ("Chargeable Weight", "chargeable_weight"),
    ("Weight Unit", "weight_unit"), ("Volume", "volume"), ("Volume Unit", "volume_unit"),
    ("Currency", "currency"), ("Airlines Rate", "airlines_rate"),
    ("Total Cost to Carrier", "total_cost_to_carrier"),
    ("Total Fuel Surcharge", "total_fuel_surcharge"),
    ("Total Security Surcharge", "total_security_surcharge"),
]

FEED_TYPES = ("mawb", "hawb", "cwmawb", "cwhawb")


def _project(df: DataFrame, labels: list[tuple[str, str]]) -> DataFrame:
    cols = []
    for label, src in labels:
        if src not in df.columns:
            c = F.lit(None).cast("string")
        elif src == "date":
            c = feed_date(src)
        else:
            c = F.col(src)
        cols.append(c.alias(label))
    return df.filter(non_empty("mawb")).select(*cols)


def wt_mawb_feed(wt: DataFrame, header: str = "observed") -> DataFrame:
    """MAWB feed of the WT family (P6): one row per WT row, no dedup."""
    if header not in ("observed", "declared"):
        raise ValueError(f"header must be 'observed' or 'declared', not {header!r}")
    return _project(wt, WT_MAWB_OBSERVED if header == "observed" else WT_MAWB_DECLARED)


def wt_hawb_feed(wt: DataFrame) -> DataFrame:
    """HAWB feed of the WT family."""
    return _project(wt, HAWB_LABELS)


def cw_mawb_feed(cw: DataFrame) -> DataFrame:
    """MAWB feed of the CW family."""
    return _project(cw, CW_MAWB_LABELS)


def cw_hawb_feed(cw: DataFrame) -> DataFrame:
    """Optional HAWB feed of the CW family (P9): the CW rows carry no house
    bill, so its first column is always empty. Off by default in the job."""
    return _project(cw, HAWB_LABELS)
