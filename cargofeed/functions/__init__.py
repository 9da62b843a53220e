"""Column -> Column domain expressions (built-in functions only, no UDFs)."""

from .dates import SENTINEL_DATE, day, feed_date, null_if_sentinel
from .money import converted_cost
from .validity import non_empty, valid_mawb
from .weights import (actual_weight_cw, actual_weight_wt, carrier_cost_wt, case_max,
                      chargeable_weight_cw, chargeable_weight_wt, chargeable_weight_wt_basis,
                      raise_to_actual, to_kg, to_m3)

__all__ = ["SENTINEL_DATE", "actual_weight_cw", "actual_weight_wt", "carrier_cost_wt",
           "case_max", "chargeable_weight_cw", "chargeable_weight_wt", "chargeable_weight_wt_basis",
           "converted_cost", "raise_to_actual",
           "day", "feed_date", "non_empty", "null_if_sentinel", "to_kg", "to_m3",
           "valid_mawb"]
