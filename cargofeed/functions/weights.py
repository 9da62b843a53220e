"""Weight and volume expressions (M4-M7).

All are pure Column -> Column expressions: they stay inside whole-stage
codegen and cost nothing extra to plan. NULL behaviour follows searched CASE
semantics, which is what the feeds depend on:

* ``case_max(a, b)`` is ``CASE WHEN a > b THEN a ELSE b END``. Unlike
  ``greatest``, it yields ``b`` whenever either side is NULL.
* a CASE without ELSE yields NULL for unmatched rows (unknown units).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source job's:
#   pounds to kilograms: 0.453592
#   cubic feet to cubic metres: 0.0283168
#   unit codes: 'KG' kilograms, 'LB' pounds, 'CF' cubic feet (CW family);
#               'L' pounds on airwaybill detail rows (WT family)
LB_TO_KG = Decimal("0.453592")
CF_TO_M3 = Decimal("0.0283168")
UNIT_KG = "KG"
UNIT_LB = "LB"
UNIT_CF = "CF"
WT_UNIT_POUNDS = "L"

# numeric(15,2): the per-row rounding applied before weights are summed
WEIGHT_2DP = "decimal(15,2)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def case_max(a: Column | str, b: Column | str) -> Column:
    """``a`` if ``a > b`` else ``b`` (``b`` when either is NULL)."""
    a, b = _col(a), _col(b)
    return F.when(a > b, a).otherwise(b)


def to_kg(value: Column | str, unit: Column | str) -> Column:
    """Kilograms: 'KG' as is, 'LB' times 0.453592, any other unit NULL."""
    value, unit = _col(value), _col(unit)
    return (F.when(unit == UNIT_KG, value)
             .when(unit == UNIT_LB, value * F.lit(LB_TO_KG)))


def to_m3(value: Column | str, unit: Column | str) -> Column:
    """Cubic metres: 'CF' times 0.0283168, anything else taken as is."""
    value, unit = _col(value), _col(unit)
    return F.when(unit == UNIT_CF, value * F.lit(CF_TO_M3)).otherwise(value)


def actual_weight_cw(actual: Column | str, unit: Column | str) -> Column:
    """Per-row actual weight in kg, rounded half-up to 2 decimals."""
    return to_kg(actual, unit).cast(WEIGHT_2DP)


def chargeable_weight_cw(chargeable: Column | str, actual: Column | str,
                         unit: Column | str) -> Column:
    """Per-row chargeable weight in kg (M7): the larger of chargeable and
    actual by CASE rules, rounded half-up to 2 decimals. A NULL chargeable
    weight stays NULL (and is skipped by a later sum)."""
    chg_kg = to_kg(chargeable, unit)
    act_kg = to_kg(actual, unit)
    return F.when(chg_kg < act_kg, act_kg).otherwise(chg_kg).cast(WEIGHT_2DP)


def chargeable_weight_wt_basis(c: Column | str, unit: Column | str,
                               lbs: Column | str, kgs: Column | str,
                               dim_lbs: Column | str, dim_kgs: Column | str) -> Column:
    """Chargeable weight of the WT family before the raise to actual (M4).

    ``c`` is the summed chargeable weight of the airwaybill detail; when it
    is zero or negative the shipment weights decide (pounds for unit 'L',
    kilograms otherwise, actual vs dimensional by ``case_max``). A missing
    ``c`` falls back to the pound weights whatever the unit.
    """
    c, unit = _col(c), _col(unit)
    by_unit = (F.when(unit == WT_UNIT_POUNDS, case_max(lbs, dim_lbs))
                .otherwise(case_max(kgs, dim_kgs)))
    chosen = F.when(c <= 0, by_unit).otherwise(c)
    return F.coalesce(chosen, case_max(lbs, dim_lbs))


def raise_to_actual(chargeable: Column | str, actual: Column | str) -> Column:
    """``actual`` when ``chargeable < actual``, else ``chargeable`` (a NULL on
    either side keeps the chargeable value)."""
    chargeable, actual = _col(chargeable), _col(actual)
    return F.when(chargeable < actual, actual).otherwise(chargeable)


def chargeable_weight_wt(c: Column | str, unit: Column | str, actual: Column | str,
                         lbs: Column | str, kgs: Column | str,
                         dim_lbs: Column | str, dim_kgs: Column | str) -> Column:
    """Chargeable weight of the WT family (M4): the basis, never below ``actual``."""
    return raise_to_actual(chargeable_weight_wt_basis(c, unit, lbs, kgs, dim_lbs, dim_kgs),
                           actual)


def actual_weight_wt(actual: Column | str, lbs: Column | str) -> Column:
    """Detail actual weight, else the shipment's pound weight (M5)."""
    return F.coalesce(_col(actual), _col(lbs))


def carrier_cost_wt(detail_total: Column | str, ar_ap_total: Column | str) -> Column:
    """Detail total when positive, else the AR/AP total (M5)."""
    detail_total, ar_ap_total = _col(detail_total), _col(ar_ap_total)
    return F.when(detail_total > 0, detail_total).otherwise(ar_ap_total)
