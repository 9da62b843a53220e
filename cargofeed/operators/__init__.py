"""DataFrame -> DataFrame domain operators."""

from .consol import (consol_weights, first_job_headers, linked_shipments_per_consol,
                     shipment_mawb_multiplicity, valid_consols)
from .costs import (COST_CATEGORIES, charge_costs, costs_by_mawb, costs_by_shipment,
                    total_cost)
from .flights import (air_leg_base, air_legs, air_legs_per_consol, earliest_departure,
                      flight_list)
from .joins import (broadcast_all_if_bounded, broadcast_if_bounded, has_at_most,
                    left_join_null_safe, restrict_to_keys)
from .rollup import rollup_per_key_and_unit, sum_by_key
from .select import first_by_time, latest_by_sequence
from .window import load_window

__all__ = ["COST_CATEGORIES", "air_leg_base", "air_legs", "air_legs_per_consol", "broadcast_all_if_bounded",
           "broadcast_if_bounded",
           "charge_costs", "consol_weights", "costs_by_mawb", "costs_by_shipment",
           "earliest_departure", "first_by_time", "first_job_headers", "flight_list",
           "has_at_most", "latest_by_sequence", "left_join_null_safe", "linked_shipments_per_consol", "load_window",
           "restrict_to_keys", "rollup_per_key_and_unit", "shipment_mawb_multiplicity",
           "sum_by_key", "total_cost", "valid_consols"]
