"""CW feed plan (M16): weights per (MAWB, port pair) with flights, first
real departure and categorised costs of the MAWB."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.consol import (consol_weights, linked_shipments_per_consol,
                                shipment_mawb_multiplicity)
from ..operators.cost_layout import CostLayout
from ..operators.costs import (COST_CATEGORIES, charge_costs, costs_by_mawb,
                               costs_by_shipment, total_cost)
from ..operators.flights import air_leg_base, flight_list
from ..operators.joins import cut_to_keys, restrict_to_keys
from ..params import LoadWindow
from ..operators.stage import stage

# Fixed value that must equal the source job's: the currency of the CW feed.
CW_CURRENCY = "USD"

CW_COLUMNS = ["mawb", "date", "origin", "destination", "flight_number", "actual_weight",
              "chargeable_weight", "weight_unit", "volume", "volume_unit", "currency",
              "total_security_surcharge", "total_fuel_surcharge", "airlines_rate",
              "total_cost_to_carrier"]


class MawbContext:
    """The AIR-leg base shared by flights, departures and costs, restricted
    to a set of MAWBs.

    Flights, departures and costs are computed over all history of those
    MAWBs (no date window), as in the source query; restricting the
    consolidations to the MAWBs that the weights rollup produced is exact
    because every right-hand side is grouped by MAWB.

    ``materialize=True`` stores the restricted consolidations, links,
    shipments and per-consolidation link counts once (``operators.stage``:
    written tables in the shared ``spark.checkpoint.dir``) and cuts the
    charge history to them; ``"persist"`` keeps them in executor storage
    instead (no extra jobs; recomputed from lineage if an executor is lost),
    which suits small inputs. They are small (driven by one
    load window) and each is read by several branches of the plan; Catalyst
    prunes every reference differently, so without this each branch would
    recompute the whole restriction chain, weights rollup included.

    Without ``mawbs`` nothing is restricted: every later join drops what has no
    partner. ``layout`` is the stored cost layout that the costs of
    all history then read.
    """

    def __init__(self, tables: Mapping[str, DataFrame], mawbs: DataFrame | None = None,
                 materialize: bool | str = False, layout: CostLayout | None = None):
        def keep(df: DataFrame, label: str) -> DataFrame:
            if materialize == "persist":
                return df.persist(StorageLevel.MEMORY_AND_DISK)
            return stage(df, label) if materialize else df

        self.tables, self.layout, self.whole = tables, layout, mawbs is None
        self.materialize = materialize is True

        def cut(df: DataFrame, keys: DataFrame, on: str, key: str) -> DataFrame:
            if self.whole:
                return df
            if self.materialize:  # the keys are a written table: counted, then cut inside the scan
                return cut_to_keys(df, keys, [on], [key])
            return restrict_to_keys(df, keys, on, key)

        consol = tables["jobconsol"]
        if mawbs is not None:
            consol = cut(consol, mawbs, "jk_masterbillnum", "mawb")
        self.consol = keep(consol.select("jk_pk", "jk_masterbillnum"), "consol")
        self.link = keep(cut(tables["jobconshiplink"].select("jn_js", "jn_jk"),
                             self.consol, "jn_jk", "jk_pk"), "link")
        transport = tables["jobconsoltransport"]
        if mawbs is not None:
            transport = cut(transport, self.consol, "jw_parentguid", "jk_pk")
        self.legs = keep(air_leg_base(transport), "air_legs")
        self.shipments = keep(cut(
            tables["jobshipment"].select("js_pk", "js_systemcreatetimeutc"),
            self.link, "js_pk", "jn_js"), "shipment")
        self._links_per_consol = keep(linked_shipments_per_consol(self.link, self.shipments),
                                      "links_per_consol")

    def links_per_consol(self) -> DataFrame:
        return self._links_per_consol

    def flights(self) -> DataFrame:
        """``(mawb, flight_number)``."""
        per_consol = self.legs.select("jw_parentguid", "flt", "n_leg")
        links = self.links_per_consol()
        occ = (self.consol.join(links, self.consol["jk_pk"] == links["jn_jk"])
               .join(per_consol, F.col("jk_pk") == per_consol["jw_parentguid"])
               .select(F.col("jk_masterbillnum").alias("mawb"), "flt",
                       (F.col("n_leg") * F.col("n_links")).alias("n")))
        return flight_list(occ, "mawb", "flt", count="n")

    def departures(self) -> DataFrame:
        """``(mawb, atd)``."""
        per_consol = self.legs.groupBy("jw_parentguid").agg(F.min("first_atd").alias("atd"))
        linked = restrict_to_keys(self.consol, self.links_per_consol(), "jk_pk", "jn_jk")
        occ = linked.join(per_consol, linked["jk_pk"] == per_consol["jw_parentguid"]).select(
            F.col("jk_masterbillnum").alias("mawb"), "atd")
        return occ.groupBy("mawb").agg(F.min("atd").alias("atd"))

    def costs(self, categories: Mapping[str, list[str]] = COST_CATEGORIES) -> DataFrame:
        """``(mawb, <category>...)`` (M8)."""
        every = self.whole and self.layout is not None
        charges = charge_costs(self.tables, None if every else self.shipments, categories,
                               reduce_history=self.materialize, layout=self.layout)
        per_ship = costs_by_shipment(charges, categories)
        n_air = self.legs.groupBy("jw_parentguid").agg(F.sum("n_leg").alias("n_air"))
        mult = shipment_mawb_multiplicity(self.link, self.consol, n_air)
        return costs_by_mawb(per_ship, mult, categories)


def cw_feed(tables: Mapping[str, DataFrame], window: LoadWindow,
            reduce_history: bool | None = None, layout: CostLayout | None = None) -> DataFrame:
    """CW query result (P3), one row per (MAWB, origin, destination).

    Rows need a positive total cost, a positive chargeable weight and a
    known departure (F13-F15). Flights and costs of a MAWB repeat on each of
    its port pairs, unallocated, as in the source query. The source's final
    DISTINCT is implied: the weights rollup is unique per (MAWB, port pair)
    and every right-hand side is unique per MAWB.

    ``reduce_history`` (by default: unless the window is a full load, whatever the sizes) stages the
    window-driven sets in the shared checkpoint folder and cuts the
    history-wide charge tables to them. A full load needs all history: nothing but the counted rates is staged,
    nothing cut, and its costs come from the stored ``layout`` where one is given. ``False`` for a
    45-day window persists the sets and joins
    the history with ordinary shuffles (to compare plans). All give the same rows.
    """
    cut = not window.full_load if reduce_history is None else reduce_history
    # one row per (MAWB, port pair) of the window: small, read by every branch
    main = consol_weights(tables, window, cut)
    if window.full_load and not cut:
        ctx = MawbContext(tables, None, layout=layout)
    else:
        main = stage(main, "weights") if cut else main.persist(StorageLevel.MEMORY_AND_DISK)
        ctx = MawbContext(tables, main.select("mawb"), materialize=True if cut else "persist")
    j = (main.join(ctx.flights(), "mawb", "left")
             .join(ctx.departures(), "mawb", "left")
             .join(ctx.costs(), "mawb", "left"))
    out = j.select(
        "mawb", F.to_date("atd").alias("date"), "origin", "destination", "flight_number",
        "actual_weight", "chargeable_weight", "weight_unit", "volume", "volume_unit",
        F.lit(CW_CURRENCY).alias("currency"), *COST_CATEGORIES)
    out = total_cost(out, list(COST_CATEGORIES))
    return (out.filter((F.col("chargeable_weight") > 0) & F.col("date").isNotNull())
               .select(*CW_COLUMNS))
