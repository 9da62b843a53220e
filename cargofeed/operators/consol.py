"""Consolidation weights rollup (M14) and the shared link multiplicities."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.validity import valid_mawb
from ..functions.weights import actual_weight_cw, chargeable_weight_cw, to_m3
from ..params import LoadWindow
from .flights import air_legs_per_consol
from .joins import (DIMENSION_MAX_ROWS, broadcast_if_bounded, cut_to_keys, has_at_most,
                    restrict_to_keys)
from .select import first_by_time
from .stage import stage
from .window import load_window

# Fixed values that must equal the source job's: output units of the CW feed.
WEIGHT_UNIT_KG = "KG"
VOLUME_UNIT_M3 = "M3"
SUMMED_WEIGHT = "decimal(25,2)"


def first_job_headers(jobheader: DataFrame, parents: DataFrame | None = None,
                      broadcast_cut: bool = False) -> DataFrame:
    """One job header per shipment: the earliest created, then lowest
    company, then lowest key (M2). ``parents`` (a one-column frame of
    shipment keys) restricts the headers looked at, without changing the
    choice for those parents. ``broadcast_cut`` filters the header history
    inside its scan against the broadcast parent keys when their row bound
    is proven (``cut_to_keys``), instead of a shuffled semi join."""
    jh = jobheader.select("jh_pk", "jh_parentid", "jh_gc", "jh_systemcreatetimeutc")
    if parents is not None:
        if broadcast_cut:
            jh = cut_to_keys(jh, parents, ["jh_parentid"], [parents.columns[0]])
        else:
            jh = restrict_to_keys(jh, parents, "jh_parentid", parents.columns[0])
    return first_by_time(jh, "jh_parentid", "jh_systemcreatetimeutc", ["jh_gc", "jh_pk"])


def valid_consols(consol: DataFrame) -> DataFrame:
    """Consolidations that are not cancelled and carry a usable MAWB."""
    return consol.filter((F.col("jk_iscancelled") == 0) & valid_mawb("jk_masterbillnum", "cw"))


def consol_weights(tables: Mapping[str, DataFrame], window: LoadWindow,
                   reduce_history: bool = True) -> DataFrame:
    """One row per (mawb, origin, destination) of the CW family.

    Shipments created inside ``window`` that have a first job header of a
    known company, linked to a valid consolidation, are summed per
    (MAWB, load port, discharge port): actual and chargeable weight in kg
    (each rounded to 2 decimals per row before summing) and volume in m3.

    Parity note: each shipment counts once **per AIR leg** of its
    consolidation (a two-leg consolidation doubles its weights), as in the
    source query. The legs are pre-counted per consolidation and applied as
    a multiplier, so no shipment x leg product is materialised.

    ``reduce_history``: headers and links are cut to the window's shipments, and
    consolidations and legs to those links, before they are joined. Where the window is
    all history that drops nothing: pass ``False``.
    """
    ship = load_window(tables["jobshipment"], "js_systemcreatetimeutc", window).select(
        "js_pk", "js_unitofweight", "js_actualweight", "js_actualchargeable",
        "js_unitofvolume", "js_actualvolume")
    if reduce_history:
        # the window's shipments are written first, so that what is counted and
        # cut by is the window and not the planner's estimate of all history
        ship = stage(ship, "window_shipments")
        heads = first_job_headers(tables["jobheader"], ship.select("js_pk"), broadcast_cut=True)
    else:
        heads = first_job_headers(tables["jobheader"])
    company = broadcast_if_bounded(tables["glbcompany"].select("gc_pk"))
    heads = heads.join(company, heads["jh_gc"] == company["gc_pk"]).select("jh_parentid")
    consol = valid_consols(tables["jobconsol"]).select(
        F.col("jk_pk"), F.col("jk_masterbillnum").alias("mawb"),
        F.col("jk_rl_nkloadport").alias("origin"),
        F.col("jk_rl_nkdischargeport").alias("destination"))
    transport = tables["jobconsoltransport"]
    link = tables["jobconshiplink"].select("jn_js", "jn_jk")
    if reduce_history:
        link = stage(cut_to_keys(link, ship, ["jn_js"], ["js_pk"]), "window_links")
        small = has_at_most(link, DIMENSION_MAX_ROWS)
        consol = cut_to_keys(consol, link, ["jk_pk"], ["jn_jk"], proven=small)
        transport = cut_to_keys(transport, link, ["jw_parentguid"], ["jn_jk"], proven=small)
    legs = air_legs_per_consol(transport)

    rows = (ship.join(heads, ship["js_pk"] == heads["jh_parentid"])
                .join(link, F.col("js_pk") == link["jn_js"])
                .join(consol, F.col("jn_jk") == consol["jk_pk"])
                .join(legs, F.col("jk_pk") == legs["jw_parentguid"]))
    n = F.col("n_air")
    act = actual_weight_cw("js_actualweight", "js_unitofweight")
    chg = chargeable_weight_cw("js_actualchargeable", "js_actualweight", "js_unitofweight")
    vol = to_m3("js_actualvolume", "js_unitofvolume")
    return (rows.groupBy("mawb", "origin", "destination")
                .agg(F.sum(act * n).cast(SUMMED_WEIGHT).alias("actual_weight"),
                     F.sum(chg * n).cast(SUMMED_WEIGHT).alias("chargeable_weight"),
                     F.sum(vol * n).alias("volume"))
                .withColumn("weight_unit", F.lit(WEIGHT_UNIT_KG))
                .withColumn("volume_unit", F.lit(VOLUME_UNIT_M3)))


def linked_shipments_per_consol(link: DataFrame, shipments: DataFrame) -> DataFrame:
    """``(jn_jk, n_links)``: per consolidation, the number of link rows whose
    shipment exists (times the number of shipment rows with that key)."""
    ship_n = shipments.groupBy("js_pk").agg(F.count(F.lit(1)).alias("n_ship"))
    return (link.join(ship_n, link["jn_js"] == ship_n["js_pk"])
                .groupBy("jn_jk").agg(F.sum("n_ship").alias("n_links")))


def shipment_mawb_multiplicity(link: DataFrame, consol: DataFrame,
                               air_per_consol: DataFrame) -> DataFrame:
    """``(jn_js, mawb, mult)``: how many (consolidation row x AIR leg) rows
    each shipment contributes to each MAWB through its links. Dealt by shipment, so
    that a join on the shipment needs no further exchange."""
    c = consol.select("jk_pk", F.col("jk_masterbillnum").alias("mawb"))
    return (link.select("jn_js", "jn_jk")
                .join(c, F.col("jn_jk") == c["jk_pk"])
                .join(air_per_consol, F.col("jk_pk") == air_per_consol["jw_parentguid"])
                .select("jn_js", "mawb", "n_air").repartition("jn_js")
                .groupBy("jn_js", "mawb").agg(F.sum("n_air").alias("mult")))
