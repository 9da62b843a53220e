"""WT feed plan (M15): one row per (airwaybill row, unit) of the latest
sequence of each order flown inside the load window."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.validity import valid_mawb
from ..functions.weights import (actual_weight_wt, carrier_cost_wt,
                                 chargeable_weight_wt_basis, raise_to_actual)
from ..operators.joins import DIMENSION_MAX_ROWS, cut_to_keys, has_at_most, key_size
from ..operators.rollup import rollup_per_key_and_unit, sum_by_key
from ..operators.stage import stage
from ..operators.select import latest_by_sequence
from ..params import LoadWindow

WT_COLUMNS = ["mawb", "hawb", "date", "origin", "destination", "flight_number",
              "actual_weight", "chargeable_weight", "weight_unit", "volume", "volume_unit",
              "currency", "airline_rate", "total_cost_to_airline", "total_fuel_surcharge",
              "total_security_surcharge"]


def airwaybill_detail(desc: DataFrame) -> DataFrame:
    """Detail totals per airwaybill, one row per non-empty weight unit (M3)."""
    return rollup_per_key_and_unit(
        desc, "fk_airwaybillno",
        {"d_actual": "grossweight", "d_chargeable": "chargeableweight", "d_total": "total"},
        "lb_kg").withColumnRenamed("lb_kg", "d_unit")


def shipment_weights(shipdesc: DataFrame) -> DataFrame:
    """Weight sums per order (A2)."""
    return sum_by_key(shipdesc, "fk_orderno",
                      {"w_lbs": "weight", "w_kgs": "weightkilo",
                       "w_dim_lbs": "dimweight", "w_dim_kgs": "dimweightkilo"})


def wt_rows(tables: Mapping[str, DataFrame], window: LoadWindow,
            latest_strategy: str = "max_join", reduce_history: bool | None = None) -> DataFrame:
    """The distinct joined rows before the final projection (A5), keyed by
    ``file_nbr`` (the order).

    Airwaybills and carrier lines repeat an (order, sequence); both are made
    distinct before they meet, so that repeated rows are not multiplied.

    ``reduce_history``: the latest-sequence rows of the window are staged
    (a written table in the shared checkpoint folder) and counted, and the
    four history-wide tables are cut to the window's orders and airwaybills
    before any rollup, always inside their scans: by the keys where they are few enough to
    broadcast, else by a Bloom filter of them, whose false positives the joins
    drop. A window of many rows is read where it is stored, so that bucketed
    tables are not shuffled to find its latest rows. Rollups are per order / per airwaybill
    and every dropped row could only meet a non-matching join key, so the
    result is the same; the daily job just stops re-aggregating all history.
    ``False`` leaves the history whole; so does the default for a full load, whose
    window is all history and would drop nothing.
    """
    if reduce_history is None:
        reduce_history = not window.full_load
    awb = tables["tbl_airwaybill"]
    in_window = F.to_date(F.col("flightdatetime1")) >= F.lit(window.start)
    if reduce_history:
        # the window's rows first; the history is read for their orders alone
        inside = awb.filter(in_window)
        if latest_strategy != "max_join":
            inside = inside.select("fk_orderno")
        size = key_size(inside, ["fk_orderno"])
        if size.within(DIMENSION_MAX_ROWS):
            inside = stage(inside, "wt_window")
        history = awb.select("fk_orderno", "fk_seqno") if latest_strategy == "max_join" else awb
        history = cut_to_keys(history, inside, ["fk_orderno"], ["fk_orderno"], exact=False, size=size)
    if reduce_history and latest_strategy == "max_join":
        newest = history.groupBy("fk_orderno").agg(F.max("fk_seqno").alias("__newest"))
        # one row per order: compared by >=, the sequence is no join key and the order's buckets serve
        a = inside.join(newest, "fk_orderno").filter(F.col("fk_seqno") >= F.col("__newest")).drop("__newest")
    else:
        a = latest_by_sequence(history if reduce_history else awb, "fk_orderno", "fk_seqno", keep=in_window,
                               strategy=latest_strategy)
    apar = tables["tbl_shipmentapar"].filter(valid_mawb("refno", "wt"))
    desc = tables["tbl_airwaybilldesc"]
    header = tables["tbl_shipmentheader"]
    shipdesc = tables["tbl_shipmentdesc"]
    a = a.distinct()
    if reduce_history:
        a = stage(a, "wt_latest")
        small = has_at_most(a, DIMENSION_MAX_ROWS)
        apar = cut_to_keys(apar, a, ["fk_orderno", "seqno"], ["fk_orderno", "fk_seqno"],
                           proven=small, exact=False)
        desc = cut_to_keys(desc, a, ["fk_airwaybillno"], ["pk_airwaybillno"], proven=small, exact=False)
        header = cut_to_keys(header, a, ["pk_orderno"], ["fk_orderno"], proven=small, exact=False)
        shipdesc = cut_to_keys(shipdesc, a, ["fk_orderno"], ["fk_orderno"], proven=small, exact=False)
    c = apar.select(F.col("fk_orderno").alias("c_order"), F.col("seqno").alias("c_seq"),
                    "refno", F.col("rate").alias("c_rate"), F.col("total").alias("c_total")).distinct()
    d = airwaybill_detail(desc)
    # Header and its order weights first: the weights join on the header's
    # key, so an order without a header gets no fallback weights.
    e = header.select("pk_orderno", "housebill")
    w = shipment_weights(shipdesc)
    ew = e.join(w, e["pk_orderno"] == w["fk_orderno"], "left").drop("fk_orderno")

    j = (a.join(c, (a["fk_orderno"] == c["c_order"]) & (a["fk_seqno"] == c["c_seq"]))
          .join(d, F.col("pk_airwaybillno") == d["fk_airwaybillno"], "left")
          .join(ew, F.col("fk_orderno") == ew["pk_orderno"], "left"))
    return j.select(
        F.col("fk_orderno").alias("file_nbr"),
        F.col("housebill").alias("hawb"),
        F.col("refno").alias("mawb"),
        F.col("flightdatetime1").alias("flight_ts"),
        F.col("orgairport").alias("origin"),
        F.col("destairport").alias("destination"),
        F.col("flightno1").alias("flight_number"),
        actual_weight_wt("d_actual", "w_lbs").alias("actual_weight"),
        chargeable_weight_wt_basis("d_chargeable", "d_unit", "w_lbs", "w_kgs",
                                   "w_dim_lbs", "w_dim_kgs").alias("chargeable_weight"),
        F.col("d_unit").alias("weight_unit"),
        F.lit("").alias("volume"),
        F.lit("").alias("volume_unit"),
        F.col("fk_currency").alias("currency"),
        F.col("c_rate").alias("airline_rate"),
        carrier_cost_wt("d_total", "c_total").alias("total_cost_to_airline"),
        F.lit("").alias("total_fuel_surcharge"),
        F.lit("").alias("total_security_surcharge"),
    ).distinct()


def wt_feed(tables: Mapping[str, DataFrame], window: LoadWindow,
            latest_strategy: str = "max_join", ordered: bool = False,
            reduce_history: bool | None = None) -> DataFrame:
    """WT query result (P1): the distinct rows without ``file_nbr`` (two
    orders identical in everything else give two rows), chargeable weight
    raised to the actual weight, date cast to a date.

    ``ordered=True`` adds the source's ``ORDER BY date``; it costs a range
    shuffle and only matters for a single-file export.
    """
    rows = wt_rows(tables, window, latest_strategy, reduce_history)
    out = rows.select(
        "mawb", "hawb", F.to_date("flight_ts").alias("date"), "origin", "destination",
        "flight_number", "actual_weight",
        raise_to_actual("chargeable_weight", "actual_weight").alias("chargeable_weight"),
        "weight_unit", "volume", "volume_unit", "currency", "airline_rate",
        "total_cost_to_airline", "total_fuel_surcharge", "total_security_surcharge")
    return out.orderBy(F.col("date").asc_nulls_last()) if ordered else out

