"""Registered queries over the test tables, each with its DuckDB oracle.

Every query reads the whole test tables (through the freight views of
``bindings.testdata``); date windows are the feed's own load window (M13)
at the test run day, or the full history.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.validity import valid_mawb
from ..functions.weights import actual_weight_cw, chargeable_weight_cw, to_m3
from ..operators.consol import consol_weights, first_job_headers
from ..operators.costs import COST_CATEGORIES, charge_costs, total_cost
from ..operators.select import latest_by_sequence
from ..operators.window import load_window
from ..params import LoadWindow
from ..plans.cost_state import CostState
from ..plans.cw import MawbContext, cw_feed
from ..plans.feeds import cw_hawb_feed, cw_mawb_feed, wt_hawb_feed, wt_mawb_feed
from ..plans.wt import airwaybill_detail, shipment_weights, wt_feed, wt_rows
from ..session import checkpoint_dir
from ..sinks.csv import export_feed, read_feed
from . import oracle as O
from .testdata import TEST_AS_OF, freight_cost_layout, freight_tables

# The feed's own 45-day window at the test run day, and the full history.
WINDOW_45 = LoadWindow(TEST_AS_OF, False, dt.date(2019, 1, 1))
HISTORY_START = dt.date(1990, 1, 1)
WINDOW_ALL = LoadWindow(TEST_AS_OF, True, HISTORY_START)
# A full load from a chosen start (the start date is a run parameter).
FULL_LOAD_START = dt.date(1998, 1, 1)
WINDOW_FULL = LoadWindow(TEST_AS_OF, True, FULL_LOAD_START)

MONEY_DP = 6


def typed(df: DataFrame, money: tuple[str, ...] = ()) -> DataFrame:
    """Comparison types: decimals -> double (``money`` rounded to 6 dp
    first), dates and timestamps -> ISO text."""
    cols: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = (F.round(c, MONEY_DP) if f.name in money else c).cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


MONEY = tuple(COST_CATEGORIES) + ("total_cost_to_carrier", "cost")


def _tables(spark: SparkSession, sf_dir: str):
    return freight_tables(spark, sf_dir)


# --- Spark side -----------------------------------------------------------------

def q_latest_by_sequence(spark, sf_dir, strategy="max_join"):
    wt, _ = _tables(spark, sf_dir)
    out = latest_by_sequence(wt["tbl_airwaybill"], "fk_orderno", "fk_seqno", strategy=strategy)
    return typed(out.select("fk_orderno", "fk_seqno", "pk_airwaybillno", "flightno1",
                            F.col("flightdatetime1").alias("flight_time")))


def q_first_by_time(spark, sf_dir):
    _, cw = _tables(spark, sf_dir)
    out = first_job_headers(cw["jobheader"])
    return typed(out.select("jh_pk", "jh_parentid", "jh_gc",
                            F.col("jh_systemcreatetimeutc").alias("created")))


def q_detail_rollup_by_unit(spark, sf_dir):
    wt, _ = _tables(spark, sf_dir)
    return typed(airwaybill_detail(wt["tbl_airwaybilldesc"]))


def q_shipment_weight_rollup(spark, sf_dir):
    wt, _ = _tables(spark, sf_dir)
    e = wt["tbl_shipmentheader"]
    w = shipment_weights(wt["tbl_shipmentdesc"])
    return typed(e.join(w, e["pk_orderno"] == w["fk_orderno"], "left").drop("fk_orderno"))


def q_chargeable_weight_wt(spark, sf_dir):
    wt, _ = _tables(spark, sf_dir)
    return typed(wt_rows(wt, WINDOW_ALL))


def q_wt_feed(spark, sf_dir, window=WINDOW_45):
    wt, _ = _tables(spark, sf_dir)
    return typed(wt_feed(wt, window))


def q_wt_feed_history_cut(spark, sf_dir):
    """The WT feed of all history through the window plan (history cut to the window's keys)."""
    wt, _ = _tables(spark, sf_dir)
    return typed(wt_feed(wt, WINDOW_ALL, reduce_history=True))


def q_cw_feed_history_cut(spark, sf_dir):
    """The CW feed of all history through the window plan (staged sets, charge history cut)."""
    _, cw = _tables(spark, sf_dir)
    return typed(cw_feed(cw, WINDOW_ALL, reduce_history=True), MONEY)


def q_wt_feed_uncut(spark, sf_dir):
    """The WT feed of the 45-day window with all history joined, as the source query has it."""
    wt, _ = _tables(spark, sf_dir)
    return typed(wt_feed(wt, WINDOW_45, reduce_history=False))


def q_cw_feed_uncut(spark, sf_dir):
    """The CW feed of the 45-day window with all history joined, as the source query has it."""
    _, cw = _tables(spark, sf_dir)
    return typed(cw_feed(cw, WINDOW_45, reduce_history=False), MONEY)


def q_wt_feed_rank(spark, sf_dir):
    wt, _ = _tables(spark, sf_dir)
    return typed(wt_feed(wt, WINDOW_45, latest_strategy="window"))


def q_wt_mawb_feed(spark, sf_dir):
    wt, _ = _tables(spark, sf_dir)
    return typed(wt_mawb_feed(wt_feed(wt, WINDOW_45)))


def q_wt_mawb_feed_declared(spark, sf_dir):
    wt, _ = _tables(spark, sf_dir)
    return typed(wt_mawb_feed(wt_feed(wt, WINDOW_45), header="declared"))


def q_wt_hawb_feed(spark, sf_dir):
    wt, _ = _tables(spark, sf_dir)
    return typed(wt_hawb_feed(wt_feed(wt, WINDOW_45)))


def q_unit_normalise(spark, sf_dir):
    _, cw = _tables(spark, sf_dir)
    s = cw["jobshipment"]
    return typed(s.select("js_pk", "js_unitofweight", "js_unitofvolume",
                          actual_weight_cw("js_actualweight", "js_unitofweight").alias("actual_kg"),
                          to_m3("js_actualvolume", "js_unitofvolume").alias("volume_m3")))


def q_chargeable_weight_cw(spark, sf_dir):
    _, cw = _tables(spark, sf_dir)
    s = cw["jobshipment"]
    return typed(s.select("js_pk", chargeable_weight_cw(
        "js_actualchargeable", "js_actualweight", "js_unitofweight").alias("chargeable_kg")))


def q_consol_rollup(spark, sf_dir, window=WINDOW_45):
    _, cw = _tables(spark, sf_dir)
    return typed(consol_weights(cw, window, reduce_history=not window.full_load))


def q_valid_mawb_wt(spark, sf_dir):
    wt, _ = _tables(spark, sf_dir)
    apar = wt["tbl_shipmentapar"]
    return apar.filter(valid_mawb("refno", "wt")).select("fk_orderno", "seqno", "refno")


def q_valid_mawb_cw(spark, sf_dir):
    _, cw = _tables(spark, sf_dir)
    consol = cw["jobconsol"]
    return consol.filter(valid_mawb("jk_masterbillnum", "cw")).select("jk_pk", "jk_masterbillnum")


def q_load_window_incremental(spark, sf_dir):
    _, cw = _tables(spark, sf_dir)
    s = load_window(cw["jobshipment"], "js_systemcreatetimeutc", WINDOW_45)
    return typed(s.select("js_pk", F.col("js_systemcreatetimeutc").alias("created")))


def q_load_window_full(spark, sf_dir):
    wt, _ = _tables(spark, sf_dir)
    a = load_window(wt["tbl_airwaybill"], "flightdatetime1", WINDOW_FULL)
    return a.select("fk_orderno", "fk_seqno", "pk_airwaybillno")


def q_flight_list(spark, sf_dir):
    _, cw = _tables(spark, sf_dir)
    return MawbContext(cw).flights()


def q_earliest_departure(spark, sf_dir):
    _, cw = _tables(spark, sf_dir)
    return typed(MawbContext(cw).departures())


def q_fx_convert(spark, sf_dir):
    _, cw = _tables(spark, sf_dir)
    rows = charge_costs(cw, None, layout=freight_cost_layout(spark, sf_dir))
    out = rows.groupBy("js_pk", "ac_code").agg(F.sum("cost").alias("cost"))
    return typed(out, MONEY)


def q_categorised_costs(spark, sf_dir):
    _, cw = _tables(spark, sf_dir)
    return typed(MawbContext(cw, layout=freight_cost_layout(spark, sf_dir)).costs(), MONEY)


def q_categorised_costs_incremental(spark, sf_dir):
    """Costs of all MAWBs from the stored state: yesterday's tables, then a day's late, corrected and moved rows.

    Yesterday lacked the charges and links of some keys, and held other amounts and other receivable lines for others.
    """
    _, cw = _tables(spark, sf_dir)
    charge, link = cw["jobcharge"], cw["jobconshiplink"]
    part = F.crc32(F.coalesce("jr_al_apline", F.lit(""))) % 40
    corrected = (charge.filter(part == 1).withColumn("jr_localcostamt", (F.col("jr_localcostamt") + 7).cast("decimal(19,4)"))
                 .unionByName(charge.filter(part == 2).withColumn("jr_al_arline", F.lit(None).cast("string"))))
    late_link = F.crc32(F.coalesce("jn_js", F.lit(""))) % 40 == 0
    before = {**cw, "jobcharge": charge.filter(part > 2).unionByName(corrected), "jobconshiplink": link.filter(~late_link)}
    minus, plus = F.lit("-").alias("op"), F.lit("+").alias("op")
    changes = {"jobcharge": corrected.select("*", minus).unionByName(charge.filter(part <= 2).select("*", plus)),
               "jobconshiplink": link.filter(late_link).select("*", plus)}
    state = CostState(spark, f"{checkpoint_dir(spark).rstrip('/')}/cargofeed-cost-state-{uuid.uuid4().hex}")
    state.rebuild(before)
    state.apply(cw, changes, TEST_AS_OF.isoformat())
    return typed(state.costs(), MONEY)


def q_total_cost(spark, sf_dir):
    _, cw = _tables(spark, sf_dir)
    return typed(total_cost(MawbContext(cw, layout=freight_cost_layout(spark, sf_dir)).costs()), MONEY)


def q_cw_feed(spark, sf_dir, window=WINDOW_45):
    _, cw = _tables(spark, sf_dir)
    layout = freight_cost_layout(spark, sf_dir) if window.full_load else None
    return typed(cw_feed(cw, window, layout=layout), MONEY)


def q_cw_mawb_feed(spark, sf_dir):
    _, cw = _tables(spark, sf_dir)
    return typed(cw_mawb_feed(cw_feed(cw, WINDOW_45)),
                 ("Airlines Rate", "Total Cost to Carrier", "Total Fuel Surcharge",
                  "Total Security Surcharge"))


def q_cw_hawb_feed(spark, sf_dir):
    _, cw = _tables(spark, sf_dir)
    return typed(cw_hawb_feed(cw_feed(cw, WINDOW_45)))


def q_csv_roundtrip(spark, sf_dir):
    """Write the WT MAWB feed as CSV to the shared checkpoint folder and read it back."""
    wt, _ = _tables(spark, sf_dir)
    root = f"{checkpoint_dir(spark).rstrip('/')}/csv-roundtrip-{uuid.uuid4().hex}"
    path = export_feed(wt_mawb_feed(wt_feed(wt, WINDOW_45)), "mawb", TEST_AS_OF, root)
    return read_feed(spark, path)


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "latest_by_sequence": q_latest_by_sequence,
        "latest_by_sequence_rank": lambda s, d: q_latest_by_sequence(s, d, "window"),
        "first_by_time": q_first_by_time,
        "detail_rollup_by_unit": q_detail_rollup_by_unit,
        "shipment_weight_rollup": q_shipment_weight_rollup,
        "chargeable_weight_wt": q_chargeable_weight_wt,
        "unit_normalise": q_unit_normalise,
        "chargeable_weight_cw": q_chargeable_weight_cw,
        "consol_rollup": q_consol_rollup,
        "consol_rollup_full_history": lambda s, d: q_consol_rollup(s, d, WINDOW_ALL),
        "valid_mawb_wt": q_valid_mawb_wt,
        "valid_mawb_cw": q_valid_mawb_cw,
        "load_window_incremental": q_load_window_incremental,
        "load_window_full": q_load_window_full,
        "flight_list": q_flight_list,
        "earliest_departure": q_earliest_departure,
        "fx_convert": q_fx_convert,
        "categorised_costs": q_categorised_costs,
        "categorised_costs_incremental": q_categorised_costs_incremental,
        "total_cost": q_total_cost,
        "wt_feed": q_wt_feed,
        "wt_feed_rank": q_wt_feed_rank,
        "wt_feed_history_cut": q_wt_feed_history_cut,
        "wt_feed_full_history": lambda s, d: q_wt_feed(s, d, WINDOW_ALL),
        "wt_mawb_feed": q_wt_mawb_feed,
        "wt_mawb_feed_declared": q_wt_mawb_feed_declared,
        "wt_hawb_feed": q_wt_hawb_feed,
        "cw_feed": q_cw_feed,
        "cw_feed_full_history": lambda s, d: q_cw_feed(s, d, WINDOW_ALL),
        "cw_feed_history_cut": q_cw_feed_history_cut,
        "wt_feed_uncut": q_wt_feed_uncut,
        "cw_feed_uncut": q_cw_feed_uncut,
        "cw_mawb_feed": q_cw_mawb_feed,
        "cw_hawb_feed": q_cw_hawb_feed,
        "csv_roundtrip": q_csv_roundtrip,
    }


# --- oracle side ----------------------------------------------------------------

def _wt(body: str) -> str:
    return O.with_views(body, O.WT_VIEWS)


def _cw(body: str) -> str:
    return O.with_views(body, O.CW_VIEWS)


def _labels(pairs: list[tuple[str, str]], src: str, null_missing: set[str] = frozenset()) -> str:
    cols = []
    for label, col in pairs:
        expr = "CAST(NULL AS VARCHAR)" if col in null_missing else f'"{col}"'
        cols.append(f'{expr} AS "{label}"')
    return f"SELECT {', '.join(cols)} FROM ({src}) f WHERE length(mawb) > 0"


def oracle_queries() -> dict[str, str]:
    from ..plans.feeds import CW_MAWB_LABELS, HAWB_LABELS, WT_MAWB_DECLARED, WT_MAWB_OBSERVED

    s45 = WINDOW_45.start
    latest = f"""
        SELECT fk_orderno, fk_seqno, pk_airwaybillno, flightno1,
               strftime(flightdatetime1, {O.TS_FMT}) AS flight_time
        FROM ({O.NEWEST})"""
    first = f"""
        SELECT jh_pk, jh_parentid, jh_gc, strftime(jh_systemcreatetimeutc, {O.TS_FMT}) AS created
        FROM ({O.FIRST_HEADERS})"""
    rollup = f"""
        SELECT fk_airwaybillno, CAST(gross AS DOUBLE) AS d_actual, CAST(billed AS DOUBLE) AS d_chargeable,
               CAST(money AS DOUBLE) AS d_total, unit AS d_unit
        FROM ({O.DETAIL})"""
    ship_w = f"""
        SELECT pk_orderno, housebill, CAST(lbs AS DOUBLE) AS w_lbs, CAST(kgs AS DOUBLE) AS w_kgs,
               CAST(dim_lbs AS DOUBLE) AS w_dim_lbs, CAST(dim_kgs AS DOUBLE) AS w_dim_kgs
        FROM ({O.ORDER_WEIGHTS})"""
    typed = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in O.MEASURES_WT)
    wt_inner_typed = f"""
        SELECT * REPLACE ({typed}, strftime(flight_ts, {O.TS_FMT}) AS flight_ts)
        FROM ({O.wt_rows(HISTORY_START)})"""
    unit_norm = f"""
        SELECT js_pk, js_unitofweight, js_unitofvolume, CAST({O.ACTUAL_KG} AS DOUBLE) AS actual_kg,
               CAST({O.VOLUME_M3} AS DOUBLE) AS volume_m3
        FROM jobshipment"""
    chg_cw = f"SELECT js_pk, CAST({O.CHARGEABLE_KG} AS DOUBLE) AS chargeable_kg FROM jobshipment"

    def consol(start):
        double = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in ("actual_weight", "chargeable_weight", "volume"))
        return f"SELECT * REPLACE ({double}) FROM ({O.weights_sql(start)})"

    valid_wt = """
        SELECT fk_orderno, seqno, refno FROM tbl_shipmentapar
        WHERE length(refno) = 11 AND regexp_full_match(refno, '[0-9]{11}')"""
    valid_cw = "SELECT jk_pk, jk_masterbillnum FROM jobconsol WHERE length(jk_masterbillnum) > 10"
    lw_inc = f"""
        SELECT js_pk, strftime(js_systemcreatetimeutc, {O.TS_FMT}) AS created FROM jobshipment
        WHERE CAST(js_systemcreatetimeutc AS DATE) >= DATE '{s45.isoformat()}'"""
    lw_full = f"""
        SELECT fk_orderno, fk_seqno, pk_airwaybillno FROM tbl_airwaybill
        WHERE CAST(flightdatetime1 AS DATE) >= DATE '{FULL_LOAD_START.isoformat()}'"""
    flights = O.FLIGHTS
    departures = f"SELECT mawb, strftime(atd, {O.TS_FMT}) AS atd FROM ({O.DEPARTURES})"
    fx = f"SELECT js_pk, ac_code, round(cost, {MONEY_DP}) AS cost FROM ({O.COSTS_BY_SHIPMENT})"
    costs = f"""
        SELECT mawb, {", ".join(f"round({n}, {MONEY_DP}) AS {n}" for n in O.COST_COLUMNS)}
        FROM ({O.COSTS})"""
    totals = f"""
        SELECT mawb, {", ".join(f"round(coalesce({n}, 0), {MONEY_DP}) AS {n}" for n in O.COST_COLUMNS)},
               round({O.TOTAL}, {MONEY_DP}) AS total_cost_to_carrier
        FROM ({O.COSTS}) WHERE {O.TOTAL} > 0"""
    wt45 = O.wt_feed_sql(s45)
    cw45 = O.cw_feed_sql(s45)
    # CSV text: decimals keep their scale; NULL and '' stay apart
    roundtrip = ", ".join(
        f'CAST("{label}" AS VARCHAR) AS "{label}"' for label, _ in WT_MAWB_OBSERVED)
    wt45_text = O.wt_feed_sql(s45, as_double=False)
    return {
        "latest_by_sequence": _wt(latest),
        "latest_by_sequence_rank": _wt(latest),
        "first_by_time": _cw(first),
        "detail_rollup_by_unit": _wt(rollup),
        "shipment_weight_rollup": _wt(ship_w),
        "chargeable_weight_wt": _wt(wt_inner_typed),
        "unit_normalise": _cw(unit_norm),
        "chargeable_weight_cw": _cw(chg_cw),
        "consol_rollup": _cw(consol(s45)),
        "consol_rollup_full_history": _cw(consol(HISTORY_START)),
        "valid_mawb_wt": _wt(valid_wt),
        "valid_mawb_cw": _cw(valid_cw),
        "load_window_incremental": _cw(lw_inc),
        "load_window_full": _wt(lw_full),
        "flight_list": _cw(flights),
        "earliest_departure": _cw(departures),
        "fx_convert": _cw(fx),
        "categorised_costs": _cw(costs),
        "categorised_costs_incremental": _cw(costs),
        "total_cost": _cw(totals),
        "wt_feed": _wt(wt45),
        "wt_feed_rank": _wt(wt45),
        "wt_feed_history_cut": _wt(O.wt_feed_sql(HISTORY_START)),
        "wt_feed_uncut": _wt(wt45),
        "wt_feed_full_history": _wt(O.wt_feed_sql(HISTORY_START)),
        "wt_mawb_feed": _wt(_labels(WT_MAWB_OBSERVED, wt45)),
        "wt_mawb_feed_declared": _wt(_labels(WT_MAWB_DECLARED, wt45)),
        "wt_hawb_feed": _wt(_labels(HAWB_LABELS, wt45)),
        "cw_feed": _cw(cw45),
        "cw_feed_full_history": _cw(O.cw_feed_sql(HISTORY_START)),
        "cw_feed_history_cut": _cw(O.cw_feed_sql(HISTORY_START)),
        "cw_feed_uncut": _cw(cw45),
        "cw_mawb_feed": _cw(_labels(CW_MAWB_LABELS, cw45)),
        "cw_hawb_feed": _cw(_labels(HAWB_LABELS, cw45, {"hawb"})),
        "csv_roundtrip": _wt(f"SELECT {roundtrip} FROM ({_labels(WT_MAWB_OBSERVED, wt45_text)}) f"),
    }
