"""Explicit schemas of the two freight source families.

The source job has no DDL; the columns below are every column its queries
touch, with types inferred from use. Money, weights and volumes are
``decimal(19,4)``; exchange rates ``decimal(18,9)``; timestamps are
timestamp-without-time-zone (cast to dates in UTC).
"""

from __future__ import annotations

from pyspark.sql import types as T

DEC = T.DecimalType(19, 4)
RATE = T.DecimalType(18, 9)
TS = T.TimestampNTZType()
STR = T.StringType()
INT = T.IntegerType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in cols])


# --- WT family --------------------------------------------------------------

WT_SCHEMAS: dict[str, T.StructType] = {
    "tbl_airwaybill": _schema(
        ("fk_orderno", STR), ("fk_seqno", INT), ("pk_airwaybillno", STR),
        ("flightdatetime1", TS), ("orgairport", STR), ("destairport", STR),
        ("flightno1", STR), ("fk_currency", STR)),
    "tbl_shipmentapar": _schema(
        ("fk_orderno", STR), ("seqno", INT), ("refno", STR), ("rate", DEC), ("total", DEC)),
    "tbl_airwaybilldesc": _schema(
        ("fk_airwaybillno", STR), ("pieces", INT), ("grossweight", DEC),
        ("chargeableweight", DEC), ("total", DEC), ("lb_kg", STR)),
    "tbl_shipmentheader": _schema(("pk_orderno", STR), ("housebill", STR)),
    "tbl_shipmentdesc": _schema(
        ("fk_orderno", STR), ("weight", DEC), ("weightkilo", DEC),
        ("dimweight", DEC), ("dimweightkilo", DEC)),
}

# --- CW family --------------------------------------------------------------

CW_SCHEMAS: dict[str, T.StructType] = {
    "jobshipment": _schema(
        ("js_pk", STR), ("js_unitofweight", STR), ("js_actualweight", DEC),
        ("js_actualchargeable", DEC), ("js_unitofvolume", STR), ("js_actualvolume", DEC),
        ("js_systemcreatetimeutc", TS)),
    "jobheader": _schema(
        ("jh_pk", STR), ("jh_parentid", STR), ("jh_gc", STR), ("jh_gb", STR),
        ("jh_systemcreatetimeutc", TS)),
    "glbcompany": _schema(("gc_pk", STR), ("gc_rx_nklocalcurrency", STR)),
    "jobconshiplink": _schema(("jn_js", STR), ("jn_jk", STR)),
    "jobconsol": _schema(
        ("jk_pk", STR), ("jk_masterbillnum", STR), ("jk_rl_nkloadport", STR),
        ("jk_rl_nkdischargeport", STR), ("jk_iscancelled", INT)),
    "jobconsoltransport": _schema(
        ("jw_parentguid", STR), ("jw_transportmode", STR), ("jw_voyageflight", STR),
        ("jw_atd", TS)),
    "jobcharge": _schema(
        ("jr_jh", STR), ("jr_gc", STR), ("jr_al_apline", STR), ("jr_al_arline", STR),
        ("jr_localcostamt", DEC)),
    "acctransactionlines": _schema(
        ("al_pk", STR), ("al_gc", STR), ("al_ah", STR), ("al_ac", STR),
        ("al_linetype", STR), ("al_osamount", DEC)),
    "acctransactionheader": _schema(
        ("ah_pk", STR), ("ah_gc", STR), ("ah_postdate", TS),
        ("ah_rx_nktransactioncurrency", STR), ("ah_invoicedate", TS)),
    "accchargecode": _schema(("ac_pk", STR), ("ac_gc", STR), ("ac_code", STR)),
    "glbbranch": _schema(("gb_pk", STR), ("gb_gc", STR)),
    "refexchangerate": _schema(
        ("re_rx_nkexcurrency", STR), ("re_startdate", TS), ("re_gc", STR),
        ("re_exratetype", STR), ("re_sellrate", RATE)),
}

ALL_SCHEMAS: dict[str, T.StructType] = {**WT_SCHEMAS, **CW_SCHEMAS}

# Short code columns whose value goes on (units, currencies, charge codes).
# Trailing blanks are trimmed at the scan so that 'KG ' matches 'KG' (the source
# dialect ignored them). Columns that only filter a large table (transport mode,
# line type, rate type) stay as stored and are compared by ``functions.is_code``,
# which also ignores trailing blanks but lets the scan skip row groups.
CODE_COLUMNS: dict[str, tuple[str, ...]] = {
    "tbl_airwaybilldesc": ("lb_kg",),
    "jobshipment": ("js_unitofweight", "js_unitofvolume"),
    "glbcompany": ("gc_rx_nklocalcurrency",),
    "acctransactionheader": ("ah_rx_nktransactioncurrency",),
    "accchargecode": ("ac_code",),
    "refexchangerate": ("re_rx_nkexcurrency",),
}
