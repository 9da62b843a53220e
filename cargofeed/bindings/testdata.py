"""Freight-shaped views over the shared TPC-H-like test tables.

The 17 source tables of the two families are derived, row for row, from
``lineitem``, ``orders``, ``customer``, ``part``, ``nation`` and ``region``
with narrow projections (plus a few UNION ALLs and array explodes); no view
caps, samples or subsets rows by id, so every query over them grows with the
test tables; where a join is to miss, the key is broken and the row stays. NULLs, blanks, sentinel dates, duplicate keys, cancelled and
invalid rows are injected by arithmetic rules on the keys so that every
branch of the operators is exercised. ``bindings.oracle`` defines the same
views in DuckDB SQL; the two definitions must stay in step.

All values are exact in both engines: quantities are integral, prices have
two decimals, derived measures are products with decimal constants (never
quotients), and exchange rates have reciprocals with finite decimals.

The views are written as SQL expressions (``selectExpr``): one call per view
instead of one driver round trip per column expression.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.cost_layout import CostLayout, cost_layout
from ..operators.costs import RATE_COMPANY
from ..session import checkpoint_dir
from ..sources.layout import BUCKET_KEYS, bucket_count, store_family
from ..sources.tables import conform

BASE_TABLES = ("lineitem", "orders", "customer", "part", "nation", "region")

# Columns of the test tables that the views read (explicit: no schema inference job).
BASE_SCHEMAS: dict[str, T.StructType] = {
    "lineitem": T.StructType([
        T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
        T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_discount", T.DoubleType()), T.StructField("l_returnflag", T.StringType()),
        T.StructField("l_linestatus", T.StringType()),
        T.StructField("l_shipdate", T.TimestampNTZType())]),
    "orders": T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType())]),
    "customer": T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_nationkey", T.IntegerType())]),
    "part": T.StructType([
        T.StructField("p_partkey", T.LongType()), T.StructField("p_type", T.StringType())]),
    "nation": T.StructType([T.StructField("n_nationkey", T.IntegerType())]),
    "region": T.StructType([T.StructField("r_regionkey", T.IntegerType())]),
}

# Run day of the test data (orders end on 2001-08-01).
TEST_AS_OF = dt.date(2001, 8, 1)
# Exchange rates: reciprocals 2, 1.25, 0.8, 0.625, 0.5, 0.4, 0.25.
TEST_RATES = ["0.5", "0.8", "1.25", "1.6", "2", "2.5", "4"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

DEC = "DECIMAL(19,4)"
LINE_ID = ("concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), "
           "CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING))")
LINE_K = "(l_orderkey + l_partkey + l_linenumber)"


def _q(v: str) -> str:
    return "'" + v.replace("'", "\\'") + "'"


def _broken(when: str, key: str) -> str:
    """The key, prefixed so that it finds no partner where ``when`` holds (no row is left out)."""
    return f"CASE WHEN {when} THEN concat('?', {key}) ELSE {key} END"


def _choose(index: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {index} = {i} THEN {_q(v)}" for i, v in enumerate(values))
    return f"CASE {whens} END"


def read_base(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    root = sf_dir.rstrip("/")
    return {n: spark.read.schema(BASE_SCHEMAS[n]).parquet(f"{root}/{n}.parquet")
            for n in BASE_TABLES}


# --- WT family --------------------------------------------------------------

def wt_views(base: dict[str, DataFrame]) -> dict[str, DataFrame]:
    li, o = base["lineitem"], base["orders"]
    awb = li.selectExpr(
        "CAST(l_orderkey AS STRING) AS fk_orderno",
        "CASE WHEN l_orderkey % 37 = 0 THEN NULL ELSE l_linenumber END AS fk_seqno",
        "CAST(l_partkey AS STRING) AS pk_airwaybillno",
        "CASE WHEN l_orderkey % 6 = 0 THEN NULL ELSE l_shipdate END AS flightdatetime1",
        "concat('O', l_linestatus) AS orgairport",
        "concat('D', l_returnflag) AS destairport",
        "concat('FL', CAST(l_suppkey AS STRING)) AS flightno1",
        "'USD' AS fk_currency")
    apar = li.selectExpr(
        "CAST(l_orderkey AS STRING) AS fk_orderno",
        "l_linenumber AS seqno",
        """CASE WHEN l_returnflag = 'R' THEN lpad(concat('X', CAST(l_orderkey AS STRING)), 11, '0')
                WHEN l_linestatus = 'O' AND l_orderkey % 5 = 0
                     THEN lpad(CAST(l_orderkey AS STRING), 10, '0')
                ELSE lpad(CAST(l_orderkey * 10 + l_linenumber AS STRING), 11, '0') END AS refno""",
        f"CAST(l_discount AS {DEC}) AS rate",
        f"CAST(l_extendedprice AS {DEC}) AS total")
    desc = li.selectExpr(
        _broken("l_partkey % 13 = 0", "CAST(l_partkey AS STRING)") + " AS fk_airwaybillno",
        "l_linenumber AS pieces",
        f"CAST(l_quantity AS {DEC}) AS grossweight",
        f"""CASE WHEN l_partkey % 7 = 0 THEN NULL
                 WHEN l_partkey % 5 = 0 THEN CAST(0 AS {DEC})
                 WHEN l_partkey % 3 = 0 THEN CAST(l_quantity AS {DEC}) - 60
                 ELSE CAST(l_quantity AS {DEC}) END AS chargeableweight""",
        f"""CASE WHEN l_partkey % 11 = 0 THEN CAST(0 AS {DEC})
                 ELSE CAST(l_extendedprice AS {DEC}) END AS total""",
        """CASE WHEN l_returnflag = 'A' THEN 'L' WHEN l_returnflag = 'N' THEN 'K'
                WHEN l_linestatus = 'O' THEN NULL ELSE '' END AS lb_kg""")
    header = o.selectExpr(
        _broken("o_orderkey % 11 = 0", "CAST(o_orderkey AS STRING)") + " AS pk_orderno",
        "concat('H', CAST(o_orderkey AS STRING)) AS housebill")
    shipdesc = li.selectExpr(
        "CAST(l_orderkey AS STRING) AS fk_orderno",
        f"CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE CAST(l_quantity AS {DEC}) * 2.2046 END AS weight",
        f"CAST(l_quantity AS {DEC}) AS weightkilo",
        f"CAST(floor(l_extendedprice) AS {DEC}) * 0.0011 AS dimweight",
        f"CAST(floor(l_extendedprice) AS {DEC}) * 0.0005 AS dimweightkilo")
    views = {"tbl_airwaybill": awb, "tbl_shipmentapar": apar, "tbl_airwaybilldesc": desc,
             "tbl_shipmentheader": header, "tbl_shipmentdesc": shipdesc}
    return {n: conform(df, n) for n, df in views.items()}


# --- CW family --------------------------------------------------------------

def cw_views(base: dict[str, DataFrame]) -> dict[str, DataFrame]:
    li, o, c, p, n, r = (base[k] for k in BASE_TABLES)
    weight = f"(CAST(o_totalprice AS {DEC}) * 0.01)"
    shipment = o.selectExpr(
        "CAST(o_orderkey AS STRING) AS js_pk",
        """CASE WHEN o_orderkey % 10 = 0 THEN 'G' WHEN o_orderkey % 10 <= 2 THEN 'LB'
                ELSE 'KG' END AS js_unitofweight""",
        f"{weight} AS js_actualweight",
        f"""CASE WHEN o_orderkey % 8 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN {weight} * 2
                 ELSE {weight} * 0.5 END AS js_actualchargeable""",
        "CASE WHEN o_orderkey % 4 = 0 THEN 'CF' ELSE 'M3' END AS js_unitofvolume",
        f"CAST(floor(o_totalprice) AS {DEC}) * 0.001 AS js_actualvolume",
        "o_orderdate AS js_systemcreatetimeutc")
    jobheader = li.selectExpr(
        f"{LINE_ID} AS jh_pk",
        "CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE CAST(l_orderkey AS STRING) END AS jh_parentid",
        "CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE CAST(l_suppkey % 5 AS STRING) END AS jh_gc",
        "CAST(l_suppkey % 3 AS STRING) AS jh_gb",
        "CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE l_shipdate END AS jh_systemcreatetimeutc")
    company = r.selectExpr(
        "CAST(r_regionkey AS STRING) AS gc_pk",
        f"""CASE WHEN r_regionkey < 2 THEN 'USD' WHEN r_regionkey = 2 THEN {_q(PRIORITIES[0])}
                 WHEN r_regionkey = 3 THEN {_q(PRIORITIES[1])} ELSE {_q(PRIORITIES[2])} END
              AS gc_rx_nklocalcurrency""")
    link = (o.selectExpr("CAST(o_orderkey AS STRING) AS jn_js", "CAST(o_custkey AS STRING) AS jn_jk")
            .unionByName(o.where("o_orderkey % 7 = 0").selectExpr(
                "CAST(o_orderkey AS STRING) AS jn_js", "CAST(o_custkey + 1 AS STRING) AS jn_jk")))
    consol = c.selectExpr(
        "CAST(c_custkey AS STRING) AS jk_pk",
        """CASE WHEN c_custkey % 13 = 0 THEN ''
                WHEN c_custkey % 19 = 0 THEN lpad(CAST(c_custkey div 2 AS STRING), 10, '0')
                WHEN c_custkey % 23 = 0 THEN NULL
                ELSE lpad(CAST(c_custkey div 2 AS STRING), 11, '0') END AS jk_masterbillnum""",
        "concat('L', CAST(c_nationkey % 3 AS STRING)) AS jk_rl_nkloadport",
        "concat('D', CAST(c_nationkey % 2 AS STRING)) AS jk_rl_nkdischargeport",
        "CASE WHEN c_custkey % 17 = 0 THEN 1 ELSE 0 END AS jk_iscancelled")
    transport = c.selectExpr("c_custkey", "explode(array(0, 1)) AS leg").selectExpr(
        "CAST(c_custkey AS STRING) AS jw_parentguid",
        "CASE WHEN (c_custkey + leg) % 4 = 0 THEN 'SEA' ELSE 'AIR' END AS jw_transportmode",
        """CASE WHEN c_custkey % 31 = 0 AND leg = 1 THEN NULL
                ELSE concat(' FL', CAST(c_custkey % 50 AS STRING), CAST(leg AS STRING), ' ') END
             AS jw_voyageflight""",
        """CASE WHEN c_custkey % 9 = 0 AND (leg = 0 OR c_custkey % 18 = 0)
                     THEN TIMESTAMP_NTZ '1900-01-01 10:30:00'
                WHEN c_custkey % 5 = 0 AND leg = 0 THEN NULL
                ELSE CAST(date_add(DATE '2000-01-01', CAST(c_custkey % 300 + leg AS INT))
                          AS TIMESTAMP_NTZ) END AS jw_atd""")
    gc = "CAST(l_suppkey % 5 AS STRING)"
    amount = f"CAST(l_extendedprice AS {DEC})"
    currency = _choose("l_orderkey % 5", PRIORITIES)
    charge = li.selectExpr(
        f"{LINE_ID} AS jr_jh", f"{gc} AS jr_gc",
        f"concat('AP', {LINE_ID}) AS jr_al_apline", f"CASE WHEN {LINE_K} % 11 <> 0 THEN concat('AR', {LINE_ID}) END AS jr_al_arline",
        f"{amount} AS jr_localcostamt")
    ap_lines = li.selectExpr(
        f"concat('AP', {LINE_ID}) AS al_pk", f"{gc} AS al_gc",
        f"CASE WHEN {LINE_K} % 13 <> 0 THEN concat('HAP', {LINE_ID}) END AS al_ah", "CAST(l_partkey AS STRING) AS al_ac",
        f"{_choose(LINE_K + ' % 5', ['CST', 'ACR', 'CST', 'ACR', 'REV'])} AS al_linetype",
        f"-{amount} AS al_osamount")
    ar_lines = li.selectExpr(
        _broken(f"{LINE_K} % 3 = 0", f"concat('AR', {LINE_ID})") + " AS al_pk", f"{gc} AS al_gc",
        f"concat('HAR', {LINE_ID}) AS al_ah", "CAST(l_partkey AS STRING) AS al_ac",
        "'REV' AS al_linetype", f"{amount} AS al_osamount")
    ap_headers = li.selectExpr(
        _broken(f"{LINE_K} % 7 = 0", f"concat('HAP', {LINE_ID})") + " AS ah_pk", f"{gc} AS ah_gc",
        f"CASE WHEN {LINE_K} % 4 = 0 THEN NULL ELSE l_shipdate END AS ah_postdate",
        f"{currency} AS ah_rx_nktransactioncurrency",
        "l_shipdate AS ah_invoicedate")
    ar_headers = li.selectExpr(
        _broken(f"{LINE_K} % 2 <> 0", f"concat('HAR', {LINE_ID})") + " AS ah_pk", f"{gc} AS ah_gc",
        "l_shipdate AS ah_postdate",
        f"{currency} AS ah_rx_nktransactioncurrency",
        f"""CASE WHEN {LINE_K} % 4 = 0 THEN NULL
                 ELSE CAST(date_add(to_date(l_shipdate), 1) AS TIMESTAMP_NTZ) END AS ah_invoicedate""")
    chargecode = p.selectExpr("p_partkey", "p_type", "explode(array(0, 1, 2, 3, 4)) AS gc").selectExpr(
        "CAST(p_partkey AS STRING) AS ac_pk", "CAST(gc AS STRING) AS ac_gc",
        """CASE WHEN p_type = 'PROMO' AND gc = 4 THEN 'SECURSURC'
                WHEN p_type = 'PROMO' AND gc = 2 THEN 'SEC SERV'
                WHEN p_type = 'PROMO' THEN 'SEC'
                WHEN p_type = 'SMALL' THEN 'FSC'
                WHEN p_type = 'ECONOMY' AND gc = 3 THEN 'FRT2'
                WHEN p_type = 'ECONOMY' THEN 'FRT'
                WHEN p_type = 'STANDARD' AND gc = 1 THEN 'INTL AIR'
                WHEN p_type = 'STANDARD' THEN 'AIRFRT'
                WHEN p_type = 'LARGE' THEN 'ISS'
                ELSE 'MISC' END AS ac_code""")
    branch = n.selectExpr("CAST(n_nationkey % 3 AS STRING) AS gb_pk",
                          "CAST(n_nationkey % 5 AS STRING) AS gb_gc")
    rates = (o.selectExpr("o_orderkey", _broken("o_orderkey % 3 <> 0", "o_orderpriority") + " AS o_orderpriority", "o_orderdate",
                         "explode(array('BUY', 'SELL')) AS rtype")
             .selectExpr(
                 "o_orderpriority AS re_rx_nkexcurrency",
                 "o_orderdate + INTERVAL 6 HOURS AS re_startdate",
                 f"CASE WHEN o_orderkey % 5 = 0 THEN 'OTHER-COMPANY' ELSE {_q(RATE_COMPANY)} END AS re_gc",
                 "rtype AS re_exratetype",
                 f"CAST({_choose('o_orderkey % 7', TEST_RATES)} AS DECIMAL(18,9)) AS re_sellrate"))
    views = {"jobshipment": shipment, "jobheader": jobheader, "glbcompany": company,
             "jobconshiplink": link, "jobconsol": consol, "jobconsoltransport": transport,
             "jobcharge": charge, "acctransactionlines": ap_lines.unionByName(ar_lines),
             "acctransactionheader": ap_headers.unionByName(ar_headers),
             "accchargecode": chargecode, "glbbranch": branch, "refexchangerate": rates}
    return {name: conform(df, name) for name, df in views.items()}


def freight_views(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(WT tables, CW tables) as lazy views over the test tables in ``sf_dir``."""
    base = read_base(spark, sf_dir)
    return wt_views(base), cw_views(base)


# Bump when a view definition changes: stored copies are keyed by it.
BINDING_VERSION = "4"


def _fs_status(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    parts = [BINDING_VERSION, sf_dir.rstrip("/")]
    for n in BASE_TABLES:
        fs, p = _fs_status(spark, f"{sf_dir.rstrip('/')}/{n}.parquet")
        st = fs.getFileStatus(p)
        parts.append(f"{n}:{st.getLen()}:{st.getModificationTime()}")
    return hashlib.sha1("|".join(parts).encode()).hexdigest()[:16]


def freight_tables(spark: SparkSession, sf_dir: str, materialize: bool = True,
                   files_per_table: int | None = None) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(WT tables, CW tables) over the test tables in ``sf_dir``.

    With ``materialize`` (default) the derived tables are stored once under
    the shared checkpoint folder (``spark.checkpoint.dir``), keyed by a
    fingerprint of the inputs and the view definitions, and read back from
    there: queries then scan stored source tables, bucketed on their join keys
    (``sources.layout``), as the feed job does in production, instead of deriving
    them from single-file test tables on every run. A table is stored when it is first
    looked up, so a query stores the tables that it reads; dimensions, which have no
    bucket key, are read as views. A copy is used only when
    its ``_SUCCESS`` marker exists; a missing or partial copy is rewritten.
    """
    wt, cw = freight_views(spark, sf_dir)
    if not materialize:
        return wt, cw
    buckets = bucket_count(spark, base_bytes(spark, sf_dir))
    root = store_root(spark, sf_dir)
    return StoredFamily(wt, root, buckets, files_per_table), StoredFamily(cw, root, buckets, files_per_table)


class StoredFamily(Mapping):
    """Tables of one family by name, each large one stored (or opened) by ``store_family`` at its first lookup."""

    def __init__(self, views: dict[str, DataFrame], root: str, buckets: int, plain_files: int | None = None):
        self._views, self._root, self._buckets, self._plain_files = views, root, buckets, plain_files
        self._stored: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in BUCKET_KEYS:
            return self._views[name]
        if name not in self._stored:
            self._stored |= store_family({name: self._views[name]}, self._root, self._buckets, self._plain_files)
        return self._stored[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._views)

    def __len__(self) -> int:
        return len(self._views)


def base_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Bytes of the test tables that the views read."""
    found = [_fs_status(spark, f"{sf_dir.rstrip('/')}/{n}.parquet") for n in BASE_TABLES]
    return sum(fs.getContentSummary(p).getLength() for fs, p in found)


def store_root(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the stored copies of one test directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/cargofeed-freight/{_fingerprint(spark, sf_dir)}"


def freight_cost_layout(spark: SparkSession, sf_dir: str) -> CostLayout:
    """The stored cost layout of the CW tables of ``sf_dir``, built once, from the views: the layout is itself
    the stored form of its tables, so these are not stored for it a second time."""
    _, cw = freight_views(spark, sf_dir)
    return cost_layout(cw, store_root(spark, sf_dir), bucket_count(spark, base_bytes(spark, sf_dir)))
