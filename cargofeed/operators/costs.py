"""Categorised, currency-converted carrier costs per MAWB (M8) and totals (M9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day
from ..functions.money import POST, PRE, converted_cost, rate_needed
from ..functions.validity import is_code
from .cost_layout import CostLayout
from .joins import broadcast_all_if_bounded, cut_to_keys, left_join_null_safe
from .stage import stage

# Fixed values that must equal the source job's:
#   charge codes of each cost category
#   transaction line types that count as cost
#   company and type of the exchange rates used
COST_CATEGORIES: dict[str, list[str]] = {
    "total_security_surcharge": ["SEC", "SECURSURC", "SCC", "SEC SERV", "ISS"],
    "total_fuel_surcharge": ["FSC"],
    "airlines_rate": ["FREIGHTER", "FRT", "FRT2", "INTL AIR", "AIRFRT"],
}
COST_LINE_TYPES = ["CST", "ACR"]
RATE_COMPANY = "9EEBDCD6-7BDF-460C-8210-7698FDD99758"
RATE_TYPE = "BUY"

# Precision of converted money. One charge line and one shipment's sum keep
# 14 integer digits and 12 decimals, so that multiplying by a multiplicity of
# up to 11 digits stays within decimal(38) without Spark cutting the scale.
COST_ROW = "decimal(26,12)"
MULTIPLICITY = "decimal(11,0)"
COST_SUM = "decimal(38,12)"


def _rates(refexchangerate: DataFrame, company: str, rate_type: str) -> DataFrame:
    """``(cur, day, rate, n)``: rates of one company and type, equal ones of a (currency, day) counted."""
    r = refexchangerate.filter((F.col("re_gc") == company) & is_code("re_exratetype", rate_type))
    r = r.select(F.col("re_rx_nkexcurrency").alias("cur"), day("re_startdate").alias("day"),
                 F.col("re_sellrate").alias("rate")).filter("cur IS NOT NULL AND day IS NOT NULL")
    return r.groupBy("cur", "day", "rate").agg(F.count(F.lit(1)).alias("n"))


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in df.columns])


def _with_rates(x: DataFrame, rates: DataFrame, per_day: DataFrame) -> DataFrame:
    """Cost lines with each different rate of the one day that converts them: ``used_rate``, and ``times``, how many
    (PRE rate, POST rate) pairs of the line's two days hold it.

    The source joins both days' rates, so a line occurs once per pair although one rate
    of a pair converts it at most. The day that does not convert only counts: the
    pairs are never built, and equal rates are one row.
    """
    pre, post, used = _prefixed(per_day, "pre"), _prefixed(per_day, "post"), _prefixed(rates, "used")
    inv = F.coalesce(F.col("ar_inv"), F.col("ap_inv"))
    needed = rate_needed("local_cur", "ap_post")
    x = x.withColumn("__cur", F.when(needed == PRE, F.col("local_cur")).when(needed == POST, F.col("txn_cur")))
    x = x.withColumn("__day", F.when(needed == PRE, F.col("ship_day")).when(needed == POST, inv))
    x = (x.join(pre, (x["local_cur"] == pre["pre_cur"]) & (x["ship_day"] == pre["pre_day"]), "left")
          .join(post, (x["txn_cur"] == post["post_cur"]) & (inv == post["post_day"]), "left")
          .join(used, (x["__cur"] == used["used_cur"]) & (x["__day"] == used["used_day"]), "left"))
    n_pre, n_post, n_used = (F.coalesce(F.col(f"{c}_n"), F.lit(1).cast("long")) for c in ("pre", "post", "used"))
    others = F.when(needed == PRE, n_post).when(needed == POST, n_pre).otherwise(n_pre * n_post)
    return x.withColumn("times", n_used * others)


def _dimensions(tables: Mapping[str, DataFrame], all_codes: Sequence[str], rate_company: str, rate_type: str) -> list[DataFrame]:
    """Charge codes, companies, branch multiplicities, rates and their number per day: broadcast only
    after one bounded job proves their sizes."""
    codes = (tables["accchargecode"].filter(F.col("ac_code").isin(list(all_codes)))
             .select("ac_pk", "ac_gc", "ac_code"))
    company = tables["glbcompany"].select(
        "gc_pk", F.col("gc_rx_nklocalcurrency").alias("local_cur"))
    branch = (tables["glbbranch"].groupBy("gb_pk", "gb_gc")
              .agg(F.count(F.lit(1)).cast("int").alias("n_branch")))
    # a few rows of a table that may be large: written once, read by every join with them
    rates = stage(_rates(tables["refexchangerate"], rate_company, rate_type), "rates")
    per_day = rates.groupBy("cur", "day").agg(F.sum("n").alias("n"))
    return broadcast_all_if_bounded([codes, company, branch, rates, per_day])


def _stored_chain(layout: CostLayout, shipments: DataFrame | None, codes: DataFrame,
                  line_types: Sequence[str]) -> DataFrame:
    """Charges with header, payable and receivable line from the stored layout.

    The charges meet their headers without an exchange; then they alone are shuffled, once
    to each role's lines, which stay in their buckets.
    """
    h, c = layout.headers, layout.charges
    if shipments is not None:
        wanted = shipments.select(F.col("js_pk").alias("__js"))
        h = h.join(wanted, h["js_pk"] == wanted["__js"], "left_semi")
    x = h.join(c, (h["jh_pk"] == c["jr_jh"]) & (h["jh_gc"] == c["jr_gc"]) & (h["copy"] == c["copy"])).drop("copy")
    ap = layout.lines.filter(is_code("al_linetype", *line_types)).select(
        F.col("al_pk").alias("ap_pk"), F.col("al_gc").alias("ap_gc"), F.col("copy").alias("__ap"), F.col("al_ac").alias("ap_ac"),
        F.col("al_osamount").alias("ap_os"), F.col("post").alias("ap_post"), "txn_cur", F.col("inv").alias("ap_inv"))
    ar = layout.lines.select(F.col("al_pk").alias("ar_pk"), F.col("al_gc").alias("ar_gc"), F.col("copy").alias("__ar"),
                             F.col("inv").alias("ar_inv"))
    x = (x.join(ap, (x["jr_al_apline"] == ap["ap_pk"]) & (x["jr_gc"] == ap["ap_gc"]) & (x["ap_copy"] == ap["__ap"]))
          .join(codes, (F.col("ap_ac") == codes["ac_pk"]) & (F.col("jr_gc") == codes["ac_gc"])))
    return left_join_null_safe(x, ar, ["jr_al_arline", "jr_gc", "ar_copy"], ["ar_pk", "ar_gc", "__ar"])


def charge_costs(tables: Mapping[str, DataFrame], shipments: DataFrame | None,
                 categories: Mapping[str, Sequence[str]] = COST_CATEGORIES,
                 line_types: Sequence[str] = COST_LINE_TYPES,
                 rate_company: str = RATE_COMPANY, rate_type: str = RATE_TYPE,
                 reduce_history: bool = False, layout: CostLayout | None = None) -> DataFrame:
    """Costed charge lines of ``shipments``: ``(js_pk, ac_code, cost)``, one row per line and different rate
    that converts it, with the cost of all its occurrences.

    The chain: shipment -> all its job headers -> charges of the header's
    company -> payable line (cost line types only) and its header -> the
    receivable line and its header (optional: they only supply the invoice
    day) -> charge code (listed codes only) -> company -> rate of the
    shipment's creation day (PRE) and of the invoice day (POST, receivable
    invoice first). A charge matched by two rates on one day counts twice,
    as in the source query; so does one whose other day has two, and these
    pairs are counted, not built (:func:`_with_rates`). A branch of the header that occurs k times
    multiplies the line k times (the source joined it without using it).

    ``reduce_history``: for a small ``shipments`` set (one load window),
    each history-wide table is first cut to the rows that can match the
    previous level (headers of those shipments, their charges, the lines
    of those charges, the headers of those lines), each cut a map-side
    semi join with a broadcast, size-checked key set, and the small levels
    are staged. The big tables are then scanned and filtered, never shuffled
    whole. Each cut only drops rows that the following join could not
    match, so the result is unchanged.

    ``layout``: the whole history from the stored bucketed tables
    (:mod:`cost_layout`) instead; ``shipments`` None then stands for all of them.
    """
    all_codes = sorted({c for codes in categories.values() for c in codes})
    codes, company, branch, rates, per_day = _dimensions(tables, all_codes, rate_company, rate_type)
    if layout is not None:
        x = _stored_chain(layout, shipments, codes, line_types)
    else:
        x = _source_chain(tables, shipments, codes, line_types, reduce_history)
    x = (x.join(company, F.col("jr_gc") == company["gc_pk"])
          .join(branch, (F.col("jh_gb") == branch["gb_pk"]) & (F.col("jh_gc") == branch["gb_gc"]), "left"))
    x = _with_rates(x, rates, per_day)
    cost = converted_cost("local_cur", "jr_localcostamt", "ap_post", "ap_os", "used_rate", "used_rate")
    times = F.coalesce(F.col("n_branch"), F.lit(1)) * F.col("times")
    return x.select("js_pk", "ac_code", (cost.cast(COST_ROW) * times.cast(MULTIPLICITY)).cast(COST_SUM).alias("cost"))


def _source_chain(tables: Mapping[str, DataFrame], shipments: DataFrame, codes: DataFrame,
                  line_types: Sequence[str], reduce_history: bool) -> DataFrame:
    """The chain over the source tables; see :func:`charge_costs`."""
    ship = shipments.select("js_pk", day("js_systemcreatetimeutc").alias("ship_day"))
    jh = tables["jobheader"].select("jh_pk", "jh_parentid", "jh_gc", "jh_gb")
    jr = tables["jobcharge"].select("jr_jh", "jr_gc", "jr_al_apline", "jr_al_arline",
                                    "jr_localcostamt")
    lines = tables["acctransactionlines"]
    ap = lines.filter(is_code("al_linetype", *line_types)).select(
        F.col("al_pk").alias("ap_pk"), F.col("al_gc").alias("ap_gc"),
        F.col("al_ah").alias("ap_ah"), F.col("al_ac").alias("ap_ac"),
        F.col("al_osamount").alias("ap_os"))
    ar = lines.select(F.col("al_pk").alias("ar_pk"), F.col("al_gc").alias("ar_gc"),
                      F.col("al_ah").alias("ar_ah"))
    hdr = tables["acctransactionheader"]
    aph = hdr.select(F.col("ah_pk").alias("aph_pk"), F.col("ah_gc").alias("aph_gc"),
                     F.col("ah_postdate").alias("ap_post"),
                     F.col("ah_rx_nktransactioncurrency").alias("txn_cur"),
                     day("ah_invoicedate").alias("ap_inv"))
    arh = hdr.select(F.col("ah_pk").alias("arh_pk"), F.col("ah_gc").alias("arh_gc"),
                     day("ah_invoicedate").alias("ar_inv"))
    if reduce_history:
        def cut(df, keys, on, key_cols, label=None):
            out = cut_to_keys(df, keys, on, key_cols)
            return stage(out, label) if label else out

        jh = cut(jh, ship, ["jh_parentid"], ["js_pk"], "job_headers")
        jr = cut(jr, jh, ["jr_jh", "jr_gc"], ["jh_pk", "jh_gc"], "charges")
        ap = cut(ap, jr, ["ap_pk", "ap_gc"], ["jr_al_apline", "jr_gc"], "payable_lines")
        aph = cut(aph, ap, ["aph_pk", "aph_gc"], ["ap_ah", "ap_gc"])
        ar = cut(ar, jr, ["ar_pk", "ar_gc"], ["jr_al_arline", "jr_gc"], "receivable_lines")
        arh = cut(arh, ar, ["arh_pk", "arh_gc"], ["ar_ah", "ar_gc"])

    # Each transaction line is joined to its header first, NULL header keys
    # spread by the line's own key.
    ap_full = left_join_null_safe(ap.join(codes, (ap["ap_ac"] == codes["ac_pk"])
                                          & (ap["ap_gc"] == codes["ac_gc"])),
                                  aph, ["ap_ah", "ap_gc"], ["aph_pk", "aph_gc"], spread_by="ap_pk")
    ar_full = left_join_null_safe(ar, arh, ["ar_ah", "ar_gc"], ["arh_pk", "arh_gc"],
                                  spread_by="ar_pk").select("ar_pk", "ar_gc", "ar_inv")
    x = (ship.join(jh, ship["js_pk"] == jh["jh_parentid"])
             .join(jr, (F.col("jh_pk") == jr["jr_jh"]) & (F.col("jh_gc") == jr["jr_gc"]))
             .join(ap_full, (F.col("jr_al_apline") == ap_full["ap_pk"])
                   & (F.col("jr_gc") == ap_full["ap_gc"])))
    return left_join_null_safe(x, ar_full, ["jr_al_arline", "jr_gc"], ["ar_pk", "ar_gc"], spread_by="ap_pk")


def _category_sums(code: Column, value: Column,
                   categories: Mapping[str, Sequence[str]]) -> list[Column]:
    return [F.sum(F.when(code.isin(list(codes)), value)).alias(name)
            for name, codes in categories.items()]


def costs_by_shipment(charges: DataFrame,
                      categories: Mapping[str, Sequence[str]] = COST_CATEGORIES) -> DataFrame:
    """``(js_pk, <category>...)``: one conditional sum per category.

    One aggregate computes all categories from a single pass over the charge
    join (the source query ran the same 14-way join once per category).
    """
    sums = _category_sums(F.col("ac_code"), F.col("cost"), categories)
    out = charges.groupBy("js_pk").agg(*sums)
    return out.select("js_pk", *[F.col(c).cast(COST_ROW).alias(c) for c in categories])


def costs_by_mawb(per_shipment: DataFrame, multiplicity: DataFrame,
                  categories: Mapping[str, Sequence[str]] = COST_CATEGORIES) -> DataFrame:
    """``(mawb, <category>...)``: shipment costs summed per MAWB, each
    shipment counted ``mult`` times (once per consolidation row and AIR leg
    linking it to the MAWB, as in the source query). A category with no
    charge line, or only unconvertible ones, is NULL."""
    j = per_shipment.join(multiplicity, per_shipment["js_pk"] == multiplicity["jn_js"])
    return j.groupBy("mawb").agg(
        *[F.sum(F.col(c) * F.col("mult").cast(MULTIPLICITY)).cast(COST_SUM).alias(c) for c in categories])


def total_cost(df: DataFrame, cols: Sequence[str] = tuple(COST_CATEGORIES),
               out: str = "total_cost_to_carrier") -> DataFrame:
    """Replace NULL costs by 0, add ``out`` = their sum and keep rows with a
    positive total (M9)."""
    filled = df.select(*[F.coalesce(F.col(c), F.lit(0)).cast(COST_SUM).alias(c)
                         if c in cols else F.col(c) for c in df.columns])
    # add with two digits of headroom, so Spark keeps all 12 decimals
    addends = [F.col(c).cast("decimal(36,12)") for c in cols]
    total = sum(addends[1:], addends[0]).cast(COST_SUM)
    return filled.withColumn(out, total).filter(F.col(out) > 0)
