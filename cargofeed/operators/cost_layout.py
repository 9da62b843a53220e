"""Stored layout of the cost tables (J14-J17): charges meet their headers and lines without an exchange.

Three bucketed tables are derived from the source tables once per load:

* ``headers``: job headers with the creation day of their shipment, bucketed by
  header key, company and copy,
* ``charges``: charge lines, bucketed by the header key they carry and copy,
* ``lines``: transaction lines with currency and dates of their transaction
  header, bucketed by line key, company and copy.

Hot keys do not fill a bucket. Counts of hash bins name where keys that hold more
than ``1 / (PIECES * buckets)`` of all charges can be; exact counts find them. Rows of a
hot key are dealt over as many copy numbers as it has such shares, and
the other side's row is stored once per copy. Every charge still meets
each partner exactly once, so the joined rows are the same.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day
from ..sources.layout import BINS, exists, heavy_bins, open_buckets, write_buckets
from .joins import left_join_null_safe

#: Shares of an even bucket that a hot key is cut into.
PIECES = 8

HEADER_KEYS = ["jh_pk", "jh_gc", "copy"]
CHARGE_KEYS = ["jr_jh", "jr_gc", "copy"]
LINE_KEYS = ["al_pk", "al_gc", "copy"]


def hot_keys(df: DataFrame, columns: Sequence[str], pieces: int) -> DataFrame:
    """``(key, copies)`` of the values that hold more than ``1 / pieces`` of the rows in one of ``columns``.

    Counts of hash bins (``heavy_bins``), one scan for all columns, bound what is counted exactly to the
    values in bins above that share; the result holds at most ``len(columns) * pieces`` rows.
    """
    total = df.count()
    even, bins = max(1.0, total / pieces), BINS * pieces
    keyed = [F.when(F.col(c).isNotNull(), F.struct(F.col(c))) for c in columns]
    heavy = heavy_bins(df.select(*columns).filter(" OR ".join(f"{c} IS NOT NULL" for c in columns)), keyed, bins, total / pieces)
    heavy = heavy.collect()  # < len(columns) * pieces rows, NULL's bin among them
    rows: dict[str, int] = {}
    for i, c in enumerate(columns):
        found = [r["__bin"] for r in heavy if r["__column"] == i]
        if not found:
            continue
        inside = df.select(F.col(c).alias("key")).filter("key IS NOT NULL")
        inside = inside.filter(F.pmod(F.xxhash64(F.struct("key")), F.lit(bins)).isin(found))
        counted = inside.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > F.lit(total / pieces))
        for r in counted.collect():  # < pieces rows: kept as values, so that no later plan counts them again
            rows[r["key"]] = max(rows.get(r["key"], 1), math.ceil(r["n"] / even))
    return df.sparkSession.createDataFrame(list(rows.items()), "key string, copies int")


def with_copy(df: DataFrame, key: str, hot: DataFrame, spread: Sequence[str], out: str = "copy") -> DataFrame:
    """``out``: 0, or for rows of a hot ``key`` a number below its copies, dealt by a hash of ``spread``."""
    marked = df.join(F.broadcast(hot.withColumnRenamed("key", "__hot")), F.col(key) == F.col("__hot"), "left")
    dealt = F.pmod(F.xxhash64(*spread, F.lit(7)), F.col("copies")).cast("int")
    return marked.withColumn(out, F.coalesce(dealt, F.lit(0))).drop("__hot", "copies")


def with_copies(df: DataFrame, key: str, hot: DataFrame, out: str = "copy") -> DataFrame:
    """Every row of a hot ``key`` once per copy, other rows once with ``out`` 0."""
    marked = df.join(F.broadcast(hot.withColumnRenamed("key", "__hot")), F.col(key) == F.col("__hot"), "left")
    numbers = F.sequence(F.lit(0), F.coalesce(F.col("copies"), F.lit(1)) - 1)
    return marked.withColumn(out, F.explode(numbers)).drop("__hot", "copies")


def heavy_split_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str],
                     spread: Sequence[str], how: str = "inner", pieces: int | None = None) -> DataFrame:
    """Equi-join whose hot left keys (by the first key column) are dealt over copies of their right rows.

    The same rows as the plain join (``how`` inner or left), in tasks of even size whatever the keys. NULL keys
    of a left join are dealt by the hash of ``spread`` too.
    """
    n = pieces or PIECES * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(left, [left_keys[0]], n)
    if hot.isEmpty():
        if how == "left":
            return left_join_null_safe(left, right, left_keys, right_keys, spread_by=spread[0])
        return left.join(right, [left[a] == right[b] for a, b in zip(left_keys, right_keys, strict=True)], how)
    l = with_copy(left, left_keys[0], hot, spread, "__copy_l")
    r = with_copies(right, right_keys[0], hot, "__copy_r")
    if how == "left":
        joined = left_join_null_safe(l, r, [*left_keys, "__copy_l"], [*right_keys, "__copy_r"], spread_by=spread[0])
    else:
        on = [l[a] == r[b] for a, b in zip([*left_keys, "__copy_l"], [*right_keys, "__copy_r"], strict=True)]
        joined = l.join(r, on, how)
    return joined.drop("__copy_l", "__copy_r")


@dataclass(frozen=True)
class CostLayout:
    """The stored tables; ``headers`` holds one row per header, shipment row and copy."""

    headers: DataFrame
    charges: DataFrame
    lines: DataFrame


def _headers(tables: Mapping[str, DataFrame]) -> DataFrame:
    ship = tables["jobshipment"].select("js_pk", day("js_systemcreatetimeutc").alias("ship_day"))
    jh = tables["jobheader"].select("jh_pk", "jh_gc", "jh_gb", "jh_parentid").filter("jh_pk IS NOT NULL")
    return jh.join(ship, jh["jh_parentid"] == ship["js_pk"]).drop("jh_parentid")


def _lines(tables: Mapping[str, DataFrame]) -> DataFrame:
    lines = tables["acctransactionlines"].filter("al_pk IS NOT NULL")
    header = tables["acctransactionheader"].select(
        "ah_pk", "ah_gc", F.col("ah_postdate").alias("post"), F.col("ah_rx_nktransactioncurrency").alias("txn_cur"),
        day("ah_invoicedate").alias("inv"))
    joined = heavy_split_join(lines, header, ["al_ah", "al_gc"], ["ah_pk", "ah_gc"], ["al_pk"], "left")
    return joined.select("al_pk", "al_gc", "al_linetype", "al_ac", "al_osamount", "post", "txn_cur", "inv")


def cost_layout(tables: Mapping[str, DataFrame], root: str, buckets: int) -> CostLayout:
    """Build the layout under ``root``, or open what a completed earlier build left there."""
    spark = tables["jobcharge"].sparkSession
    names = {"headers": HEADER_KEYS, "charges": CHARGE_KEYS, "lines": LINE_KEYS}
    at = {n: f"{root}/cost-layout-{buckets}/{n}" for n in names}
    pieces = PIECES * buckets
    found: dict[str, DataFrame] = {}

    def hot() -> tuple[DataFrame, DataFrame]:
        if "of_headers" not in found:
            found["of_headers"] = hot_keys(tables["jobcharge"], ["jr_jh"], pieces)
            found["of_lines"] = hot_keys(tables["jobcharge"], ["jr_al_apline", "jr_al_arline"], pieces)
        return found["of_headers"], found["of_lines"]

    def charges() -> DataFrame:
        of_headers, of_lines = hot()
        own: list[str | Column] = ["jr_al_apline", "jr_al_arline", "jr_localcostamt", F.monotonically_increasing_id().cast("string")]
        out = tables["jobcharge"].filter("jr_jh IS NOT NULL").withColumn("__row", F.concat_ws("/", *own))
        out = with_copy(out, "jr_jh", of_headers, ["__row"])
        out = with_copy(out, "jr_al_apline", of_lines, ["__row"], "ap_copy")
        return with_copy(out, "jr_al_arline", of_lines, ["__row"], "ar_copy").drop("__row")

    build = {"headers": lambda: with_copies(_headers(tables), "jh_pk", hot()[0]), "charges": charges,
             "lines": lambda: with_copies(_lines(tables), "al_pk", hot()[1])}
    stored = {}
    for name, keys in names.items():
        if exists(spark, at[name]):
            stored[name] = open_buckets(spark, at[name], spark.read.parquet(at[name]).schema, keys, buckets)
        else:
            stored[name] = write_buckets(build[name](), at[name], keys, buckets)
    return CostLayout(**stored)
