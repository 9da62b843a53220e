"""Incremental costs of MAWBs (M16, W9-W12): stored partial sums with retractions.

The costs of a MAWB sum over its shipments, each counted once per link and AIR
leg. Three stored logs hold what a run needs of the past, as sums that only ever
grow by appended rows:

* ``shipments`` ``(js_pk, <category>_sum, <category>_n, n_rows)``: cost and number of
  converted charge lines of a shipment, and of all its costed lines,
* ``links`` ``(jn_js, mawb, mult)``: how often a shipment counts for a MAWB,
* ``mawbs`` ``(mawb, <category>_sum, <category>_n, n_rows)``: the costs, with the number of
  shipments that give one, and of all that have costed lines.

A run gets the changed rows of the source tables, the old image of each with
``op`` '-' and the new one with '+', and the tables as they are now. It walks
from the changed rows' keys to the shipments they touch, through the
tables and the old images (a late charge, a corrected rate, a moved link, a line
that changed its header), recomputes those shipments alone, and appends new minus
old. All sums are exact decimals, so retractions leave no residue and the state
equals a rebuild. Logs are compacted into one folder after ``COMPACT_AFTER`` runs.
Each run is published by a version file (``sinks.publish``): a run killed half-way
changes nothing, and repeating it does not count twice.

Changes of companies, charge codes and branches can touch every charge; such a run raises
:class:`NeedsRebuild`, and :func:`rebuild` starts the state anew.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import day
from ..operators.consol import shipment_mawb_multiplicity
from ..operators.cost_layout import CostLayout
from ..operators.costs import COST_CATEGORIES, COST_ROW, COST_SUM, MULTIPLICITY, charge_costs
from ..operators.flights import air_legs_per_consol
from ..operators.joins import cut_to_keys
from ..operators.stage import stage
from ..session import shuffles_dropped
from ..sinks.publish import current, drop_old, new_folder, publish

COMPACT_AFTER = 30
LOGS = ("shipments", "links", "mawbs")
REBUILD_TABLES = ("glbcompany", "accchargecode", "glbbranch")
CATEGORIES = tuple(COST_CATEGORIES)


class NeedsRebuild(RuntimeError):
    """A change that no set of shipments bounds; call :func:`rebuild`."""


@dataclass(frozen=True)
class RunInfo:
    """What one run read and wrote: touched shipments, and rows appended to each log."""

    version: int
    touched: int
    appended: dict[str, int]


MEASURES = [*[f"{c}{end}" for c in CATEGORIES for end in ("_sum", "_n")], "n_rows"]


def shipment_sums(charges: DataFrame) -> DataFrame:
    """``(js_pk, <category>_sum, <category>_n, n_rows)`` of :func:`charge_costs` rows."""
    out = []
    for c, codes in COST_CATEGORIES.items():
        value = F.when(F.col("ac_code").isin(list(codes)), F.col("cost"))
        out += [F.coalesce(F.sum(value), F.lit(0)).cast(COST_ROW).cast(COST_SUM).alias(f"{c}_sum"), F.count(value).alias(f"{c}_n")]
    return charges.groupBy("js_pk").agg(*out, F.count(F.lit(1)).alias("n_rows"))


def _multiplicity(tables: Mapping[str, DataFrame], shipments: DataFrame | None) -> DataFrame:
    """``(jn_js, mawb, mult)`` of all shipments, or of a written set of them."""
    link, consol, legs = (tables[n] for n in ("jobconshiplink", "jobconsol", "jobconsoltransport"))
    link = link.select("jn_js", "jn_jk")
    if shipments is not None:
        link = stage(cut_to_keys(link, shipments, ["jn_js"], ["js_pk"]), "state_links")
        consol = cut_to_keys(consol, link, ["jk_pk"], ["jn_jk"])
        legs = cut_to_keys(legs, link, ["jw_parentguid"], ["jn_jk"])
    out = shipment_mawb_multiplicity(link, consol, air_legs_per_consol(legs))
    return out.select("jn_js", "mawb", F.col("mult").cast("decimal(38,0)").alias("mult"))


def contributions(costs: DataFrame, mult: DataFrame) -> DataFrame:
    """``(mawb, <category>_sum, <category>_n, n_rows)`` that shipments give to MAWBs."""
    costed = costs.filter("n_rows > 0")
    j = costed.join(mult, costed["js_pk"] == mult["jn_js"])
    out = []
    for c in CATEGORIES:
        some = F.col(f"{c}_n") > 0
        part = F.col(f"{c}_sum").cast(COST_ROW) * F.col("mult").cast(MULTIPLICITY)
        out += [F.sum(F.when(some, part).otherwise(F.lit(0))).cast(COST_SUM).alias(f"{c}_sum"),
                F.sum(F.when(some, F.lit(1)).otherwise(F.lit(0))).alias(f"{c}_n")]
    return j.groupBy("mawb").agg(*out, F.count(F.lit(1)).alias("n_rows"))


def _summed(log: str, rows: DataFrame) -> DataFrame:
    """A log's rows added up per key; keys whose sums are all zero are gone."""
    if log == "links":
        return rows.groupBy("jn_js", "mawb").agg(F.sum("mult").cast("decimal(38,0)").alias("mult")).filter("mult <> 0")
    key = "js_pk" if log == "shipments" else "mawb"
    sums = [F.sum(m).cast(COST_SUM if m.endswith("_sum") else "long").alias(m) for m in MEASURES]
    return rows.groupBy(key).agg(*sums).filter(" OR ".join(f"{m} <> 0" for m in MEASURES))


def _negated(rows: DataFrame) -> DataFrame:
    types = dict(rows.dtypes)
    return rows.select(*[(-F.col(c)).cast(types[c]).alias(c) if c in ("mult", *MEASURES) else F.col(c) for c in rows.columns])


class CostState:
    """The stored state under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def log(self, name: str, keys: DataFrame | None = None) -> DataFrame:
        """A log added up, for all keys or those of a written key set (one column, named as the log's key)."""
        content = current(self.spark, self.root)
        if content is None:
            raise ValueError(f"no cost state under {self.root}; call rebuild first")
        rows = self.spark.read.parquet(*[f"{f}/{name}" for f in content["folders"]])
        if keys is not None:
            key = keys.columns[0]
            rows = cut_to_keys(rows, keys, [rows.columns[0]], [key])
        return _summed(name, rows)

    def costs(self, mawbs: DataFrame | None = None) -> DataFrame:
        """``(mawb, <category>...)`` as ``costs_by_mawb`` gives it, from the stored sums."""
        rows = self.log("mawbs", mawbs).filter("n_rows > 0")
        return rows.select("mawb", *[F.when(F.col(f"{c}_n") > 0, F.col(f"{c}_sum")).alias(c) for c in CATEGORIES])

    def _write(self, folder: str, parts: Mapping[str, DataFrame]) -> dict[str, int]:
        for name, df in parts.items():
            with shuffles_dropped(self.spark):
                df.write.parquet(f"{folder}/{name}")
        return {name: self.spark.read.parquet(f"{folder}/{name}").count() for name in parts}

    def rebuild(self, tables: Mapping[str, DataFrame], layout: CostLayout | None = None, runs: tuple[str, ...] = ()) -> RunInfo:
        """The state of all history, as version one or in place of what is there."""
        charges = charge_costs(tables, None if layout else tables["jobshipment"], layout=layout)
        ships = stage(shipment_sums(charges), "state_shipments")
        mult = stage(_multiplicity(tables, None), "state_mult")
        folder = new_folder(self.root)
        n = self._write(folder, {"shipments": ships, "links": mult, "mawbs": contributions(ships, mult)})
        return RunInfo(publish(self.spark, self.root, {"folders": [folder], "runs": list(runs)}), ships.count(), n)

    def apply(self, tables: Mapping[str, DataFrame], changes: Mapping[str, DataFrame], run: str) -> RunInfo:
        """Add the changes of one run, named ``run``; a run that is part of the state already changes nothing."""
        content = current(self.spark, self.root)
        if content is None:
            raise ValueError(f"no cost state under {self.root}; call rebuild first")
        if run in content["runs"]:
            return RunInfo(0, 0, {})
        touched = stage(touched_shipments(tables, changes), "state_touched")
        old_cost, old_mult = stage(self.log("shipments", touched), "state_old_cost"), stage(self.log("links", touched), "state_old_mult")
        ship = stage(cut_to_keys(tables["jobshipment"], touched, ["js_pk"], ["js_pk"]), "state_ship")
        new_cost = stage(shipment_sums(charge_costs(tables, ship, reduce_history=True)), "state_new_cost")
        new_mult = stage(_multiplicity(tables, touched), "state_new_mult")
        parts = {"shipments": (new_cost, old_cost), "links": (new_mult, old_mult),
                 "mawbs": (contributions(new_cost, new_mult), contributions(old_cost, old_mult))}
        folder = new_folder(self.root)
        n = self._write(folder, {name: _summed(name, new.unionByName(_negated(old))) for name, (new, old) in parts.items()})
        folders = [*content["folders"], folder]
        if len(folders) > COMPACT_AFTER:
            folders = [self._compacted(folders)]
        number = publish(self.spark, self.root, {"folders": folders, "runs": [*content["runs"], run]})
        return RunInfo(number, touched.count(), n)

    def _compacted(self, folders: list[str]) -> str:
        out = new_folder(self.root)
        for name in LOGS:
            _summed(name, self.spark.read.parquet(*[f"{f}/{name}" for f in folders])).write.parquet(f"{out}/{name}")
        return out

    def clean(self) -> None:
        """Delete folders that the newest version does not name (no reader may still use an older one)."""
        content = current(self.spark, self.root)
        if content:
            drop_old(self.spark, self.root, set(content["folders"]), keep=1)


def touched_shipments(tables: Mapping[str, DataFrame], changes: Mapping[str, DataFrame]) -> DataFrame:
    """``(js_pk)`` of every shipment whose costs or links the changed rows can have changed.

    Each level looks its keys up in the table as it is and in the old images, so a row
    that changed its parent touches the old and the new one.
    """
    for name in REBUILD_TABLES:
        if name in changes and not changes[name].isEmpty():
            raise NeedsRebuild(f"{name} changed")

    def images(name: str) -> DataFrame | None:
        return changes[name].drop("op") if name in changes else None

    def ever(name: str, cols: list[str]) -> DataFrame:
        now = tables[name].select(cols)
        return now.unionByName(changes[name].filter("op = '-'").select(cols)) if name in changes else now

    def both(a: DataFrame | None, b: DataFrame | None) -> DataFrame | None:
        if a is None or b is None:
            return a if b is None else b
        return a.unionByName(b)

    def keyed(df: DataFrame | None, *cols: str) -> DataFrame | None:
        return None if df is None else df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(cols)])

    def up(name: str, on: list[str], keys: DataFrame | None, *out: str) -> DataFrame | None:
        """Rows of a level whose ``on`` columns are among the keys, as keys of the next level."""
        if keys is None:
            return None
        cols = list(dict.fromkeys([*on, *out]))
        rows = cut_to_keys(ever(name, cols), stage(keys.distinct(), f"keys_{name}"), on, list(keys.columns))
        return keyed(rows, *out)

    found = keyed(images("jobshipment"), "js_pk")
    headers = keyed(images("acctransactionheader"), "ah_pk", "ah_gc")
    rates = images("refexchangerate")
    if rates is not None:  # a rate counts for shipments created, and invoices dated, on its day
        days = stage(rates.select(day("re_startdate").alias("k0")).distinct(), "keys_rates")

        def on_day(name: str, ts: str, *out: str) -> DataFrame:
            rows = ever(name, [*out, ts]).withColumn("__day", day(ts))
            return keyed(cut_to_keys(rows, days, ["__day"], ["k0"]), *out)
        found = both(found, on_day("jobshipment", "js_systemcreatetimeutc", "js_pk"))
        headers = both(headers, on_day("acctransactionheader", "ah_invoicedate", "ah_pk", "ah_gc"))
    lines = both(keyed(images("acctransactionlines"), "al_pk", "al_gc"), up("acctransactionlines", ["al_ah", "al_gc"], headers, "al_pk", "al_gc"))
    charges = keyed(images("jobcharge"), "jr_jh", "jr_gc")
    if lines is not None:
        lines = stage(lines.distinct(), "keys_lines")
        for role in ("jr_al_apline", "jr_al_arline"):
            charges = both(charges, up("jobcharge", [role, "jr_gc"], lines, "jr_jh", "jr_gc"))
    found = both(found, keyed(images("jobheader"), "jh_parentid"))
    found = both(found, up("jobheader", ["jh_pk", "jh_gc"], charges, "jh_parentid"))
    consols = both(keyed(images("jobconsol"), "jk_pk"), keyed(images("jobconsoltransport"), "jw_parentguid"))
    found = both(found, keyed(images("jobconshiplink"), "jn_js"))
    found = both(found, up("jobconshiplink", ["jn_jk"], consols, "jn_js"))
    if found is None:
        return tables["jobshipment"].select("js_pk").limit(0)
    return found.select(F.col("k0").alias("js_pk")).filter("js_pk IS NOT NULL").distinct()


def rebuild(spark: SparkSession, root: str, tables: Mapping[str, DataFrame], layout: CostLayout | None = None) -> CostState:
    """A new state of all history under ``root``."""
    state = CostState(spark, root)
    state.rebuild(tables, layout)
    return state
