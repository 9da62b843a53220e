"""AIR legs of consolidations: leg counts, flight lists (M10), earliest departure."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import SENTINEL_DATE, null_if_sentinel
from ..functions.validity import is_code

# Fixed value that must equal the source job's: the transport mode kept.
AIR = "AIR"
FLIGHT_SEPARATOR = ";"
# Characters of a flight that name its part of a long list.
PART_CHARS = 4
# Occurrences of a flight in one piece of text, and pieces that one task joins.
RUN_PIECE = 4096
RUN_PART = 64


def air_legs(transport: DataFrame) -> DataFrame:
    """Transport legs flown by air."""
    return transport.filter(is_code("jw_transportmode", AIR))


def air_leg_base(transport: DataFrame) -> DataFrame:
    """``(jw_parentguid, flt, n_leg, first_atd)``: AIR legs counted per
    consolidation and trimmed flight, with their earliest known departure.

    Leg counts, flight lists and departures all come from these rows, so one
    scan of the transport table serves all three.
    """
    return (air_legs(transport)
            .groupBy("jw_parentguid", F.trim("jw_voyageflight").alias("flt"))
            .agg(F.count(F.lit(1)).alias("n_leg"),
                 F.min(null_if_sentinel("jw_atd")).alias("first_atd")))


def air_legs_per_consol(transport: DataFrame) -> DataFrame:
    """``(jw_parentguid, n_air)``: number of AIR legs of each consolidation.

    Joining consolidations to this count instead of to the legs themselves
    keeps the leg fan-out of the feeds (weights and costs repeat once per AIR
    leg) without materialising the product of legs and shipments.
    """
    return (air_legs(transport).groupBy("jw_parentguid")
            .agg(F.count(F.lit(1)).cast("int").alias("n_air")))


def flight_list(legs: DataFrame, key: str, flight: str, sep: str = FLIGHT_SEPARATOR,
                count: str | None = None, out: str = "flight_number") -> DataFrame:
    """``(key, out)``: trimmed flight numbers of each key joined by ``sep``.

    Duplicates are kept (a flight appears once per leg occurrence, or
    ``count`` times when the input carries a multiplicity column); NULL
    flights are skipped, empty ones kept; the list is ordered by flight text.
    A key whose flights are all NULL gets a NULL list.

    Plan: occurrences are first counted per (key, flight) with map-side
    partial aggregation, so the list aggregates see one row per distinct
    flight of a key, however many legs and shipments repeat it. A count is a run,
    cut into pieces of ``RUN_PIECE`` occurrences while it is still a pair of numbers; pieces are
    dealt over tasks by their place in the run and only there become text. Places, flights and
    first characters of flights all follow the list's order, so joining the texts of a part, then of a
    head, then of the key, each in order, gives the list: a key that holds a large
    share of all flights (blank or NULL MAWBs), or a flight that occurs millions of times, is
    built by many tasks, and only its finished parts meet.
    """
    trimmed = F.trim(F.col(flight))
    n: Column = F.col(count) if count else F.lit(1)
    per_flight = (legs.select(F.col(key), trimmed.alias("__flt"), n.alias("__n"))
                  .groupBy(key, "__flt").agg(F.sum("__n").cast("long").alias("__n")))
    last = F.floor((F.col("__n") - 1) / F.lit(RUN_PIECE)).cast("long")
    # NULL flights keep their key (the list is then NULL) but add no piece
    places = F.when(F.col("__flt").isNotNull(), F.sequence(F.lit(0).cast("long"), F.greatest(last, F.lit(0).cast("long")))).otherwise(
        F.array(F.lit(0).cast("long")))
    runs = per_flight.select(key, "__flt", "__n", F.explode(places).alias("__place"))
    runs = runs.withColumn("__part", F.floor(F.col("__place") / F.lit(RUN_PART))).repartition(key, "__flt", "__part")
    times = F.least(F.lit(RUN_PIECE).cast("long"), F.col("__n") - F.col("__place") * RUN_PIECE).cast("int")
    piece = F.when(F.col("__flt").isNotNull(), F.concat(F.repeat(F.concat(F.col("__flt"), F.lit(sep)), times - 1), F.col("__flt")))

    def joined(df: DataFrame, by: list[str], text: str, order: str, to: str) -> DataFrame:
        return df.groupBy(*by).agg(F.expr(f"listagg({text}, '{sep}') WITHIN GROUP (ORDER BY {order})").alias(to))
    parts = joined(runs.withColumn("__piece", piece), [key, "__flt", "__part"], "__piece", "__place", "__text")
    parts = parts.withColumn("__head", F.substring("__flt", 1, PART_CHARS)).withColumn(
        "__at", F.struct("__flt", "__part"))
    heads = joined(parts, [key, "__head"], "__text", "__at", "__text")
    return joined(heads, [key], "__text", "__head", out)


def earliest_departure(legs: DataFrame, key: str, ts: str,
                       sentinel: dt.date = SENTINEL_DATE, out: str = "atd") -> DataFrame:
    """``(key, out)``: the earliest departure of each key, where a departure
    on the ``sentinel`` day counts as unknown (NULL). Keys with no known
    departure get NULL."""
    return legs.groupBy(key).agg(F.min(null_if_sentinel(ts, sentinel)).alias(out))
