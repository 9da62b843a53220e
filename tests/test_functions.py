"""Column expressions on hand-made rows (every branch, NULLs included)."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from cargofeed.functions import (actual_weight_cw, actual_weight_wt, carrier_cost_wt, case_max,
                                 chargeable_weight_cw, chargeable_weight_wt, converted_cost,
                                 feed_date, null_if_sentinel, to_kg, to_m3, valid_mawb)


def _one(spark, schema, data, expr):
    df = spark.createDataFrame(data, schema)
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def test_case_max_is_not_greatest(spark):
    out = _one(spark, "a decimal(10,2), b decimal(10,2)",
               [(D("2"), D("1")), (D("1"), D("2")), (None, D("3")), (D("4"), None)],
               case_max("a", "b"))
    # NULL on either side yields b (greatest would skip the NULL)
    assert out == [D("2"), D("2"), D("3"), None]


def test_unit_normalisation(spark):
    data = [(D("10"), "KG", D("2"), "CF"), (D("10"), "LB", D("2"), "M3"),
            (D("10"), "G", D("2"), None), (D("10"), None, None, "CF")]
    df = spark.createDataFrame(data, "w decimal(19,4), u string, v decimal(19,4), vu string")
    got = df.select(to_kg("w", "u").alias("kg"), to_m3("v", "vu").alias("m3")).collect()
    assert [r.kg for r in got] == [D("10"), D("4.53592"), None, None]
    assert [r.m3 for r in got] == [D("0.0566336"), D("2"), D("2"), None]


def test_cw_weights_round_half_up_per_row(spark):
    data = [(D("1.0050"), D("0.5000"), "KG"),     # actual 1.005 -> 1.01
            (D("10"), D("12"), "KG"),              # chargeable above actual
            (D("10"), D("5"), "LB"),               # chargeable below actual -> actual in kg
            (D("10"), None, "KG"),                 # NULL chargeable stays NULL
            (D("10"), D("12"), "G")]               # unknown unit -> NULL
    df = spark.createDataFrame(data, "a decimal(19,4), c decimal(19,4), u string")
    got = df.select(actual_weight_cw("a", "u").alias("a"),
                    chargeable_weight_cw("c", "a", "u").alias("c")).collect()
    assert [r.a for r in got] == [D("1.01"), D("10.00"), D("4.54"), D("10.00"), None]
    assert [r.c for r in got] == [D("1.01"), D("12.00"), D("4.54"), None, None]


def test_wt_chargeable_weight_branches(spark):
    schema = ("c decimal(19,4), u string, act decimal(19,4), lbs decimal(19,4), "
              "kgs decimal(19,4), dlbs decimal(19,4), dkgs decimal(19,4)")
    data = [
        (D("50"), "L", D("10"), D("30"), D("14"), D("40"), D("18")),    # c > 0 -> c
        (D("0"), "L", D("10"), D("30"), D("14"), D("40"), D("18")),     # c = 0, pounds -> max(lbs, dim)
        (D("-5"), "K", D("10"), D("30"), D("14"), D("40"), D("18")),    # c < 0, other unit -> max(kgs, dim)
        (None, "K", D("10"), D("30"), D("14"), D("40"), D("18")),       # c NULL -> pounds whatever the unit
        (D("0"), "K", D("10"), D("30"), None, D("40"), D("18")),        # casemax with NULL side -> dim kgs
        (D("5"), "L", D("10"), D("30"), D("14"), D("40"), D("18")),     # below actual -> actual
        (None, None, None, None, None, None, None),                      # everything NULL
    ]
    got = _one(spark, schema, data, chargeable_weight_wt("c", "u", "act", "lbs", "kgs", "dlbs", "dkgs"))
    assert got == [D("50"), D("40"), D("18"), D("40"), D("18"), D("10"), None]


def test_wt_actual_weight_and_cost_fallbacks(spark):
    data = [(None, D("7"), D("5"), D("9")), (D("3"), D("7"), D("0"), D("9")),
            (D("3"), None, None, D("9")), (D("3"), None, D("-1"), None)]
    df = spark.createDataFrame(data, "a decimal(10,2), lbs decimal(10,2), dt decimal(10,2), ct decimal(10,2)")
    got = df.select(actual_weight_wt("a", "lbs").alias("a"), carrier_cost_wt("dt", "ct").alias("t")).collect()
    assert [r.a for r in got] == [D("7"), D("3"), D("3"), D("3")]
    assert [r.t for r in got] == [D("5"), D("9"), D("9"), None]


def test_valid_mawb_rules(spark):
    values = ["12345678901", "1234567890", "123456789012", "1234567890A", "12345678901\n", None]
    df = spark.createDataFrame([(v,) for v in values], "m string")
    got = df.select(valid_mawb("m", "wt").alias("wt"), valid_mawb("m", "cw").alias("cw")).collect()
    assert [r.wt for r in got] == [True, False, False, False, False, None]
    assert [r.cw for r in got] == [True, False, True, True, True, None]


def test_converted_cost_branches(spark):
    schema = ("cur string, amt decimal(19,4), post timestamp_ntz, os decimal(19,4), "
              "pre decimal(18,9), postr decimal(18,9)")
    t = dt.datetime(2001, 1, 1)
    data = [("USD", D("100"), None, D("-80"), None, None),        # reporting currency: as is
            ("EUR", D("100"), None, D("-80"), D("1.25"), None),    # not posted: / PRE rate
            ("EUR", D("100"), None, D("-80"), None, D("2")),       # not posted, no PRE rate: NULL
            ("EUR", D("100"), t, D("-80"), None, D("1.6")),        # posted: -os / POST rate
            ("EUR", D("100"), t, D("-80"), D("4"), None)]          # posted, no POST rate: / 1
    got = _one(spark, schema, data, converted_cost("cur", "amt", "post", "os", "pre", "postr"))
    assert [None if g is None else float(g) for g in got] == [100.0, 80.0, None, 50.0, 80.0]


def test_sentinel_and_feed_date(spark):
    data = [(dt.datetime(1900, 1, 1, 10, 30),), (dt.datetime(2001, 5, 6, 7, 8),), (None,)]
    df = spark.createDataFrame(data, "ts timestamp_ntz")
    got = df.select(null_if_sentinel("ts").alias("t"), feed_date(F.to_date("ts")).alias("d")).collect()
    assert [r.t for r in got] == [None, dt.datetime(2001, 5, 6, 7, 8), None]
    assert [r.d for r in got] == ["1900-01-01", "2001-05-06", None]
