"""DataFrame operators on hand-made rows (FIXTURES §3 cases)."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cargofeed.operators import (broadcast_all_if_bounded, consol_weights, earliest_departure,
                                 first_by_time, flight_list, latest_by_sequence,
                                 left_join_null_safe, load_window, rollup_per_key_and_unit)
from cargofeed.params import LoadWindow
from cargofeed.sources.schemas import CW_SCHEMAS

from conftest import rows


@pytest.mark.parametrize("strategy", ["max_join", "window"])
def test_latest_by_sequence(spark, strategy):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"),                 # one max
         ("b", 3, "p"), ("b", 3, "q"), ("b", 1, "r"),  # tied max: both kept
         ("c", None, "s"),                             # NULL seq only: nothing
         (None, 9, "t")],                              # NULL key: dropped
        "k string, s int, v string")
    out = latest_by_sequence(df, "k", "s", strategy=strategy)
    assert rows(out, "k", "s", "v") == [("a", 2, "y"), ("b", 3, "p"), ("b", 3, "q")]


@pytest.mark.parametrize("strategy", ["max_join", "window"])
def test_latest_by_sequence_keep_filters_after_the_max(spark, strategy):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 1), ("b", 5, 10)], "k string, s int, day int")
    # the latest row of 'a' is outside the window: 'a' yields nothing, not its older row
    out = latest_by_sequence(df, "k", "s", keep=F.col("day") >= 5, strategy=strategy)
    assert rows(out, "k", "s") == [("b", 5)]


def test_first_by_time(spark):
    t1, t2 = dt.datetime(2001, 1, 1), dt.datetime(2001, 1, 2)
    df = spark.createDataFrame(
        [("h1", "p1", "3", t1),                                     # single
         ("h2", "p2", "1", t2), ("h3", "p2", "9", t1),             # two times: earliest wins
         ("h4", "p3", "2", t1), ("h5", "p3", "1", t1),             # tie on time: lowest company
         ("h6", "p4", None, t1), ("h7", "p4", "5", t1),            # NULL company sorts last
         ("h8", "p5", "1", None),                                   # NULL time: dropped
         ("h9", None, "1", t1)],                                    # NULL parent: dropped
        "pk string, parent string, gc string, t timestamp_ntz")
    out = first_by_time(df, "parent", "t", ["gc", "pk"])
    assert rows(out, "parent", "pk") == [("p1", "h1"), ("p2", "h3"), ("p3", "h5"), ("p4", "h7")]


def test_rollup_per_key_and_unit(spark):
    df = spark.createDataFrame(
        [("w1", D("1"), "L"), ("w1", D("2"), "K"), ("w1", D("4"), "L"),   # two units, same totals
         ("w1", D("100"), ""), ("w1", D("100"), None),                     # excluded from all
         ("w2", D("5"), "K"), ("w3", D("7"), "")],
        "k string, v decimal(19,4), u string")
    out = rollup_per_key_and_unit(df, "k", {"total": "v"}, "u")
    assert rows(out, "k", "total", "u") == [("w1", D("7"), "K"), ("w1", D("7"), "L"), ("w2", D("5"), "K")]


def test_flight_list(spark):
    legs = spark.createDataFrame(
        [("m1", " FL2 "), ("m1", "FL1"), ("m1", "FL2"), ("m1", None),   # trimmed, sorted, dups kept
         ("m2", None),                                                  # only NULL -> NULL list
         ("m3", ""), ("m3", "")],                                       # empty strings kept
        "m string, f string")
    out = flight_list(legs, "m", "f")
    assert rows(out, "m", "flight_number") == [("m1", "FL1;FL2;FL2"), ("m2", None), ("m3", ";")]


def test_flight_list_of_long_runs(spark, monkeypatch):
    from cargofeed.operators import flights
    monkeypatch.setattr(flights, "RUN_PIECE", 10)
    monkeypatch.setattr(flights, "RUN_PART", 3)
    data = [("m1", "AA1", 95), ("m1", "AA10", 1), ("m1", "AA2", 31), ("m1", " AB", 10), ("m1", None, 40), ("m2", "", 12), (None, "Z", 11)]
    out = flight_list(spark.createDataFrame(data, "m string, f string, n long"), "m", "f", count="n")
    want = ";".join(["AA1"] * 95 + ["AA10"] + ["AA2"] * 31 + ["AB"] * 10)
    assert rows(out, "m", "flight_number") == sorted([("m1", want), ("m2", ";" * 11), (None, ";".join("Z" * 11))],
                                                     key=lambda t: tuple((x is None, str(x)) for x in t))
    many = flight_list(spark.createDataFrame([("m", "F", 10_000)], "m string, f string, n long"), "m", "f", count="n")
    # the run is text only beyond the exchange that deals its pieces
    p = many._jdf.queryExecution().executedPlan().toString()
    assert p.index("repeat(") < p.index("REPARTITION_BY_COL")  # the plan is printed from the result down
    assert many.first()["flight_number"] == ";".join(["F"] * 10_000)


def test_earliest_departure(spark):
    s = dt.datetime(1900, 1, 1, 12, 0)
    real = dt.datetime(2001, 3, 4)
    legs = spark.createDataFrame(
        [("m1", s), ("m2", s), ("m2", real), ("m3", None), ("m3", s)], "m string, atd timestamp_ntz")
    out = earliest_departure(legs, "m", "atd")
    assert rows(out, "m", "atd") == [("m1", None), ("m2", real), ("m3", None)]


def test_load_window(spark):
    as_of = dt.date(2001, 8, 1)
    days = [dt.datetime(2001, 6, 16, 23), dt.datetime(2001, 6, 17), dt.datetime(2001, 6, 18), None]
    df = spark.createDataFrame([(d,) for d in days], "ts timestamp_ntz")
    inc = load_window(df, "ts", LoadWindow(as_of, False, dt.date(2019, 1, 1)))
    assert rows(inc) == [(dt.datetime(2001, 6, 17),), (dt.datetime(2001, 6, 18),)]
    full = load_window(df, "ts", LoadWindow(as_of, True, dt.date(2001, 6, 18)))
    assert rows(full) == [(dt.datetime(2001, 6, 18),)]


def test_left_join_null_safe_equals_left_join(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), (None, 3), ("z", 4)], "k string, v int")
    right = spark.createDataFrame([("a", 10), ("a", 11), (None, 12)], "rk string, w int")
    out = left_join_null_safe(left, right, ["k"], ["rk"])
    plain = left.join(right, left["k"] == right["rk"], "left")
    assert out.columns == plain.columns
    assert rows(out) == rows(plain)


def test_broadcast_all_if_bounded(spark):
    small = spark.range(5)
    big = spark.range(50)
    a, b = broadcast_all_if_bounded([small, big], max_rows=10)
    plan_a = a.join(spark.range(100), "id")._jdf.queryExecution().optimizedPlan().toString()
    plan_b = b.join(spark.range(100), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "BROADCAST" in plan_a.upper()
    assert "BROADCAST" not in plan_b.upper()


def _cw_tables(spark, **overrides):
    t0 = dt.datetime(2001, 7, 20)
    data = {
        "jobshipment": [("s1", "KG", D("100"), D("120"), "M3", D("2"), t0),
                        ("s2", "LB", D("100"), D("10"), "CF", D("100"), t0),
                        ("s3", "KG", D("50"), None, "M3", D("1"), t0),
                        ("s4", "KG", D("70"), D("70"), "M3", D("1"), dt.datetime(2000, 1, 1))],
        "jobheader": [("h1", "s1", "0", "0", t0), ("h2", "s2", "0", "0", t0),
                      ("h3", "s3", "1", "0", t0), ("h4", "s4", "0", "0", t0)],
        "glbcompany": [("0", "USD"), ("1", "USD")],
        "jobconshiplink": [("s1", "c1"), ("s2", "c1"), ("s3", "c2"), ("s3", "c3"), ("s4", "c1")],
        "jobconsol": [("c1", "00000000001", "AAA", "BBB", 0),
                      ("c2", "00000000002", "AAA", "CCC", 1),     # cancelled
                      ("c3", "0000000003", "AAA", "CCC", 0)],      # 10-character MAWB
        "jobconsoltransport": [("c1", "AIR", "FL1", t0), ("c1", "AIR", "FL2", t0),  # two AIR legs
                               ("c1", "SEA", "SH1", t0), ("c2", "AIR", "FL3", t0),
                               ("c3", "AIR", "FL4", t0)],
    }
    data.update(overrides)
    return {n: spark.createDataFrame(v, CW_SCHEMAS[n]) for n, v in data.items()}


def test_consol_weights_leg_fan_out_and_filters(spark):
    out = consol_weights(_cw_tables(spark), LoadWindow(dt.date(2001, 8, 1), False, dt.date(2018, 1, 1)))
    got = rows(out, "mawb", "origin", "destination", "actual_weight", "chargeable_weight", "volume")
    # s1 and s2 on c1 (two AIR legs: everything counted twice); s4 outside the window;
    # c2 cancelled and c3 with a 10-character MAWB are dropped.
    # s1: 100 kg / chg 120; s2: 100 lb = 45.36 kg / chg 10 lb < actual -> 45.36
    act = (D("100.00") + D("45.36")) * 2
    chg = (D("120.00") + D("45.36")) * 2
    vol = (D("2") + D("100") * D("0.0283168")) * 2
    assert len(got) == 1
    m, o, d, a, c, v = got[0]
    assert (m, o, d, a, c) == ("00000000001", "AAA", "BBB", act, chg)
    assert v == vol


def test_charge_costs_every_fx_branch(spark):
    from cargofeed.operators import charge_costs, costs_by_shipment
    from cargofeed.operators.costs import RATE_COMPANY
    d = dt.datetime
    t = {
        "jobshipment": [("s1", "KG", D("1"), D("1"), "M3", D("1"), d(2001, 1, 10, 8)),
                        ("s2", "KG", D("1"), D("1"), "M3", D("1"), d(2001, 2, 1))],
        "jobheader": [("h0", "s1", "0", "b", d(2001, 1, 1)), ("h1", "s1", "1", "b", d(2001, 1, 1)),
                      ("h2", "s2", "0", "b", d(2001, 1, 1))],
        "glbcompany": [("0", "EUR"), ("1", "USD")],
        "jobcharge": [
            ("h1", "1", "AP1", "AR1", D("100")),   # USD company: as is -> security 100
            ("h0", "0", "AP2", "AR2", D("200")),   # not posted, two EUR rates that day -> fuel 160 + 80
            ("h2", "0", "AP3", "AR3", D("300")),   # no payable header, no rate that day -> NULL
            ("h0", "0", "AP4", "AR4", D("999")),   # posted, receivable invoice day has a rate -> 80 / 2
            ("h0", "0", "AP5", "AR5", D("999")),   # posted, receivable without header, payable
                                                   # invoice day has no rate -> 80 / 1
            ("h0", "0", "AP6", "AR6", D("999")),   # line type outside CST/ACR -> dropped
            ("h0", "0", "AP7", "AR7", D("999"))],  # unlisted charge code -> dropped
        "acctransactionlines": [
            ("AP1", "1", "HAP1", "PSEC", "CST", D("-10")), ("AP2", "0", "HAP2", "PFSC", "ACR", D("-10")),
            ("AP3", "0", "NOHDR", "PSEC", "CST", D("-10")), ("AP4", "0", "HAP4", "PFRT", "CST", D("-80")),
            ("AP5", "0", "HAP5", "PFRT", "CST", D("-80")), ("AP6", "0", "HAP6", "PFRT", "REV", D("-80")),
            ("AP7", "0", "HAP7", "PMISC", "CST", D("-80")),
            ("AR4", "0", "HAR4", "PFRT", "REV", D("80")), ("AR5", "0", "NOHDR", "PFRT", "REV", D("80"))],
        "acctransactionheader": [
            ("HAP1", "1", None, "USD", d(2001, 1, 10)), ("HAP2", "0", None, "GBP", d(2001, 1, 10)),
            ("HAP4", "0", d(2001, 3, 1), "GBP", d(2001, 3, 4)),
            ("HAP5", "0", d(2001, 3, 1), "GBP", d(2001, 3, 6)),
            ("HAP6", "0", d(2001, 3, 1), "GBP", d(2001, 3, 6)),
            ("HAP7", "0", d(2001, 3, 1), "GBP", d(2001, 3, 6)),
            ("HAR4", "0", d(2001, 3, 2), "GBP", d(2001, 3, 5, 23))],
        "accchargecode": [("PSEC", "0", "SEC"), ("PSEC", "1", "SEC"), ("PFSC", "0", "FSC"),
                          ("PFRT", "0", "FRT"), ("PMISC", "0", "MISC")],
        "glbbranch": [("b", "0"), ("b", "1")],
        "refexchangerate": [
            ("EUR", d(2001, 1, 10, 6), RATE_COMPANY, "BUY", D("1.25")),
            ("EUR", d(2001, 1, 10, 9), RATE_COMPANY, "BUY", D("2.5")),
            ("EUR", d(2001, 1, 10), RATE_COMPANY, "SELL", D("4")),       # other type: ignored
            ("EUR", d(2001, 1, 10), "OTHER", "BUY", D("4")),             # other company: ignored
            ("GBP", d(2001, 3, 5, 1), RATE_COMPANY, "BUY", D("2")),      # receivable invoice day
            ("GBP", d(2001, 3, 4), RATE_COMPANY, "BUY", D("4"))],        # payable invoice day: unused
    }
    tables = {n: spark.createDataFrame(v, CW_SCHEMAS[n]) for n, v in t.items()}
    for reduce_history in (False, True):
        charges = charge_costs(tables, tables["jobshipment"], reduce_history=reduce_history)
        got = {r.js_pk: (r.total_security_surcharge, r.total_fuel_surcharge, r.airlines_rate)
               for r in costs_by_shipment(charges).collect()}
        # The two same-day EUR rates fan out every EUR charge row of s1 through the
        # PRE join, posted ones included (source join semantics): fuel 160 + 80,
        # freight 2 x (40 + 80). The USD company has no USD rate rows: 100 once.
        assert got == {"s1": (D("100"), D("240"), D("240")), "s2": (None, None, None)}, (reduce_history, got)


def test_charge_costs_count_the_pairs_of_two_days_rates(spark):
    """A line was one row per (PRE rate, POST rate) pair, 40 x 60 here; now one per rate that converts it."""
    from cargofeed.operators import charge_costs, costs_by_shipment
    from cargofeed.operators.costs import RATE_COMPANY
    t0, t1, posted = dt.datetime(2001, 1, 10, 8), dt.datetime(2001, 3, 4), dt.datetime(2001, 3, 1)
    pre = [D("1.25")] * 20 + [D("2.5")] * 18 + [None, None]
    post = [D("2")] * 30 + [D("4")] * 29 + [None]
    t = {
        "jobshipment": [("s1", "KG", D("1"), D("1"), "M3", D("1"), t0)],
        "jobheader": [("h0", "s1", "0", "b", t0), ("h1", "s1", "1", "b", t0)],
        "glbcompany": [("0", "EUR"), ("1", "USD")],
        "jobcharge": [("h0", "0", "AP1", None, D("200")), ("h0", "0", "AP2", None, D("999")), ("h1", "1", "AP3", None, D("100"))],
        "acctransactionlines": [("AP1", "0", "H1", "PSEC", "CST", D("-10")), ("AP2", "0", "H2", "PFSC", "CST", D("-80")),
                                ("AP3", "1", "H3", "PFRT", "CST", D("-10"))],
        "acctransactionheader": [("H1", "0", None, "GBP", t1), ("H2", "0", posted, "GBP", t1), ("H3", "1", posted, "GBP", t1)],
        "accchargecode": [("PSEC", "0", "SEC"), ("PFSC", "0", "FSC"), ("PFRT", "1", "FRT")],
        "glbbranch": [("b", "0"), ("b", "0"), ("b", "1")],
        "refexchangerate": [("EUR", t0, RATE_COMPANY, "BUY", r) for r in pre] + [("GBP", t1, RATE_COMPANY, "BUY", r) for r in post],
    }
    charges = charge_costs({n: spark.createDataFrame(v, CW_SCHEMAS[n]) for n, v in t.items()},
                           spark.createDataFrame(t["jobshipment"], CW_SCHEMAS["jobshipment"]))
    assert charges.count() == 3 + 3 + 1  # different rates, the missing one too; the USD company needs none
    unposted = sum(D("200") / r for r in pre if r) * len(post) * 2  # two branches
    converted = sum(D("80") / (r or 1) for r in post) * len(pre) * 2
    got = costs_by_shipment(charges).first()
    assert (got.total_security_surcharge, got.total_fuel_surcharge, got.airlines_rate) == (unposted, converted, D("100") * len(post))


def test_first_job_headers_cut_paths_agree(spark):
    from cargofeed.operators import first_job_headers
    t1, t2 = dt.datetime(2001, 1, 1), dt.datetime(2001, 1, 2)
    jh = spark.createDataFrame(
        [("h1", "s1", "1", "b", t2), ("h2", "s1", "0", "b", t1), ("h3", "s2", "0", "b", t1),
         ("h4", "s3", "0", "b", t1)], CW_SCHEMAS["jobheader"])
    parents = spark.createDataFrame([("s1",), ("s2",)], "js_pk string")
    shuffled = first_job_headers(jh, parents)
    cut = first_job_headers(jh, parents, broadcast_cut=True)
    assert rows(shuffled, "jh_parentid", "jh_pk") == rows(cut, "jh_parentid", "jh_pk") == \
        [("s1", "h2"), ("s2", "h3")]


def test_size_check_counts(spark):
    from cargofeed.operators import has_at_most
    df = spark.range(5)
    assert has_at_most(df, 10)
    assert not has_at_most(df, 3)


def test_cut_beyond_the_broadcast_bound_is_a_shuffled_semi_join(spark):
    from cargofeed.operators.joins import cut_to_keys
    df = spark.range(100).selectExpr("id % 20 AS k", "id AS v")
    keys = spark.range(5).selectExpr("id AS key")
    wide, narrow = cut_to_keys(df, keys, ["k"], ["key"], max_rows=3), cut_to_keys(df, keys, ["k"], ["key"])
    assert rows(wide) == rows(narrow) and len(rows(wide)) == 25
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_checkpoint_folder_must_be_named_on_a_cluster():
    import pytest
    from types import SimpleNamespace
    from cargofeed.session import checkpoint_dir
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn",
                              getConf=lambda: SimpleNamespace(get=lambda key, default: default))
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(session)
