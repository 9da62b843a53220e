"""Physical-plan checks: the rewrites must show up in what Spark executes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cargofeed.bindings.testdata import freight_tables
from cargofeed.operators import first_by_time, latest_by_sequence, load_window
from cargofeed.params import LoadWindow
from cargofeed.plans import airwaybill_detail, cw_feed, wt_feed
from conftest import rows

SF = "/root/testdata/sf0.001"
WINDOW = LoadWindow(dt.date(2001, 8, 1), False, dt.date(2019, 1, 1))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return freight_tables(spark, SF)


def test_first_by_time_limits_before_the_shuffle(spark, tables):
    _, cw = tables
    p = plan(first_by_time(cw["jobheader"], "jh_parentid", "jh_systemcreatetimeutc", ["jh_gc"]))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_latest_by_sequence_window_limits_before_the_shuffle(spark, tables):
    wt, _ = tables
    p = plan(latest_by_sequence(wt["tbl_airwaybill"], "fk_orderno", "fk_seqno", strategy="window"))
    assert "WindowGroupLimit" in p


def test_latest_by_sequence_max_join_reads_two_columns_for_the_max(spark, tables):
    wt, _ = tables
    df = latest_by_sequence(wt["tbl_airwaybill"], "fk_orderno", "fk_seqno",
                            keep=F.to_date("flightdatetime1") >= F.lit(dt.date(2001, 6, 17)))
    p = plan(df)
    # the max side scans two columns; only the windowed row side reads them all
    assert "ReadSchema: struct<fk_orderno:string,fk_seqno:int>" in p


def test_load_window_bound_reaches_the_parquet_scan(spark, tables):
    wt, _ = tables
    p = plan(load_window(wt["tbl_airwaybill"], "flightdatetime1", WINDOW))
    assert "PushedFilters: [IsNotNull(flightdatetime1), GreaterThanOrEqual(flightdatetime1" in p


def test_detail_rollup_aggregates_before_its_window(spark, tables):
    wt, _ = tables
    p = plan(airwaybill_detail(wt["tbl_airwaybilldesc"]))
    # the window runs over per-(key, unit) aggregates, not over raw rows
    assert p.index("Window") < p.index("HashAggregate")


def test_cw_feed_runs_the_charge_join_once(spark, tables):
    _, cw = tables
    p = plan(cw_feed(cw, WINDOW))
    # one scan of the charge table for all three cost categories
    assert p.count("ReadSchema: struct<jr_jh:string") == 1


def test_cw_feed_reads_the_stored_legs(spark, tables):
    _, cw = tables
    p = plan(cw_feed(cw, WINDOW))
    # flights, departures and multiplicities come from the staged leg base
    assert "jw_transportmode" not in p and "first_atd" in p


def test_wt_feed_reads_the_history_of_the_windows_orders_only(spark, tables):
    wt, _ = tables
    files = wt_feed(wt, WINDOW).inputFiles()
    # the final plan starts from the staged latest rows, not from the order history
    assert any("/wt_latest/" in f for f in files) and not any("/tbl_airwaybill/" in f for f in files)


def test_wt_feed_has_no_estimate_based_broadcast_of_history(spark, tables):
    wt, _ = tables
    p = plan(wt_feed(wt, WINDOW))
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_outer_joins_salt_null_keys(spark, tables):
    from cargofeed.operators.costs import charge_costs
    _, cw = tables
    p = plan(charge_costs(cw, cw["jobshipment"]))
    assert "__null_salt" in p


def test_wt_feed_of_a_large_window_shuffles_no_bucketed_table_for_its_cuts(spark, tables, monkeypatch):
    """beyond the broadcast bound only the staged rows, and what joins on another key, are shuffled."""
    from cargofeed.operators import joins
    from cargofeed.plans import wt as plan_wt
    wt, _ = tables
    want = rows(wt_feed(wt, WINDOW))
    monkeypatch.setattr(plan_wt, "DIMENSION_MAX_ROWS", 0)
    monkeypatch.setattr(joins.cut_to_keys, "__defaults__", (0, *joins.cut_to_keys.__defaults__[1:]))
    feed = wt_feed(wt, WINDOW)
    p = plan(feed)
    assert "__block" in p  # the Bloom cut
    assert "SortMergeJoin LeftSemi" not in p and p.count("LeftSemi") == p.count("BroadcastHashJoin")
    assert rows(feed) == want and want


def test_wt_feed_does_not_multiply_repeated_rows(spark):
    """300 copies of an order's airwaybill and line are one row each before they are joined."""
    import datetime as dt
    from cargofeed.sources.schemas import WT_SCHEMAS
    t = {"tbl_airwaybill": [("o1", 2, "w1", dt.datetime(2001, 7, 20), "O", "D", "FL1", "USD")] * 300,
         "tbl_shipmentapar": [("o1", 2, "01234567890", None, None)] * 300,
         "tbl_airwaybilldesc": [], "tbl_shipmentheader": [("o1", "H1")], "tbl_shipmentdesc": []}
    feed = wt_feed({n: spark.createDataFrame(v, WT_SCHEMAS[n]) for n, v in t.items()}, WINDOW)
    assert len(rows(feed)) == 1
    steps = feed._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert any("Aggregate [" in s and "c_order" in s for s in steps), steps  # the lines are distinct before their join
    assert spark.read.parquet(*[f for f in feed.inputFiles() if "/wt_latest/" in f]).count() == 1


def test_the_rank_strategy_ranks_the_rows_of_the_windows_orders_only(spark, tables):
    """the window function read and sorted every order; now the history is cut to the window's orders first."""
    wt, _ = tables
    awb = wt["tbl_airwaybill"]
    inside = awb.filter(F.to_date("flightdatetime1") >= F.lit(WINDOW.start)).select("fk_orderno").distinct()
    feed = wt_feed(wt, WINDOW, latest_strategy="window")
    assert rows(feed) == rows(wt_feed(wt, WINDOW)) == rows(wt_feed(wt, WINDOW, latest_strategy="window", reduce_history=False))
    ranked = []
    from cargofeed.plans import wt as plan_wt
    real = plan_wt.latest_by_sequence
    plan_wt.latest_by_sequence = lambda df, *a, **k: ranked.append(df) or real(df, *a, **k)
    try:
        wt_feed(wt, WINDOW, latest_strategy="window")
    finally:
        plan_wt.latest_by_sequence = real
    assert ranked[0].count() == awb.join(inside, "fk_orderno", "left_semi").count() < awb.count()


def test_the_window_is_sized_by_one_scan(spark, tables, monkeypatch):
    """the window's rows were counted for their size, and scanned again for their keys' range."""
    from cargofeed.operators import joins
    from cargofeed.plans import wt as plan_wt
    wt, _ = tables
    sized = []
    real = joins.key_size
    for m in (joins, plan_wt):
        monkeypatch.setattr(m, "key_size", lambda *a: sized.append(a) or real(*a))
    counted = []
    checked = plan_wt.has_at_most
    monkeypatch.setattr(plan_wt, "has_at_most", lambda *a: counted.append(a) or checked(*a))
    wt_feed(wt, WINDOW)
    assert len(sized) == 1 and len(counted) == 1  # the window, and its latest rows
