"""Bucketed storage, hot keys and Bloom cuts: fewer exchanges, the same rows."""

import datetime as dt
import uuid
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

import bench
from cargofeed.bindings.testdata import BASE_TABLES, freight_cost_layout, freight_tables, freight_views, store_root
from cargofeed.operators import joins
from cargofeed.operators.cost_layout import cost_layout, heavy_split_join, hot_keys
from cargofeed.operators.costs import charge_costs
from cargofeed.plans.cw import MawbContext
from cargofeed.session import SHUFFLE_CLEANUP, checkpoint_dir
from cargofeed.sources.layout import heavy_bins, is_hot, open_buckets, store_family, write_buckets
from cargofeed.sources.schemas import ALL_SCHEMAS, CW_SCHEMAS

from conftest import rows

SF = "/root/testdata/sf0.001"


def fresh(spark):
    return f"{checkpoint_dir(spark).rstrip('/')}/test-layout-{uuid.uuid4().hex}"


def shape(df):
    return bench.plan_shape(df._jdf.queryExecution().executedPlan())


@pytest.fixture(scope="module")
def cw(spark):
    return freight_tables(spark, SF)[1]


def test_stored_layout_gives_the_source_chain_and_few_shuffles(spark, cw):
    layout = freight_cost_layout(spark, SF)
    stored = charge_costs(cw, None, layout=layout)
    assert rows(stored) == rows(charge_costs(cw, cw["jobshipment"]))
    costs = MawbContext(cw, layout=layout).costs()
    assert rows(costs) == rows(MawbContext(cw).costs())
    assert shape(costs)["shuffles"] <= 10 and shape(stored)["shuffles"] <= 5
    some = cw["jobshipment"].filter(F.crc32("js_pk") % 3 == 0)
    assert rows(charge_costs(cw, some, layout=layout)) == rows(charge_costs(cw, some))


def test_buckets_join_and_group_without_exchange(spark):
    root = fresh(spark)
    a = spark.range(500).selectExpr("cast(id % 97 as string) k", "id v")
    b = spark.range(97).selectExpr("cast(id as string) k2", "id w")
    x = write_buckets(a, f"{root}/a", ["k"], 8)
    write_buckets(b, f"{root}/b", ["k2"], 8)
    spark.sql(f"DROP TABLE {spark.sql('SHOW TABLES').filter(F.col('tableName').startswith('cargofeed_')).first()['tableName']}")
    x = open_buckets(spark, f"{root}/a", a.schema, ["k"], 8)  # another session would have no entry either
    y = open_buckets(spark, f"{root}/b", b.schema, ["k2"], 8)
    joined = x.join(y, x["k"] == y["k2"]).groupBy("k").agg(F.sum("w").alias("w"), F.count("*").alias("n"))
    assert shape(joined)["shuffles"] == 0
    assert rows(joined) == rows(a.join(b, a["k"] == b["k2"]).groupBy("k").agg(F.sum("w").alias("w"), F.count("*").alias("n")))


def test_a_table_with_a_hot_key_is_stored_without_buckets(spark):
    t0 = dt.datetime(2001, 7, 20)
    legs = spark.createDataFrame([("hot" if i % 2 else f"c{i}", "AIR", "FL", t0) for i in range(400)], CW_SCHEMAS["jobconsoltransport"])
    consol = spark.createDataFrame([(f"c{i}", "00000000001", "A", "B", 0) for i in range(200)], CW_SCHEMAS["jobconsol"])
    root = fresh(spark)
    for _ in range(2):  # stored, then opened
        out = store_family({"jobconsoltransport": legs, "jobconsol": consol}, root, 8)
        assert rows(out["jobconsoltransport"]) == rows(legs) and rows(out["jobconsol"]) == rows(consol)
        assert any("/buckets-8/" in f for f in out["jobconsol"].inputFiles())
        assert not any("/buckets-8/" in f for f in out["jobconsoltransport"].inputFiles())


def hot_tables(spark, n=3000):
    """Half of all charges on one header, a third of them on one payable line, a third on one receivable
    line, half of all lines on one transaction header."""
    t0 = dt.datetime(2001, 7, 20)
    data = {
        "jobshipment": [(f"s{i}", "KG", D(1), D(1), "M3", D(1), t0) for i in range(100)],
        "jobheader": [(f"h{i}", f"s{i % 100}", "0", "0", t0) for i in range(300)],
        "glbcompany": [("0", "USD")],
        "jobcharge": [("h0" if i % 2 else f"h{i % 300}", "0", "l0" if i % 3 == 0 else f"l{i}",
                       "r0" if i % 3 == 1 else (None if i % 5 == 0 else f"r{i}"), D(i)) for i in range(n)],
        "acctransactionlines": [(f"{kind}{i}", "0", "t0" if i % 2 else (None if i % 7 == 0 else f"t{i}"), "c0", "CST" if kind == "l" else "REV", D(2))
                                for kind in "lr" for i in range(n)],
        "acctransactionheader": [(f"t{i}", "0", t0, "EUR", t0) for i in range(n)],
        "accchargecode": [("c0", "0", "FSC")], "glbbranch": [("0", "0"), ("0", "0")],
        "refexchangerate": [],
    }
    return {k: spark.createDataFrame(v, ALL_SCHEMAS[k]).repartition(4) for k, v in data.items()}


def test_hot_keys_do_not_fill_a_bucket_or_a_task(spark):
    tables = hot_tables(spark)
    layout = cost_layout(tables, fresh(spark), 8)
    for side in (layout.charges, layout.lines):
        sizes = sorted(r["count"] for r in side.groupBy(F.input_file_name()).count().collect())
        assert len(sizes) == 8 and sizes[-1] <= 5 * sizes[len(sizes) // 2]
    assert rows(charge_costs(tables, None, layout=layout)) == rows(charge_costs(tables, tables["jobshipment"]))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines, header = tables["acctransactionlines"], tables["acctransactionheader"]
        for how in ("inner", "left"):
            split = heavy_split_join(lines, header, ["al_ah", "al_gc"], ["ah_pk", "ah_gc"], ["al_pk"], how)
            plain = lines.join(header, (lines["al_ah"] == header["ah_pk"]) & (lines["al_gc"] == header["ah_gc"]), how)
            assert split.columns == plain.columns and rows(split) == rows(plain)
            sizes = sorted(r["count"] for r in split.groupBy(F.spark_partition_id()).count().collect())
            assert len(sizes) == 8 and sizes[-1] <= 5 * sizes[4]
        charges = layout.charges
        by_line = charges.repartition(8, "jr_al_apline", "jr_gc", "ap_copy").groupBy(F.spark_partition_id()).count().collect()
        sizes = sorted(r["count"] for r in by_line)
        assert sizes[-1] <= 5 * sizes[len(sizes) // 2]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_hot_keys_are_bounded_and_exact(spark):
    df = spark.range(1000).selectExpr("if(id % 4 = 0, 'a', cast(id as string)) k", "if(id % 10 < 3, 'b', null) k2")
    assert {r["key"]: r["copies"] for r in hot_keys(df, ["k", "k2"], 10).collect()} == {"a": 3, "b": 3}
    assert hot_keys(df.filter("id < 0"), ["k"], 10).collect() == []


def test_bloom_cut_keeps_every_match_and_shuffles_little_else(spark, monkeypatch):
    history = spark.range(20000).selectExpr("cast(id as string) k", "id % 3 g", "id v")
    keys = spark.range(0, 20000, 40).selectExpr("cast(id as string) k", "id % 3 g").union(spark.createDataFrame([(None, 1)], "k string, g long"))
    passed = joins.bloom_cut(history, keys, ["k", "g"], ["k", "g"], 501)
    exact = history.join(keys, ["k", "g"], "left_semi")
    assert exact.join(passed, "k", "left_anti").isEmpty()
    assert 500 <= passed.count() <= 500 + 0.03 * 20000
    cut = joins.cut_to_keys(history, keys, ["k", "g"], ["k", "g"], max_rows=100)  # too many keys to broadcast
    assert rows(cut) == rows(exact)
    p = cut._jdf.queryExecution().executedPlan().toString()
    shuffled = p.index("Exchange hashpartitioning(k")
    assert "BroadcastHashJoin" in p[shuffled:] and "__w7" in p[shuffled:]  # the filter lies below the exchange
    monkeypatch.setattr(joins, "BLOOM_MAX_BLOCKS", 1)
    plain = joins.cut_to_keys(history, keys, ["k", "g"], ["k", "g"], max_rows=100)
    assert "__w7" not in plain._jdf.queryExecution().executedPlan().toString() and rows(plain) == rows(exact)
    # bytes count too: few rows of long keys are not broadcast
    assert joins.has_at_most(spark.createDataFrame([("x" * 1000,)] * 10, "k string"), 100, 20000)
    assert not joins.has_at_most(spark.createDataFrame([("x" * 1000,)] * 10, "k string"), 100, 5000)


def test_a_cut_reads_only_files_that_can_hold_its_keys(spark):
    root = fresh(spark)
    df = spark.range(4000).selectExpr("cast(1000000 + id as string) k", "id v")
    stored = write_buckets(df, f"{root}/bucketed", ["k"], 8)
    one = spark.createDataFrame([("1000007",), ("1000007",)], "k string")
    cut = joins.cut_to_keys(stored, one, ["k"], ["k"])
    p = cut._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 1 out of 8" in p and "In(k" in p or "EqualTo(k,1000007)" in p
    assert rows(cut) == [("1000007", 7)]
    # many keys of one stretch: files of other stretches are passed over by their least and greatest key
    df.repartitionByRange(8, "k").write.parquet(f"{root}/ranges")
    history = spark.read.parquet(f"{root}/ranges")
    keys = spark.range(100, 1300).selectExpr("cast(1000000 + id as string) k")
    cut = joins.cut_to_keys(history, keys, ["k"], ["k"])
    assert "GreaterThanOrEqual(k,1000100), LessThanOrEqual(k,1001299)" in cut._jdf.queryExecution().executedPlan().toString()
    assert cut.count() == 1200
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        cut = joins.cut_to_keys(history, keys, ["k"], ["k"])
        cut.collect()
        scan = cut._jdf.queryExecution().executedPlan()
        while scan.children().size():
            scan = scan.children().head()
        assert scan.metrics().apply("numOutputRows").value() < 2100  # four of eight files have such rows at most
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    nulls = joins.cut_to_keys(history, spark.createDataFrame([(None,)], "k string"), ["k"], ["k"])
    assert nulls.count() == 0 and joins.cut_to_keys(history, keys.limit(0), ["k"], ["k"]).count() == 0


def test_a_query_stores_only_the_tables_it_reads(spark, tmp_path):
    """every query stored all 17 tables first, and the cost layout's tables twice."""
    import shutil
    sf = tmp_path / "sf"
    shutil.copytree(SF, sf, ignore=lambda _, names: [n for n in names if n.split(".")[0] not in BASE_TABLES])
    wt, tables = freight_tables(spark, str(sf))
    assert len(wt) == 5 and set(wt) == {n for n in ALL_SCHEMAS if n.startswith("tbl_")}
    assert wt["tbl_airwaybill"].count() == spark.read.parquet(str(sf / "lineitem.parquet")).count()
    tables["jobshipment"]
    layout = freight_cost_layout(spark, str(sf))
    root = store_root(spark, str(sf))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [str(s.getPath().toString()).rsplit("/", 1)[1] for d in fs.listStatus(path(root)) for s in fs.listStatus(d.getPath())]
    assert {n for n in found if n in ALL_SCHEMAS} == {"tbl_airwaybill", "jobshipment"}
    assert rows(MawbContext(tables, layout=layout).costs()) == rows(MawbContext(freight_views(spark, str(sf))[1]).costs())


def test_hot_values_are_found_exactly(spark):
    """one scan counts hash bins; values in heavy bins alone are counted one by one."""
    df = spark.range(4000).selectExpr("CASE WHEN id % 10 < 3 THEN 'a' WHEN id % 10 = 3 THEN NULL ELSE concat('k', id) END AS k", "id")
    for buckets, hot in ((8, True), (4, False), (2, False)):  # 30 % of the rows are 2.4, 1.2 and 0.6 even shares
        assert is_hot(df, ["k"], buckets) is hot
    assert is_hot(df.filter("k IS NULL OR k <> 'a'"), ["k"], 16)  # NULL, a seventh of these
    assert not is_hot(df.filter("k <> 'a'"), ["k"], 16) and not is_hot(df.limit(0), ["k"], 16)
    assert heavy_bins(df.filter("k <> 'a'"), [F.struct("k")], 64, 4000 / 16).count() == 0


def test_stored_and_staged_tables_leave_no_shuffle_files(spark):
    """the shuffles of every table written before stayed on the disk while a query ran."""
    from cargofeed.operators.stage import stage
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = spark.conf.get(SHUFFLE_CLEANUP)
    df = spark.range(2000).selectExpr("cast(id % 97 as string) k", "id").groupBy("k").agg(F.sum("id").alias("v"))
    held = manager.shuffleStatuses().size()
    assert rows(write_buckets(df, f"{fresh(spark)}/a", ["k"], 8)) == rows(stage(df, "a"))
    written = manager.shuffleStatuses().size()
    stage(df, "b")
    write_buckets(df, f"{fresh(spark)}/b", ["k"], 8)
    assert manager.shuffleStatuses().size() <= written <= held + 2  # those of the two reads at most
    assert rows(df) == rows(stage(df, "c")) and spark.conf.get(SHUFFLE_CLEANUP) == before
