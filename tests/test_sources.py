"""Tables as the job reads them: stored types, padded codes, options, pushdown."""

import datetime as dt
import uuid
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cargofeed.job import reader_options
from cargofeed.operators import load_window
from cargofeed.operators.costs import COST_LINE_TYPES
from cargofeed.operators.flights import air_legs
from cargofeed.functions.validity import is_code
from cargofeed.params import LoadWindow
from cargofeed.session import checkpoint_dir
from cargofeed.sources import SchemaError, read_family, read_table
from cargofeed.sources.tables import table_options

WINDOW = LoadWindow(dt.date(2001, 8, 1), False, dt.date(2019, 1, 1))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _store(spark, df, name) -> str:
    root = f"{checkpoint_dir(spark).rstrip('/')}/test-sources-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{name}")
    return root


@pytest.fixture(scope="module")
def transport_root(spark):
    legs = spark.createDataFrame(
        [("c1", "AIR", "X1", dt.datetime(2001, 7, 1)), ("c2", "AIR  ", "X2", dt.datetime(2001, 7, 2)),
         ("c3", "SEA", "V", None), ("c4", "AIRX", "X3", None), ("c5", None, "X4", None)],
        "JW_ParentGuid string, jw_transportmode string, jw_voyageflight string, jw_atd timestamp")
    return _store(spark, legs, "jobconsoltransport")


def test_padded_mode_matches_and_is_pushed(spark, transport_root):
    legs = air_legs(read_table(spark, transport_root, "jobconsoltransport"))
    assert sorted(r.jw_parentguid for r in legs.collect()) == ["c1", "c2"]
    assert "StringStartsWith(jw_transportmode,AIR)" in _plan(legs)


def test_line_types_are_pushed(spark):
    lines = spark.createDataFrame(
        [("1", "g", "h", "a", "CST ", D(1)), ("2", "g", "h", "a", "REV", D(1)), ("3", "g", None, "a", "ACR", D(1))],
        "al_pk string, al_gc string, al_ah string, al_ac string, al_linetype string, al_osamount decimal(19,4)")
    df = read_table(spark, _store(spark, lines, "acctransactionlines"), "acctransactionlines")
    kept = df.filter(is_code("al_linetype", *COST_LINE_TYPES))
    assert sorted(r.al_pk for r in kept.collect()) == ["1", "3"]
    assert "StringStartsWith(al_linetype,CST)" in _plan(kept)


@pytest.mark.parametrize("stored", ["timestamp", "timestamp_ntz"])
def test_window_reaches_the_scan_whatever_the_stored_timestamp(spark, stored):
    ship = spark.createDataFrame(
        [("s1", dt.datetime(2001, 7, 20)), ("s2", dt.datetime(2001, 1, 1)), ("s3", None)], f"js_pk string, t {stored}")
    ship = ship.select("js_pk", F.lit("KG").alias("js_unitofweight"), F.lit(D(1)).alias("js_actualweight"),
                       F.lit(D(1)).alias("js_actualchargeable"), F.lit("CF").alias("js_unitofvolume"),
                       F.lit(D(1)).alias("js_actualvolume"), F.col("t").alias("js_systemcreatetimeutc"))
    df = load_window(read_table(spark, _store(spark, ship, "jobshipment"), "jobshipment"), "js_systemcreatetimeutc", WINDOW)
    assert [r.js_pk for r in df.collect()] == ["s1"]
    assert "GreaterThanOrEqual(js_systemcreatetimeutc" in _plan(df)


def test_missing_column_fails_fast(spark):
    root = _store(spark, spark.createDataFrame([("g",)], "gc_pk string"), "glbcompany")
    with pytest.raises(SchemaError):
        read_family(spark, root, "cw", names=["glbcompany"])


def test_reader_options_per_table():
    given = reader_options(["url=jdbc:x", "jobcharge.partitionColumn=id", "a.b=c"])
    assert table_options(given, "jobcharge") == {"url": "jdbc:x", "partitionColumn": "id", "a.b": "c"}
    assert table_options(given, "jobheader") == {"url": "jdbc:x", "a.b": "c"}
    with pytest.raises(ValueError):
        reader_options(["url"])


def test_job_from_two_roots_and_from_a_catalog_database(spark, capsys):
    """Each family from a database of its own (S18), and a database named by stage."""
    from cargofeed.bindings.testdata import freight_tables
    from cargofeed.job import main
    from cargofeed.sinks import read_feed
    wt, cw = freight_tables(spark, "/root/testdata/sf0.001")
    base = f"{checkpoint_dir(spark).rstrip('/')}/test-job-{uuid.uuid4().hex}"
    for family, tables in (("one", wt), ("two", cw)):
        for name, df in tables.items():
            df.write.parquet(f"{base}/{family}/{name}")

    def run(out, *more):
        assert main(["--as-of", "2001-08-01", "--out", f"{base}/{out}", *more]) == 0
        assert "ok=True" in capsys.readouterr().out
        return {feed: sorted(map(str, read_feed(spark, f"{base}/{out}/feed={feed}/dt=2001-08-01").collect()))
                for feed in ("mawb", "hawb", *(["cwmawb"] if "--cw-root" in more else []))}
    files = run("files", "--wt-root", f"{base}/one", "--cw-root", f"{base}/two")
    assert all(files.values())
    database = f"uat_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database}")
    for name in wt:
        spark.sql(f"CREATE TABLE {database}.{name} USING parquet LOCATION '{base}/one/{name}'")
    tables = run("tables", "--wt-root", database, "--format", "table")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    assert tables["mawb"] == files["mawb"] and tables["hawb"] == files["hawb"]
    with pytest.raises(Exception, match="two/tbl_airwaybill|PATH_NOT_FOUND"):  # the families are not mixed up
        main(["--as-of", "2001-08-01", "--out", f"{base}/none", "--wt-root", f"{base}/two"])
