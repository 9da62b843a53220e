"""The incremental cost state against rebuilding from scratch."""

import datetime as dt
import uuid
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cargofeed.operators.costs import RATE_COMPANY
from cargofeed.plans import cost_state
from cargofeed.plans.cost_state import CostState, NeedsRebuild, touched_shipments
from cargofeed.plans.cw import MawbContext
from cargofeed.session import checkpoint_dir
from cargofeed.sinks.publish import current, publish, versions
from cargofeed.sources.schemas import ALL_SCHEMAS

from conftest import rows

T0, T1 = dt.datetime(2001, 7, 20), dt.datetime(2001, 7, 21)


def base():
    """Eight shipments on four MAWBs, two headers each, charges with payable and receivable lines."""
    n = 8
    return {
        "jobshipment": [(f"s{i}", "KG", D(1), D(1), "M3", D(1), T0 if i % 2 else T1) for i in range(n)],
        "jobheader": [(f"h{i}", f"s{i % n}", "0", "0", T0) for i in range(2 * n)],
        "glbcompany": [("0", "EUR")],
        "jobconshiplink": [(f"s{i}", f"c{i % 5}") for i in range(n)] + [("s0", "c3")],
        "jobconsol": [(f"c{i}", f"0000000000{i % 4}" if i < 4 else None, "A", "B", 0) for i in range(5)],
        "jobconsoltransport": [(f"c{i}", "AIR", f"F{k}", T0) for i in range(5) for k in range(1 + i % 2)],
        "jobcharge": [(f"h{i % (2 * n)}", "0", f"l{i}", f"r{i}" if i % 3 else None, D(10 + i)) for i in range(30)],
        "acctransactionlines": [(f"l{i}", "0", f"t{i % 6}", f"k{i % 3}", "CST", D(5 + i)) for i in range(30)]
        + [(f"r{i}", "0", f"t{i % 6}", None, "REV", D(1)) for i in range(30)],
        "acctransactionheader": [(f"t{i}", "0", T0 if i % 2 else None, "USD", T0 if i < 4 else T1) for i in range(6)],
        "accchargecode": [("k0", "0", "FSC"), ("k1", "0", "SEC"), ("k2", "0", "FRT")],
        "glbbranch": [("0", "0")],
        "refexchangerate": [(cur, day, RATE_COMPANY, "BUY", D(rate)) for cur, rate in (("EUR", 2), ("USD", 4)) for day in (T0, T1)],
    }


def frames(spark, data):
    return {k: spark.createDataFrame(v, ALL_SCHEMAS[k]) for k, v in data.items()}


def step(spark, before, after):
    """Change images between two versions of the tables."""
    out = {}
    for name in after:
        minus = list(before[name])
        plus = []
        for r in after[name]:
            if r in minus:
                minus.remove(r)
            else:
                plus.append(r)
        if minus or plus:
            df = spark.createDataFrame([(*r, "-") for r in minus] + [(*r, "+") for r in plus],
                                       ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ALL_SCHEMAS[name].fields) + ", op string")
            out[name] = df
    return out


def state_at(spark):
    return CostState(spark, f"{checkpoint_dir(spark).rstrip('/')}/test-state-{uuid.uuid4().hex}")


def full(tables):
    return rows(MawbContext(tables).costs())


def edited(data, name, fn):
    return {**data, name: [r for old in data[name] for r in fn(old)]}


def test_runs_of_changes_equal_a_rebuild(spark, monkeypatch):
    monkeypatch.setattr(cost_state, "COMPACT_AFTER", 3)
    data = base()
    state = state_at(spark)
    with pytest.raises(ValueError):
        state.costs()
    state.rebuild(frames(spark, data))
    assert rows(state.costs()) == full(frames(spark, data))
    days = [
        # a corrected amount, a charge that moves to another header, a late charge on a late line
        lambda d: {**edited(d, "jobcharge", lambda r: [(*r[:4], r[4] + 3), ("h2", "0", "l99", None, D(50))] if r[2] == "l4" else [("h9", *r[1:])] if r[2] == "l7" else [r]),
                   "acctransactionlines": [*d["acctransactionlines"], ("l99", "0", "t1", "k1", "ACR", D(8))]},
        # a corrected line, a line that is no cost any more, an invoice date that moves, a corrected rate of one day
        lambda d: edited(edited(edited(d, "acctransactionlines", lambda r: [(*r[:5], D(77))] if r[0] == "l2" else [(*r[:4], "REV", r[5])] if r[0] == "l3" else [r]),
                                "acctransactionheader", lambda r: [(*r[:4], T1)] if r[0] == "t1" else [r]),
                         "refexchangerate", lambda r: [(*r[:4], D(8))] if r[0] == "USD" and r[1] == T1 else [r]),
        # links that go and come, another MAWB of a consolidation, one leg more; a header that moves
        lambda d: edited(edited(edited({**d, "jobconsoltransport": [*d["jobconsoltransport"], ("c2", "AIR", "F9", T1)]},
                                       "jobconshiplink", lambda r: [] if r == ("s0", "c3") else [r, ("s1", "c0")] if r == ("s5", "c0") else [r]),
                                "jobconsol", lambda r: [(r[0], "00000000009", *r[2:])] if r[0] == "c1" else [r]),
                         "jobheader", lambda r: [(r[0], "s6", *r[2:])] if r[0] == "h1" else [r]),
        # a shipment and charges that go
        lambda d: edited(edited(d, "jobshipment", lambda r: [] if r[0] == "s3" else [r]), "jobcharge", lambda r: [] if r[0] == "h4" else [r]),
    ]
    for k, change in enumerate(days):
        after = change(data)
        images = step(spark, data, after)
        info = state.apply(frames(spark, after), images, f"day{k}")
        assert rows(state.costs()) == full(frames(spark, after)), k
        assert 0 < info.touched <= 8 and info.version == k + 2
        again = state.apply(frames(spark, after), images, f"day{k}")  # a repeated run changes nothing
        assert again.appended == {} and len(versions(spark, state.root)) == k + 2
        data = after
    assert len(current(spark, state.root)["folders"]) <= 3
    state.clean()
    assert rows(state.costs()) == full(frames(spark, data)) and len(versions(spark, state.root)) == 1


def test_a_run_touches_only_the_shipments_of_its_changes(spark):
    data = base()
    tables = frames(spark, data)
    late = spark.createDataFrame([("h5", "0", "l5", None, D(9), "+")], "jr_jh string, jr_gc string, jr_al_apline string, jr_al_arline string, jr_localcostamt decimal(19,4), op string")
    assert rows(touched_shipments(tables, {"jobcharge": late})) == [("s5",)]
    assert rows(touched_shipments(tables, {})) == []
    company = tables["glbcompany"].withColumn("op", F.lit("-"))
    with pytest.raises(NeedsRebuild):
        touched_shipments(tables, {"glbcompany": company})
    state = state_at(spark)
    state.rebuild(tables)
    after = {**data, "jobcharge": [*data["jobcharge"], ("h5", "0", "l5", None, D(9))]}
    info = state.apply(frames(spark, after), {"jobcharge": late}, "late")
    assert info.touched == 1 and info.appended["shipments"] == 1 and info.appended["links"] == 0 and info.appended["mawbs"] == 1


def test_a_killed_run_leaves_the_state_as_it_was(spark, monkeypatch):
    data = base()
    state = state_at(spark)
    state.rebuild(frames(spark, data))
    before = rows(state.costs())
    after = edited(data, "jobcharge", lambda r: [(*r[:4], r[4] * 2)])

    def killed(*_):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(cost_state, "publish", killed)
        with pytest.raises(KeyboardInterrupt):
            state.apply(frames(spark, after), step(spark, data, after), "day")
    assert rows(state.costs()) == before
    state.apply(frames(spark, after), step(spark, data, after), "day")
    assert rows(state.costs()) == full(frames(spark, after))


def test_a_version_is_published_once(spark):
    root = f"{checkpoint_dir(spark).rstrip('/')}/test-publish-{uuid.uuid4().hex}"
    assert current(spark, root) is None and publish(spark, root, {"a": 1}) == 1 and publish(spark, root, {"a": 2}) == 2
    assert current(spark, root) == {"a": 2} and versions(spark, root) == [1, 2]
