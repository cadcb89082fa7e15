"""Key index (K3, D1), file swaps (K1), key-restricted change test (K2), layouts."""

import glob
import os

import pytest

from conftest import SF001, raw_frame, tx
from paylake.operators import quality as DQ
from paylake.plans.load import run_load
from paylake.session import touch_file
from paylake.sources import warehouse as W
from paylake.sources.testdata import raw_transactions

FACT = "fact_transactions"


@pytest.fixture
def wh(spark, tmp_path):
    w = W.Warehouse(spark, str(tmp_path / "wh"), layout="month", index_buckets=16)
    w.create_tables()
    return w


def _load(spark, wh, rows, mode="replace"):
    return run_load(spark, raw_frame(spark, rows), wh, full=True, fact_mode=mode)


def _facts(wh):
    return sorted((r["transaction_id"], r["amount"], str(r["transaction_date"]))
                  for r in wh.read(FACT).collect())


def _files(wh):
    return set(glob.glob(wh.path(FACT) + "/*=*/*.parquet"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _above_scan(plan, path):
    """Operators from the root down to the scan of ``path``, that branch only."""
    lines = plan.split("\n")
    at = next(i for i, x in enumerate(lines) if "FileScan" in x and path in x)
    depth, out = len(lines[at]) - len(lines[at].lstrip(" :+-")), []
    for x in reversed(lines[:at]):
        d = len(x) - len(x.lstrip(" :+-"))
        if d < depth:
            out.append(x.strip(" :+-"))
            depth = d
    return out


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(W, "BROADCAST_KEY_ROWS", 0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_large_batches_do_not_move_the_stored_keys(spark, wh, no_broadcast):
    raw = raw_transactions(spark, SF001, None, "1995-09-01")
    run_load(spark, raw, wh, end="1995-09-01")
    batch = wh.read(FACT).limit(50)
    join = wh.stored_keys(FACT, batch.repartition(3))
    plan = _plan(join)
    above = _above_scan(plan, "paylake_ids")
    assert any("SortMergeJoin" in x or "ShuffledHashJoin" in x for x in above)
    assert not any("Exchange" in x for x in above), above
    assert "Exchange hashpartitioning(transaction_id" in plan  # of the batch
    assert join.count() == 50
    # D1 over all stored ids: grouped where they lie
    rule = wh.key_index().groupBy("transaction_id").count()
    assert "Exchange" not in _plan(rule)
    assert DQ.uniqueness(wh.key_index(), "transaction_id", FACT).first()["violations"] == 0
    # the same loads as with broadcasts
    assert run_load(spark, raw, wh, end="1995-09-01").fact_rows_added == 0
    run_load(spark, raw, wh, end="1995-09-01", fact_mode="replace")
    assert wh.key_index().count() == wh.read(FACT).count() > 100


def test_index_follows_a_load_that_died_between_the_writes(spark, wh):
    _load(spark, wh, [tx("T1"), tx("T2")], "ignore")
    held = wh.read(FACT).where("transaction_id = 'T2'")
    wh._append(FACT, spark.createDataFrame([("T3", *tuple(r)[1:]) for r in held.collect()],
                                           held.schema))
    # T3 is stored but not in the index: it must not be added again
    assert _load(spark, wh, [tx("T3"), tx("T4")], "ignore").fact_rows_added == 1
    assert [t for t, _, _ in _facts(wh)] == ["T1", "T2", "T3", "T4"]
    assert sorted(r[0] for r in wh.key_index().collect()) == ["T1", "T2", "T3", "T4"]


def test_index_of_an_older_warehouse_and_of_an_empty_one(spark, wh):
    assert wh.key_index().count() == 0
    _load(spark, wh, [tx("T1")], "ignore")
    other = W.Warehouse(spark, wh.root, index_buckets=3)  # the folder's buckets count
    assert other.key_index().count() == 1
    assert [os.path.basename(p) for p in glob.glob(wh.root + "/_ids-*")] == ["_ids-16"]


@pytest.mark.parametrize("layout", W.LAYOUTS)
def test_only_files_with_a_changed_row_are_rewritten(spark, tmp_path, layout):
    wh = W.Warehouse(spark, str(tmp_path / "wh"), layout=layout)
    wh.create_tables()
    _load(spark, wh, [tx(f"T{m}{i}", ts=f"2026-0{m}-01 10:00:00") for m in (1, 2, 3) for i in range(3)])
    before = _files(wh)
    # T10 as it was, T20 changed, T30 moved to another month, T90 new
    _load(spark, wh, [tx("T10", ts="2026-01-01 10:00:00"),
                      tx("T20", ts="2026-02-01 10:00:00", amount=7.0),
                      tx("T90", ts="2026-04-01 10:00:00")])
    after = _files(wh)
    assert {f for f in before if "2026-01" in f or "2026-03" in f} <= after
    assert not {f for f in before if "2026-02" in f} & after
    _load(spark, wh, [tx("T30", ts="2026-05-01 10:00:00")])
    got = {t: (a, d) for t, a, d in _facts(wh)}
    assert len(got) == wh.read(FACT).count() == 10
    assert got["T20"] == (7.0, "2026-02-01") and got["T30"] == (100.0, "2026-05-01")
    assert got["T21"] == (100.0, "2026-02-01") and got["T10"] == (100.0, "2026-01-01")
    # an unchanged batch writes nothing
    now = _files(wh)
    _load(spark, wh, [tx("T30", ts="2026-05-01 10:00:00"), tx("T11", ts="2026-01-01 10:00:00")])
    assert _files(wh) == now
    assert not glob.glob(wh.path(FACT) + "/_swap-*")


def test_files_of_an_odd_path(spark, tmp_path):
    wh = W.Warehouse(spark, str(tmp_path / "a b+c%20"))
    wh.create_tables()
    _load(spark, wh, [tx("T1"), tx("T2", ts=None)])
    _load(spark, wh, [tx("T1", amount=3.0), tx("T2", ts=None, amount=4.0)])
    assert [(t, a) for t, a, _ in _facts(wh)] == [("T1", 3.0), ("T2", 4.0)]


def test_a_swap_dies_before_and_after_its_commit(spark, wh, monkeypatch):
    _load(spark, wh, [tx("T1"), tx("T2")])
    before = _facts(wh)
    # before the marker: the table is as it was, the next load starts afresh
    monkeypatch.setattr(W, "touch_file", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        _load(spark, wh, [tx("T1", amount=5.0)])
    assert _facts(wh) == before
    # after the marker: nothing was moved yet
    monkeypatch.setattr(W, "touch_file", lambda s, p: (touch_file(s, p), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        _load(spark, wh, [tx("T1", amount=6.0)])
    monkeypatch.undo()
    assert [(t, a) for t, a, _ in _facts(wh)] == [("T1", 6.0), ("T2", 100.0)]  # a read finishes it
    assert [(t, a) for t, a, _ in _facts(wh)] == [("T1", 6.0), ("T2", 100.0)]
    _load(spark, wh, [tx("T2", amount=8.0)])
    assert [(t, a) for t, a, _ in _facts(wh)] == [("T1", 6.0), ("T2", 8.0)]
    assert not glob.glob(wh.path(FACT) + "/_swap-*")


def test_change_test_scans_the_stored_table_once(spark, wh):
    raw = raw_transactions(spark, SF001, None, "1995-06-01")
    run_load(spark, raw, wh, end="1995-06-01")
    current = wh.read("dim_users")
    batch = spark.createDataFrame(current.take(20), current.schema)
    plan = _plan(wh.unchanged_rows(current, batch, ["user_id"], 20))
    assert plan.count("FileScan") == 1 and "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan
    version = wh.location("dim_users")
    run_load(spark, raw, wh, end="1995-06-01")
    assert wh.location("dim_users") == version


def test_null_values_are_compared_as_values(spark, wh):
    row = spark.createDataFrame([("M1", None, "A"), ("M2", "n", None)], wh.schema("dim_merchants"))
    wh.upsert_replace_table("dim_merchants", row)
    version = wh.location("dim_merchants")
    wh.upsert_replace_table("dim_merchants", row)
    assert wh.location("dim_merchants") == version
    wh.upsert_replace_table("dim_merchants", row.fillna({"merchant_name": "x"}))
    assert sorted(map(tuple, wh.read("dim_merchants").collect()))[0] == ("M1", "x", "A")


def test_layouts_hold_the_same_rows(spark, tmp_path):
    import datetime
    got = {}
    for layout in W.LAYOUTS:
        wh = W.Warehouse(spark, str(tmp_path / layout), layout=layout)
        wh.create_tables()
        for lo, hi in ((None, "1995-04-01"), ("1995-03-20", "1995-05-01")):
            run_load(spark, raw_transactions(spark, SF001, lo, hi), wh, start=lo, end=hi,
                     fact_mode="replace", summary_from_store=True)
        day = datetime.date(1995, 4, 5)
        part = wh.read_days(FACT, [day])
        assert "PartitionFilters: []" not in part._jdf.queryExecution().toString()
        got[layout] = (_facts(wh), sorted(map(tuple, part.collect())),
                       sorted(map(tuple, wh.read("daily_merchant_summary").collect())))
    assert got["day"] == got["month"] and got["day"][1]
    with pytest.raises(ValueError):
        W.Warehouse(spark, str(tmp_path), layout="year")


def test_month_layout_in_the_catalog(spark, tmp_path):
    wh = W.Warehouse(spark, str(tmp_path / "wh"), database="paylake_test_month", layout="month")
    wh.create_tables()
    run_load(spark, raw_frame(spark, [tx("T1"), tx("T2", ts="2026-09-03 00:00:00")]), wh, day="2026-08-01")
    run_load(spark, raw_frame(spark, [tx("T2", ts="2026-09-03 00:00:00")]), wh, day="2026-09-03")
    table = spark.table("paylake_test_month.fact_transactions")
    assert table.count() == 2 and "transaction_month" in table.columns
