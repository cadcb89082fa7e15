"""Warehouse loads: full, incremental, replay, modes, gate."""

import pytest

from conftest import SF001, raw_frame, tx
from paylake.operators import cleaning as C
from paylake.operators import model as M
from paylake.operators.quality import DataQualityError
from paylake.plans.load import run_load
from paylake.sources.testdata import raw_transactions
from paylake.sources.warehouse import Warehouse, create_table_sql


def _snap(wh):
    out = {}
    for t in ("dim_users", "dim_merchants", "fact_transactions", "daily_merchant_summary"):
        out[t] = sorted(tuple(r) for r in wh.read(t).collect())
    return out


def _facts(wh, *cols):
    """Stored fact rows as a sorted list: duplicates show."""
    rows = wh.read("fact_transactions").select("transaction_id", *(cols or ("amount",))).collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture
def wh(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "wh"))
    w.create_tables()
    return w


def test_create_tables_idempotent(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "wh2"), database="paylake_test_ddl")
    w.create_tables()
    w.create_tables()
    assert spark.table("paylake_test_ddl.fact_transactions").count() == 0
    assert "PARTITIONED BY (`transaction_date`)" in create_table_sql("fact_transactions", "/x")


def test_full_load_matches_model(spark, wh):
    raw = raw_transactions(spark, SF001)
    res = run_load(spark, raw, wh, full=True, count_read=True)
    assert res.loaded and res.counters == {"read": 6000, "batch": 6000, "dedupe": 4599,
                                           "drop_missing": 4484, "positive_amount": 4458,
                                           "removed_duplicates": 1401, "removed_missing": 115,
                                           "removed_invalid_amount": 26}
    model = M.star_schema(C.transform(raw))
    snap = _snap(wh)
    for t, df in model.items():
        assert snap[t] == sorted(tuple(r) for r in df.select(*wh.read(t).columns).collect()), t


def test_day_replay_is_idempotent(spark, wh):
    raw = raw_transactions(spark, SF001)
    run_load(spark, raw, wh, start=None, end="1998-07-01")
    run_load(spark, raw, wh, day="1998-07-01")
    first = _snap(wh)
    res = run_load(spark, raw, wh, day="1998-07-01")
    assert res.fact_rows_added == 0
    assert _snap(wh) == first


def test_fact_modes(spark, tmp_path):
    rows_a = [tx("T1", amount=10.0, ts="2026-08-01 10:00:00"),
              tx("T2", amount=20.0, ts="2026-08-01 11:00:00")]
    rows_b = [tx("T1", amount=99.0, status="FAILED", ts="2026-08-02 10:00:00")]
    for mode, expect in (("ignore", 10.0), ("replace", 99.0)):
        w = Warehouse(spark, str(tmp_path / f"wh_{mode}"))
        w.create_tables()
        run_load(spark, raw_frame(spark, rows_a), w, full=True, fact_mode=mode)
        run_load(spark, raw_frame(spark, rows_b), w, full=True, fact_mode=mode)
        assert _facts(w) == [("T1", expect), ("T2", 20.0)]
        # the summary is replaced per (day, category) in both modes
        days = {str(r["transaction_date"]): r["total_transactions"]
                for r in w.read("daily_merchant_summary").collect()}
        assert days == {"2026-08-01": 2, "2026-08-02": 1}


def test_dims_replace_keeps_others(spark, wh):
    run_load(spark, raw_frame(spark, [tx("T1", uid="U1", name="Old Name"),
                                      tx("T2", uid="U2")]), wh, full=True)
    run_load(spark, raw_frame(spark, [tx("T3", uid="U1", name="New")]), wh, full=True)
    users = {r["user_id"]: r["masked_user_name"] for r in wh.read("dim_users").collect()}
    assert users == {"U1": "N****", "U2": "R**** S****"}


def test_gate_blocks_load(spark, wh):
    # missing merchant id is not filtered by cleaning but fails the gate
    bad = raw_frame(spark, [tx("T1"), tx("T2", mid=None)])
    with pytest.raises(DataQualityError, match="Completeness check failed"):
        run_load(spark, bad, wh, full=True)
    assert wh.read("fact_transactions").count() == 0
    # a null phone masks to UNKNOWN and fails the PII rule
    with pytest.raises(DataQualityError, match="PII"):
        run_load(spark, raw_frame(spark, [tx("T9", phone=None)]), wh, full=True)


def test_empty_day_is_noop(spark, wh):
    res = run_load(spark, raw_frame(spark, [tx("T1")]), wh, day="2020-01-01")
    assert not res.loaded and wh.read("fact_transactions").count() == 0


def test_unparsable_timestamp(spark, wh):
    raw = raw_frame(spark, [tx("T1"), tx("T2", ts="garbage")])
    # an incremental load drops it, a full load aborts before writing
    run_load(spark, raw, wh, day="2026-08-01")
    assert wh.read("fact_transactions").count() == 1
    with pytest.raises(Exception, match="unparsable timestamp"):
        run_load(spark, raw, wh, full=True)


def test_missing_timestamp_passes_full_load(spark, wh):
    run_load(spark, raw_frame(spark, [tx("T1"), tx("T2", ts=None)]), wh, full=True)
    fact = {r["transaction_id"]: r["transaction_date"]
            for r in wh.read("fact_transactions").collect()}
    assert set(fact) == {"T1", "T2"} and fact["T2"] is None
    assert wh.read("daily_merchant_summary").count() == 1


def test_staged_copies_are_dropped(spark, wh):
    import os
    from paylake.session import shared_root
    root = shared_root(spark).replace("file:", "")
    stage_dir = os.path.join(root, "paylake-stage")
    before = set(os.listdir(stage_dir)) if os.path.isdir(stage_dir) else set()
    run_load(spark, raw_frame(spark, [tx("T1"), tx("T2", uid="U2")]), wh, full=True)
    run_load(spark, raw_frame(spark, [tx("T1"), tx("T3")]), wh, full=True, fact_mode="replace")
    after = set(os.listdir(stage_dir)) if os.path.isdir(stage_dir) else set()
    assert after - before == set()
    assert wh.read("fact_transactions").count() == 3


def test_category_drift_between_summary_and_q2(spark, wh):
    """SURVEY 8.7: the summary groups by the row's category; Q2 by the
    merchant dimension's current one."""
    from paylake.operators import analytics as Q
    run_load(spark, raw_frame(spark, [tx("T1", mid="M1", cat="Retail", amount=10.0)]), wh,
             full=True)
    run_load(spark, raw_frame(spark, [tx("T2", mid="M1", cat="F&B", amount=5.0,
                                         ts="2026-08-02 10:00:00")]), wh, full=True)
    summary = {(str(r["transaction_date"]), r["merchant_category"])
               for r in wh.read("daily_merchant_summary").collect()}
    assert summary == {("2026-08-01", "Retail"), ("2026-08-02", "F&B")}
    q2 = [tuple(r) for r in Q.q2_category_ranking(wh.read("fact_transactions"),
                                                  wh.read("dim_merchants")).collect()]
    assert q2 == [("F&B", 2, 15.0, 1)]


def test_stale_summary_rows_stay(spark, wh):
    """SURVEY 8.13: a (day, category) missing from a re-run is not deleted."""
    day = [tx("T1", cat="Retail"), tx("T2", cat="F&B", mid="M2")]
    run_load(spark, raw_frame(spark, day), wh, day="2026-08-01")
    run_load(spark, raw_frame(spark, day[:1]), wh, day="2026-08-01")
    cats = sorted(r["merchant_category"] for r in wh.read("daily_merchant_summary").collect())
    assert cats == ["F&B", "Retail"]


def test_csv_export_text_formats(spark, wh, tmp_path):
    run_load(spark, raw_frame(spark, [tx("T1", ts="2026-08-01 10:00:05")]), wh, full=True)
    out = str(tmp_path / "fact_csv")
    wh.export_csv("fact_transactions", out)
    rows = spark.read.option("header", True).csv(out).collect()
    assert [(r["transaction_id"], r["timestamp"], r["transaction_date"]) for r in rows] == [
        ("T1", "2026-08-01 10:00:05", "2026-08-01")]


def test_merchant_null_attributes(spark, wh):
    """FIXTURES 2: a null category on a merchant's first row fails the gate;
    on a later row it only falls out of the summary."""
    later = [tx("T1", mid="M1", cat="Retail"), tx("T2", mid="M1", cat=None, amount=7.0)]
    run_load(spark, raw_frame(spark, later), wh, full=True)
    merchants = [tuple(r) for r in wh.read("dim_merchants").collect()]
    assert merchants == [("M1", "Kopi", "Retail")]
    summary = [(r["merchant_category"], r["total_transactions"])
               for r in wh.read("daily_merchant_summary").collect()]
    assert summary == [("Retail", 1)]
    assert wh.read("fact_transactions").count() == 2
    first = [tx("T3", mid="M2", cat=None), tx("T4", mid="M2", cat="F&B")]
    with pytest.raises(DataQualityError, match="merchant_category"):
        run_load(spark, raw_frame(spark, first), wh, full=True)
    first_name = [tx("T5", mid="M3", mname=None)]
    with pytest.raises(DataQualityError, match="merchant_name"):
        run_load(spark, raw_frame(spark, first_name), wh, full=True)


def test_null_user_id_is_cleaned_out(spark, wh):
    run_load(spark, raw_frame(spark, [tx("T1"), tx("T2", uid=None)]), wh, full=True)
    assert [r["transaction_id"] for r in wh.read("fact_transactions").collect()] == ["T1"]


def test_create_tables_adds_no_files_on_repeat(spark, tmp_path):
    import glob
    w = Warehouse(spark, str(tmp_path / "wh_rep"))
    w.create_tables()
    first = sorted(glob.glob(str(tmp_path / "wh_rep" / "**" / "*"), recursive=True))
    w.create_tables()
    assert sorted(glob.glob(str(tmp_path / "wh_rep" / "**" / "*"), recursive=True)) == first


def test_failed_replace_keeps_previous_version(spark, wh, tmp_path):
    """A write that dies mid-job leaves the previous snapshot current."""
    from pyspark.sql import functions as F
    run_load(spark, raw_frame(spark, [tx("T1", uid="U1"), tx("T2", uid="U2")]), wh, full=True)
    before = sorted(tuple(r) for r in wh.read("dim_users").collect())
    # a partial version folder (no _SUCCESS) is ignored by readers
    import os
    partial = os.path.join(wh.path("dim_users"), "v=00000099")
    os.makedirs(partial)
    open(os.path.join(partial, "part-0.parquet"), "w").write("garbage")
    assert sorted(tuple(r) for r in wh.read("dim_users").collect()) == before
    # a batch whose evaluation fails inside the write job
    bad = spark.range(1).select(
        F.raise_error(F.lit("boom")).cast("string").alias("user_id"),
        F.lit("X****").alias("masked_user_name"), F.lit("0812****0000").alias("masked_phone"),
        F.lit("h").alias("phone_hash"))
    with pytest.raises(Exception, match="boom"):
        wh.upsert_replace_table("dim_users", bad)
    assert sorted(tuple(r) for r in wh.read("dim_users").collect()) == before


def test_catalog_follows_versions(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "wh_cat"), database="paylake_test_versions")
    w.create_tables()
    run_load(spark, raw_frame(spark, [tx("T1", uid="U1")]), w, full=True)
    run_load(spark, raw_frame(spark, [tx("T2", uid="U2")]), w, full=True)
    assert spark.table("paylake_test_versions.dim_users").count() == 2
    assert spark.table("paylake_test_versions.fact_transactions").count() == 2
    assert len(w._versions("dim_users")) == 2  # older versions are pruned


def test_staged_batch_holds_no_raw_pii(spark):
    from paylake.plans.load import prepare
    scope = []
    staged, _ = prepare(spark, raw_frame(spark, [tx("T1")]), scope=scope)
    assert "user_name" not in staged.columns and "phone_number" not in staged.columns
    assert {"masked_user_name", "masked_phone", "phone_hash"} <= set(staged.columns)
    from paylake.session import delete_paths
    delete_paths(spark, scope)


def _load(spark, wh, rows, mode="replace"):
    return run_load(spark, raw_frame(spark, rows), wh, full=True, fact_mode=mode)


def test_moved_id_empties_its_day(spark, wh):
    """The only fact of a day moves to another day: the old day is gone."""
    _load(spark, wh, [tx("T1", ts="2026-08-01 10:00:00")])
    _load(spark, wh, [tx("T1", ts="2026-08-02 10:00:00", amount=5.0)])
    assert _facts(wh) == [("T1", 5.0)]
    assert [str(d) for _, d in _facts(wh, "transaction_date")] == ["2026-08-02"]


def test_null_day_in_replace_mode(spark, wh):
    """Rows without a timestamp stay when other such rows are loaded."""
    _load(spark, wh, [tx("T1", ts=None), tx("T2", ts=None)])
    _load(spark, wh, [tx("T3", ts=None)])
    assert [t for t, _ in _facts(wh)] == ["T1", "T2", "T3"]
    # null and real days mixed: T1 gets a day, T4 none, T2 and T3 stay
    _load(spark, wh, [tx("T1", ts="2026-08-01 10:00:00", amount=7.0), tx("T4", ts=None)])
    assert [(t, str(d)) for t, d in _facts(wh, "transaction_date")] == [
        ("T1", "2026-08-01"), ("T2", "None"), ("T3", "None"), ("T4", "None")]
    # the last null-day rows move: the null day is gone
    _load(spark, wh, [tx(t, ts="2026-08-03 10:00:00") for t in ("T2", "T3", "T4")])
    assert {str(d) for _, d in _facts(wh, "transaction_date")} == {"2026-08-01", "2026-08-03"}


def test_ignore_load_on_a_store_with_duplicates(spark, wh):
    """Duplicate stored keys do not cancel new rows."""
    batch = M.star_schema(C.transform(raw_frame(spark, [tx("T1")])))["fact_transactions"]
    for _ in range(2):
        wh._append("fact_transactions", batch)
    res = _load(spark, wh, [tx("T1"), tx("T9", amount=9.0)], mode="ignore")
    assert res.fact_rows_added == 1
    assert _facts(wh) == [("T1", 100.0), ("T1", 100.0), ("T9", 9.0)]


def test_load_after_a_failed_write(spark, wh):
    """A write that dies in a non-key column leaves a folder without a marker;
    readers see the old version and the next load succeeds."""
    import os

    from pyspark.sql import functions as F
    _load(spark, wh, [tx("T1", uid="U1")])
    before = _snap(wh)["dim_users"]
    bad = spark.range(3).select(
        F.concat(F.lit("U"), F.col("id").cast("string")).alias("user_id"),
        F.lit("X****").alias("masked_user_name"), F.lit("0812****0000").alias("masked_phone"),
        F.udf(lambda i: 1 // (i - 2) and "h", "string")("id").alias("phone_hash"))
    with pytest.raises(Exception):
        wh._commit_version("dim_users", bad)
    os.makedirs(wh.path("dim_users") + "/v=00000050/_temporary", exist_ok=True)
    assert _snap(wh)["dim_users"] == before
    _load(spark, wh, [tx("T2", uid="U2")])
    assert [r[0] for r in _snap(wh)["dim_users"]] == ["U1", "U2"]


def test_replay_writes_no_new_version(spark, wh):
    _load(spark, wh, [tx("T1", uid="U1")], mode="ignore")
    before = wh._versions("dim_users"), wh._versions("daily_merchant_summary")
    _load(spark, wh, [tx("T1", uid="U1")], mode="ignore")
    assert (wh._versions("dim_users"), wh._versions("daily_merchant_summary")) == before


def test_summary_from_stored_facts(spark, wh):
    """Two batches of one day: the summary counts both."""
    for rows in ([tx("T1"), tx("T2")], [tx("T3", amount=50.0)]):
        run_load(spark, raw_frame(spark, rows), wh, full=True, summary_from_store=True)
    got = [(r["total_transactions"], r["total_volume_idr"])
           for r in wh.read("daily_merchant_summary").collect()]
    assert got == [(3, 250.0)]


def test_export_and_jdbc_are_part_of_the_load(spark, wh, tmp_path, monkeypatch):
    from paylake.plans import load
    seen = []
    monkeypatch.setattr(load, "append_all", lambda tables, url, props, n: seen.append(
        (sorted(tables), url, props, n, tables["fact_transactions"].count())))
    run_load(spark, raw_frame(spark, [tx("T1")]), wh, full=True, export_dir=str(tmp_path / "csv"),
             jdbc={"url": "jdbc:x", "props": {"user": "u"}, "num_partitions": 2})
    assert seen == [(["daily_merchant_summary", "dim_merchants", "dim_users",
                      "fact_transactions"], "jdbc:x", {"user": "u"}, 2, 1)]
    for t in seen[0][0]:
        assert spark.read.option("header", True).csv(str(tmp_path / "csv" / t)).count() == 1

    def fails(*_a):
        raise RuntimeError("database is down")

    monkeypatch.setattr(load, "append_all", fails)
    with pytest.raises(RuntimeError, match="database is down"):
        run_load(spark, raw_frame(spark, [tx("T2")]), wh, full=True, jdbc={"url": "jdbc:x"})


def test_other_timestamp_formats(spark, wh):
    rows = [tx("T1", ts="01/08/2026 10:30"), tx("T2", ts="02/08/2026 23:59")]
    run_load(spark, raw_frame(spark, rows), wh, day="2026-08-02",
             timestamp_format="dd/MM/yyyy HH:mm")
    assert [(t, str(d)) for t, d in _facts(wh, "timestamp")] == [("T2", "2026-08-02 23:59:00")]
