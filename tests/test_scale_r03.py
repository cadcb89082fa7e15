"""Steps that grew faster than their input: what they read, move and write now."""

import glob

import pyarrow as pa
import pytest

from conftest import SF001, raw_frame, tx
from paylake.functions import privacy as P
from paylake.functions.timeparse import parse_lenient, parse_strict
from paylake.operators import cleaning as C
from paylake.operators import key_filter as K
from paylake.operators import model as M
from paylake.plans import load as L
from paylake.plans import queries as Q
from paylake.plans.load import run_load
from paylake.schemas import NEAR
from paylake.session import stage
from paylake.sources import csv_records
from paylake.sources import warehouse as W
from paylake.sources.testdata import _six_digits, raw_transactions
from pyspark.sql import functions as F


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _load(spark, wh, ids, mode="ignore"):
    return run_load(spark, raw_frame(spark, [tx(i) for i in ids]), wh, full=True, fact_mode=mode)


@pytest.mark.parametrize("mode", ["ignore", "replace"])
def test_first_load_and_replay_stage_no_second_copy(spark, tmp_path, monkeypatch, mode):
    staged, compared, real = [], [], W.Warehouse.unchanged_rows
    monkeypatch.setattr(W, "stage", lambda df, s, name, scope=None: (
        staged.append(name), stage(df, s, name, scope))[1])
    monkeypatch.setattr(W.Warehouse, "unchanged_rows", staticmethod(
        lambda *a, **k: (compared.append(1), real(*a, **k))[1]))
    wh = W.Warehouse(spark, str(tmp_path / "wh"), layout="month", index_buckets=4)
    wh.create_tables()
    _load(spark, wh, ["T1", "T2"], mode)  # nothing stored: all rows are new
    assert not compared and "fact_transactions-new" not in staged
    _load(spark, wh, ["T1", "T2"], mode)  # all stored
    assert "fact_transactions-new" not in staged
    _load(spark, wh, ["T2", "T3"], mode)  # some
    assert "fact_transactions-new" in staged
    assert sorted(r[0] for r in wh.read("fact_transactions").select("transaction_id")
                  .collect()) == ["T1", "T2", "T3"]
    assert wh.key_index().count() == 3


def test_staged_and_stored_files_are_compact(spark, tmp_path):
    wh = W.Warehouse(spark, str(tmp_path / "wh"), layout="month", index_buckets=4)
    wh.create_tables()
    _load(spark, wh, ["T1"])
    for t in ("fact_transactions", "dim_users"):
        files = glob.glob(f"{tmp_path}/wh/{t}/*/*.parquet")
        assert files and all(".zstd." in f for f in files)


def test_sketch_takes_a_row_a_key(spark):
    small = spark.range(3_000).select(F.concat(F.lit("K"), "id").alias("k"))
    assert "explode(" not in _plan(K.sketch(small, ["k"], 3_000))
    large = spark.range(100_000).select(F.concat(F.lit("K"), "id").alias("k"))
    passed = K.may_hold(large, small, ["k"], 3_000)
    assert passed.join(small, "k").count() == 3_000
    assert passed.count() < 3_000 + 97_000 // 50


def test_order_key_shuffle_carries_no_supplier_texts(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(raw_transactions(spark, SF001))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.index("BroadcastHashJoin [l_suppkey") < plan.index("SortMergeJoin [l_orderkey")


def test_padded_keys_are_those_of_the_formatter(spark):
    df = spark.createDataFrame([(k,) for k in (0, 7, 999_999, 1_000_000, 12345678, -1, -1234567,
                                               None)], "k bigint")
    got = df.select(_six_digits(F.col("k")), F.format_string("%06d", "k")).collect()
    assert all(a == b for a, b in got)


TEXTS = ["2026-08-01 10:00:00", "2026-02-30 10:00:00", "2026-08-01 24:00:00", "0000-01-01 00:00:00",
         "0001-01-01 00:00:00", "2026-08-01T10:00:00", "2026-8-01 010:00:00", " 026-08-01 10:00:00",
         "2026-08-01 10:00:0 ", "2026-08-01 10:00:0Z", "2026-08-01 10:00:00.5", "+12026-08-01 10:00:00",
         "-2026-08-01 10:00:00", "2026-08-01", "2026-08-01 1:00:000", "", None, "9999-12-31 23:59:59",
         "20a6-08-01 10:00:00", "2026-08-01 10:60:00"]


def test_cast_timestamps_are_those_of_the_formatter(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    fmt = F.lit("yyyy-MM-dd HH:mm:ss")
    old = F.when(F.try_to_timestamp("t", fmt).isNotNull(), F.to_timestamp_ntz("t", fmt))
    assert "cast(t" in _plan(df.select(parse_lenient(F.col("t"))))  # the formatter is the rest
    got = df.select("t", parse_lenient(F.col("t")).cast("string"), old.cast("string")).collect()
    assert [r for r in got if r[1] != r[2]] == []
    good = df.where(old.isNotNull())
    assert good.select(parse_strict(F.col("t"))).where("1 = 1").count() == good.count()


def test_day_filter_parses_once(spark):
    raw = raw_frame(spark, [tx(f"T{i}", ts=t) for i, t in enumerate(TEXTS)])
    for start, end in (("2026-08-01", None), (None, "2026-08-01"), ("0001-01-01", "2026-08-02")):
        df = C.between_days(raw, start, end)
        ts = F.col("timestamp")
        fmt = F.lit("yyyy-MM-dd HH:mm:ss")
        p = F.when(F.try_to_timestamp(ts, fmt).isNotNull(), F.to_timestamp_ntz(ts, fmt))
        want = raw.where(p.isNotNull())
        if start:
            want = want.where(p >= F.lit(f"{start} 00:00:00").cast("timestamp_ntz"))
        if end:
            want = want.where(p < F.lit(f"{end} 00:00:00").cast("timestamp_ntz"))
        assert sorted(r[0] for r in df.collect()) == sorted(r[0] for r in want.collect())
    assert "CASE WHEN (timestamp" in df._jdf.queryExecution().optimizedPlan().toString()


def test_report_of_a_large_log_reads_one_staged_model(spark, monkeypatch):
    lazy = sorted(map(tuple, Q.dq_report(spark, SF001).collect()), key=str)
    monkeypatch.setattr(Q, "STAGE_ROWS", 1)
    df = Q.dq_report(spark, SF001)
    assert "lineitem" not in _plan(df)
    assert sorted(map(tuple, df.collect()), key=str) == lazy


def test_fragment_pass_makes_no_whole_records():
    text = ["a", 'b "x', 'y" c', "d", 'e "', "f"]
    batch = pa.RecordBatch.from_pydict({
        "file": ["p"] * 6, "block": [0, 0, 0, 0, 9, 9], "value": text,
        "open": [False] * 4 + [False] * 2})
    whole = [r for b in csv_records._whole([batch]) for r in b.to_pylist()]
    parts = [r for b in csv_records._fragments([batch]) for r in b.to_pylist()]
    assert [(r["block"], r["pos"], r["record"]) for r in whole] == [
        (0, 0, "a"), (0, 1, 'b "x\ny" c'), (0, 2, "d")]
    assert [(r["kind"], r["record"]) for r in parts] == [(csv_records.BEGIN, 'e "\nf')]


def _near(spark, rows, near):
    """Raw log of ``rows`` with ``near`` values."""
    at = spark.createDataFrame(list(enumerate(near)), "p bigint, n bigint")
    raw = raw_frame(spark, rows)
    return raw.join(at, raw["ingest_ord._pos"] == at.p).select(*raw.columns, F.col("n").alias(NEAR))


BAD = dict(ts="2026-08-01 1:00:00")
NEAR_CASES = {
    "copies share the value": ([tx("T1"), tx("T1", amount=5.0), tx("T2", amount=None), tx("T2"),
                                tx(None), tx(None), tx("T3", amount=-1.0), tx("T4", uid="U2")],
                               [1, 1, 2, 2, 3, 4, 5, 6], 1),
    "copies apart": ([tx("T1"), tx("T1", amount=5.0), tx("T2", amount=None), tx("T2")],
                     [1, 2, 3, 4], 2),
    "a later copy is refused": ([tx("T1"), tx("T1", **BAD)], [1, 2], 2),
}


@pytest.mark.parametrize("case", NEAR_CASES)
def test_copies_meet_where_they_lie(spark, monkeypatch, case):
    rows, near, writes = NEAR_CASES[case]
    raw, names = _near(spark, rows, near), []
    monkeypatch.setattr(L, "stage", lambda df, s, name, scope=None: (
        names.append(_plan(df)), stage(df, s, name, scope))[1])
    want, counters = L.prepare(spark, raw.drop(NEAR))
    names.clear()
    got, found = L.prepare(spark, raw)
    assert got.columns == want.columns and found == counters
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert len(names) == writes  # the plain way follows only where an id is left twice


def test_a_refused_timestamp_still_ends_a_load(spark):
    with pytest.raises(Exception, match="unparsable timestamp"):
        L.prepare(spark, _near(spark, [tx("T1", **BAD)], [1]))
    assert L.prepare(spark, _near(spark, [tx("T1", **BAD)], [1]), strict_timestamps=False)[0] \
        .first()["timestamp"] is None


def test_rows_of_an_order_are_deduped_without_a_shuffle(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(C.dedupe_near(raw_transactions(spark, SF001, near=True), NEAR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange" not in plan[:plan.index("SortMergeJoin")]


@pytest.mark.parametrize("bound", [0, 100])
def test_dimensions_of_a_large_batch_shuffle_no_attributes(spark, monkeypatch, bound):
    monkeypatch.setattr(M, "MAX_LEAST_ROWS", bound)
    df = spark.createDataFrame(
        [("U1", (3, 1), "a", "p", "h"), ("U1", (2, 9), "b", "p", "h"), ("U1", (2, 8), "c", "p", "h"),
         ("U2", (5, 1), "d", None, "h"), ("U2", (None, 7), "e", "p", None), (None, (1, 1), "f", "", ""),
         ("U2", (None, 6), "g", None, "x"), (None, (0, 2), "i", "", "")],
        "user_id string, ingest_ord struct<a: bigint, b: bigint>, masked_user_name string, "
        "masked_phone string, phone_hash string")
    kept = []
    got = M.first_per_key_staged(df, "user_id", df.columns[2:], lambda d, name: (
        kept.append(d.columns), stage(d, spark, name))[1])
    assert sorted(map(str, got.collect())) == sorted(map(str, M.dim_users(df).collect()))
    assert kept == [["user_id", "_lead"]]


def test_replace_of_a_large_batch_leaves_other_rows_where_they_lie(spark, tmp_path, monkeypatch):
    writes, real = [], W.Warehouse._write
    monkeypatch.setattr(W.Warehouse, "_write", lambda self, name, df, path, mode, in_place=False: (
        writes.append((in_place, _plan(df), sorted(r["transaction_id"] for r in df.collect()))),
        real(self, name, df, path, mode, in_place))[1])
    tables = []
    for bound in (100, 1):
        monkeypatch.setattr(W, "BROADCAST_KEY_ROWS", bound)
        wh = W.Warehouse(spark, str(tmp_path / f"wh{bound}"), layout="month", index_buckets=4)
        wh.create_tables()
        _load(spark, wh, [f"T{i}" for i in range(40)], "replace")
        rows = [tx(f"T{i}", amount=7.0) for i in (3, 4)] + [tx("T50")]
        writes.clear()
        run_load(spark, raw_frame(spark, rows), wh, full=True, fact_mode="replace")
        tables.append(sorted(map(str, wh.read("fact_transactions").collect())))
    assert tables[0] == tables[1] and len(tables[0]) == 41
    moved, unmoved = [next(w for w in writes if w[0] is place) for place in (False, True)]
    assert len(unmoved[2]) > 30 and {"T3", "T4"} <= set(moved[2])
    assert len(moved[2]) + len(unmoved[2]) == 40 and "Exchange hash" not in unmoved[1]


def test_names_in_ascii_are_split_without_unicode_classes(spark):
    names = ["Rina Sari", "  a  b ", "", " ", "a\tb", "a\x1cb", "a b", "Éva Núñez",
             "a b c", "x\ny", "~!", None, "a\x7fb c", "a\u0085b", "\U0001f600 d"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    parts = F.filter(F.split("n", P._NAME_SPLIT), lambda t: F.length(t) > 0)
    old = F.when(F.col("n").isNull(), "Anonymous").otherwise(F.array_join(F.transform(
        parts, lambda t: F.concat(F.substring(t, 1, 1), F.lit("****"))), " "))
    out = df.select("n", P.mask_name("n"), old)
    assert [r for r in out.collect() if r[1] != r[2]] == []
    assert "RLIKE" in _plan(out).upper()
