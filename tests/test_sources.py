"""CSV/Parquet raw scans (S1, S2) and the streaming ingest."""

import pytest

from conftest import RAW_FIELDS, raw_frame, tx
from paylake.operators import cleaning as C
from paylake.sources.raw import read_raw_csv, read_raw_parquet
from paylake.sources.warehouse import Warehouse
from paylake.streaming.ingest import start_file_ingest

CSV = """transaction_id,user_id,user_name,phone_number,merchant_id,merchant_name,merchant_category,amount,payment_method,status,timestamp
T1,U1,Ana Bell,081234567890,M1,Kopi,F&B,100.0,QRIS,SUCCESS,2026-08-01 10:00:00
T1,U1,Ana Bell,081234567890,M1,Kopi,F&B,999.0,QRIS,SUCCESS,2026-08-01 10:00:00
T2,U2,NA,081234567891,M1,Kopi,F&B,NA,QRIS,SUCCESS,2026-08-01 11:00:00
T3,U3,Budi,null,M1,Kopi,F&B,abc,QRIS,FAILED,2026-08-01 12:00:00
T4,U4,Citra,081234567893,M1,Kopi,F&B,5.5,QRIS,pending,2026-08-02 12:00:00
"""


def test_csv_scan_tokens_and_order(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text(CSV)
    raw = read_raw_csv(spark, str(p))
    rows = {(r["transaction_id"], r["amount"]) for r in raw.collect()}
    assert ("T2", None) in rows and ("T3", None) in rows
    assert {r["user_name"] for r in raw.collect() if r["transaction_id"] == "T2"} == {None}
    cleaned = {r["transaction_id"]: r["amount"] for r in C.clean(raw).collect()}
    assert cleaned == {"T1": 100.0, "T4": 5.5}


def test_missing_raw_path_raises(spark, tmp_path):
    with pytest.raises(Exception):
        read_raw_csv(spark, str(tmp_path / "nope.csv")).collect()


def test_parquet_scan_order(spark, tmp_path):
    rows = [tx("T1", amount=1.0), tx("T1", amount=2.0), tx("T2", amount=3.0)]
    path = str(tmp_path / "raw_parquet")
    raw_frame(spark, rows).select(*RAW_FIELDS).coalesce(1).write.parquet(path)
    got = {r["transaction_id"]: r["amount"]
           for r in C.dedupe_first(read_raw_parquet(spark, path)).collect()}
    assert got == {"T1": 1.0, "T2": 3.0}


def test_streaming_ingest_matches_batch(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    header, *lines = CSV.strip().split("\n")
    good = [line for line in lines if not line.startswith(("T3",))]
    (landing / "day1.csv").write_text("\n".join([header] + good[:3]) + "\n")
    w = Warehouse(spark, str(tmp_path / "wh"))
    w.create_tables()
    q = start_file_ingest(spark, str(landing), w, checkpoint=str(tmp_path / "chk"))
    q.awaitTermination(120)
    (landing / "day2.csv").write_text("\n".join([header] + good[3:]) + "\n")
    q = start_file_ingest(spark, str(landing), w, checkpoint=str(tmp_path / "chk"))
    q.awaitTermination(120)
    fact = {r["transaction_id"]: (r["amount"], r["status"])
            for r in w.read("fact_transactions").collect()}
    assert fact == {"T1": (100.0, "SUCCESS"), "T4": (5.5, "PENDING")}
    assert w.read("dim_users").count() == 2


def test_streaming_parquet_ingest(spark, tmp_path):
    from conftest import RAW_FIELDS
    landing = str(tmp_path / "landing_pq")
    rows = [tx("T1", amount=10.0), tx("T1", amount=99.0), tx("T2", amount=5.0, uid="U2")]
    raw_frame(spark, rows).select(*RAW_FIELDS).coalesce(1).write.parquet(landing)
    w = Warehouse(spark, str(tmp_path / "wh_pq"))
    w.create_tables()
    q = start_file_ingest(spark, landing, w, checkpoint=str(tmp_path / "chk_pq"), fmt="parquet")
    q.awaitTermination(120)
    fact = {r["transaction_id"]: r["amount"] for r in w.read("fact_transactions").collect()}
    assert fact == {"T1": 10.0, "T2": 5.0}


def test_scale_conf():
    from paylake.session import scale_conf
    conf = scale_conf(100 * 1024 ** 4, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert int(scale_conf(10 * 1024 ** 2, 64)["spark.sql.shuffle.partitions"]) == 192


def test_job_cli(spark, tmp_path):
    import pytest as _pytest
    from paylake.plans.job import main
    p = tmp_path / "raw.csv"
    p.write_text(CSV.replace("T3,U3,Budi,null", "T3,U3,Budi,081234567892"))
    wh = str(tmp_path / "wh_job")
    out = main(["--raw", str(p), "--warehouse", wh, "--date", "2026-08-01",
                "--count-read"], spark=spark)
    assert out["counters"]["corrupt_records"] == 0
    assert out["loaded"] and out["counters"]["read"] == 5 and out["counters"]["batch"] == 4
    assert out["fact_rows_added"] == 1  # T1 only: T2/T3 have no amount
    out = main(["--raw", str(p), "--warehouse", wh, "--full"], spark=spark)
    assert out["fact_rows_added"] == 1  # T4 (the 2026-08-02 row) is new
    with _pytest.raises(SystemExit):
        main(["--raw", str(p), "--warehouse", wh], spark=spark)


def test_replayed_micro_batch_changes_nothing(spark, tmp_path):
    landing = tmp_path / "landing_replay"
    landing.mkdir()
    header, *lines = CSV.strip().split("\n")
    good = [line for line in lines if not line.startswith("T3")]
    (landing / "day.csv").write_text("\n".join([header] + good) + "\n")
    w = Warehouse(spark, str(tmp_path / "wh_replay"))
    w.create_tables()

    def snap():
        return {t: sorted(tuple(r) for r in w.read(t).collect())
                for t in ("dim_users", "dim_merchants", "fact_transactions",
                          "daily_merchant_summary")}

    start_file_ingest(spark, str(landing), w, checkpoint=str(tmp_path / "c1")).awaitTermination(120)
    first = snap()
    # a fresh checkpoint re-reads the same file: the same batch is loaded again
    start_file_ingest(spark, str(landing), w, checkpoint=str(tmp_path / "c2")).awaitTermination(120)
    assert snap() == first and len(first["fact_transactions"]) == 2


def test_csv_log_through_cli_equals_model(spark, tmp_path):
    """End to end: the adapter's log written as ordered CSV parts, loaded by
    the job, gives exactly the tables the registered queries compute."""
    from conftest import SF001
    from paylake.operators import cleaning as C
    from paylake.operators import model as M
    from paylake.plans.job import main
    from paylake.schemas import ORD, RAW_COLUMNS
    from paylake.sources.testdata import raw_transactions
    raw = raw_transactions(spark, SF001)
    path = str(tmp_path / "raw_csv")
    raw.orderBy(ORD).select(*RAW_COLUMNS).write.option("header", True).csv(path)
    out = main(["--raw", path, "--warehouse", str(tmp_path / "wh_e2e"), "--full"], spark=spark)
    assert out["counters"]["positive_amount"] == 4458
    wh = Warehouse(spark, str(tmp_path / "wh_e2e"))
    model = M.star_schema(C.transform(raw))
    for t, df in model.items():
        got = wh.read(t)
        want = df.select(*got.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, t
