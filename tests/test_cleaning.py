"""Cleaning order, ingest order, parsing, counters."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001, raw_frame, tx
from paylake.operators import cleaning as C
from paylake.sources.testdata import raw_transactions


def test_dedupe_keeps_first_in_ingest_order(spark):
    rows = [tx("T1", amount=1.0), tx("T2", amount=2.0), tx("T1", amount=3.0),
            tx(None, amount=4.0), tx(None, amount=5.0)]
    out = {r["transaction_id"]: r["amount"]
           for r in C.dedupe_first(raw_frame(spark, rows)).collect()}
    assert out == {"T1": 1.0, "T2": 2.0, None: 4.0}  # null ids form one key


def test_order_dedupe_before_filters(spark):
    # first copy of T1 has a null amount: the id is lost even though the
    # second copy is good (reference order); filtering first would keep it.
    rows = [tx("T1", amount=None), tx("T1", amount=10.0), tx("T2", amount=-5.0),
            tx("T2", amount=7.0), tx("T3", amount=float("nan")), tx("T4", status=None),
            tx("T5", amount=0.0), tx("T6", amount=9.0, status="success")]
    cleaned = C.clean(raw_frame(spark, rows))
    got = {r["transaction_id"]: (r["amount"], r["status"]) for r in cleaned.collect()}
    assert got == {"T6": (9.0, "SUCCESS")}
    wrong = C.dedupe_first(C.positive_amount(C.drop_incomplete(raw_frame(spark, rows))))
    assert {r["transaction_id"] for r in wrong.collect()} == {"T1", "T2", "T6"}


def test_fixture_counts_sf0001(spark):
    raw = raw_transactions(spark, SF001)
    d = C.dedupe_first(raw)
    assert raw.count() == 6000
    assert d.count() == 4599
    assert C.drop_incomplete(d).count() == 4484
    cleaned = C.clean(raw)
    assert cleaned.count() == 4458
    by_status = dict(cleaned.groupBy("status").count().collect())
    assert by_status == {"SUCCESS": 2989, "FAILED": 729, "PENDING": 740}
    wrong = C.dedupe_first(C.positive_amount(C.drop_incomplete(raw)))
    assert wrong.count() == 4495


def test_counters(spark):
    rows = {r["step"]: r["rows"]
            for r in C.cleaning_counters(raw_transactions(spark, SF001)).collect()}
    assert rows == {"read": 6000, "batch": 6000, "dedupe": 4599, "drop_missing": 4484,
                    "positive_amount": 4458}


def test_timestamps_lenient_and_strict(spark):
    rows = [tx("T1", ts="2026-08-01 10:00:00"), tx("T2", ts="2026"),
            tx("T3", ts="garbage"), tx("T4", ts=None), tx("T5", ts="2026-08-02 00:00:00")]
    raw = raw_frame(spark, rows)
    day = {r["transaction_id"] for r in C.day_slice(raw, "2026-08-01").collect()}
    assert day == {"T1"}
    rng = {r["transaction_id"] for r in C.between_days(raw, "2026-08-01", None).collect()}
    assert rng == {"T1", "T5"}
    # strict parse: garbage aborts, missing stays missing
    with pytest.raises(Exception, match="unparsable timestamp"):
        C.clean(raw).collect()
    ok = C.clean(raw.filter(F.col("transaction_id").isin("T1", "T4")))
    got = {r["transaction_id"]: (r["timestamp"], r["transaction_date"]) for r in ok.collect()}
    assert got == {"T1": (dt.datetime(2026, 8, 1, 10), dt.date(2026, 8, 1)), "T4": (None, None)}


def test_bad_target_day_rejected(spark):
    raw = raw_frame(spark, [tx("T1")])
    with pytest.raises(ValueError):
        C.day_slice(raw, "2026-8-1")


def test_status_upper_not_trimmed(spark):
    rows = [tx("T1", status=" success"), tx("T2", status="pending")]
    got = {r["transaction_id"]: r["status"] for r in C.clean(raw_frame(spark, rows)).collect()}
    assert got == {"T1": " SUCCESS", "T2": "PENDING"}


def test_day_prefilter_is_pushed_to_scan(spark):
    raw = raw_transactions(spark, SF001, "1998-07-01", "1998-07-02")
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = C.day_slice(raw, "1998-07-01")._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert any("PushedFilters" in line and "GreaterThanOrEqual(l_shipdate" in line
               for line in plan.splitlines())


def test_results_do_not_depend_on_session_time_zone(spark):
    raw = raw_transactions(spark, SF001, "1998-07-01", "1998-07-03")

    def run():
        out = C.clean(C.between_days(raw, "1998-07-01", "1998-07-03"))
        return sorted((r["transaction_id"], r["timestamp"], r["transaction_date"])
                      for r in out.collect())

    utc = run()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert run() == utc and len(utc) > 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_fixture_day_and_group_counts_sf001(spark):
    from conftest import SF01
    from paylake.functions.timeparse import parse_lenient
    raw = raw_transactions(spark, SF01)
    days = raw.select(F.to_date(parse_lenient(F.col("timestamp"))).alias("d"), "merchant_category")
    assert days.select("d").distinct().count() == 2499
    assert days.distinct().count() == 12297
    # wrong order (filters before dedupe) at this scale
    assert C.dedupe_first(C.positive_amount(C.drop_incomplete(raw))).count() == 44761
    assert C.clean(raw).count() == 44421
