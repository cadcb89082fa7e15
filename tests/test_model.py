"""Star schema and daily summary."""

from paylake.operators import cleaning as C
from paylake.operators import model as M
from conftest import raw_frame, tx


def test_dims_take_first_clean_row(spark):
    rows = [tx("T1", uid="U1", name="Alpha Beta", phone="081111112222"),
            tx("T2", uid="U1", name="Gamma", phone="089999998888"),
            tx("T3", uid="U2", name=None, phone=None, mid="M2", mname="Shop", cat="Retail")]
    cl = C.transform(raw_frame(spark, rows))
    users = {r["user_id"]: tuple(r)[1:3] for r in M.dim_users(cl).collect()}
    assert users == {"U1": ("A**** B****", "0811****2222"), "U2": ("Anonymous", "UNKNOWN")}
    merchants = sorted(tuple(r) for r in M.dim_merchants(cl).collect())
    assert merchants == [("M2", "Shop", "Retail"), ("MCH-1", "Kopi", "F&B")]
    assert M.fact_transactions(cl).columns == ["transaction_id", "user_id", "merchant_id",
                                               "amount", "payment_method", "status",
                                               "timestamp", "transaction_date"]


def test_summary_counts_rounding_and_null_keys(spark):
    # 1 success of 8 -> 12.5%; pandas rounds 12.5 (x100 = 1250 exactly) -> 12.5
    # 1 of 3 -> 33.333.. -> 33.33 ; null category row is not grouped
    rows = ([tx(f"A{i}", status="SUCCESS" if i == 0 else "FAILED", amount=10.01)
             for i in range(8)]
            + [tx(f"B{i}", ts="2026-08-02 01:00:00", status="SUCCESS" if i == 0 else "PENDING",
                  amount=0.1) for i in range(3)]
            + [tx("C1", cat=None)])
    s = {(str(r["transaction_date"]), r["merchant_category"]): r
         for r in M.daily_summary(C.transform(raw_frame(spark, rows))).collect()}
    assert set(s) == {("2026-08-01", "F&B"), ("2026-08-02", "F&B")}
    a = s[("2026-08-01", "F&B")]
    assert (a["total_transactions"], a["successful_transactions"], a["failed_transactions"]) == (8, 1, 7)
    assert a["total_volume_idr"] == 80.08 and a["successful_volume_idr"] == 10.01
    assert a["success_rate_pct"] == 12.5
    b = s[("2026-08-02", "F&B")]
    assert b["success_rate_pct"] == 33.33 and b["total_volume_idr"] == 0.3


def test_half_even_rate_matches_numpy(spark):
    import numpy as np
    from pyspark.sql import functions as F
    from paylake.functions.numeric import rate_pct_half_even, rate_pct_half_up
    pairs = [(s, t) for t in range(1, 90) for s in range(0, t + 1)]
    df = spark.createDataFrame(pairs, "s long, t long")
    got = df.select("s", "t", rate_pct_half_even(F.col("s"), F.col("t")).alias("e"),
                    rate_pct_half_up(F.col("s"), F.col("t")).alias("u")).collect()
    from decimal import Decimal, ROUND_HALF_UP
    for r in got:
        assert r["e"] == float(np.round((r["s"] / r["t"]) * 100, 2))
        exact = (Decimal(r["s"]) * 100 / Decimal(r["t"])).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert r["u"] == float(exact)


def test_rates_over_zero_counts_are_null(spark):
    """SURVEY 8.9: a group whose counted ids are all null gets a null rate."""
    from pyspark.sql import functions as F
    from paylake.functions.numeric import rate_pct_half_even, rate_pct_half_up
    df = spark.createDataFrame([(0, 0)], "s long, t long")
    r = df.select(rate_pct_half_up(F.col("s"), F.col("t")).alias("u"),
                  rate_pct_half_even(F.col("s"), F.col("t")).alias("e")).collect()[0]
    assert r["u"] is None and r["e"] is None
