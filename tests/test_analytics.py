"""Q1-Q4 on a hand-checked fixture."""

import datetime as dt

from paylake.operators import analytics as Q
from paylake.operators import cleaning as C
from paylake.operators import model as M
from conftest import raw_frame, tx


def _model(spark):
    rows = [
        tx("T1", uid="U1", amount=100.0, status="SUCCESS", method="QRIS", mid="M1", cat="F&B"),
        tx("T2", uid="U1", amount=50.0, status="FAILED", method="QRIS", mid="M1", cat="F&B"),
        tx("T3", uid="U2", amount=300.0, status="SUCCESS", method="DEBIT_CARD", mid="M2",
           cat="Retail", ts="2026-08-02 09:00:00"),
        tx("T4", uid="U3", amount=20.0, status="PENDING", method="DEBIT_CARD", mid="M2",
           cat="Retail", ts="2026-08-02 10:00:00"),
        tx("T5", uid="U3", amount=0.5, status="SUCCESS", method="CREDIT_CARD", mid="M3",
           cat="Transport", ts="2026-08-02 11:00:00"),
    ]
    return M.star_schema(C.transform(raw_frame(spark, rows)))


def test_q1(spark):
    m = _model(spark)
    rows = [tuple(r) for r in Q.q1_daily_gtv(m["fact_transactions"]).collect()]
    assert rows == [(dt.date(2026, 8, 1), 2, 1, 100.0, 50.0),
                    (dt.date(2026, 8, 2), 3, 2, 300.5, 66.67)]


def test_q2_rank(spark):
    m = _model(spark)
    rows = [tuple(r) for r in Q.q2_category_ranking(m["fact_transactions"],
                                                    m["dim_merchants"]).collect()]
    assert rows == [("Retail", 2, 300.0, 1), ("F&B", 2, 100.0, 2), ("Transport", 1, 0.5, 3)]


def test_q3_and_q3b(spark):
    m = _model(spark)
    rows = [tuple(r) for r in Q.q3_payment_health(m["fact_transactions"]).collect()]
    assert rows == [("CREDIT_CARD", 1, 1, 0, 0, 100.0), ("DEBIT_CARD", 2, 1, 0, 1, 50.0),
                    ("QRIS", 2, 1, 1, 0, 50.0)]
    assert Q.q3b_payment_rate(m["fact_transactions"]).columns == [
        "payment_method", "total_attempts", "successful_tx", "success_rate_pct"]


def test_q4_counts_successful_rows_only(spark):
    m = _model(spark)
    rows = [tuple(r) for r in Q.q4_top_users(m["fact_transactions"], m["dim_users"], 2).collect()]
    assert rows == [("U2", "R**** S****", "0812****7890", 1, 300.0),
                    ("U1", "R**** S****", "0812****7890", 1, 100.0)]
    plan = Q.q4_top_users(m["fact_transactions"], m["dim_users"])._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan


def test_sql_form_equals_dataframe_form(spark):
    from conftest import SF001
    from paylake.operators import analytics_sql as S
    from paylake.sources.testdata import raw_transactions
    m = M.star_schema(C.transform(raw_transactions(spark, SF001)))
    fact, users, merchants = m["fact_transactions"], m["dim_users"], m["dim_merchants"]
    S.register_views(fact, users, merchants)
    frames = {"q1_daily_gtv": Q.q1_daily_gtv(fact),
              "q2_category_ranking": Q.q2_category_ranking(fact, merchants),
              "q3_payment_health": Q.q3_payment_health(fact),
              "q3b_payment_rate": Q.q3b_payment_rate(fact),
              "q4_top_users": Q.q4_top_users(fact, users)}
    for name, df in frames.items():
        sql_df = S.run(spark, name)
        assert sql_df.columns == df.columns, name
        assert [f.dataType for f in sql_df.schema] == [f.dataType for f in df.schema], name
        assert [tuple(r) for r in sql_df.collect()] == [tuple(r) for r in df.collect()], name


def test_sql_form_adds_infinite_amounts(spark):
    from paylake.operators import analytics_sql as S
    rows = [tx("A1", uid="U1", mid="M1", amount=float("inf")), tx("A2", uid="U1", mid="M1"),
            tx("A3", uid="U2", mid="M2", cat="Retail", amount=2.5),
            tx("A4", uid="U3", mid="M2", cat="Retail", amount=1e300)]
    m = M.star_schema(C.transform(raw_frame(spark, rows)))
    fact, users, merchants = m["fact_transactions"], m["dim_users"], m["dim_merchants"]
    S.register_views(fact, users, merchants)
    for name, df in (("q1_daily_gtv", Q.q1_daily_gtv(fact)),
                     ("q2_category_ranking", Q.q2_category_ranking(fact, merchants)),
                     ("q4_top_users", Q.q4_top_users(fact, users))):
        assert list(map(tuple, S.run(spark, name).collect())) == list(map(tuple, df.collect()))


def test_ties_are_broken_by_the_group_key(spark):
    """SURVEY 8.8: equal rates / volumes / spend order by the key."""
    rows = [tx("A1", method="QRIS", mid="M1", cat="F&B", uid="U2", amount=50.0),
            tx("A2", method="DEBIT_CARD", mid="M2", cat="Retail", uid="U1", amount=50.0)]
    m = M.star_schema(C.transform(raw_frame(spark, rows)))
    q3 = [r["payment_method"] for r in Q.q3_payment_health(m["fact_transactions"]).collect()]
    assert q3 == ["DEBIT_CARD", "QRIS"]
    q2 = [(r["merchant_category"], r["rank_by_volume"])
          for r in Q.q2_category_ranking(m["fact_transactions"], m["dim_merchants"]).collect()]
    assert q2 == [("F&B", 1), ("Retail", 1)]  # dense rank ties share a rank
    q4 = [r["user_id"] for r in Q.q4_top_users(m["fact_transactions"], m["dim_users"], 1).collect()]
    assert q4 == ["U1"]
