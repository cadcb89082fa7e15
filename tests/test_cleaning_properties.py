"""Property test: the cleaning chain equals a plain pandas run of the same
steps (keep-first dedupe -> drop missing -> amount > 0 -> upper-case status)
on generated logs with repeated ids, missing values, NaN and bad amounts."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import raw_frame, tx
from paylake.operators import cleaning as C

ids = st.sampled_from(["T1", "T2", "T3", "T4", None])
users = st.sampled_from(["U1", "U2", None])
amounts = st.sampled_from([10.0, 25.5, 0.0, -50000.0, None, float("nan"), 99.99])
statuses = st.sampled_from(["SUCCESS", "success", "FAILED", "PENDING", None])
rows = st.lists(st.tuples(ids, users, amounts, statuses), min_size=1, max_size=25)


def pandas_clean(recs):
    df = pd.DataFrame(recs, columns=["transaction_id", "user_id", "amount", "status"])
    df = df.drop_duplicates(subset=["transaction_id"])
    df = df.dropna(subset=["transaction_id", "user_id", "amount", "status"])
    df = df[df["amount"] > 0]
    df["status"] = df["status"].astype(str).str.upper()
    return sorted((r.transaction_id, r.user_id, float(r.amount), r.status)
                  for r in df.itertuples())


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows)
def test_clean_matches_pandas(spark, recs):
    raw = raw_frame(spark, [tx(i, uid=u, amount=a, status=s) for i, u, a, s in recs])
    got = sorted((r["transaction_id"], r["user_id"], r["amount"], r["status"])
                 for r in C.clean(raw).collect())
    want = pandas_clean(recs)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:2] == w[:2] and g[3] == w[3]
        assert (math.isnan(g[2]) and math.isnan(w[2])) or g[2] == w[2]


days = st.sampled_from(["2026-08-01 10:00:00", "2026-08-02 11:30:00", "2026-08-03 09:15:00"])
cats = st.sampled_from(["F&B", "Retail", "Transport", None])
clean_rows = st.lists(st.tuples(st.sampled_from(["SUCCESS", "FAILED", "PENDING"]),
                                st.sampled_from([10.01, 0.1, 250000.0, 1.05, 33.33]),
                                days, cats), min_size=1, max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(clean_rows)
def test_summary_matches_pandas(spark, recs):
    from paylake.operators import model as M
    raw = raw_frame(spark, [tx(f"T{i}", status=s, amount=a, ts=d, cat=c)
                            for i, (s, a, d, c) in enumerate(recs)])
    got = {(str(r["transaction_date"]), r["merchant_category"]): r
           for r in M.daily_summary(C.clean(raw)).collect()}
    df = pd.DataFrame(recs, columns=["status", "amount", "ts", "cat"])
    df["day"] = df["ts"].str[:10]
    g = df.groupby(["day", "cat"])  # null categories are not grouped
    assert set(got) == {k for k, _ in g}
    for (day, cat), part in g:
        r = got[(day, cat)]
        t = len(part)
        s = int((part["status"] == "SUCCESS").sum())
        assert r["total_transactions"] == t and r["successful_transactions"] == s
        assert r["failed_transactions"] == int((part["status"] == "FAILED").sum())
        assert r["success_rate_pct"] == round((s / t) * 100, 2)
        assert r["total_volume_idr"] == round(float(part["amount"].sum()), 2)
        assert r["successful_volume_idr"] == round(
            float(part.loc[part["status"] == "SUCCESS", "amount"].sum()), 2)


names = st.sampled_from(["Ana Bell", "Budi", "  Citra  Dewi ", None, "Eko"])
dim_rows = st.lists(st.tuples(st.sampled_from(["U1", "U2", "U3"]), names,
                              st.sampled_from([5.0, -1.0, None])),
                    min_size=1, max_size=30)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(dim_rows)
def test_dim_users_first_clean_row_matches_pandas(spark, recs):
    from paylake.operators import model as M
    from test_privacy_properties import py_mask_name
    raw = raw_frame(spark, [tx(f"T{i}", uid=u, name=n, amount=a)
                            for i, (u, n, a) in enumerate(recs)])
    got = {r["user_id"]: r["masked_user_name"]
           for r in M.dim_users(C.transform(raw)).collect()}
    df = pd.DataFrame(recs, columns=["user_id", "name", "amount"])
    df = df.dropna(subset=["amount"])
    df = df[df["amount"] > 0]
    first = df.drop_duplicates(subset=["user_id"])
    want = {r.user_id: py_mask_name(r.name if isinstance(r.name, str) else None)
            for r in first.itertuples()}
    assert got == want


fact_rows = st.lists(st.tuples(st.sampled_from(["SUCCESS", "FAILED", "PENDING"]),
                               st.sampled_from([10.01, 0.1, 250000.0, 1.05]),
                               days), min_size=1, max_size=60)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(fact_rows)
def test_q1_matches_exact_sql_semantics(spark, recs):
    from decimal import ROUND_HALF_UP, Decimal

    from paylake.operators import analytics as Q
    from paylake.operators import model as M
    raw = raw_frame(spark, [tx(f"T{i}", status=s, amount=a, ts=d)
                            for i, (s, a, d) in enumerate(recs)])
    got = {str(r["transaction_date"]): tuple(r)[1:]
           for r in Q.q1_daily_gtv(M.fact_transactions(C.clean(raw))).collect()}
    want = {}
    for day in {d[:10] for _, _, d in recs}:
        part = [(s, a) for s, a, d in recs if d[:10] == day]
        t = len(part)
        ok = [a for s, a in part if s == "SUCCESS"]
        rate = (Decimal(len(ok)) * 100 / Decimal(t)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        gtv = sum(Decimal(str(a)) for a in ok)
        want[day] = (t, len(ok), float(gtv), float(rate))
    assert got == want
