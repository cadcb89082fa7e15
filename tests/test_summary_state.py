"""The daily summary from mergeable states."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import raw_frame, tx
from paylake.operators import cleaning as C
from paylake.plans.load import run_load
from paylake.sources.summary_state import SummaryState, daily_summary_exact
from paylake.sources.warehouse import Warehouse

DAYS = [dt.date(2026, 7, 31), dt.date(2026, 8, 1), dt.date(2026, 8, 2)]


def _log(n=90, seed=5):
    """Rows of three days in two months, days and merchants in every third of the log."""
    rng = random.Random(seed)
    return [tx(f"T{i}", uid=f"USR-{i % 9}", amount=rng.uniform(0.01, 9e5),
               status=rng.choice(["SUCCESS", "FAILED", "PENDING"]),
               ts=f"{rng.choice(DAYS)} 10:00:{i % 60:02d}",
               mid=f"MCH-{i % 4}", cat=["F&B", "Retail"][i % 4 // 2]) for i in range(n)]


def _wh(spark, tmp_path, layout):
    w = Warehouse(spark, str(tmp_path / "wh"), layout=layout, index_buckets=2)
    w.create_tables()
    return w


def _load(spark, wh, rows, **kw):
    return run_load(spark, raw_frame(spark, rows), wh, full=True, summary_from_state=True, **kw)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _expected(spark, rows):
    return _rows(daily_summary_exact(C.transform(raw_frame(spark, rows))))


def test_volumes_equal_fsum(spark):
    rows = _log(60)
    got = _expected(spark, rows)
    assert len(got) == 6
    for r in got:
        own = [x for x in rows if x[10].startswith(r[0].isoformat()) and x[6] == r[1]]
        assert r[2] == len(own) and r[5] == math.fsum(x[7] for x in own)
        assert r[6] == math.fsum(x[7] for x in own if x[9] == "SUCCESS")


def test_split_days_equal_one_load(spark, tmp_path, monkeypatch):
    """Every batch holds rows of every day; no state is made from stored facts. Then
    deltas are merged, and a merchant changes its category."""
    monkeypatch.setattr(SummaryState, "rebuild", lambda self, days: days and 1 / 0)
    wh, rows = _wh(spark, tmp_path, "month"), _log()
    _load(spark, wh, rows[:50])
    _load(spark, wh, rows[40:])  # ten rows come twice
    want = _expected(spark, rows)
    assert _rows(wh.read("daily_merchant_summary")) == want
    state = SummaryState(wh)
    many = state.read(DAYS).count()
    state.compact(DAYS)
    assert state.read(DAYS).count() < many and state.out_of_step(DAYS) == []
    assert _rows(state.daily([*DAYS, None])) == want
    assert state.daily([dt.date(2031, 1, 1)]).collect() == []

    moved = [r[:6] + ("New",) + r[7:] if r[4] == "MCH-0" else r for r in rows]
    _load(spark, wh, [tx("X", amount=7.0, ts=f"{DAYS[0]} 01:00:00", mid="MCH-0", cat="New")])
    moved.append(tx("X", amount=7.0, ts=f"{DAYS[0]} 01:00:00", mid="MCH-0", cat="New"))
    assert _rows(state.daily(DAYS)) == _expected(spark, moved)


def test_state_out_of_step_is_made_again(spark, tmp_path, monkeypatch):
    """Facts older than the state; a load that dies between the fact and the state, whose
    replay inserts nothing; a keep-last load. A row without a day is in no summary."""
    wh, rows = _wh(spark, tmp_path, "day"), _log()
    run_load(spark, raw_frame(spark, rows[:40]), wh, full=True)
    later = rows[40:] + [tx("N", ts=None)]
    with monkeypatch.context() as m:
        m.setattr(SummaryState, "add", lambda self, new: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            _load(spark, wh, later)
    assert _load(spark, wh, later).fact_rows_added == 0
    state = SummaryState(wh)
    assert _rows(state.daily(DAYS)) == _expected(spark, rows)

    changed = [r[:7] + (r[7] + 0.01,) + r[8:] for r in rows[:10]]
    _load(spark, wh, changed, fact_mode="replace")
    want = _expected(spark, changed + rows[10:])
    assert _rows(wh.read("daily_merchant_summary")) == want

    # the check counts the rows of these days and reads no value of theirs
    plan = state._facts(DAYS[1:]).groupBy("transaction_date").agg(F.count("*")) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "amount" not in plan and "transaction_id" not in plan
    assert "PartitionFilters: [" in plan and "2026-08" in plan
