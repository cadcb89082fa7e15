"""Several ranges of one log: cleaned in one pass, as each by itself."""

import pytest

from conftest import SF001, raw_frame, tx
from paylake.operators import cleaning as C
from paylake.plans import load as L
from paylake.plans import queries as Q
from paylake.schemas import NEAR
from paylake.session import stage
from pyspark.sql import functions as F

RANGES = [(None, None), (None, "2026-08-03"), ("2026-08-02", None)]
DAYS = [f"2026-08-0{d} 10:00:00" for d in range(1, 5)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(str, df.collect()))


def _near(spark, rows, near):
    """Raw log of ``rows`` with ``near`` values."""
    at = spark.createDataFrame(list(enumerate(near)), "p bigint, n bigint")
    raw = raw_frame(spark, rows)
    return raw.join(at, raw["ingest_ord._pos"] == at.p).select(*raw.columns, F.col("n").alias(NEAR))


def _stages(monkeypatch):
    names = []
    monkeypatch.setattr(L, "stage", lambda df, s, name, scope=None: (
        names.append((df.columns, _plan(df))), stage(df, s, name, scope))[1])
    return names


def test_sets_are_those_deduped_one_by_one(spark):
    # copies on several days, with equal and null order fields, ids and days
    df = spark.createDataFrame(
        [(None if i % 13 == 0 else f"T{i * 7 % 41}", (i % 3, None if i % 5 == 0 else i % 4),
          f"U{i % 6}", None if i % 9 == 0 else DAYS[i % 4], i * 7 % 41 % 5) for i in range(300)],
        f"transaction_id string, ingest_ord struct<a: int, b: int>, user_id string, "
        f"timestamp string, {NEAR} int").withColumn(
        NEAR, F.coalesce(F.when(F.col("transaction_id").isNotNull(), F.col(NEAR)), F.lit(9)))
    sets = [F.lit(True), F.col("timestamp") < DAYS[2], F.col("timestamp") > DAYS[0],
            F.lit(False)]
    got = C.dedupe_sets(df, NEAR, sets)
    plain = df.drop(NEAR)
    assert got.columns == [*plain.columns, C.SETS, C.LEAD]
    for i, one in enumerate(sets):
        assert _rows(got.where(F.col(C.SETS).bitwiseAND(1 << i) != 0).select(*plain.columns)) \
            == _rows(C.dedupe_first(plain.where(one)))
    assert got.where(C.LEAD).count() == df.select("transaction_id").distinct().count()


CASES = {
    "copies share the value": ([1, 1, 1, 2, 2, 3, 4, 5, 6, 7], True),
    "copies apart": ([1, 2, 1, 2, 2, 3, 4, 5, 6, 7], False),
}


@pytest.mark.parametrize("case", CASES)
def test_ranges_are_those_cleaned_one_by_one(spark, monkeypatch, case):
    near, once = CASES[case]
    rows = [tx("T1", uid="U1", ts=DAYS[0]), tx("T1", uid="U2", ts=DAYS[1]),
            tx("T1", uid="U3", ts=DAYS[3]), tx("T2", amount=None, ts=DAYS[1]),
            tx("T2", uid="U4", ts=DAYS[3]), tx(None, ts=DAYS[0]), tx(None, ts=DAYS[3]),
            tx("T3", amount=-1.0, ts=DAYS[2]), tx("T4", uid="U5", ts=None),
            tx("T5", uid="U6", mid="M2", ts="2026-08-02 1:00:00")]
    raw, names, columns = _near(spark, rows, near), _stages(monkeypatch), ["user_id", "merchant_id"]
    got = L.prepare_ranges(spark, raw, RANGES, columns)
    assert len(names) == 1 and set(names[0][0]) == {"_id", *columns, C.SETS}
    for r, df in zip(RANGES, got, strict=True):
        plain = raw.drop(NEAR)
        want = C.transform(plain if r == (None, None) else C.between_days(plain, *r))
        assert _rows(df) == _rows(want.select(*columns)) and df.count() > 0
        assert ("Scan parquet" in _plan(df)) is once


def test_orphans_of_a_large_log_take_one_pass(spark, monkeypatch):
    """The log is read and shuffled by order key once for all three models, whole rows
    are not shuffled for the dedupe, and only keys are staged."""
    small = Q.dq_orphans_prefiltered(spark, SF001)
    assert _plan(small).count("lineitem.parquet") > 1
    monkeypatch.setattr(Q, "STAGE_ROWS", 1)
    names = _stages(monkeypatch)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = Q.dq_orphans_prefiltered(spark, SF001)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    (columns, plan), = names
    assert set(columns) == {"_id", "user_id", "merchant_id", C.SETS}
    assert plan.count("lineitem.parquet") == 1
    assert "Exchange" not in plan[:plan.index("SortMergeJoin")]
    assert "lineitem" not in _plan(df) and "getbit" in _plan(df)
    assert _rows(df) == _rows(small)
