"""Bloom prefilter of large joins: exact results, smaller shuffles, plan shapes."""

import re

import pytest
from conftest import SF001, raw_frame, tx
from paylake.operators import key_filter as K
from paylake.operators import quality as DQ
from paylake.operators import upsert as U
from paylake.plans.load import run_load
from paylake.sources import warehouse as W
from paylake.sources.testdata import raw_transactions
from pyspark.sql import functions as F


def _keys(spark, lo, hi, step=1):
    return spark.range(lo, hi, step).select(F.concat(F.lit("T"), "id").alias("k"), "id")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_loses_no_key_and_rules_most_others_out(spark):
    large, small = _keys(spark, 0, 200_000), _keys(spark, 0, 200_000, 40)
    maybe, other = K.split(large, small, ["k"], 5_000)
    assert maybe.where("id % 40 = 0").count() == 5_000
    assert maybe.count() < 5_000 + 0.01 * 200_000
    assert maybe.count() + other.count() == 200_000
    assert maybe.columns == other.columns == ["k", "id"]


def test_undersized_sketch_stays_exact(spark):
    large, small = _keys(spark, 0, 5_000), _keys(spark, 0, 5_000, 2)
    maybe = K.may_hold(large, small, ["k"], 1)
    assert maybe.where("id % 2 = 0").count() == 2_500


def test_nulls_repeats_and_empty_sides(spark):
    rows = [("a", 1), (None, 2), ("a", 3), ("b", 4)]
    large = spark.createDataFrame(rows, "k string, v int")
    small = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    maybe, other = K.split(large, small, ["k"], 3)
    assert {r["v"] for r in maybe.collect()} >= {1, 2, 3}
    assert maybe.count() + other.count() == 4
    none = small.where("false")
    assert K.may_hold(large, none, ["k"], 0).count() == 0
    assert K.split(large, none, ["k"], 0)[1].count() == 4
    assert K.may_hold(large.where("false"), small, ["k"], 3).count() == 0


def test_two_key_columns(spark):
    large = spark.range(1_000).select((F.col("id") % 10).alias("a"), F.col("id").alias("b"))
    small = large.where("b < 50")
    assert K.may_hold(large, small, ["a", "b"], 50).where("b < 50").count() == 50


def test_no_sketch_beyond_its_bound_or_for_other_types(spark):
    large, small = spark.range(10), spark.range(5)
    assert K.split(large, small, ["id"], K.MAX_KEYS + 1) == (large, None)
    narrow = small.select(F.col("id").cast("int").alias("id"))
    assert K.split(large, narrow, ["id"], 5) == (large, None)


def test_sketch_size_follows_the_expected_keys(spark):
    small = _keys(spark, 0, 10)
    for expected, blocks in ((0, 1), (2_048, 1), (2_049, 2), (5_000, 4), (10**12, K.MAX_BLOCKS)):
        assert K._blocks(expected) == blocks
    rows = K.sketch(small, ["k"], 5_000).collect()
    assert len(rows) == 4 and {len(r["_words"]) for r in rows} == {K.WORDS}


def _orphan_rows(df):
    return [(r["violations"], r["sample"]) for r in df.collect()]


def test_orphans_with_prefilter_equal_those_without(spark):
    fact = spark.range(4_000).select(
        F.when(F.col("id") % 100 == 7, None).when(F.col("id") % 3 == 0, F.lit("U1"))
        .otherwise(F.concat(F.lit("U"), F.col("id") % 50)).alias("user_id"))
    dim = spark.range(10, 20_000).select(F.concat(F.lit("U"), "id").alias("user_id"))
    plain = DQ.orphans(fact, dim, "user_id")
    lean = DQ.orphans(fact, dim, "user_id", expected_keys=50)
    assert _orphan_rows(lean) == _orphan_rows(plain) and plain.first()["violations"] > 1_000


def test_orphans_prefilter_shrinks_the_shuffle(spark, tmp_path):
    """The dimension's rows drop out before their exchange, and the sketch reads the
    fact's counted keys from the exchange that the anti join uses."""
    _keys(spark, 0, 100).write.parquet(str(tmp_path / "fact"))
    _keys(spark, 0, 100_000).write.parquet(str(tmp_path / "dim"))
    fact, dim = (spark.read.parquet(str(tmp_path / n)) for n in ("fact", "dim"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = DQ.orphans(fact, dim, "k", expected_keys=100)
        plan = _plan(df)
        probe, exchange = plan.index("getbit"), plan.index("SortMergeJoin")
        assert exchange < probe  # below the join, above the dimension's scan
        side = plan[:probe].rstrip()
        assert re.search(r"Exchange hashpartitioning\(k#\d+, \d+\)[^\n]*\n[^\n]*Project[^\n]*\n"
                         r"[^\n]*BroadcastHashJoin \[_block", plan), side
        df.collect()
        assert "ReusedExchange" in _plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_replace_of_a_large_batch_keeps_ruled_out_rows_unshuffled(spark):
    old = spark.range(1_000).select(F.concat(F.lit("K"), "id").alias("k"), F.lit(0).alias("v"))
    new = spark.range(0, 2_000, 10).select(F.concat(F.lit("K"), "id").alias("k"),
                                           F.lit(1).alias("v"))
    got = U.upsert_replace(old, new, ["k"], prefilter_rows=200)
    want = U.upsert_replace(old, new, ["k"])
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 1_100


@pytest.mark.parametrize("mode", ["ignore", "replace"])
def test_loads_beyond_the_broadcast_bound(spark, tmp_path, monkeypatch, mode):
    """Batches above the bound take the prefiltered joins and store the same tables."""
    def load(root):
        wh = W.Warehouse(spark, str(tmp_path / root), layout="month")
        wh.create_tables()
        for lo, hi in ((None, "1995-04-01"), ("1995-02-01", "1995-06-01")):
            run_load(spark, raw_transactions(spark, SF001, lo, hi), wh, start=lo, end=hi,
                     fact_mode=mode)
        return {t: sorted(map(tuple, wh.read(t).collect()), key=str) for t in W.TABLES}

    small = load("small")
    monkeypatch.setattr(W, "BROADCAST_KEY_ROWS", 5)
    assert load("large") == small


def test_key_index_stays_bucketed_below_the_probe(spark, tmp_path, monkeypatch):
    wh = W.Warehouse(spark, str(tmp_path / "wh"), index_buckets=4)
    wh.create_tables()
    run_load(spark, raw_frame(spark, [tx(f"T{i}") for i in range(50)]), wh, full=True)
    batch = spark.createDataFrame([(f"T{i}",) for i in range(40, 80)], "transaction_id string")
    monkeypatch.setattr(W, "BROADCAST_KEY_ROWS", 5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        hits = wh.stored_keys("fact_transactions", batch)
        plan = _plan(hits)
        assert sorted(r[0] for r in hits.collect()) == [f"T{i}" for i in range(40, 50)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "getbit" in plan
    # the batch alone is shuffled by id
    assert len(re.findall(r"Exchange hashpartitioning\(transaction_id#\d+", plan)) == 1
