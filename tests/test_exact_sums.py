"""Exact sums of doubles against math.fsum."""

import math
import random
import struct

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paylake.operators.exact_sums import exact_totals, finished, merged, partials


def _totals(spark, groups, parts=3):
    df = spark.createDataFrame([(k, v) for k, vs in enumerate(groups) for v in vs],
                               "k int, v double").repartition(parts)
    got = exact_totals(df, ["k"], F.col("v"), {"s": None}).collect()
    return [dict((r["k"], r["s"]) for r in got).get(k) for k in range(len(groups))]


def _any_double(rng):
    while True:
        x = struct.unpack("<d", rng.getrandbits(64).to_bytes(8, "little"))[0]
        if math.isfinite(x) and abs(x) < 2.0 ** 1000:
            return x


def test_random_bit_patterns_equal_fsum(spark):
    rng = random.Random(7)
    groups = [[_any_double(rng) for _ in range(rng.randint(1, 40))] for _ in range(150)]
    # near sums: values of one magnitude, their negatives, and small remainders
    for _ in range(150):
        xs = [rng.uniform(-1, 1) * 2.0 ** rng.randint(-70, 70) for _ in range(20)]
        groups.append(xs + [-x for x in xs[:rng.randint(0, 20)]] + [rng.random() * 1e-300])
    assert _totals(spark, groups) == [math.fsum(g) for g in groups]


def test_edges_of_the_range(spark):
    tiny, big = 5e-324, 1.7976931348623157e308
    groups = [[tiny], [tiny, tiny, -tiny], [2.2250738585072014e-308, -tiny], [big, -big, tiny],
              [big], [-big, big / 2], [1.0, 2.0 ** -53], [1.0, 2.0 ** -53, tiny],
              [1.0 + 2.0 ** -52, 2.0 ** -53], [0.0], [-0.0, 0.0], [1e16, 1.0, -1e16],
              [2.0 ** k for k in range(-1074, 1000, 7)], [2.0 ** 20, -1.0], [2.0 ** -20]]
    assert _totals(spark, groups) == [math.fsum(g) for g in groups]


def test_neighbours_of_powers_of_two(spark):
    """The logarithm that picks the bucket is inexact there."""
    groups = [[math.nextafter(2.0 ** e, to) * sign] for e in range(-1060, 1020, 20)
              for to in (0.0, math.inf) for sign in (1, -1)]
    assert _totals(spark, groups) == [g[0] for g in groups]


def test_nulls_infinities_and_overflow(spark):
    inf = math.inf
    got = _totals(spark, [[None, None], [None, 2.5], [inf, 1.0], [-inf], [inf, -inf],
                          [math.nan, 1.0], [1.7e308, 1.7e308], [-1.7e308, -1.7e308]])
    assert got[:4] == [None, 2.5, inf, -inf] and got[6:] == [inf, -inf]
    assert math.isnan(got[4]) and math.isnan(got[5])


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64,
                                   min_value=-1e300, max_value=1e300),
                         min_size=1, max_size=12), min_size=1, max_size=12))
def test_any_doubles_equal_fsum(spark, groups):
    assert _totals(spark, groups) == [math.fsum(g) for g in groups]


def test_many_rows_of_one_hot_key(spark):
    """0.1 added 300,000 times among other keys; order and partitions do not matter."""
    df = spark.range(400_000).select(
        F.when(F.col("id") % 4 < 3, F.lit(0)).otherwise(F.col("id") % 50).alias("k"),
        F.lit(0.1).alias("v"))
    hot = {r["k"]: (r["s"], r["n"]) for r in exact_totals(
        df, ["k"], F.col("v"), {"s": None}, {"n": F.col("v") > 0}).collect()}
    n = hot[0][1]
    assert n >= 300_000 and hot[0][0] == math.fsum([0.1] * n)


def test_states_of_batches_add_up(spark):
    rng = random.Random(3)
    rows = [(i % 5 or None, rng.uniform(0, 1e6), rng.random() < 0.7) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, v double, ok boolean")
    totals, counts = {"all_v": None, "ok_v": F.col("ok")}, {"n": F.lit(True), "ok_n": F.col("ok")}
    cut = F.col("v") < 3e5
    a, b = (partials(df.where(c), ["k"], F.col("v"), totals, counts) for c in (cut, ~cut))
    both = merged(a.unionByName(b), ["k"])
    assert both.groupBy("k", "bucket").count().where("count > 1").isEmpty()
    got = {r["k"]: tuple(r)[1:] for r in finished(both, ["k"]).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == k]
        want[k] = (len(own), sum(r[2] for r in own), math.fsum(r[1] for r in own),
                   math.fsum(r[1] for r in own if r[2]))
    assert got == want


def test_empty_tables(spark):
    df = spark.createDataFrame([], "k int, v double")
    assert exact_totals(df, ["k"], F.col("v"), {"s": None}).collect() == []


def test_plan_has_partial_aggregates_and_no_python(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").cast("double").alias("v"))
    plan = exact_totals(df, ["k"], F.col("v"), {"s": None})._jdf.queryExecution().toString()
    assert "partial_sum" in plan and "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("keys", [["k", "d"], ["d"]])
def test_composite_keys(spark, keys):
    df = spark.createDataFrame([(1, "x", 0.1), (1, "x", 0.2), (2, "x", 0.3), (1, None, 5.0)],
                               "k int, d string, v double")
    got = {tuple(r)[:-1]: r["s"] for r in exact_totals(df, keys, F.col("v"), {"s": None}).collect()}
    assert got[(1, "x") if len(keys) == 2 else ("x",)] == math.fsum(
        [0.1, 0.2] if len(keys) == 2 else [0.1, 0.2, 0.3])
