"""Upsert operators on small frames (K1-K3)."""

from paylake.operators import upsert as K


def _df(spark, rows):
    return spark.createDataFrame(rows, "id string, v long, ord long")


def test_replace_keep_last_and_ignore(spark):
    old = _df(spark, [("a", 1, 1), ("b", 2, 2)])
    new = _df(spark, [("b", 20, 3), ("c", 30, 4)])
    rep = sorted(tuple(r) for r in K.upsert_replace(old, new, ["id"]).collect())
    assert rep == [("a", 1, 1), ("b", 20, 3), ("c", 30, 4)]
    ign = sorted(tuple(r) for r in K.insert_ignore_state(old, new, ["id"]).collect())
    assert ign == [("a", 1, 1), ("b", 2, 2), ("c", 30, 4)]
    # first load: the batch as is
    assert K.upsert_replace(None, new, ["id"]).count() == 2


def test_keep_last_resolves_duplicates_inside_the_batch(spark):
    old = _df(spark, [("a", 1, 1)])
    new = _df(spark, [("a", 10, 5), ("a", 11, 6), ("b", 2, 2)])
    out = sorted(tuple(r) for r in K.keep_last(old, new, ["id"], order_col="ord").collect())
    assert out == [("a", 11, 6), ("b", 2, 2)]


def test_composite_keys(spark):
    old = spark.createDataFrame([("d1", "x", 1), ("d1", "y", 2)], "d string, c string, n long")
    new = spark.createDataFrame([("d1", "y", 5), ("d2", "x", 7)], "d string, c string, n long")
    out = sorted(tuple(r) for r in K.upsert_replace(old, new, ["d", "c"]).collect())
    assert out == [("d1", "x", 1), ("d1", "y", 5), ("d2", "x", 7)]
