"""Money sums, the default day, load options."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from paylake.functions.numeric import money_sum, money_total
from paylake.plans import job, load


def _sum(spark, values, fn=money_sum):
    df = spark.createDataFrame([(v,) for v in values], "amount double").repartition(3)
    return df.agg(fn(F.col("amount")).alias("s")).first()["s"]


def test_sub_cent_amounts_are_not_rounded(spark):
    assert _sum(spark, [0.004, 0.004, 0.004]) == 0.012
    assert _sum(spark, [0.004, 0.004, 0.004], money_total) == 0.01


def test_sum_does_not_depend_on_order(spark):
    values = [0.1] * 1000 + [1e13, 0.01, -1e13]
    assert _sum(spark, values) == _sum(spark, values[::-1]) == 100.01


def test_sum_of_what_no_decimal_holds(spark):
    inf = float("inf")
    assert _sum(spark, [1.0, inf]) == inf and _sum(spark, [inf]) == inf
    assert _sum(spark, [1e40, 1.0]) == 1e40
    assert _sum(spark, [None, None]) is None and _sum(spark, [None, 2.5]) == 2.5


def test_default_day_is_yesterday():
    assert load.default_day() == dt.date.today() - dt.timedelta(days=1)


def test_yesterday_reaches_the_load(spark, tmp_path, monkeypatch):
    seen = {}
    monkeypatch.setattr(job, "run_load", lambda *a, **k: seen.update(k) or load.LoadResult())
    monkeypatch.setattr(job, "read_raw_parquet", lambda *a: None)
    job.main(["--raw", "x", "--format", "parquet", "--warehouse", str(tmp_path / "w"),
              "--yesterday"], spark)
    assert seen["day"] == load.default_day() and seen["count_read"] is False


@pytest.mark.parametrize("mode", [["--date", "2026-08-01"], ["--yesterday"]])
def test_a_day_and_a_range_exclude_each_other(mode):
    with pytest.raises(SystemExit):
        job.parse_args(["--raw", "x", "--warehouse", "w", *mode, "--start", "2026-08-01"])


def test_shared_folder_must_be_set_off_local_mode(monkeypatch):
    from paylake import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(Session())
