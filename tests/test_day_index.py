"""The day index of raw files."""

import os
from urllib.parse import unquote

import pytest

from conftest import raw_frame, tx
from paylake.operators.cleaning import between_days
from paylake.operators.timestamps import INFER
from paylake.schemas import ORD, RAW_COLUMNS
from paylake.sources.day_index import DayIndex
from paylake.sources.raw import read_raw_csv, read_raw_parquet


def _put(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(",".join(RAW_COLUMNS) + "\n")
        for r in rows:
            f.write(",".join("" if v is None else str(v) for v in r) + "\n")


def _ids(df):
    return sorted(r["transaction_id"] for r in df.select("transaction_id").collect())


def _names(files):
    return [unquote(f).rsplit("/", 1)[1] for f in files]


@pytest.fixture
def log(tmp_path):
    raw = str(tmp_path / "raw log")  # a name that file paths must quote
    _put(raw, "a.csv", [tx("A1", ts="2026-07-01 00:00:00"), tx("A2", ts="2026-07-31 23:59:59")])
    _put(raw, "b.csv", [tx("B1", ts="2026-08-01 00:00:00"), tx("B2", ts="rubbish"),
                        tx("B3", ts="2026-08-03 10:00:00")])
    _put(raw, "c.csv", [tx("C1", ts=None), tx("C2", ts="soon")])
    _put(raw, "d.csv", [tx("D1", ts="2026-08-02 12:00:00"), tx("D2", ts="2025-01-01 00:00:00")])
    return raw


@pytest.mark.parametrize("start,end", [("2026-08-01", "2026-08-02"), ("2026-07-31", "2026-08-01"),
                                       ("2026-08-03", None), (None, "2026-01-01"),
                                       ("2030-01-01", "2030-01-02"), (None, None)])
def test_same_rows_as_the_whole_log(spark, log, tmp_path, start, end):
    index = DayIndex(spark, log, str(tmp_path / "index"))
    got, want = index.read(start, end), between_days(read_raw_csv(spark, log), start, end)
    assert _ids(got) == _ids(want) and got.columns == want.columns


def test_only_files_of_the_days_are_opened(spark, log, tmp_path):
    index = DayIndex(spark, log, str(tmp_path / "index"))
    assert index.update() == 4 and index.update() == 0
    assert _names(index.files("2026-08-01", "2026-08-02")) == ["b.csv", "d.csv"]
    assert _names(index.files("2026-08-01", None)) == ["b.csv", "d.csv"]
    assert _names(index.files("2026-07-31", "2026-08-01")) == ["a.csv", "d.csv"]
    assert _names(index.files()) == ["a.csv", "b.csv", "d.csv"]
    opened = index.read("2026-08-03", "2026-08-04").select(f"{ORD}.file").inputFiles()
    assert _names(opened) == ["b.csv"]


def test_new_changed_and_deleted_files(spark, log, tmp_path):
    index = DayIndex(spark, log, str(tmp_path / "index"))
    index.update()
    _put(log, "e.csv", [tx("E1", ts="2026-08-01 05:00:00")])
    _put(log, "a.csv", [tx("A9", ts="2026-08-01 06:00:00")])
    os.remove(f"{log}/b.csv")
    assert _ids(index.read("2026-08-01", "2026-08-02")) == ["A9", "E1"]
    assert index.update() == 0 and index.entries().count() == 4


def test_inferred_formats_and_parquet(spark, tmp_path):
    raw = str(tmp_path / "iso")
    _put(raw, "a.csv", [tx("A1", ts="2026-07-31T10:00:00.5")])
    _put(raw, "b.csv", [tx("B1", ts="2026-08-01")])
    index = DayIndex(spark, raw, str(tmp_path / "index"), fmt=INFER)
    assert _ids(index.read("2026-08-01", "2026-08-02")) == ["B1"]
    assert _names(index.files("2026-08-01", None)) == ["b.csv"]

    path = str(tmp_path / "parquet")
    for rows in ([tx("P1", ts="2026-07-01 00:00:00")], [tx("P2", ts="2026-08-01 00:00:00")]):
        raw_frame(spark, rows).drop(ORD).coalesce(1).write.mode("append").parquet(path)
    index = DayIndex(spark, path, str(tmp_path / "index2"), read_raw_parquet)
    assert _ids(index.read("2026-08-01", None)) == ["P2"] and len(index.files("2026-08-01")) == 1


def test_job_loads_a_day_through_the_index(spark, log, tmp_path):
    from paylake.plans import job
    out = job.main(["--raw", log, "--warehouse", str(tmp_path / "wh"), "--date", "2026-08-01",
                    "--day-index", str(tmp_path / "index"), "--layout", "month"], spark)
    assert out["loaded"] and out["fact_rows_added"] == 1 and out["counters"]["batch"] == 1
