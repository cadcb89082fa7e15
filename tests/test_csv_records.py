"""Quoted line breaks in split files (S1); timestamp formats of files."""

import csv
import datetime
import random

import pytest

from conftest import RAW_FIELDS, raw_frame, tx
from paylake.operators import cleaning as C
from paylake.operators.timestamps import canonical, formats
from paylake.plans.load import run_load
from paylake.sources import csv_records
from paylake.sources.raw import count_corrupt, read_raw_csv
from paylake.sources.warehouse import Warehouse


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "331", "spark.sql.files.openCostInBytes": "1",
            "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _rows(rng, n, start=0):
    parts = ["a", "b\nc", 'say ""', "x,y", "\n\n", "é", '"', "line\nline\nline", " ", "\n" * 40,
             "long " * 120]
    out = []
    for i in range(start, start + n):
        name = "".join(rng.choice(parts) for _ in range(rng.choice([1, 2, 4])))
        out.append(tx(f"T{i}", name=f"[{name}]", mname="[" + rng.choice(parts) + "]"))
    return out


def _write(path, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(RAW_FIELDS)
        w.writerows(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_split_scan_equals_the_unsplit_one(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    rows = {}
    for k in range(3):
        rows[k] = _rows(rng, rng.randint(1, 60), 100 * k)
        _write(tmp_path / f"{k}.csv", rows[k])
    path = str(tmp_path)
    got = read_raw_csv(spark, path, multi_line=True)
    assert csv_records.lines(spark, path).rdd.getNumPartitions() > 20
    plain = spark.read.options(header=True, multiLine=True, escape='"').csv(path)
    names = ["transaction_id", "user_name", "merchant_name"]
    want = sorted(tuple(r) for r in plain.select(*names).collect())
    assert sorted(tuple(r) for r in got.select(*names).collect()) == want
    assert want == sorted((r[0], r[2], r[5]) for k in rows for r in rows[k])
    # the order key follows the file
    for k in rows:
        ids = [r[0] for r in got.where(f"ingest_ord.file like '%{k}.csv'").orderBy("ingest_ord")
               .select("transaction_id").collect()]
        assert ids == [r[0] for r in rows[k]]
    assert count_corrupt(spark, path, multi_line=True) == 0


def test_only_fragments_are_shuffled(spark, tmp_path, small_splits):
    _write(tmp_path / "a.csv", _rows(random.Random(5), 40))
    plan = csv_records.records(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    whole = plan.split("Union")[1].split("MapInArrow")[0]
    assert "Exchange" not in whole  # from the union down to the cut


def test_headers_and_broken_records(spark, tmp_path):
    _write(tmp_path / "a.csv", [tx("T1", name="a\nb")])
    (tmp_path / "b.csv").write_text("other,header\n1,2\n")
    with pytest.raises(Exception, match="header"):
        read_raw_csv(spark, str(tmp_path), multi_line=True).collect()
    (tmp_path / "b.csv").write_text(",".join(RAW_FIELDS) + "\r\nT2,U2\r\n\r\nT3" + ",x" * 10 + "\r\n")
    got = {r["transaction_id"]: r for r in read_raw_csv(spark, str(tmp_path), multi_line=True).collect()}
    assert sorted(got) == ["T1", "T2", "T3"]
    assert got["T1"]["user_name"] == "a\nb" and got["T3"]["timestamp"] == "x"
    assert count_corrupt(spark, str(tmp_path), multi_line=True) == 1


# --- formats -----------------------------------------------------------------
FILES = {
    "a": [None, "2026-08-01T10:00:00", "2026-08-02T11:30:00", "2026-08-02 11:30:00"],
    "b": ["2026-08-01T10:00:00.123456", "2026-08-01T10:00:01.5"],
    "c": ["2026-08-03", "2026-08-04"],
    "d": ["soon", "13/08/2026 01:02:03", "01/09/2026 00:00:00", "2026-08-01"],
    "e": ["2026-08-01T10:00:00Z", "x"],
    "f": [None, "never"],
    "g": ["2026-08-05 09:08:07", "2026-08-05"],
}
WANT = {
    "a": [None, "2026-08-01 10:00:00", "2026-08-02 11:30:00", "unparsable: 2026-08-02 11:30:00"],
    "b": ["2026-08-01 10:00:00", "2026-08-01 10:00:01"],
    "c": ["2026-08-03 00:00:00", "2026-08-04 00:00:00"],
    "d": ["unparsable: soon", "2026-08-13 01:02:03", "2026-09-01 00:00:00", "unparsable: 2026-08-01"],
    "e": ["2026-08-01 10:00:00", "unparsable: x"],
    "f": [None, "unparsable: never"],
    "g": ["2026-08-05 09:08:07", "unparsable: 2026-08-05"],
}


def test_every_file_tells_its_format(spark, tmp_path):
    for k, values in FILES.items():
        _write(tmp_path / f"{k}.csv", [tx(f"{k}{i}", ts=v) for i, v in enumerate(values)])
    raw = read_raw_csv(spark, str(tmp_path))
    assert formats(raw).count() == 6
    got = {r["transaction_id"]: r["timestamp"] for r in canonical(raw).collect()}
    assert got == {f"{k}{i}": t for k, v in WANT.items() for i, t in enumerate(v)}
    # one file: no join
    one = read_raw_csv(spark, str(tmp_path / "c.csv"))
    assert "Join" not in canonical(one)._jdf.queryExecution().executedPlan().toString()
    days = C.day_slice(canonical(one), datetime.date(2026, 8, 4)).collect()
    assert [r["transaction_id"] for r in days] == ["c1"]


@pytest.mark.parametrize(("ts", "want"), [("2026-08-01T10:00:00", "2026-08-01 10:00:00"),
                                          ("2026-08-01 10:00:00.75", "2026-08-01 10:00:00"),
                                          ("2026-08-01", "2026-08-01 00:00:00")])
def test_loads_without_a_given_format(spark, tmp_path, ts, want):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.create_tables()
    run_load(spark, raw_frame(spark, [tx("T1", ts=ts), tx("T2", ts=None)]), wh, full=True,
             timestamp_format="infer")
    assert [str(r["timestamp"]) for r in wh.read("fact_transactions").orderBy("transaction_id")
            .collect()] == [want, "None"]
    with pytest.raises(Exception, match="unparsable timestamp"):
        run_load(spark, raw_frame(spark, [tx("T1", ts=ts), tx("T2", ts="13:00")]), wh, full=True,
                 timestamp_format="infer")
