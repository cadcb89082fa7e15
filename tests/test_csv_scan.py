"""Raw CSV scan: columns by name, quoted fields, corrupt records; typed Parquet."""

import pytest

from conftest import RAW_FIELDS, tx
from paylake.operators import cleaning as C
from paylake.schemas import RAW
from paylake.sources.raw import count_corrupt, read_raw_csv, read_raw_parquet


def _write(path, header, rows):
    path.write_text("\n".join([",".join(header), *rows]) + "\n")
    return str(path)


def _line(row, header):
    cells = dict(zip(RAW_FIELDS, row, strict=True))
    return ",".join("" if cells.get(c) is None else str(cells.get(c, "x")) for c in header)


def test_columns_are_bound_by_name(spark, tmp_path):
    header = ["user_id", "transaction_id", "extra", *RAW_FIELDS[2:]]
    path = _write(tmp_path / "a.csv", header, [_line(tx("T1", uid="U1"), header)])
    (r,) = read_raw_csv(spark, path).collect()
    assert (r["transaction_id"], r["user_id"], r["amount"]) == ("T1", "U1", 100.0)


def test_missing_column_raises(spark, tmp_path):
    path = _write(tmp_path / "b.csv", RAW_FIELDS[1:], [_line(tx("T1"), RAW_FIELDS[1:])])
    with pytest.raises(ValueError, match="transaction_id"):
        read_raw_csv(spark, path)


def test_file_with_another_header_fails(spark, tmp_path):
    _write(tmp_path / "1.csv", RAW_FIELDS, [_line(tx("T1"), RAW_FIELDS)])
    swapped = [RAW_FIELDS[1], RAW_FIELDS[0], *RAW_FIELDS[2:]]
    _write(tmp_path / "2.csv", swapped, [_line(tx("T2"), swapped)])
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, str(tmp_path)).collect()


def test_quoted_fields(spark, tmp_path):
    name = '"Toko ""Maju"", Jakarta"'
    broken = '"Toko\nDua"'
    rows = [_line(tx("T1", mname=name), RAW_FIELDS), _line(tx("T2", mname=broken), RAW_FIELDS)]
    path = _write(tmp_path / "q.csv", RAW_FIELDS, rows)
    got = {r["transaction_id"]: r["merchant_name"]
           for r in read_raw_csv(spark, path, multi_line=True).collect()}
    assert got == {"T1": 'Toko "Maju", Jakarta', "T2": "Toko\nDua"}
    assert count_corrupt(spark, path, multi_line=True) == 0
    # without multi_line the broken record shows as corrupt, the other is whole
    assert count_corrupt(spark, path) == 2
    kept = {r["transaction_id"]: r["merchant_name"] for r in read_raw_csv(spark, path).collect()}
    assert kept["T1"] == 'Toko "Maju", Jakarta'


def test_a_load_counts_corrupt_records_in_its_own_scan(spark, tmp_path):
    """Too few and too many fields, on any day, under any timestamp format."""
    from paylake.plans.load import run_load
    from paylake.sources.warehouse import Warehouse
    whole = [_line(tx("T1"), RAW_FIELDS), _line(tx("T2", ts="2026-08-02 00:00:00"), RAW_FIELDS)]
    cut = whole[0].replace("T1", "T3").rsplit(",", 2)[0]
    more = whole[1].replace("T2", "T4") + ",extra"
    path = _write(tmp_path / "c.csv", RAW_FIELDS, [*whole, cut, more])
    for i, (multi, fmt) in enumerate([(False, "infer"), (True, "yyyy-MM-dd HH:mm:ss")]):
        wh = Warehouse(spark, str(tmp_path / f"wh{i}"))
        wh.create_tables()
        raw = read_raw_csv(spark, path, multi, mark_corrupt=True)
        out = run_load(spark, raw, wh, day="2026-08-01", timestamp_format=fmt)
        assert out.counters["corrupt_records"] == 2 and out.counters["batch"] == 1
        plain = run_load(spark, read_raw_csv(spark, path, multi), wh, day="2026-08-01",
                         timestamp_format=fmt)
        assert "corrupt_records" not in plain.counters and plain.counters["batch"] == 1


def test_missing_tokens_are_for_text_only(spark, tmp_path):
    path = _write(tmp_path / "m.csv", RAW_FIELDS, [_line(tx("NA", status="None"), RAW_FIELDS)])
    (r,) = read_raw_csv(spark, path).collect()
    assert r["transaction_id"] is None and r["status"] is None
    typed = spark.createDataFrame([tx("NA", status="None")], RAW)
    typed.write.parquet(str(tmp_path / "p"))
    (r,) = read_raw_parquet(spark, str(tmp_path / "p")).collect()
    assert r["transaction_id"] == "NA" and r["status"] == "None"


def test_day_filter_reaches_the_parquet_scan(spark, tmp_path):
    stamps = ["2026-07-31 23:59:59", "2026-08-01 00:00:00", "2026-08-01 23:59:59",
              "2026-08-02 00:00:00", "garbage", None, "2026-08-01", "-001-08-01 00:00:00"]
    spark.createDataFrame([tx(f"T{i}", ts=t) for i, t in enumerate(stamps)], RAW) \
        .write.parquet(str(tmp_path / "p"))
    day = C.day_slice(read_raw_parquet(spark, str(tmp_path / "p")), "2026-08-01")
    assert sorted(r["transaction_id"] for r in day.collect()) == ["T1", "T2"]
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    day = C.day_slice(read_raw_parquet(spark, str(tmp_path / "p")), "2026-08-01")
    plan = day._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):]
    assert "LessThan(timestamp,2026-08-02)" in pushed
    assert "GreaterThanOrEqual(timestamp,2026-08-01)" in pushed
