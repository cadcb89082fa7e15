"""Quality rules: one broken cell at a time on a small shop of our own."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.operators import quality as DQ
from paylake.schemas import DIM_MERCHANTS, DIM_USERS, FACT


@pytest.fixture
def shop(spark):
    """Three customers, one stall, four payments; timestamps as text."""
    people = [(f"c{i}", f"{n}****", f"08{i}7****{i}00", f"digest{i}")
              for i, n in enumerate("LQZ")]
    pay = [(f"p{i}", f"c{i % 3}", "stall-9", 12.5 * (i + 1), "DEBIT_CARD", s,
            f"2031-03-0{i + 1} 08:15:00", f"2031-03-0{i + 1}")
           for i, s in enumerate(["PENDING", "SUCCESS", "SUCCESS", "FAILED"])]
    text = T.StructType([T.StructField(f.name, T.DoubleType() if f.name == "amount"
                                       else T.StringType()) for f in FACT.fields])
    return (spark.createDataFrame(people, DIM_USERS),
            spark.createDataFrame([("stall-9", "Noodles", "Street")], DIM_MERCHANTS),
            spark.createDataFrame(pay, text))


def broken(df, key, where, column, value):
    hit = F.col(key) == where
    return df.withColumn(column, F.when(hit, F.lit(value)).otherwise(F.col(column)))


def rules(report):
    return {r["rule"]: (r["violations"], r["sample"]) for r in report.collect()}


def test_sound_tables_pass_every_rule(shop):
    found = DQ.validate_all(*shop)
    assert found and all(r["passed"] for r in found)
    numbers = [r["rule_no"] for r in found]
    assert numbers == sorted(set(numbers))


def test_surplus_rows_of_a_key(shop):
    people = shop[0]
    thrice = people.union(people.where("user_id = 'c2'")).union(people.where("user_id = 'c2'"))
    report = DQ.uniqueness(thrice, "user_id", "dim_users")
    assert rules(report) == {"uniqueness": (2, "c2")}
    with pytest.raises(DQ.DataQualityError, match="Uniqueness check failed"):
        DQ.gate(report)


@pytest.mark.parametrize("column", ["transaction_id", "status", "amount"])
def test_empty_cells(shop, column):
    holes = broken(shop[2], "merchant_id", "stall-9", column, None)
    with pytest.raises(DQ.DataQualityError, match="Completeness check failed"):
        DQ.gate(DQ.completeness(holes, [column], "fact_transactions"))


def test_absent_column(shop):
    with pytest.raises(DQ.DataQualityError, match="missing"):
        DQ.gate(DQ.completeness(shop[1].drop("merchant_category"), DQ.MERCHANT_REQUIRED,
                                "dim_merchants"))


@pytest.mark.parametrize("value", [0.0, -0.5])
def test_amounts_must_be_positive(shop, value):
    with pytest.raises(DQ.DataQualityError, match="amount <= 0"):
        DQ.gate(DQ.validity(broken(shop[2], "transaction_id", "p3", "amount", value)))


def test_statuses_outside_the_domain(shop):
    odd = broken(shop[2], "transaction_id", "p1", "status", "REFUNDED")
    with pytest.raises(DQ.DataQualityError, match="invalid status"):
        DQ.gate(DQ.validity(odd))
    assert [tuple(r) for r in DQ.invalid_statuses(odd).collect()] == [("REFUNDED", 1)]


@pytest.mark.parametrize("phone, raw", [("+62 811 222 333", 0), ("089912345678", 1), (None, 0)])
def test_unmasked_phone(shop, phone, raw):
    leak = broken(shop[0], "user_id", "c1", "masked_phone", phone)
    found = rules(DQ.pii(leak))
    assert found["pii_phone_masked"] == (1, "c1")
    assert found["pii_phone_raw"][0] == raw and found["pii_name_masked"][0] == 0
    with pytest.raises(DQ.DataQualityError, match="PII"):
        DQ.gate(DQ.pii(leak))


def test_name_without_a_mask(shop):
    found = rules(DQ.pii(broken(shop[0], "user_id", "c0", "masked_user_name", None)))
    assert found["pii_name_masked"] == (1, "c0")


def test_first_failing_rule_is_raised(shop):
    people, stalls, pay = shop
    with pytest.raises(DQ.DataQualityError, match="Uniqueness"):
        DQ.validate_all(people.union(people), stalls,
                        broken(pay, "transaction_id", "p0", "amount", -3.0))


def test_empty_tables_pass(shop):
    people = shop[0].limit(0)
    DQ.gate(DQ.completeness(people.drop("masked_phone"), DQ.USER_REQUIRED, "dim_users"))
    DQ.gate(DQ.pii(people))
