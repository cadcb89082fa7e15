"""Masking golden cases (FIXTURES.md 4) and edge cases."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.functions.privacy import hash_pii, mask_name, mask_phone


def _apply(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values],
                               T.StructType([T.StructField("v", T.StringType())]))
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_mask_phone_golden(spark):
    got = _apply(spark, ["+628123456789", "081234567890", "123456", "1234567", None,
                         "(0800) 002-8183", "+62 8000012345"], mask_phone)
    assert got == ["6281****6789", "0812****7890", "****", "1234****4567", "UNKNOWN",
                   "0800****8183", "6280****2345"]


def test_mask_phone_min_digits(spark):
    assert _apply(spark, ["1234567"], lambda c: mask_phone(c, 8)) == ["****"]


def test_mask_phone_unicode_digits(spark):
    # Python's str.isdigit keeps non-ASCII decimal digits too
    assert _apply(spark, ["\u0660\u0661\u0662\u0663-4567"], mask_phone) == [
        "\u0660\u0661\u0662\u0663****4567"]


def test_mask_name_golden(spark):
    got = _apply(spark, ["Dewi Ayu Lestari", "  a  b ", "   ", None,
                         "Ana Maria", "Émile\tZola", "x\x1cy"], mask_name)
    assert got == ["D**** A**** L****", "a**** b****", "", "Anonymous",
                   "A**** M****", "É**** Z****", "x**** y****"]


def test_hash_pii_golden(spark):
    got = _apply(spark, ["x", None], hash_pii)
    assert got == ["2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881", ""]


def test_hash_pii_salt(spark):
    a, = _apply(spark, ["x"], lambda c: hash_pii(c, "pepper"))
    b, = _apply(spark, ["pepperx"], hash_pii)
    assert a == b
