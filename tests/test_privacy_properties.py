"""Property tests: the column expressions agree with plain-Python definitions
of the reference's masking rules on generated text."""

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.functions.privacy import hash_pii, mask_name, mask_phone

# letters, ASCII and Arabic-Indic digits, punctuation, the whitespace kinds the
# reference splits on (space, tab, no-break space, U+001C, ideographic space),
# a supplementary-plane character and a combining mark (code-point semantics)
ALPHABET = "abcXYZÉß0123456789٠١٢+-() .#\t \u001c　\U0001F600\u0301"
texts = st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=24))


def py_mask_phone(s):
    if s is None:
        return "UNKNOWN"
    digits = "".join(ch for ch in s if ch.isdigit())
    return "****" if len(digits) < 7 else digits[:4] + "****" + digits[-4:]


def py_mask_name(s):
    if s is None:
        return "Anonymous"
    return " ".join(p[0] + "****" for p in s.strip().split() if p)


def py_hash(s):
    return "" if s is None else hashlib.sha256(s.encode("utf-8")).hexdigest()


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts, min_size=1, max_size=60))
def test_masks_match_python_definitions(spark, values):
    df = spark.createDataFrame([(v,) for v in values],
                               T.StructType([T.StructField("v", T.StringType())]))
    rows = df.select(mask_phone(F.col("v")), mask_name(F.col("v")), hash_pii(F.col("v"))).collect()
    for v, (p, n, h) in zip(values, rows):
        assert p == py_mask_phone(v), v
        assert n == py_mask_name(v), v
        assert h == py_hash(v), v
