import os
import sys

import pytest

sys.path.insert(0, os.path.abspath(os.path.join(os.path.dirname(__file__), "..")))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from paylake.session import build_session
    s = build_session("local[8]", shuffle_partitions=8)
    # Tests own their session, so they set the checkpoint dir themselves.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


RAW_FIELDS = ["transaction_id", "user_id", "user_name", "phone_number", "merchant_id",
              "merchant_name", "merchant_category", "amount", "payment_method", "status",
              "timestamp"]


def raw_frame(spark, rows):
    """Raw log from tuples in file order (position = list index)."""
    from paylake.schemas import RAW
    from paylake.sources.raw import raw_from_frame
    from pyspark.sql import types as T
    schema = T.StructType(list(RAW.fields) + [T.StructField("_pos", T.LongType())])
    df = spark.createDataFrame([tuple(r) + (i,) for i, r in enumerate(rows)], schema)
    return raw_from_frame(df, ["_pos"])


def tx(tid, uid="USR-1", amount=100.0, status="SUCCESS", ts="2026-08-01 10:00:00",
       mid="MCH-1", cat="F&B", method="QRIS", name="Rina Sari", phone="081234567890",
       mname="Kopi"):
    return (tid, uid, name, phone, mid, mname, cat, amount, method, status, ts)
