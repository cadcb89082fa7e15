"""Explicit schemas for every table (never inferred)."""

from pyspark.sql import types as T

S = T.StringType()
D = T.DoubleType()
L = T.LongType()

# Raw transaction log as it arrives (CSV or Parquet).  ``timestamp`` stays
# text until the cleaning step parses it.
RAW = T.StructType([
    T.StructField("transaction_id", S),
    T.StructField("user_id", S),
    T.StructField("user_name", S),
    T.StructField("phone_number", S),
    T.StructField("merchant_id", S),
    T.StructField("merchant_name", S),
    T.StructField("merchant_category", S),
    T.StructField("amount", D),
    T.StructField("payment_method", S),
    T.StructField("status", S),
    T.StructField("timestamp", S),
])
RAW_COLUMNS = [f.name for f in RAW.fields]

# Name of the ingest-order column every source attaches.  It is a struct whose
# field order defines "file order"; dedupe and first-row picks use it.
ORD = "ingest_ord"

# Optional column of a raw log: a value by which the source's rows are partitioned
# already, and that copies of one id mostly share.  The load's dedupe meets such copies
# where they are; it changes no result.
NEAR = "ingest_near"

DIM_USERS = T.StructType([
    T.StructField("user_id", S),
    T.StructField("masked_user_name", S),
    T.StructField("masked_phone", S),
    T.StructField("phone_hash", S),
])

DIM_MERCHANTS = T.StructType([
    T.StructField("merchant_id", S),
    T.StructField("merchant_name", S),
    T.StructField("merchant_category", S),
])

FACT = T.StructType([
    T.StructField("transaction_id", S),
    T.StructField("user_id", S),
    T.StructField("merchant_id", S),
    T.StructField("amount", D),
    T.StructField("payment_method", S),
    T.StructField("status", S),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("transaction_date", T.DateType()),
])

DAILY_SUMMARY = T.StructType([
    T.StructField("transaction_date", T.DateType()),
    T.StructField("merchant_category", S),
    T.StructField("total_transactions", L),
    T.StructField("successful_transactions", L),
    T.StructField("failed_transactions", L),
    T.StructField("total_volume_idr", D),
    T.StructField("successful_volume_idr", D),
    T.StructField("success_rate_pct", D),
])

# Warehouse tables: schema, primary key, partition column (None = unpartitioned).
TABLES = {
    "dim_users": (DIM_USERS, ["user_id"], None),
    "dim_merchants": (DIM_MERCHANTS, ["merchant_id"], None),
    "fact_transactions": (FACT, ["transaction_id"], "transaction_date"),
    # The summary has one row per (day, category): bounded by the calendar
    # and the category list, not by data volume, so it is not partitioned.
    "daily_merchant_summary": (DAILY_SUMMARY, ["transaction_date", "merchant_category"], None),
}

# Fixed values that must equal the reference's.
VALID_STATUSES = ("SUCCESS", "FAILED", "PENDING")
PAYMENT_METHODS = ("QRIS", "E-WALLET_BALANCE", "VIRTUAL_ACCOUNT", "CREDIT_CARD", "DEBIT_CARD")
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Unmasked Indonesian phone number (leak detector for rule D7).
RAW_PHONE_PATTERN = r"^(?:\+?62|0)\d{8,12}$"
MASK = "****"
