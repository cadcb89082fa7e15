"""Star schema (M1-M3) and the daily category summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.operators import key_filter
from paylake.operators.cleaning import first_row
from paylake.operators.joins import bounded_broadcast
from paylake.functions.numeric import money_sum, rate_pct_half_even
from paylake.schemas import DAILY_SUMMARY, DIM_MERCHANTS, DIM_USERS, FACT, ORD

#: Keys up to which the first rows' order fields are broadcast.
MAX_LEAST_ROWS = 2_000_000


def _first_per_key(df: DataFrame, key: str, attrs: list[str], order: str = ORD) -> DataFrame:
    """First row per key in ingest order, as a partial (map-side) aggregate."""
    if not attrs:
        return df.select(key).distinct()
    return first_row(df, key, attrs, order)


#: Types whose minimum a hash aggregate finds.
_FIXED = (T.LongType, T.IntegerType, T.DateType, T.TimestampNTZType, T.TimestampType)


def first_per_key_staged(df: DataFrame, key: str, attrs: list[str], keep,
                         order: str = ORD) -> DataFrame:
    """``_first_per_key`` of staged rows with many rows a key: the least first field
    of the order key is found for each key, without the attributes, and only rows that
    have it are compared further.  ``keep`` stages a frame; up to the upserts' broadcast
    bound the least fields are broadcast, beyond it a sketch of them comes first."""
    lead = df.schema[order].dataType.fields[0]
    if not isinstance(lead.dataType, _FIXED):
        return _first_per_key(df, key, attrs, order)
    at = F.col(order)[lead.name]
    # a null sorts before all values
    least = keep(df.groupBy(key).agg(
        F.when(F.count_if(at.isNull()) == 0, F.min(at)).alias("_lead")), f"first-{key}")
    rows = least.count()  # Parquet footers only
    own = df.select(key, at.alias("_lead"), order, *attrs)
    if rows > MAX_LEAST_ROWS:
        own = key_filter.may_hold(own, least, [key, "_lead"], rows)
    least = bounded_broadcast(least.toDF("_key", "_least"), MAX_LEAST_ROWS, rows)
    first = own.join(least, F.col(key).eqNullSafe(F.col("_key"))
                     & F.col("_lead").eqNullSafe(F.col("_least")))
    return _first_per_key(first.select(key, order, *attrs), key, attrs, order)


def _columns(schema: T.StructType, only=None) -> list[str]:
    return [f.name for f in schema.fields if only is None or f.name in only]


def dim_users(clean: DataFrame, only=None) -> DataFrame:
    """M1: one row per user_id, attributes from its first cleaned row."""
    cols = _columns(DIM_USERS, only)
    return _first_per_key(clean, cols[0], cols[1:])


def dim_merchants(clean: DataFrame, only=None) -> DataFrame:
    """M2: one row per merchant_id, attributes from its first cleaned row."""
    cols = _columns(DIM_MERCHANTS, only)
    return _first_per_key(clean, cols[0], cols[1:])


def fact_transactions(clean: DataFrame, only=None) -> DataFrame:
    """M3: the 8 fact columns, no raw PII."""
    return clean.select(*_columns(FACT, only))


def daily_summary(clean: DataFrame) -> DataFrame:
    """A1: per (day, category): counts, volumes and the pandas-rounded rate.

    Rows with a null day or category are not grouped (the reference's
    groupby drops null keys).  One hash aggregate with map-side partials.
    """
    status = F.col("status")
    amount = F.col("amount")
    agg = (clean
           .filter(F.col("transaction_date").isNotNull() & F.col("merchant_category").isNotNull())
           .groupBy("transaction_date", "merchant_category")
           .agg(F.count("transaction_id").alias("total_transactions"),
                F.count_if(status == "SUCCESS").alias("successful_transactions"),
                F.count_if(status == "FAILED").alias("failed_transactions"),
                money_sum(amount).alias("total_volume_idr"),
                money_sum(F.when(status == "SUCCESS", amount).otherwise(F.lit(0.0)))
                .alias("successful_volume_idr")))
    agg = agg.withColumn("success_rate_pct",
                         rate_pct_half_even(F.col("successful_transactions"),
                                            F.col("total_transactions")))
    return agg.select(*[F.col(f.name).cast(f.dataType) for f in DAILY_SUMMARY.fields])


def key_tables(clean: DataFrame, only: list[str]) -> dict[str, DataFrame]:
    """Dimensions and fact with the columns ``only``, the dimensions' keys among them, for
    readers of no others: ``clean`` needs no further ones."""
    return {"dim_users": dim_users(clean, only), "dim_merchants": dim_merchants(clean, only),
            "fact_transactions": fact_transactions(clean, only)}


def star_schema(clean: DataFrame, keep=None) -> dict[str, DataFrame]:
    """The four tables.  ``keep`` (stages a frame under a name): ``clean`` is staged and
    large, so the dimensions are found in two passes over it."""
    def dim(one, schema):
        cols = [f.name for f in schema.fields]
        return one(clean) if keep is None else first_per_key_staged(clean, cols[0], cols[1:], keep)

    return {
        "dim_users": dim(dim_users, DIM_USERS),
        "dim_merchants": dim(dim_merchants, DIM_MERCHANTS),
        "fact_transactions": fact_transactions(clean),
        "daily_merchant_summary": daily_summary(clean),
    }
