"""Adapter: the supplied TPC-H-style tables -> raw transaction log.

The mapping is fixed (see FIXTURES.md section 3).  Everything downstream reads
this adapter, so every query's work grows with ``lineitem``.

Plan shape: lineitem is joined once with orders+customer (customer broadcast under a
counted bound) on the order key and then once with the supplier geography (supplier +
nation + region; broadcast when the counted supplier rows are under the same
bound, a sort-merge join beyond it), so that the order-key shuffle does not carry the
supplier's texts.  Orders and customer are joined first, so lineitem is shuffled at
most twice.  Only the needed columns are read (ReadSchema) and a day filter is
pushed to the lineitem scan as a conservative range on ``l_shipdate``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.functions.timeparse import format_ts
from paylake.operators.joins import DEFAULT_MAX_ROWS, bounded_broadcast, scan_rows
from paylake.schemas import NEAR, ORD, PAYMENT_METHODS, RAW_COLUMNS

# Mapping: order priority digit 1..5 -> the payment methods in their fixed order.
PRIORITY_TO_METHOD = {str(i + 1): m for i, m in enumerate(PAYMENT_METHODS)}

ORDER_FIELDS = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _phone(custkey):
    n = F.lpad(((custkey * F.lit(7919) + F.lit(12345)) % F.lit(1000000000)).cast("string"),
               9, "0")
    kind = custkey % 3
    return (F.when(kind == 0, F.concat(F.lit("+62 8"), n))
            .when(kind == 1, F.concat(F.lit("08"), n))
            .otherwise(F.concat(F.lit("(08"), F.substring(n, 1, 2), F.lit(") "),
                                F.substring(n, 3, 3), F.lit("-"), F.substring(n, 6, 4))))


def _six_digits(key):
    """``%06d``: native padding for keys of up to six digits, the formatter for others."""
    return F.when(key.between(0, 999_999), F.lpad(key.cast("string"), 6, "0")) \
        .when(key > 999_999, key.cast("string")).otherwise(F.format_string("%06d", key))


def _payment_method(priority):
    digit = F.substring(priority, 1, 1)
    expr = None
    for k, v in PRIORITY_TO_METHOD.items():
        expr = (F.when(digit == k, F.lit(v)) if expr is None
                else expr.when(digit == k, F.lit(v)))
    return expr


def _status(partkey, flag, linestatus):
    return (F.when(partkey % 89 == 0, F.lit(None).cast("string"))
            .when(flag.isin("A", "N"),
                  F.when(partkey % 7 == 0, F.lit("success")).otherwise(F.lit("SUCCESS")))
            .when((flag == "R") & (linestatus == "F"), F.lit("FAILED"))
            .when((flag == "R") & (linestatus == "O"), F.lit("PENDING")))


def _amount(partkey, price):
    return (F.when(partkey % 97 == 0, F.lit(None).cast("double"))
            .when(partkey % 101 == 0, F.lit(-50000.0))
            .otherwise(price))


def raw_transactions(spark: SparkSession, sf_dir: str,
                     start: _dt.date | str | None = None,
                     end: _dt.date | str | None = None, near: bool = False) -> DataFrame:
    """Raw log with ``ingest_ord``, and with ``near`` the order key as ``schemas.NEAR``.

    ``start``/``end`` (optional, half-open on the event day) only add a
    pre-filter on ``l_shipdate`` that is pushed into the Parquet scan; it is a
    superset of the rows whose event timestamp falls in range (the event time
    is ship date plus under one day), so the exact day filter (F2) still runs
    downstream on the parsed timestamp.
    """
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate")
    if start is not None:
        lo = _as_date(start) - _dt.timedelta(days=1)
        li = li.filter(F.col("l_shipdate") >= _wall(lo))
    if end is not None:
        hi = _as_date(end)
        li = li.filter(F.col("l_shipdate") < _wall(hi))

    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    supplier = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")

    # supplier geography has one row per supplier (nation and region are
    # lookups), so the supplier count bounds it; broadcast it under the bound.
    supp_geo = bounded_broadcast(
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select("s_suppkey", "s_name", "r_name"),
        rows=scan_rows(supplier))
    # customer is broadcast into orders under the same counted bound
    # (Catalyst's own check looks at compressed file bytes only).
    order_cust = (orders.join(bounded_broadcast(customer, rows=scan_rows(customer)),
                              orders.o_custkey == customer.c_custkey)
                  .select("o_orderkey", "o_custkey", "o_orderpriority", "c_name", "c_mktsegment"))

    # Catalyst multiplies the sizes of orders and customer, so the side that it would
    # broadcast is a small lineitem
    if scan_rows(_read(spark, sf_dir, "lineitem")) <= DEFAULT_MAX_ROWS:
        order_cust = order_cust.hint("merge")
    j = (li.join(order_cust, li.l_orderkey == order_cust.o_orderkey)
         .join(supp_geo, li.l_suppkey == supp_geo.s_suppkey))

    pk = F.col("l_partkey")
    event_ts = F.timestamp_add("SECOND", pk % 86400, F.col("l_shipdate"))
    raw = j.select(
        F.concat(F.lit("TX-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.concat(F.lit("USR-"), _six_digits(F.col("o_custkey"))).alias("user_id"),
        F.concat_ws(" ", F.col("c_name"), F.col("c_mktsegment")).alias("user_name"),
        _phone(F.col("o_custkey")).alias("phone_number"),
        F.concat(F.lit("MCH-"), _six_digits(F.col("l_suppkey"))).alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        F.col("r_name").alias("merchant_category"),
        _amount(pk, F.col("l_extendedprice")).alias("amount"),
        _payment_method(F.col("o_orderpriority")).alias("payment_method"),
        _status(pk, F.col("l_returnflag"), F.col("l_linestatus")).alias("status"),
        format_ts(event_ts).alias("timestamp"),
        F.struct(*[F.col(c) for c in ORDER_FIELDS]).alias(ORD),
        F.col("l_orderkey").alias(NEAR),
    )
    return raw.select(*RAW_COLUMNS, ORD, *([NEAR] if near else []))


def _wall(d: _dt.date):
    """Midnight of ``d`` as a timestamp_ntz literal (zone-independent)."""
    return F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz")


def _as_date(d) -> _dt.date:
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    return _dt.date.fromisoformat(str(d))
