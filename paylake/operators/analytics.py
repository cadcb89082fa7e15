"""The four analytical queries (Q1-Q4, plus the README's Q3 variant).

Joins against a dimension aggregate first and join second (valid because the
dimensions are unique on their key, rule D1): the fact is reduced by a
map-side partial aggregate to one row per merchant / user before anything
crosses the join.  Ties in every ORDER BY are broken by the group key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylake.functions.numeric import SUM_TYPE, money_total, rate_pct_half_up


def _success():
    return F.col("status") == "SUCCESS"


def _spent():
    return F.when(_success(), F.col("amount")).otherwise(F.lit(0.0))


def _exact():
    """Successful amount as the decimal that per-merchant and per-category sums share."""
    return _spent().try_cast(SUM_TYPE)


def q1_daily_gtv(fact: DataFrame) -> DataFrame:
    """Daily gross transaction value and volume, by day ascending."""
    agg = fact.groupBy("transaction_date").agg(
        F.count("transaction_id").alias("total_transactions"),
        F.count_if(_success()).alias("successful_transactions"),
        money_total(F.when(_success(), F.col("amount")).otherwise(F.lit(0.0)))
        .alias("total_gtv_idr"))
    return (agg.withColumn("overall_success_rate_pct",
                           rate_pct_half_up(F.col("successful_transactions"),
                                            F.col("total_transactions")))
            .orderBy(F.col("transaction_date").asc_nulls_first()))


def q2_category_ranking(fact: DataFrame, dim_merchants: DataFrame) -> DataFrame:
    """Merchant categories ranked by successful volume (dense rank).

    fact -> partial agg per merchant_id -> join merchants -> agg per
    category -> dense_rank over at most one row per category.
    """
    per_merchant = fact.groupBy("merchant_id").agg(
        F.count("transaction_id").alias("_n"),
        F.sum(_exact()).alias("_v"), F.sum(F.when(_exact().isNull(), _spent())).alias("_w"))
    per_cat = (per_merchant.join(dim_merchants.select("merchant_id", "merchant_category"),
                                 "merchant_id")
               .groupBy("merchant_category")
               .agg(F.sum("_n").alias("total_tx_count"),
                    (F.coalesce(F.sum("_v").cast("double"), F.lit(0.0)) + F.coalesce(F.sum("_w"), F.lit(0.0)))
                    .alias("total_volume_idr")))
    # One row per category: the unpartitioned window sees a handful of rows.
    w = Window.orderBy(F.col("total_volume_idr").desc())
    return (per_cat.withColumn("rank_by_volume", F.dense_rank().over(w).cast("long"))
            .orderBy("rank_by_volume", "merchant_category"))


def _payment_agg(fact: DataFrame) -> DataFrame:
    st = F.col("status")
    return fact.groupBy("payment_method").agg(
        F.count("transaction_id").alias("total_attempts"),
        F.count_if(st == "SUCCESS").alias("successful_tx"),
        F.count_if(st == "FAILED").alias("failed_tx"),
        F.count_if(st == "PENDING").alias("pending_tx"))


def q3_payment_health(fact: DataFrame) -> DataFrame:
    """Success rate per payment channel, best first."""
    return (_payment_agg(fact)
            .withColumn("success_rate_pct",
                        rate_pct_half_up(F.col("successful_tx"), F.col("total_attempts")))
            .orderBy(F.col("success_rate_pct").desc(), "payment_method"))


def q3b_payment_rate(fact: DataFrame) -> DataFrame:
    """README variant of Q3 without the failed/pending columns."""
    return (q3_payment_health(fact)
            .select("payment_method", "total_attempts", "successful_tx", "success_rate_pct"))


def q4_top_users(fact: DataFrame, dim_users: DataFrame, k: int = 10) -> DataFrame:
    """Top-k users by successful spend (counts successful rows only).

    Exact restructure of "join, group, sort, limit" (valid because the
    dimension is unique on user_id, rule D1):
      1. aggregate the successful fact per user (map-side partials);
      2. keep users that exist in the dimension - a semi join against its
         key column only, so the masked attributes are not shuffled;
      3. top-k (TakeOrderedAndProject: a bounded heap per partition);
      4. attach the attributes: the k rows - a proven bound - are broadcast
         against a scan of the dimension.
    """
    per_user = (fact.filter(_success())
                .groupBy("user_id")
                .agg(F.count("transaction_id").alias("total_transactions"),
                     money_total(F.col("amount")).alias("total_spent_idr")))
    known = per_user.join(dim_users.select("user_id"), "user_id", "left_semi")
    top = known.orderBy(F.col("total_spent_idr").desc(), "user_id").limit(k)
    attrs = dim_users.select("user_id", "masked_user_name", "masked_phone")
    return (attrs.join(F.broadcast(top), "user_id")
            .select("user_id", "masked_user_name", "masked_phone", "total_transactions",
                    "total_spent_idr")
            # at most k rows: a top-k node orders them without an exchange
            .orderBy(F.col("total_spent_idr").desc(), "user_id").limit(k))
