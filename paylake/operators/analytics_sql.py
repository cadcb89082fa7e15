"""The analytics queries as Spark SQL text over temp views.

Same plans as ``analytics.py`` (Catalyst sees the same operators); for users
who run the SQL file against the warehouse.  Views: ``fact_transactions``,
``dim_users``, ``dim_merchants`` (see ``register_views``).  Rates are exact
half-up from integer counts, money totals are rounded to cents, and every
ORDER BY ends with the group key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _rate(s: str, t: str) -> str:
    num = f"(CAST({s} AS BIGINT) * 20000 + CAST({t} AS BIGINT))"
    den = f"(CAST({t} AS BIGINT) * 2)"
    return f"CASE WHEN {t} > 0 THEN (({num} - pmod({num}, {den})) / {den}) / 100.0D END"


def _sum(x: str) -> str:
    """As ``numeric.money_sum``: exact decimals, and the values that are none (infinite,
    or too large) as doubles beside them."""
    exact = f"TRY_CAST({x} AS DECIMAL(38,6))"
    rest = f"SUM(CASE WHEN {exact} IS NULL THEN {x} END)"
    total = f"CAST(SUM({exact}) AS DOUBLE)"
    return f"CASE WHEN {rest} IS NULL THEN {total} ELSE COALESCE({total}, 0D) + {rest} END"


_SPENT = "CASE WHEN status = 'SUCCESS' THEN amount ELSE 0D END"
_SPENT_EXACT = f"TRY_CAST({_SPENT} AS DECIMAL(38,6))"

Q1 = f"""
SELECT transaction_date, total_transactions, successful_transactions, total_gtv_idr,
       {_rate('successful_transactions', 'total_transactions')} AS overall_success_rate_pct
FROM (
  SELECT transaction_date,
         COUNT(transaction_id) AS total_transactions,
         COUNT_IF(status = 'SUCCESS') AS successful_transactions,
         ROUND({_sum(_SPENT)}, 2) AS total_gtv_idr
  FROM fact_transactions
  GROUP BY transaction_date)
ORDER BY transaction_date ASC NULLS FIRST
"""

Q2 = f"""
WITH per_merchant AS (
  SELECT merchant_id, COUNT(transaction_id) AS n,
         SUM({_SPENT_EXACT}) AS v,
         SUM(CASE WHEN {_SPENT_EXACT} IS NULL THEN {_SPENT} END) AS w
  FROM fact_transactions
  GROUP BY merchant_id
), by_category AS (
  SELECT m.merchant_category, SUM(p.n) AS total_tx_count,
         COALESCE(CAST(SUM(p.v) AS DOUBLE), 0D) + COALESCE(SUM(p.w), 0D) AS total_volume_idr
  FROM per_merchant p JOIN dim_merchants m ON p.merchant_id = m.merchant_id
  GROUP BY m.merchant_category
)
SELECT merchant_category, total_tx_count, total_volume_idr,
       CAST(DENSE_RANK() OVER (ORDER BY total_volume_idr DESC) AS BIGINT) AS rank_by_volume
FROM by_category
ORDER BY rank_by_volume, merchant_category
"""

Q3 = f"""
SELECT payment_method, total_attempts, successful_tx, failed_tx, pending_tx,
       {_rate('successful_tx', 'total_attempts')} AS success_rate_pct
FROM (
  SELECT payment_method,
         COUNT(transaction_id) AS total_attempts,
         COUNT_IF(status = 'SUCCESS') AS successful_tx,
         COUNT_IF(status = 'FAILED') AS failed_tx,
         COUNT_IF(status = 'PENDING') AS pending_tx
  FROM fact_transactions
  GROUP BY payment_method)
ORDER BY success_rate_pct DESC, payment_method
"""

Q3B = f"""
SELECT payment_method, total_attempts, successful_tx,
       {_rate('successful_tx', 'total_attempts')} AS success_rate_pct
FROM (
  SELECT payment_method, COUNT(transaction_id) AS total_attempts,
         COUNT_IF(status = 'SUCCESS') AS successful_tx
  FROM fact_transactions
  GROUP BY payment_method)
ORDER BY success_rate_pct DESC, payment_method
"""

Q4 = f"""
WITH per_user AS (
  SELECT user_id, COUNT(transaction_id) AS total_transactions,
         {_sum("amount")} AS spent
  FROM fact_transactions
  WHERE status = 'SUCCESS'
  GROUP BY user_id
)
SELECT u.user_id, u.masked_user_name, u.masked_phone, p.total_transactions,
       ROUND(p.spent, 2) AS total_spent_idr
FROM per_user p JOIN dim_users u ON p.user_id = u.user_id
ORDER BY total_spent_idr DESC, u.user_id
LIMIT 10
"""

QUERIES = {"q1_daily_gtv": Q1, "q2_category_ranking": Q2, "q3_payment_health": Q3,
           "q3b_payment_rate": Q3B, "q4_top_users": Q4}


def register_views(fact: DataFrame, dim_users: DataFrame, dim_merchants: DataFrame) -> None:
    fact.createOrReplaceTempView("fact_transactions")
    dim_users.createOrReplaceTempView("dim_users")
    dim_merchants.createOrReplaceTempView("dim_merchants")


def run(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(QUERIES[name])
