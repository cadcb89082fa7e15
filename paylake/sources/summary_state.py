"""Mergeable state of the daily summary (A1, L2).

For each day and merchant the state holds row counts and the digits of the two
volumes (``operators/exact_sums``). A load adds the state of the rows that it put
into the fact; the summary of a day is made from the day's states, so a day that
arrives in many batches is right without another read of its facts. Categories come
from the stored merchants when a summary is made: a merchant that changes its
category takes its stored days along.

The state lies in ``_summary-state`` under the warehouse, in the fact's partitions
(days or months), one delta a load. It is derived data: before use its rows of a day
are counted against the fact's (a narrow scan of the days in question), and
partitions out of step - a load died between the two writes, or the fact was there
first - are made from the facts again. A keep-last load changes stored rows, so its
partitions are made again too. Rows without a day or a merchant are in no summary,
as in ``daily_summary``; an infinite or NaN amount decides the volumes of its day.
``compact`` merges the deltas of some days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.functions.numeric import rate_pct_half_even
from paylake.operators import exact_sums as X
from paylake.schemas import DAILY_SUMMARY, FACT
from paylake.session import delete_paths, path_exists, stage

FACTS = "fact_transactions"
KEYS = ["transaction_date", "merchant_id"]


def partials(rows: DataFrame, keys: list[str]) -> DataFrame:
    """State of cleaned rows by ``keys``: counts of the summary, both volumes, and all
    rows (``rows``)."""
    ok = F.col("status") == "SUCCESS"
    return X.partials(
        rows, keys, F.col("amount"),
        {"total_volume_idr": None, "successful_volume_idr": ok},
        {"total_transactions": F.col("transaction_id").isNotNull(),
         "successful_transactions": ok, "failed_transactions": F.col("status") == "FAILED",
         "rows": F.lit(True)})


def summary(state: DataFrame) -> DataFrame:
    """The daily summary of a state by day and category."""
    out = X.finished(state, ["transaction_date", "merchant_category"])
    out = out.withColumn("successful_volume_idr",
                         F.coalesce("successful_volume_idr", F.lit(0.0)))
    out = out.withColumn("success_rate_pct", rate_pct_half_even(
        F.col("successful_transactions"), F.col("total_transactions")))
    return out.select(*[F.col(f.name).cast(f.dataType) for f in DAILY_SUMMARY.fields])


def daily_summary_exact(clean: DataFrame) -> DataFrame:
    """A1 as ``operators.model.daily_summary``, its volumes the doubles nearest to the
    true sums of the amounts (A4, A5)."""
    known = F.col("transaction_date").isNotNull() & F.col("merchant_category").isNotNull()
    return summary(partials(clean.where(known), ["transaction_date", "merchant_category"]))


class SummaryState:
    def __init__(self, warehouse):
        self.warehouse, self.spark = warehouse, warehouse.spark
        self.path = f"{warehouse.root}/_summary-state"
        self.part = warehouse.part_column(FACTS)
        empty = partials(self.spark.createDataFrame([], FACT), KEYS)
        self.schema = self._with_part(empty).schema

    def _with_part(self, state: DataFrame) -> DataFrame:
        if self.part in state.columns:
            return state
        return state.withColumn(self.part, F.date_format("transaction_date", "yyyy-MM"))

    def _value(self, day) -> str:
        return f"{day:%Y-%m}" if self.part not in KEYS else f"{day:%Y-%m-%d}"

    def _of(self, days: list):
        """Condition on the partition column: the partitions of ``days``."""
        return F.col(self.part).cast("string").isin(sorted({self._value(d) for d in days}))

    def _facts(self, days: list) -> DataFrame:
        """Stored facts in the partitions of ``days``."""
        return self.warehouse.stored_partitions(FACTS, days).where(
            F.col("transaction_date").isNotNull())

    def _write(self, state: DataFrame, mode: str) -> None:
        self._with_part(state).select(*self.schema.fieldNames()).hint("rebalance", self.part) \
            .write.mode(mode).option("partitionOverwriteMode", "dynamic") \
            .partitionBy(self.part).parquet(self.path)

    def read(self, days: list) -> DataFrame:
        """Deltas in the partitions of ``days``."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path).where(self._of(days))

    def add(self, rows: DataFrame) -> None:
        """One more delta: the state of rows that the fact has just got."""
        self._write(partials(rows.where(F.col("transaction_date").isNotNull()), KEYS), "append")

    def rebuild(self, days: list) -> None:
        """The partitions of ``days`` from the stored facts, in place of their deltas."""
        if days:
            self._write(partials(self._facts(days), KEYS), "overwrite")

    def compact(self, days: list) -> None:
        """One delta in place of many, in the partitions of ``days``."""
        scope: list = []
        state = self.read(days).select(*[c for c in self.schema.fieldNames()
                                         if c != self.part or c in KEYS])
        self._write(stage(X.merged(state, KEYS), self.spark, "summary-state", scope),
                    "overwrite")
        delete_paths(self.spark, scope)

    def out_of_step(self, days: list) -> list:
        """Days, in the partitions of ``days``, whose state does not hold as many rows as
        the fact (one row a day reaches the driver)."""
        held = self.read(days).groupBy("transaction_date").agg(F.sum("c_rows").alias("held"))
        there = self._facts(days).groupBy("transaction_date").agg(F.count("*").alias("there"))
        return [r[0] for r in there.join(held, "transaction_date", "full")
                .where(~F.col("held").eqNullSafe(F.col("there")))
                .select("transaction_date").collect()]

    def daily(self, days: list) -> DataFrame:
        """The daily summary of ``days``; partitions out of step are made again first."""
        days = [d for d in days if d is not None]
        self.rebuild(self.out_of_step(days))
        merchants = self.warehouse.read("dim_merchants").select("merchant_id",
                                                                "merchant_category")
        state = self.read(days).where(F.col("transaction_date").isin(days)) \
            .join(merchants.where(F.col("merchant_category").isNotNull()), "merchant_id")
        return summary(state.drop(*[c for c in ("merchant_id", self.part) if c not in (
            "transaction_date",)]))
