"""Keyed upserts K1-K3 as DataFrame operators.

All three are anti/semi joins keyed on the primary key.  Catalyst
broadcasts the batch side when its size estimate is under the broadcast
threshold (a staged batch has exact file statistics); ``bounded_broadcast``
adds an explicit, counted bound for callers that want the hint.  Beyond the
bound the joins stay shuffle joins - correct at any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.operators import key_filter
from paylake.operators.joins import bounded_broadcast  # noqa: F401  (re-export)


def upsert_replace(target: DataFrame | None, batch: DataFrame, keys: list[str],
                   batch_keys: DataFrame | None = None,
                   prefilter_rows: int | None = None) -> DataFrame:
    """K1/K2: the batch row replaces the stored row with the same key.

    Empty target (first load) -> the batch as is.  ``batch_keys`` may be a
    (possibly broadcast) projection of the batch keys.  ``prefilter_rows`` (rows of a
    batch too large to broadcast): stored rows that a sketch of the batch's keys rules
    out are kept without a shuffle, at the price of a second scan.
    """
    if target is None:
        return batch
    bk = batch_keys if batch_keys is not None else batch.select(*keys)
    maybe, other = target, None
    if prefilter_rows is not None:
        maybe, other = key_filter.split(target, batch.select(*keys), keys, prefilter_rows)
    kept = maybe.join(bk, keys, "left_anti")
    if other is not None:
        kept = kept.unionByName(other)
    return kept.unionByName(batch.select(*target.columns))


def keep_last(old: DataFrame | None, new: DataFrame, keys: list[str],
              order_col: str | None = None) -> DataFrame:
    """K1 exactly: concat(old, new) and keep the last row per key.

    When ``new`` has a single row per key (the pipeline guarantees it) this
    is ``upsert_replace``; with ``order_col`` duplicates inside ``new`` are
    resolved by keeping the greatest ``order_col``.
    """
    if order_col is not None:
        rest = [c for c in new.columns if c not in keys]
        new = (new.groupBy(*keys)
               .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), F.col(order_col)).alias("_l"))
               .select(*keys, *[F.col(f"_l.{c}").alias(c) for c in rest]))
    return upsert_replace(old, new, keys)


def insert_ignore(target: DataFrame | None, batch: DataFrame, keys: list[str],
                  batch_keys: DataFrame | None = None) -> DataFrame:
    """K3: rows of the batch whose key is not stored yet (stored row wins).

    ``hits`` = target keys semi-joined with the batch keys; the batch is then
    anti-joined with ``hits``.  The large target contributes only its key
    column and, with a broadcast batch, is never shuffled.
    Returns the rows to append.
    """
    if target is None:
        return batch
    bk = batch_keys if batch_keys is not None else batch.select(*keys)
    hits = target.select(*keys).join(bk, keys, "left_semi")
    return batch.join(hits, keys, "left_anti")


def insert_ignore_state(target: DataFrame | None, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The table after K3: stored rows plus the batch rows that were new."""
    if target is None:
        return batch
    return target.unionByName(insert_ignore(target, batch, keys).select(*target.columns))
