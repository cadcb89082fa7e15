"""Labelled rows for the classifiers: folds and bounded training samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import documents, pick, text_bytes


def fold(parts: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the decimal doc_id, modulo ``parts`` (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(parts)


def held_out(parts: int, remainder: int) -> Column:
    return F.coalesce(fold(parts) == F.lit(remainder), F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, parts: int, remainder: int,
                  bound: int):
    """Texts (bytes, offsets) and 0/1 labels of at most ``bound`` labelled rows
    outside the held-out fold, the same for the same table. Null labels are
    left out; a doc_id that is labelled twice counts once, with the larger
    label; so does a doc_id that has two texts (the lesser text).
    """
    known = pick(labels, "doc_id", label).where(F.col(label).isNotNull()
                                                & (fold(parts) != F.lit(remainder)))
    known = known.groupBy("doc_id").agg(F.max(label).cast("double").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    # ``bound`` rows of two numbers: small whatever the table
    rows = documents(docs).join(F.broadcast(chosen), "doc_id") \
        .groupBy("doc_id", "y").agg(F.min("text").alias("text")).toArrow()
    order = np.argsort(rows.column("doc_id").to_numpy())
    rows = rows.take(order)
    raw, offsets = text_bytes(rows.column("text"))
    return raw, offsets, np.asarray(rows.column("y").to_numpy(), np.float64)
