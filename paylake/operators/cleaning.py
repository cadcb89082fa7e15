"""Cleaning operators F1-F13, in the reference's fixed order.

Order is part of the contract: dedupe (F4) runs before the null (F5) and
amount (F6) filters, so an id whose first row is bad is lost even if a later
copy is good.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.functions.privacy import hash_pii, mask_name, mask_phone
from paylake.functions.timeparse import parse_day, parse_lenient, parse_strict
from paylake.schemas import ORD, TIMESTAMP_FORMAT

#: Columns of ``dedupe_sets``.
SETS, LEAD = "_sets", "_lead"

CRITICAL = ["transaction_id", "user_id", "amount", "status"]


def between_days(raw: DataFrame, start=None, end=None,
                 fmt: str = TIMESTAMP_FORMAT) -> DataFrame:
    """F1+F2 over a range: keep rows whose parsed timestamp falls in
    [start, end); ``None`` leaves that side open.  Rows with unparsable
    timestamps always fall out.  The exact filter is a half-open range on the
    parsed value.

    With the fixed-width format a range on the raw text comes first: the scan
    can use it (pushed filter, row-group statistics).  It keeps every row of the
    exact filter.  A text that parses starts with a four-digit year, so text
    and time sort alike, or with a sign: a minus sorts before all digits, as
    such years do, and a plus (a year beyond 9999) is let through.  A text that parses
    and begins with a digit is in the range on time just if it is in that on text, so
    it is parsed once, to see that it parses; this filter is pushed below the joins and
    may compute its text anew for every mention.
    """
    return raw.filter(in_days(start, end, fmt))


def in_days(start=None, end=None, fmt: str = TIMESTAMP_FORMAT,
            parses: Column | None = None) -> Column:
    """Whether ``between_days`` keeps a row, as a column: true, or false or null.
    ``parses``: whether the text parses, where several ranges share that."""
    def at(d):
        # wall-clock literal from text: independent of driver and session zones
        return F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz")

    text, first = F.col("timestamp"), F.lit(True)
    if fmt == TIMESTAMP_FORMAT:
        if start is not None:
            first = first & ((text >= parse_day(start).isoformat()) | text.startswith("+"))
        if end is not None:
            first = first & (text < parse_day(end).isoformat())
    ts = parse_lenient(text, fmt)
    cond = ts.isNotNull()
    if start is not None:
        cond = cond & (ts >= at(parse_day(start)))
    if end is not None:
        cond = cond & (ts < at(parse_day(end)))
    if fmt == TIMESTAMP_FORMAT:
        if parses is None:
            parses = F.try_to_timestamp(text, F.lit(fmt)).isNotNull()
        cond = F.when(text >= "0", parses).otherwise(cond)
    return first & cond


def day_slice(raw: DataFrame, day, fmt: str = TIMESTAMP_FORMAT) -> DataFrame:
    """the reference's incremental filter - rows of one target day."""
    lo = parse_day(day)
    return between_days(raw, lo, lo + _dt.timedelta(days=1), fmt)


def dedupe_first(df: DataFrame, key: str = "transaction_id", order: str = ORD) -> DataFrame:
    """one row per key, the first in ingest order; null keys form one group.

    An aggregate rather than a window: the minimum is computed partially on the
    map side, so a key holding a third of all rows leaves each map task as a
    single row and never lands whole in one reduce task.
    """
    attrs = [c for c in df.columns if c not in (key, order)]
    return first_row(df, key, attrs, order, keep_order=order in df.columns) \
        .select(*df.columns)


def dedupe_near(df: DataFrame, near: str, key: str = "transaction_id",
                order: str = ORD) -> DataFrame:
    """The first row of each key among those that share a value of ``near``, which is
    dropped.  No shuffle where the rows are partitioned by ``near``.  These rows are
    those of ``dedupe_first`` if no key is left twice."""
    attrs = [c for c in df.columns if c not in (key, order, near)]
    return first_row(df, key, attrs, order, keep_order=True, near=near) \
        .select(*[c for c in df.columns if c != near])


def dedupe_sets(df: DataFrame, near: str, sets: list[Column], key: str = "transaction_id",
                order: str = ORD) -> DataFrame:
    """``dedupe_near`` of several sets of rows in one pass, each the rows of ``df`` where
    its condition is true.  A row that is the first of its key in more than one set comes
    once: bit i of ``SETS`` tells whether it is in set i.  ``LEAD`` marks one row for each
    key and value of ``near``."""
    attrs = [c for c in df.columns if c not in (key, order, near)]
    row = F.struct(F.col(order).alias("_o"), *attrs)
    first = df.withColumn("_row", row).groupBy(near, key).agg(
        *[F.min(F.when(c, F.col("_row"))).alias(f"_first{i}") for i, c in enumerate(sets)])
    rows, before, lead = [], [], F.lit(True)
    for i in range(len(sets)):
        own = F.col(f"_first{i}")
        new, bits = own.isNotNull(), F.lit(0)
        for other in before:
            new = new & ~own.eqNullSafe(other)
        for j in range(i, len(sets)):
            bits = bits + F.when(own.eqNullSafe(F.col(f"_first{j}")), 1 << j).otherwise(0)
        rows.append(F.when(new, F.struct(bits.alias(SETS), lead.alias(LEAD), own.alias("_row"))))
        before.append(own)
        lead = lead & own.isNull()
    return first.select(key, F.inline(F.filter(F.array(*rows), lambda r: r.isNotNull()))) \
        .select(key, *[F.col(f"_row.{c}").alias(c) for c in attrs], F.col("_row._o").alias(order),
                SETS, LEAD) \
        .select(*[c for c in df.columns if c != near], SETS, LEAD)


def first_row(df: DataFrame, key: str, attrs: list[str], order: str = ORD,
              keep_order: bool = False, near: str | None = None) -> DataFrame:
    """``key`` and ``attrs`` of each key's first row.  The least struct of (order,
    attributes) is that row, so the order key travels once per row.  ``near``: the first
    row of each key and value of this column."""
    first = F.min(F.struct(F.col(order).alias("_o"), *[F.col(c) for c in attrs]))
    out = [key, *[F.col(f"_first.{c}").alias(c) for c in attrs]]
    if keep_order:
        out.append(F.col("_first._o").alias(order))
    return df.groupBy(*([near] if near else []), key).agg(first.alias("_first")).select(*out)


def is_complete(df: DataFrame, subset=None):
    """Whether F5 keeps a row, as a column."""
    kept = F.lit(True)
    for c in subset or CRITICAL:
        kept = kept & F.col(c).isNotNull()
        if df.schema[c].dataType in (T.DoubleType(), T.FloatType()):
            kept = kept & ~F.isnan(F.col(c))
    return kept


def drop_incomplete(df: DataFrame, subset=None) -> DataFrame:
    """drop rows missing any critical field (NaN amounts count as missing)."""
    subset = subset or CRITICAL
    return df.na.drop(subset=subset)


def positive_amount(df: DataFrame) -> DataFrame:
    """``amount > 0``.  Must follow F5: in Spark NaN > 0 is true."""
    return df.filter(F.col("amount") > 0)


def standardise(df: DataFrame, strict_timestamps: bool = True,
                fmt: str = TIMESTAMP_FORMAT) -> DataFrame:
    """Parse timestamp (strict), derive the day, amount as double,
    upper-case status (no trimming)."""
    parse = parse_strict if strict_timestamps else parse_lenient
    return (df.withColumn("timestamp", parse(F.col("timestamp"), fmt))
            .withColumn("transaction_date", F.to_date(F.col("timestamp")))
            .withColumn("amount", F.col("amount").cast("double"))
            .withColumn("status", F.upper(F.col("status"))))


def mask_pii(df: DataFrame, min_digits: int = 7, salt: str | None = None) -> DataFrame:
    """P1-P3 applied to the cleaned rows."""
    return (df.withColumn("masked_phone", mask_phone(F.col("phone_number"), min_digits))
            .withColumn("masked_user_name", mask_name(F.col("user_name")))
            .withColumn("phone_hash", hash_pii(F.col("phone_number"), salt)))


def clean(raw: DataFrame, strict_timestamps: bool = True) -> DataFrame:
    """F4 -> F5 -> F6 -> F7..F10, keeping ``ingest_ord`` for the model step."""
    return standardise(positive_amount(drop_incomplete(dedupe_first(raw))), strict_timestamps)


def transform(raw: DataFrame, strict_timestamps: bool = True, min_digits: int = 7,
              salt: str | None = None) -> DataFrame:
    """Clean + mask: the frame every model table is projected from."""
    return mask_pii(clean(raw, strict_timestamps), min_digits, salt)


def cleaning_counters(raw: DataFrame, delta: DataFrame | None = None) -> DataFrame:
    """rows read, rows in the batch, rows left after each cleaning step.

    Two aggregates (raw and deduped), each a single pass with conditional
    counts; returned as one row per step.
    """
    delta = raw if delta is None else delta
    flags = dedupe_first(delta).select(
        F.lit(1).alias("one"),
        F.when(F.col("transaction_id").isNotNull() & F.col("user_id").isNotNull()
               & F.col("amount").isNotNull() & ~F.isnan(F.col("amount"))
               & F.col("status").isNotNull(), 1).alias("complete"),
        F.col("amount"))
    after = flags.agg(
        F.count("one").alias("after_dedupe"),
        F.count("complete").alias("after_null_filter"),
        F.count_if(F.col("complete").isNotNull() & (F.col("amount") > 0)).alias("after_amount_filter"))
    counts = after.select(F.inline(F.array(
        F.struct(F.lit(3).alias("step_no"), F.lit("dedupe").alias("step"),
                 F.col("after_dedupe").alias("rows")),
        F.struct(F.lit(4).alias("step_no"), F.lit("drop_missing").alias("step"),
                 F.col("after_null_filter").alias("rows")),
        F.struct(F.lit(5).alias("step_no"), F.lit("positive_amount").alias("step"),
                 F.col("after_amount_filter").alias("rows")))))
    read = raw.agg(F.lit(1).alias("step_no"), F.lit("read").alias("step"),
                   F.count(F.lit(1)).alias("rows"))
    batch = delta.agg(F.lit(2).alias("step_no"), F.lit("batch").alias("step"),
                      F.count(F.lit(1)).alias("rows"))
    return read.unionByName(batch).unionByName(counts)
