"""Load jobs: full load (L1) and incremental load of a day or range (L2).

    raw -> [day filter] -> clean + mask  --stage-->  star schema --stage-->
        quality gate (raises before any warehouse write) -> upserts

The cleaned batch is staged once as Parquet in the shared folder: it feeds
four model tables and the gate, so the scan/join/dedupe work runs once and a
lost executor costs a re-read, not a recompute of the whole lineage.  The
cleaning counters are collected with ``observe`` inside that same job.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from paylake.functions.timeparse import parse_day, parse_lenient, yesterday
from paylake.operators import cleaning as C
from paylake.operators import model as M
from paylake.operators import quality as DQ
from paylake.operators.timestamps import INFER, canonical
from paylake.schemas import NEAR, TABLES, TIMESTAMP_FORMAT
from paylake.session import delete_paths, stage
from paylake.sources.jdbc import append_all
from paylake.sources.raw import CORRUPT
from paylake.sources.summary_state import SummaryState
from paylake.sources.warehouse import Warehouse

FACT_MODES = ("ignore", "replace")
RAW_PII = ("user_name", "phone_number")
KEPT = "_kept"
#: Cleaned rows from which the dimensions are found in two passes over the staged batch.
TWO_PASS_ROWS = 1_000_000


@dataclass
class LoadResult:
    counters: dict = field(default_factory=dict)
    report: list = field(default_factory=list)
    fact_rows_added: int | None = None
    loaded: bool = False
    timings: dict = field(default_factory=dict)  # seconds per phase


def _count(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(f"{name}-{uuid.uuid4().hex[:12]}")  # names must be unique
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def prepare(spark: SparkSession, raw: DataFrame, start=None, end=None,
            strict_timestamps: bool = True, min_digits: int = 7,
            salt: str | None = None, scope: list | None = None,
            fmt: str = TIMESTAMP_FORMAT) -> tuple[DataFrame, dict]:
    """Filter, clean, mask and stage one batch; return (staged, counters).  A scan that
    marks corrupt records (``raw.CORRUPT``) has them counted, before the day filter."""
    o_corrupt = None
    if CORRUPT in raw.columns:
        o_corrupt = Observation(f"corrupt-{uuid.uuid4().hex[:12]}")
        raw = raw.observe(o_corrupt, F.count_if(CORRUPT).alias("rows")).drop(CORRUPT)
    batch = raw if start is None and end is None else C.between_days(raw, start, end, fmt)
    plain, whole = batch.drop(NEAR), batch
    batch, o_batch = _count(plain, "batch")
    staged = None
    if NEAR in whole.columns:
        staged, counters = _prepare_near(spark, whole, strict_timestamps, min_digits, salt, scope,
                                         fmt)
    if staged is None:
        staged, counters = _prepare_all(spark, batch, strict_timestamps, min_digits, salt, scope,
                                        fmt)
        counters = {"batch": o_batch.get.get("rows", 0), **counters}
    # what each step removed, as the reference reports it
    counters["removed_duplicates"] = counters["batch"] - counters["dedupe"]
    counters["removed_missing"] = counters["dedupe"] - counters["drop_missing"]
    counters["removed_invalid_amount"] = counters["drop_missing"] - counters["positive_amount"]
    if o_corrupt is not None:
        counters["corrupt_records"] = o_corrupt.get.get("rows", 0)
    return staged, counters


def _prepare_all(spark, batch, strict_timestamps, min_digits, salt, scope,
                 fmt) -> tuple[DataFrame, dict]:
    """Dedupe of whole rows by id, then the other steps; (staged, counters)."""
    # the steps after the dedupe are counted in one place: every observed step costs
    # another copy of the row
    o_steps = Observation(f"steps-{uuid.uuid4().hex[:12]}")
    deduped = C.dedupe_first(batch)
    complete = C.is_complete(deduped)
    deduped = deduped.observe(
        o_steps, F.count(F.lit(1)).alias("dedupe"), F.count_if(complete).alias("drop_missing"),
        F.count_if(complete & (F.col("amount") > 0)).alias("positive_amount"))
    positive = C.positive_amount(C.drop_incomplete(deduped))
    cleaned = C.mask_pii(C.standardise(positive, strict_timestamps, fmt), min_digits, salt)
    # raw PII never reaches storage: only masked values and the hash are staged
    staged = stage(cleaned.drop(*RAW_PII), spark, "clean", scope)
    return staged, {k: o_steps.get.get(k, 0)
                    for k in ("dedupe", "drop_missing", "positive_amount")}


def _prepare_near(spark, batch, strict_timestamps, min_digits, salt, scope,
                  fmt) -> tuple[DataFrame | None, dict]:
    """``_prepare_all`` without the shuffle of whole rows: copies of an id that share
    the batch's ``NEAR`` value meet there, the first is staged, and a count of the
    staged ids proves that none is left twice.  Rows that fail a filter are staged as
    their id alone, for this count.  Nothing (None) if an id is left twice, or if a row
    that is kept has a timestamp which a strict parse refuses: the caller then takes the
    plain way, which also raises."""
    batch, o_batch = _count(batch, "batch")
    o_steps = Observation(f"steps-{uuid.uuid4().hex[:12]}")
    first = C.dedupe_near(batch, NEAR)
    text, known = F.col("timestamp"), F.col("transaction_id").isNotNull()
    complete = C.is_complete(first)
    first = first.withColumn(KEPT, F.coalesce(complete & (F.col("amount") > 0), F.lit(False))) \
        .withColumn("_complete", complete).withColumn("_text", text.isNotNull())
    cleaned = C.standardise(first, False, fmt).observe(
        o_steps, F.count_if(known).alias("ids"), F.count_if(~known).alias("nulls"),
        F.count_if("_complete").alias("drop_missing"), F.count_if(KEPT).alias("positive_amount"),
        F.count_if(F.col(KEPT) & F.col("_text") & text.isNull()).alias("refused"))
    cleaned = C.mask_pii(cleaned, min_digits, salt).drop(*RAW_PII, "_complete", "_text")
    columns = [c for c in cleaned.columns if c != KEPT]
    own: list = []
    staged = stage(cleaned.select("transaction_id", KEPT, *[
        F.when(F.col(KEPT), F.col(c)).alias(c) for c in columns if c != "transaction_id"]),
        spark, "clean", own)
    steps = o_steps.get
    twice = staged.where(known).groupBy("transaction_id").count().where("count > 1")
    if (strict_timestamps and steps.get("refused", 0)) or not twice.isEmpty():
        delete_paths(spark, own)
        return None, {}
    if scope is not None:
        scope.extend(own)
    # null ids are one id, as in a group
    return staged.where(KEPT).select(*columns), {
        "batch": o_batch.get.get("rows", 0),
        "dedupe": steps.get("ids", 0) + min(1, steps.get("nulls", 0)),
        **{k: steps.get(k, 0) for k in ("drop_missing", "positive_amount")}}


def prepare_ranges(spark: SparkSession, raw: DataFrame, ranges: list[tuple],
                   columns: list[str], scope: list | None = None) -> list[DataFrame]:
    """``columns`` of the cleaned rows of each range of days (``None, None``: the whole
    log), each range cleaned by itself, from one pass over ``raw``: the copies of an id
    that share its ``NEAR`` value meet there, once for all ranges, and a count of the staged
    ids proves that none is left twice, as in ``_prepare_near``.  If one is, every range
    is cleaned the plain way, lazily."""
    parses = parse_lenient(F.col("timestamp")).isNotNull()
    sets = [F.lit(True) if r == (None, None) else C.in_days(*r, parses=parses) for r in ranges]
    first = C.dedupe_sets(raw, NEAR, sets)
    kept = F.coalesce(C.is_complete(first) & (F.col("amount") > 0), F.lit(False))
    first = first.withColumn(KEPT, kept).where(F.col(KEPT) | F.col(C.LEAD))
    cleaned = C.mask_pii(C.standardise(first))
    own: list = []
    # a lead row has its id, for the count; a row that passed the filters has its columns
    staged = stage(cleaned.select(
        F.when(F.col(C.LEAD), F.col("transaction_id")).alias("_id"),
        *[F.when(F.col(KEPT), F.col(c)).alias(c) for c in [*columns, C.SETS]]),
        spark, "ranges", own)
    twice = staged.where(F.col("_id").isNotNull()).groupBy("_id").count().where("count > 1")
    if not twice.isEmpty():
        delete_paths(spark, own)
        plain = raw.drop(NEAR)
        return [C.transform(plain if r == (None, None) else C.between_days(plain, *r))
                .select(*columns) for r in ranges]
    if scope is not None:
        scope.extend(own)
    return [staged.where(F.col(C.SETS).bitwiseAND(1 << i) != 0).select(*columns)
            for i in range(len(ranges))]


def run_load(spark: SparkSession, raw: DataFrame, warehouse: Warehouse, *,
             day=None, start=None, end=None, full: bool = False,
             fact_mode: str = "ignore", strict_timestamps: bool = True,
             min_digits: int = 7, salt: str | None = None,
             check_orphans: bool = False, count_read: bool = False,
             timestamp_format: str = TIMESTAMP_FORMAT, summary_from_store: bool = False,
             summary_from_state: bool = False, jdbc: dict | None = None, export_dir: str | None = None) -> LoadResult:
    """One load.  ``full`` wins over ``day``/``start``/``end`` (as ``--full``
    wins over ``--date`` in the reference).  With none of them given the
    caller must choose: see ``default_day``.  ``count_read`` adds the rows of
    the whole source (before the day filter) to the counters - a separate
    count job over the whole source, so ask for it only where that is wanted.

    ``timestamp_format`` is the raw log's (a Spark datetime pattern), or ``"infer"``:
    each file's first value decides, at the price of a pass over order and timestamp.
    ``summary_from_store`` makes the daily summary of the batch's days from the
    stored facts, for batches that do not hold whole days; ``summary_from_state`` makes
    it from a stored state to which the batch is added (``sources.summary_state``; the
    facts of these days are only counted; volumes are exact sums).  ``jdbc`` (``url``,
    optional ``props`` and ``num_partitions``) appends the batch's four tables to
    a database, ``export_dir`` writes the four stored tables as CSV folders,
    both after the warehouse's own writes; a failure raises."""
    if fact_mode not in FACT_MODES:
        raise ValueError(f"fact_mode must be one of {FACT_MODES}")
    if timestamp_format == INFER:
        raw, timestamp_format = canonical(raw), TIMESTAMP_FORMAT
    if full:
        start = end = None
    elif day is not None:
        start = parse_day(day)
        end = start + _dt.timedelta(days=1)
    elif start is None and end is None:
        raise ValueError("give day=, start=/end= or full=True")

    scope: list = []
    try:
        result = _load(spark, raw, warehouse, start, end, fact_mode, strict_timestamps,
                       min_digits, salt, check_orphans, scope, timestamp_format,
                       summary_from_store, summary_from_state, jdbc, export_dir)
        if count_read:
            result.counters = {"read": raw.count(), **result.counters}
        return result
    finally:
        delete_paths(spark, scope)  # the batch copies; the warehouse drops its own


@contextmanager
def _described(spark: SparkSession, text: str):
    """Label the Spark jobs of a phase (visible in event logs)."""
    sc = spark.sparkContext
    previous = sc.getLocalProperty("spark.job.description")
    sc.setJobDescription(f"paylake load: {text}")
    try:
        yield
    finally:
        sc.setJobDescription(previous)


def _load(spark, raw, warehouse, start, end, fact_mode, strict_timestamps, min_digits, salt,
          check_orphans, scope, fmt, summary_from_store, summary_from_state, jdbc,
          export_dir) -> LoadResult:
    t0 = time.perf_counter()
    with _described(spark, "prepare"):
        staged, counters = prepare(spark, raw, start, end, strict_timestamps, min_digits, salt,
                                   scope, fmt)
    result = LoadResult(counters=counters)
    result.timings["prepare"] = time.perf_counter() - t0
    if counters["positive_amount"] == 0:
        return result  # nothing to load: the reference's no-op

    # The small model tables are staged first (they are aggregates of the
    # cleaned batch); the gate then reads the staged copies, and the upserts
    # count and join them without recomputing the aggregations.
    keep = None
    if counters["positive_amount"] > TWO_PASS_ROWS:
        def keep(df, name):
            return stage(df, spark, name, scope)
    tables = M.star_schema(staged, keep)
    with _described(spark, "model"):
        users = stage(tables["dim_users"], spark, "dim_users-batch", scope)
        merchants = stage(tables["dim_merchants"], spark, "dim_merchants-batch", scope)
        summary = stage(tables["daily_merchant_summary"], spark, "summary-batch", scope)
    fact = tables["fact_transactions"]
    result.timings["model"] = time.perf_counter() - t0 - result.timings["prepare"]
    t1 = time.perf_counter()
    with _described(spark, "quality gate"):
        result.report = DQ.validate_all(users, merchants, fact, summary,
                                        check_orphans=check_orphans)
    result.timings["gate"] = time.perf_counter() - t1
    t2 = time.perf_counter()

    days = [r[0] for r in fact.select("transaction_date").distinct().collect()]
    with _described(spark, "upsert dimensions"):
        warehouse.upsert_replace_table("dim_users", users)
        warehouse.upsert_replace_table("dim_merchants", merchants)
    state = SummaryState(warehouse) if summary_from_state else None
    with _described(spark, f"fact {fact_mode}"):
        if fact_mode == "ignore":
            result.fact_rows_added = warehouse.insert_ignore_table(
                "fact_transactions", fact, state.add if state else None)
        else:
            days = warehouse.keep_last_table("fact_transactions", fact)
            if state:
                state.rebuild([d for d in days if d is not None])
    with _described(spark, "upsert summary"):
        if state:
            summary = stage(state.daily(days), spark, "summary-state", scope)
        elif summary_from_store:
            summary = stage(stored_summary(warehouse, days), spark, "summary-stored", scope)
        warehouse.upsert_replace_table("daily_merchant_summary", summary)
        warehouse.refresh(days)
    if jdbc:
        with _described(spark, "jdbc append"):
            append_all({"dim_users": users, "dim_merchants": merchants,
                        "fact_transactions": fact, "daily_merchant_summary": summary},
                       jdbc["url"], jdbc.get("props") or {}, jdbc.get("num_partitions"))
    if export_dir:
        with _described(spark, "csv export"):
            for name in TABLES:
                warehouse.export_csv(name, f"{export_dir.rstrip('/')}/{name}")
    result.timings["write"] = time.perf_counter() - t2
    result.loaded = True
    return result


def stored_summary(warehouse: Warehouse, days: list) -> DataFrame:
    """The daily summary of ``days`` from the stored facts, categories by the
    stored merchants (the fact holds no category of its own)."""
    fact = warehouse.read_days("fact_transactions", [d for d in days if d is not None])
    merchants = warehouse.read("dim_merchants").select("merchant_id", "merchant_category")
    return M.daily_summary(fact.join(merchants, "merchant_id"))


def default_day(today: _dt.date | str | None = None) -> _dt.date:
    """yesterday - only when the caller opts in (see README, 8.11)."""
    return yesterday(today)
