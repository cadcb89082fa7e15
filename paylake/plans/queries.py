"""Registered queries: one per operator family of the blueprint.

Every query reads the supplied tables through the adapter, so its work grows
with ``lineitem``; none runs on fixed or sampled input.  Each returns a lazy
DataFrame (the caller triggers it); the load and upsert queries first run the
load job into a warehouse of their own and return what its tables hold.

Batch parameters for the incremental/upsert queries: batch A holds the events
before ``CUT_DAY``, batch B those from ``OVERLAP_DAY`` on.  The overlap makes
the upsert modes visible: for overlap days B's dedupe sees fewer earlier
copies than A's did, so REPLACE, keep-last and IGNORE give different tables.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.functions.timeparse import parse_day
from paylake.functions.privacy import hash_pii, mask_name, mask_phone
from paylake.operators import analytics as Q
from paylake.operators import analytics_sql as S
from paylake.operators import cleaning as C
from paylake.operators import model as M
from paylake.operators import quality as DQ
from paylake.operators.timestamps import canonical
from paylake.operators.joins import scan_rows
from paylake.plans.load import RAW_PII, default_day, prepare_ranges, run_load
from paylake.schemas import ORD, RAW_COLUMNS
from paylake.session import scratch_path, stage
from paylake.sources.day_index import DayIndex
from paylake.sources.raw import read_raw_csv
from paylake.sources.summary_state import daily_summary_exact
from paylake.sources.testdata import raw_transactions
from paylake.sources.warehouse import Warehouse

SLICE_DAY = "1998-07-01"
CUT_DAY = "1998-07-01"
OVERLAP_DAY = "1998-01-01"


def _raw(spark, sf_dir):
    return raw_transactions(spark, sf_dir)


def _model(spark, sf_dir) -> dict[str, DataFrame]:
    return M.star_schema(C.transform(_raw(spark, sf_dir)))


def _batch(spark, sf_dir, start, end) -> dict[str, DataFrame]:
    raw = raw_transactions(spark, sf_dir, start, end)
    return M.star_schema(C.transform(C.between_days(raw, start, end)))


# --- scans and cleaning ------------------------------------------------------

def raw_day_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_transactions(spark, sf_dir, SLICE_DAY, None)
    return C.day_slice(raw, SLICE_DAY).select(*RAW_COLUMNS)


def raw_default_day(spark, sf_dir):
    """The default target day of a load that runs the day after SLICE_DAY."""
    day = default_day(today=parse_day(SLICE_DAY) + timedelta(days=1))
    return C.day_slice(raw_transactions(spark, sf_dir, day, None), day).select(*RAW_COLUMNS)


def dedupe_first(spark, sf_dir):
    return C.dedupe_first(_raw(spark, sf_dir)).drop(ORD)


def clean_transactions(spark, sf_dir):
    return C.clean(_raw(spark, sf_dir)).drop(ORD, "user_name", "phone_number")


def cleaning_counters(spark, sf_dir):
    return C.cleaning_counters(_raw(spark, sf_dir))


# --- privacy -----------------------------------------------------------------

def mask_phone_q(spark, sf_dir):
    return (_raw(spark, sf_dir)
            .select("phone_number", mask_phone(F.col("phone_number")).alias("masked_phone"))
            .distinct())


def mask_name_q(spark, sf_dir):
    return (_raw(spark, sf_dir)
            .select("user_name", mask_name(F.col("user_name")).alias("masked_user_name"))
            .distinct())


def hash_phone_q(spark, sf_dir):
    return (_raw(spark, sf_dir)
            .select("phone_number", hash_pii(F.col("phone_number")).alias("phone_hash"))
            .distinct())


# --- model -------------------------------------------------------------------

def dim_users(spark, sf_dir):
    return _model(spark, sf_dir)["dim_users"]


def dim_merchants(spark, sf_dir):
    return _model(spark, sf_dir)["dim_merchants"]


def fact_transactions(spark, sf_dir):
    return _model(spark, sf_dir)["fact_transactions"]


def daily_merchant_summary(spark, sf_dir):
    return _model(spark, sf_dir)["daily_merchant_summary"]


def daily_summary_exact_q(spark, sf_dir):
    """A1, A4, A5: the daily summary, volumes the doubles nearest to the true sums."""
    return daily_summary_exact(C.transform(_raw(spark, sf_dir)))


# --- data quality ------------------------------------------------------------

def _raw_users(raw: DataFrame) -> DataFrame:
    """The raw log seen as an unmasked user table (what the PII rule guards)."""
    return raw.select("user_id", F.col("user_name").alias("masked_user_name"),
                      F.col("phone_number").alias("masked_phone"))


def _union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dq_uniqueness(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    m = M.star_schema(C.transform(raw))
    return _union([
        DQ.uniqueness(raw, "transaction_id", "raw_transactions", 1),
        DQ.uniqueness(m["dim_users"], "user_id", "dim_users", 2),
        DQ.uniqueness(m["dim_merchants"], "merchant_id", "dim_merchants", 3),
        DQ.uniqueness(m["fact_transactions"], "transaction_id", "fact_transactions", 4),
    ])


def dq_completeness(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    fact = M.fact_transactions(C.transform(raw))
    return _union([
        DQ.completeness(raw, DQ.FACT_REQUIRED, "raw_transactions", "transaction_id", 1),
        DQ.completeness(fact, DQ.FACT_REQUIRED, "fact_transactions", "transaction_id", 6),
    ])


def dq_validity(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    fact = M.fact_transactions(C.transform(raw))
    return _union([DQ.validity(raw, "raw_transactions", 1),
                   DQ.validity(fact, "fact_transactions", 3)])


def dq_pii(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    users = M.dim_users(C.transform(raw))
    return _union([DQ.pii(_raw_users(raw), "raw_transactions", 1),
                   DQ.pii(users, "dim_users", 4)])


def dq_composite_key(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    cl = C.transform(raw)
    keys = ["transaction_date", "merchant_category"]
    return _union([DQ.uniqueness(cl, keys, "clean_transactions", 1),
                   DQ.uniqueness(M.daily_summary(cl), keys, "daily_merchant_summary", 2)])


def dq_orphans(spark, sf_dir):
    a = _batch(spark, sf_dir, None, CUT_DAY)
    full = _model(spark, sf_dir)
    return _union([
        DQ.orphans(full["fact_transactions"], full["dim_users"], "user_id", rule_no=1),
        DQ.orphans(full["fact_transactions"], full["dim_merchants"], "merchant_id", rule_no=2),
        # facts of the whole log against the users known to batch A only
        DQ.orphans(full["fact_transactions"], a["dim_users"], "user_id", rule_no=3),
    ])


def dq_orphans_prefiltered(spark, sf_dir):
    """Facts of batch B against the dimensions of the whole log and the users of
    batch A; keys that a sketch of the facts' keys rules out are not shuffled."""
    full, a, b = _key_models(spark, sf_dir, (None, None), (None, CUT_DAY), (OVERLAP_DAY, None))
    fact = b["fact_transactions"]
    users, merchants = (scan_rows(spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet"))
                        for t in ("customer", "supplier"))  # Parquet footers
    return _union([
        DQ.orphans(fact, dim, key, rule_no=i, expected_keys=keys)
        for i, (dim, key, keys) in enumerate([(full["dim_users"], "user_id", users),
                                              (full["dim_merchants"], "merchant_id", merchants),
                                              (a["dim_users"], "user_id", users)], 1)])


#: Raw rows from which a model that many rules read is stored once instead of being
#: made for each of them.
STAGE_ROWS = 1_000_000


def _log_rows(spark, sf_dir) -> int:
    return scan_rows(spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet"))


def _shared_model(spark, sf_dir) -> dict[str, DataFrame]:
    """``_model`` for several readers: of a large log the cleaned rows, then the small
    tables made from them, are staged, as a load does."""
    clean = C.transform(_raw(spark, sf_dir))
    if _log_rows(spark, sf_dir) < STAGE_ROWS:
        return M.star_schema(clean)
    m = M.star_schema(stage(clean.drop(*RAW_PII), spark, "clean"))
    return {n: t if n == "fact_transactions" else stage(t, spark, n) for n, t in m.items()}


def _key_models(spark, sf_dir, *ranges) -> list[dict[str, DataFrame]]:
    """``_batch`` of each range of days (``None, None``: ``_model``), for readers of the
    keys alone: of a large log the keys of the cleaned rows of all ranges are staged from
    one pass over it."""
    if _log_rows(spark, sf_dir) < STAGE_ROWS:
        return [_model(spark, sf_dir) if r == (None, None) else _batch(spark, sf_dir, *r)
                for r in ranges]
    keys = ["user_id", "merchant_id"]
    raw = raw_transactions(spark, sf_dir, near=True)
    return [M.key_tables(clean, keys) for clean in prepare_ranges(spark, raw, [*ranges], keys)]


def dq_report(spark, sf_dir):
    m = _shared_model(spark, sf_dir)
    return DQ.report(m["dim_users"], m["dim_merchants"], m["fact_transactions"],
                     m["daily_merchant_summary"], check_orphans=True)


# --- upserts and load modes --------------------------------------------------

def _loaded(spark, sf_dir, *ranges, fact_mode: str = "ignore", **options) -> Warehouse:
    """A fresh warehouse in the shared folder after one load job per range of days
    (``None, None``: a full load): scan, clean, gate, upserts.  The supplied log has
    a few hundred rows a day, so the fact is laid out by month."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"), layout="month")
    wh.create_tables()
    for start, end in ranges:
        raw = raw_transactions(spark, sf_dir, start, end, near=True)
        run_load(spark, raw, wh, start=start, end=end,
                 full=start is None and end is None, fact_mode=fact_mode, **options)
    return wh


BATCH_A = (None, CUT_DAY)
BATCH_B = (OVERLAP_DAY, None)


def upsert_replace(spark, sf_dir):
    """Stored daily summary after loads of batch A then B: REPLACE on (day, category)."""
    return _loaded(spark, sf_dir, BATCH_A, BATCH_B).read("daily_merchant_summary")


def upsert_keep_last(spark, sf_dir):
    """Stored fact after replace loads of batch A then B: the last version per id."""
    return _loaded(spark, sf_dir, BATCH_A, BATCH_B, fact_mode="replace").read("fact_transactions")


def insert_ignore(spark, sf_dir):
    """Stored fact after ignore loads of batch A then B: the stored version per id."""
    return _loaded(spark, sf_dir, BATCH_A, BATCH_B).read("fact_transactions")


def full_load_daily(spark, sf_dir):
    """L1: the summary table a full load writes into an empty warehouse."""
    return _loaded(spark, sf_dir, (None, None)).read("daily_merchant_summary")


def incremental_replay(spark, sf_dir):
    """L2: loads of batch A, batch B, then batch B again; the replay changes nothing."""
    wh = _loaded(spark, sf_dir, BATCH_A, BATCH_B, BATCH_B)
    return wh.read("daily_merchant_summary")


def incremental_replay_fact(spark, sf_dir):
    """L2: the stored fact after the same three loads."""
    return _loaded(spark, sf_dir, BATCH_A, BATCH_B, BATCH_B).read("fact_transactions")


def summary_state_replay(spark, sf_dir):
    """A1, L2: the stored summary after ignore loads of batch A, batch B and batch B
    again, each day from the state that the loads have added to."""
    return _loaded(spark, sf_dir, BATCH_A, BATCH_B, BATCH_B, summary_from_state=True) \
        .read("daily_merchant_summary")


def catalog_fact(spark, sf_dir):
    """Tables created in the session catalog; the fact of a full load read back by
    its catalog name."""
    root = scratch_path(spark, "warehouse")
    database = "paylake_" + root.rsplit("-", 1)[1]
    wh = Warehouse(spark, root, database=database, layout="month")
    wh.create_tables()
    run_load(spark, raw_transactions(spark, sf_dir, near=True), wh, full=True)
    return spark.table(f"`{database}`.`fact_transactions`").select(
        *wh.schema("fact_transactions").fieldNames())


#: Queries that return a table which their own loads have written.
LOADED = (upsert_replace, upsert_keep_last, insert_ignore, full_load_daily, incremental_replay,
          incremental_replay_fact, summary_state_replay, catalog_fact)


def raw_csv_roundtrip(spark, sf_dir):
    """The raw log written as CSV files and scanned again."""
    path = scratch_path(spark, "raw-csv")
    _raw(spark, sf_dir).drop(ORD).write.option("header", True).option("escape", '"').csv(path)
    return read_raw_csv(spark, path).select(*RAW_COLUMNS)


def raw_csv_multiline(spark, sf_dir):
    """Names with line breaks and quotes, written as CSV and scanned in splits."""
    path = scratch_path(spark, "raw-csv-lines")
    name = F.concat(F.lit('"'), F.replace("user_name", F.lit(" "), F.lit("\n")), F.lit('",\n.'))
    _raw(spark, sf_dir).drop(ORD).withColumn("user_name", name) \
        .write.option("header", True).option("escape", '"').csv(path)
    return read_raw_csv(spark, path, multi_line=True).select(*RAW_COLUMNS)


def raw_day_indexed(spark, sf_dir):
    """the log written as CSV files by time; the day index picks the files of a day."""
    path = scratch_path(spark, "raw-csv-time")
    _raw(spark, sf_dir).drop(ORD).repartitionByRange("timestamp").write \
        .option("header", True).option("escape", '"').csv(path)
    index = DayIndex(spark, path, scratch_path(spark, "day-index"))
    return index.read(SLICE_DAY, parse_day(SLICE_DAY) + timedelta(days=1)).select(*RAW_COLUMNS)


def timestamps_inferred(spark, sf_dir):
    """ISO timestamps with fractions in the files of one half of the log, days
    alone in those of the other; every file tells its own format."""
    path = scratch_path(spark, "raw-csv-iso")
    raw = _raw(spark, sf_dir).drop(ORD)
    t = F.col("timestamp")
    iso = F.concat(F.replace(t, F.lit(" "), F.lit("T")), F.lit(".250"))
    for cond, value in ((t < CUT_DAY, iso), (t >= CUT_DAY, F.substring(t, 1, 10))):
        raw.where(cond).withColumn("timestamp", value).write.mode("append") \
            .option("header", True).option("escape", '"').csv(path)
    found = canonical(read_raw_csv(spark, path))
    return C.between_days(found, OVERLAP_DAY, None).select(*RAW_COLUMNS)


def dq_status_values(spark, sf_dir):
    """The distinct statuses outside the domain in the raw log, with their rows."""
    return DQ.invalid_statuses(_raw(spark, sf_dir))


def dq_missing_column(spark, sf_dir):
    """The merchant table without one of its required columns."""
    merchants = _model(spark, sf_dir)["dim_merchants"].drop("merchant_name")
    return DQ.completeness(merchants, DQ.MERCHANT_REQUIRED, "dim_merchants", "merchant_id")


# --- analytics ---------------------------------------------------------------

def q1_daily_gtv(spark, sf_dir):
    return Q.q1_daily_gtv(_model(spark, sf_dir)["fact_transactions"])


def q2_category_ranking(spark, sf_dir):
    m = _model(spark, sf_dir)
    return Q.q2_category_ranking(m["fact_transactions"], m["dim_merchants"])


def q3_payment_health(spark, sf_dir):
    return Q.q3_payment_health(_model(spark, sf_dir)["fact_transactions"])


def q3b_payment_rate(spark, sf_dir):
    return Q.q3b_payment_rate(_model(spark, sf_dir)["fact_transactions"])


def q4_top_users(spark, sf_dir):
    m = _model(spark, sf_dir)
    return Q.q4_top_users(m["fact_transactions"], m["dim_users"])


def _sql_form(spark, sf_dir, name):
    m = _model(spark, sf_dir)
    S.register_views(m["fact_transactions"], m["dim_users"], m["dim_merchants"])
    return S.run(spark, name)


def q2_category_ranking_sql(spark, sf_dir):
    """The SQL text with common table expressions over the model's views."""
    return _sql_form(spark, sf_dir, "q2_category_ranking")


def q4_top_users_sql(spark, sf_dir):
    """The SQL text over the model's views."""
    return _sql_form(spark, sf_dir, "q4_top_users")


REGISTRY = {
    "raw_day_slice": raw_day_slice,
    "raw_default_day": raw_default_day,
    "dedupe_first": dedupe_first,
    "clean_transactions": clean_transactions,
    "cleaning_counters": cleaning_counters,
    "mask_phone": mask_phone_q,
    "mask_name": mask_name_q,
    "hash_phone": hash_phone_q,
    "dim_users": dim_users,
    "dim_merchants": dim_merchants,
    "fact_transactions": fact_transactions,
    "daily_merchant_summary": daily_merchant_summary,
    "daily_summary_exact": daily_summary_exact_q,
    "dq_uniqueness": dq_uniqueness,
    "dq_completeness": dq_completeness,
    "dq_validity": dq_validity,
    "dq_pii": dq_pii,
    "dq_composite_key": dq_composite_key,
    "dq_orphans": dq_orphans,
    "dq_orphans_prefiltered": dq_orphans_prefiltered,
    "dq_report": dq_report,
    "upsert_replace": upsert_replace,
    "upsert_keep_last": upsert_keep_last,
    "insert_ignore": insert_ignore,
    "full_load_daily": full_load_daily,
    "incremental_replay": incremental_replay,
    "incremental_replay_fact": incremental_replay_fact,
    "summary_state_replay": summary_state_replay,
    "catalog_fact": catalog_fact,
    "raw_csv_roundtrip": raw_csv_roundtrip,
    "raw_csv_multiline": raw_csv_multiline,
    "raw_day_indexed": raw_day_indexed,
    "timestamps_inferred": timestamps_inferred,
    "dq_status_values": dq_status_values,
    "dq_missing_column": dq_missing_column,
    "q1_daily_gtv": q1_daily_gtv,
    "q2_category_ranking": q2_category_ranking,
    "q3_payment_health": q3_payment_health,
    "q3b_payment_rate": q3b_payment_rate,
    "q4_top_users": q4_top_users,
    "q2_category_ranking_sql": q2_category_ranking_sql,
    "q4_top_users_sql": q4_top_users_sql,
}
