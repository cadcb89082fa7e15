"""DuckDB SQL for every registered query (the correctness oracle).

The SQL restates the adapter mapping and each operator's semantics
independently of the Spark code: row_number() for first-in-order picks,
QUALIFY for dedupe, FILTER aggregates, and the two rounding rules.
Tables are the pre-registered views (lineitem, orders, ...).
"""

from __future__ import annotations

from paylake.plans.queries import CUT_DAY, OVERLAP_DAY, SLICE_DAY

_ORD = "o_ship, o_ok, o_ln, o_pk, o_sk"

RAW_CTE = """
raw AS (
  SELECT
    'TX-' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
    'USR-' || printf('%06d', o.o_custkey) AS user_id,
    concat_ws(' ', c.c_name, c.c_mktsegment) AS user_name,
    CASE c.c_custkey % 3
      WHEN 0 THEN '+62 8' || c.n9
      WHEN 1 THEN '08' || c.n9
      ELSE '(08' || substr(c.n9, 1, 2) || ') ' || substr(c.n9, 3, 3) || '-' || substr(c.n9, 6, 4)
    END AS phone_number,
    'MCH-' || printf('%06d', l.l_suppkey) AS merchant_id,
    s.s_name AS merchant_name,
    r.r_name AS merchant_category,
    CASE WHEN l.l_partkey % 97 = 0 THEN NULL
         WHEN l.l_partkey % 101 = 0 THEN CAST(-50000.0 AS DOUBLE)
         ELSE l.l_extendedprice END AS amount,
    CASE substr(o.o_orderpriority, 1, 1)
      WHEN '1' THEN 'QRIS' WHEN '2' THEN 'E-WALLET_BALANCE' WHEN '3' THEN 'VIRTUAL_ACCOUNT'
      WHEN '4' THEN 'CREDIT_CARD' WHEN '5' THEN 'DEBIT_CARD' END AS payment_method,
    CASE WHEN l.l_partkey % 89 = 0 THEN NULL
         WHEN l.l_returnflag IN ('A', 'N') THEN
           CASE WHEN l.l_partkey % 7 = 0 THEN 'success' ELSE 'SUCCESS' END
         WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'FAILED'
         WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'O' THEN 'PENDING' END AS status,
    strftime(l.l_shipdate + to_seconds(l.l_partkey % 86400), '%Y-%m-%d %H:%M:%S') AS "timestamp",
    l.l_shipdate AS o_ship, l.l_orderkey AS o_ok, l.l_linenumber AS o_ln,
    l.l_partkey AS o_pk, l.l_suppkey AS o_sk
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN (SELECT *, lpad(CAST((c_custkey * 7919 + 12345) % 1000000000 AS VARCHAR), 9, '0') AS n9
        FROM customer) c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

RAW_COLS = ("transaction_id, user_id, user_name, phone_number, merchant_id, merchant_name, "
            "merchant_category, amount, payment_method, status, \"timestamp\"")

MASK_PHONE = """CASE WHEN phone_number IS NULL THEN 'UNKNOWN'
      WHEN length(regexp_replace(phone_number, '[^0-9]', '', 'g')) < 7 THEN '****'
      ELSE left(regexp_replace(phone_number, '[^0-9]', '', 'g'), 4) || '****'
           || right(regexp_replace(phone_number, '[^0-9]', '', 'g'), 4) END"""

MASK_NAME = """CASE WHEN user_name IS NULL THEN 'Anonymous'
      ELSE array_to_string(list_transform(
             list_filter(regexp_split_to_array(user_name, '\\s+'), lambda t: t <> ''),
             lambda t: left(t, 1) || '****'), ' ') END"""

HASH_PHONE = "coalesce(sha256(phone_number), '')"

TS = "try_strptime(\"timestamp\", '%Y-%m-%d %H:%M:%S')"


def _slice(src: str, name: str, start: str | None, end: str | None) -> str:
    cond = [f"{TS} IS NOT NULL"]
    if start:
        cond.append(f"{TS} >= TIMESTAMP '{start} 00:00:00'")
    if end:
        cond.append(f"{TS} < TIMESTAMP '{end} 00:00:00'")
    return f"{name} AS (SELECT * FROM {src} WHERE {' AND '.join(cond)})"


def _clean(src: str, p: str) -> list[str]:
    """CTEs {p}dedup, {p}clean (cleaned + masked), {p}users, {p}merchants,
    {p}fact, {p}summary built from the raw-shaped CTE ``src``."""
    return [
        f"""{p}dedup AS (
  SELECT * FROM {src}
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY {_ORD}) = 1)""",
        f"""{p}clean AS (
  SELECT transaction_id, user_id, user_name, phone_number, merchant_id, merchant_name,
         merchant_category, CAST(amount AS DOUBLE) AS amount, payment_method,
         upper(status) AS status,
         strptime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp",
         CAST(strptime("timestamp", '%Y-%m-%d %H:%M:%S') AS DATE) AS transaction_date,
         {MASK_PHONE} AS masked_phone,
         {MASK_NAME} AS masked_user_name,
         {HASH_PHONE} AS phone_hash,
         {_ORD}
  FROM {p}dedup
  WHERE transaction_id IS NOT NULL AND user_id IS NOT NULL AND amount IS NOT NULL
    AND NOT isnan(amount) AND status IS NOT NULL AND amount > 0)""",
        f"""{p}users AS (
  SELECT user_id, masked_user_name, masked_phone, phone_hash FROM {p}clean
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {_ORD}) = 1)""",
        f"""{p}merchants AS (
  SELECT merchant_id, merchant_name, merchant_category FROM {p}clean
  QUALIFY row_number() OVER (PARTITION BY merchant_id ORDER BY {_ORD}) = 1)""",
        f"""{p}fact AS (
  SELECT transaction_id, user_id, merchant_id, amount, payment_method, status,
         "timestamp", transaction_date FROM {p}clean)""",
        f"""{p}summary AS (
  SELECT transaction_date, merchant_category,
         total_transactions, successful_transactions, failed_transactions,
         total_volume_idr, successful_volume_idr,
         round_even(((successful_transactions / total_transactions) * 100.0) * 100.0, 0) / 100.0
           AS success_rate_pct
  FROM (SELECT transaction_date, merchant_category,
               count(transaction_id) AS total_transactions,
               count(*) FILTER (WHERE status = 'SUCCESS') AS successful_transactions,
               count(*) FILTER (WHERE status = 'FAILED') AS failed_transactions,
               CAST(sum(CAST(amount AS DECIMAL(38,6))) AS DOUBLE) AS total_volume_idr,
               CAST(sum(CAST(CASE WHEN status = 'SUCCESS' THEN amount ELSE 0.0 END
                             AS DECIMAL(38,6))) AS DOUBLE) AS successful_volume_idr
        FROM {p}clean
        WHERE transaction_date IS NOT NULL AND merchant_category IS NOT NULL
        GROUP BY transaction_date, merchant_category))""",
    ]


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


FULL = _with(RAW_CTE, *_clean("raw", ""))
BATCHES = _with(RAW_CTE,
                _slice("raw", "raw_a", None, CUT_DAY), *_clean("raw_a", "a_"),
                _slice("raw", "raw_b", OVERLAP_DAY, None), *_clean("raw_b", "b_"),
                *_clean("raw", ""))


def _rate_half_up(s: str, t: str) -> str:
    return (f"CASE WHEN {t} > 0 THEN CAST(({s} * 20000 + {t}) // (2 * {t}) AS DOUBLE) / 100.0 "
            f"END")


# --- data-quality rule rows ---------------------------------------------------

def _rule(no, rule, table, column, v, sample, src):
    return (f"SELECT CAST({no} AS INTEGER) AS rule_no, '{rule}' AS rule, '{table}' AS table_name, "
            f"'{column}' AS column_name, CAST(coalesce({v}, 0) AS BIGINT) AS violations, "
            f"coalesce({v}, 0) = 0 AS passed, CAST({sample} AS VARCHAR) AS sample FROM {src}")


def _uniq(no, table, src, keys):
    if len(keys) == 1:
        ktext = f"CAST({keys[0]} AS VARCHAR)"
    else:
        ktext = "concat_ws('|', " + ", ".join(
            f"coalesce(CAST({k} AS VARCHAR), '<null>')" for k in keys) + ")"
    kl = ", ".join(keys)
    inner = (f"(SELECT sum(n - 1) AS v, min(k) AS s FROM "
             f"(SELECT {ktext} AS k, count(*) AS n FROM {src} GROUP BY {kl} HAVING count(*) > 1))")
    return _rule(no, "uniqueness", table, ",".join(keys), "v", "s", inner)


def _complete(no, table, src, cols, key, doubles=("amount",)):
    parts = []
    for i, c in enumerate(cols):
        miss = f"({c} IS NULL" + (f" OR isnan({c}))" if c in doubles else ")")
        inner = (f"(SELECT count(*) FILTER (WHERE {miss}) AS v, "
                 f"min(CASE WHEN {miss} THEN {key} END) AS s FROM {src})")
        parts.append(_rule(no + i, "completeness", table, c, "v", "s", inner))
    return parts


def _valid(no, table, src):
    bad = "(status IS NOT NULL AND status NOT IN ('SUCCESS', 'FAILED', 'PENDING'))"
    inner = (f"(SELECT count(*) FILTER (WHERE amount <= 0) AS va, "
             f"min(CASE WHEN amount <= 0 THEN transaction_id END) AS sa, "
             f"count(*) FILTER (WHERE {bad}) AS vs, min(CASE WHEN {bad} THEN status END) AS ss "
             f"FROM {src})")
    return [_rule(no, "amount_positive", table, "amount", "va", "sa", inner),
            _rule(no + 1, "status_domain", table, "status", "vs", "ss", inner)]


def _pii(no, table, src):
    ph = "coalesce(masked_phone, '')"
    nm = "coalesce(masked_user_name, '')"
    unm = f"(NOT contains({ph}, '****'))"
    leak = f"regexp_full_match({ph}, '(?:\\+?62|0)\\d{{8,12}}')"
    badn = f"(NOT contains({nm}, '****'))"
    inner = (f"(SELECT count(*) FILTER (WHERE {unm}) AS vp, min(CASE WHEN {unm} THEN user_id END) AS sp, "
             f"count(*) FILTER (WHERE {leak}) AS vl, min(CASE WHEN {leak} THEN user_id END) AS sl, "
             f"count(*) FILTER (WHERE {badn}) AS vn, min(CASE WHEN {badn} THEN user_id END) AS sn "
             f"FROM {src})")
    return [_rule(no, "pii_phone_masked", table, "masked_phone", "vp", "sp", inner),
            _rule(no + 1, "pii_phone_raw", table, "masked_phone", "vl", "sl", inner),
            _rule(no + 2, "pii_name_masked", table, "masked_user_name", "vn", "sn", inner)]


def _orphans(no, table, fact, dim, key):
    inner = (f"(SELECT sum(n) AS v, min({key}) AS s FROM "
             f"(SELECT {key}, count(*) AS n FROM {fact} WHERE {key} IS NOT NULL GROUP BY {key}) f "
             f"WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = f.{key}))")
    return _rule(no, "referential_integrity", table, key, "v", "s", inner)


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


FACT_REQ = ["transaction_id", "user_id", "merchant_id", "amount", "status"]


def _q1(fact):
    return f"""SELECT transaction_date, total_transactions, successful_transactions, total_gtv_idr,
       {_rate_half_up('successful_transactions', 'total_transactions')} AS overall_success_rate_pct
FROM (SELECT transaction_date, count(transaction_id) AS total_transactions,
             count(*) FILTER (WHERE status = 'SUCCESS') AS successful_transactions,
             round(sum(CASE WHEN status = 'SUCCESS' THEN amount ELSE 0.0 END), 2) AS total_gtv_idr
      FROM {fact} GROUP BY transaction_date)"""


def _q3_core(fact):
    return f"""SELECT payment_method, count(transaction_id) AS total_attempts,
       count(*) FILTER (WHERE status = 'SUCCESS') AS successful_tx,
       count(*) FILTER (WHERE status = 'FAILED') AS failed_tx,
       count(*) FILTER (WHERE status = 'PENDING') AS pending_tx
FROM {fact} GROUP BY payment_method"""


SUMMARY_COLS = ("transaction_date, merchant_category, total_transactions, successful_transactions, "
                "failed_transactions, total_volume_idr, successful_volume_idr, success_rate_pct")


def _exact(amount: str) -> str:
    """The double nearest to the true sum: the supplied amounts are whole multiples of
    2**-60 (53 bits from 2**-7 up); the sum's digits are read once, rounded to nearest."""
    return (f"CAST(CAST(sum(CAST({amount} * 1152921504606846976.0 AS HUGEINT)) AS VARCHAR) "
            f"AS DOUBLE) / 1152921504606846976.0")


def _summary_exact(src: str) -> str:
    ok = "CASE WHEN status = 'SUCCESS' THEN amount ELSE 0.0 END"
    return f"""SELECT *, round_even(((successful_transactions / total_transactions) * 100.0)
         * 100.0, 0) / 100.0 AS success_rate_pct
FROM (SELECT transaction_date, merchant_category,
             count(transaction_id) AS total_transactions,
             count(*) FILTER (WHERE status = 'SUCCESS') AS successful_transactions,
             count(*) FILTER (WHERE status = 'FAILED') AS failed_transactions,
             {_exact('amount')} AS total_volume_idr, {_exact(ok)} AS successful_volume_idr
      FROM {src}
      WHERE transaction_date IS NOT NULL AND merchant_category IS NOT NULL
      GROUP BY transaction_date, merchant_category)"""


def oracle_sql() -> dict[str, str]:
    replace_ab = (f"SELECT {SUMMARY_COLS} FROM a_summary a WHERE NOT EXISTS ("
                  f"SELECT 1 FROM b_summary b WHERE b.transaction_date = a.transaction_date "
                  f"AND b.merchant_category = a.merchant_category) "
                  f"UNION ALL SELECT {SUMMARY_COLS} FROM b_summary")
    fact_cols = ("transaction_id, user_id, merchant_id, amount, payment_method, status, "
                 "\"timestamp\", transaction_date")
    ignore_ab = (f"SELECT {fact_cols} FROM a_fact UNION ALL SELECT {fact_cols} FROM b_fact b "
                 f"WHERE NOT EXISTS (SELECT 1 FROM a_fact a "
                 f"WHERE a.transaction_id = b.transaction_id)")
    found = {
        "raw_day_slice": _with(RAW_CTE, _slice("raw", "day", SLICE_DAY,
                                               _next_day(SLICE_DAY)))
        + f"SELECT {RAW_COLS} FROM day",
        "raw_day_indexed": _with(RAW_CTE, _slice("raw", "day", SLICE_DAY, _next_day(SLICE_DAY)))
        + f"SELECT {RAW_COLS} FROM day",
        "dedupe_first": FULL + f"SELECT {RAW_COLS} FROM dedup",
        "clean_transactions": FULL + (
            "SELECT transaction_id, user_id, merchant_id, merchant_name, merchant_category, amount, "
            "payment_method, status, \"timestamp\", transaction_date FROM clean"),
        "cleaning_counters": FULL + """SELECT * FROM (VALUES
  (1, 'read', (SELECT count(*) FROM raw)),
  (2, 'batch', (SELECT count(*) FROM raw)),
  (3, 'dedupe', (SELECT count(*) FROM dedup)),
  (4, 'drop_missing', (SELECT count(*) FROM dedup WHERE transaction_id IS NOT NULL
       AND user_id IS NOT NULL AND amount IS NOT NULL AND NOT isnan(amount) AND status IS NOT NULL)),
  (5, 'positive_amount', (SELECT count(*) FROM dedup WHERE transaction_id IS NOT NULL
       AND user_id IS NOT NULL AND amount IS NOT NULL AND NOT isnan(amount) AND status IS NOT NULL
       AND amount > 0))
) AS t(step_no, step, "rows")""",
        "mask_phone": _with(RAW_CTE) + f"SELECT DISTINCT phone_number, {MASK_PHONE} AS masked_phone FROM raw",
        "mask_name": _with(RAW_CTE) + f"SELECT DISTINCT user_name, {MASK_NAME} AS masked_user_name FROM raw",
        "hash_phone": _with(RAW_CTE) + f"SELECT DISTINCT phone_number, {HASH_PHONE} AS phone_hash FROM raw",
        "dim_users": FULL + "SELECT * FROM users",
        "dim_merchants": FULL + "SELECT * FROM merchants",
        "fact_transactions": FULL + "SELECT * FROM fact",
        "daily_merchant_summary": FULL + "SELECT * FROM summary",
        "dq_uniqueness": FULL + _union([
            _uniq(1, "raw_transactions", "raw", ["transaction_id"]),
            _uniq(2, "dim_users", "users", ["user_id"]),
            _uniq(3, "dim_merchants", "merchants", ["merchant_id"]),
            _uniq(4, "fact_transactions", "fact", ["transaction_id"])]),
        "dq_completeness": FULL + _union(
            _complete(1, "raw_transactions", "raw", FACT_REQ, "transaction_id")
            + _complete(6, "fact_transactions", "fact", FACT_REQ, "transaction_id")),
        "dq_validity": FULL + _union(_valid(1, "raw_transactions", "raw")
                                     + _valid(3, "fact_transactions", "fact")),
        "dq_pii": FULL + _union(
            _pii(1, "raw_transactions",
                 "(SELECT user_id, user_name AS masked_user_name, phone_number AS masked_phone FROM raw)")
            + _pii(4, "dim_users", "users")),
        "dq_composite_key": FULL + _union([
            _uniq(1, "clean_transactions", "clean", ["transaction_date", "merchant_category"]),
            _uniq(2, "daily_merchant_summary", "summary", ["transaction_date", "merchant_category"])]),
        "dq_orphans": BATCHES + _union([
            _orphans(1, "fact_transactions", "fact", "users", "user_id"),
            _orphans(2, "fact_transactions", "fact", "merchants", "merchant_id"),
            _orphans(3, "fact_transactions", "fact", "a_users", "user_id")]),
        "dq_orphans_prefiltered": BATCHES + _union([
            _orphans(1, "fact_transactions", "b_fact", "users", "user_id"),
            _orphans(2, "fact_transactions", "b_fact", "merchants", "merchant_id"),
            _orphans(3, "fact_transactions", "b_fact", "a_users", "user_id")]),
        "dq_report": FULL + _union(
            [_uniq(1, "dim_users", "users", ["user_id"]),
             _uniq(2, "dim_merchants", "merchants", ["merchant_id"]),
             _uniq(3, "fact_transactions", "fact", ["transaction_id"])]
            + _complete(4, "dim_users", "users",
                        ["user_id", "masked_user_name", "masked_phone"], "user_id")
            + _complete(7, "dim_merchants", "merchants",
                        ["merchant_id", "merchant_name", "merchant_category"], "merchant_id")
            + _complete(10, "fact_transactions", "fact", FACT_REQ, "transaction_id")
            + _valid(15, "fact_transactions", "fact")
            + _pii(17, "dim_users", "users")
            + [_uniq(20, "daily_merchant_summary", "summary",
                     ["transaction_date", "merchant_category"]),
               _orphans(21, "fact_transactions", "fact", "users", "user_id"),
               _orphans(22, "fact_transactions", "fact", "merchants", "merchant_id")]),
        "upsert_replace": BATCHES + replace_ab,
        "upsert_keep_last": BATCHES + (
            f"SELECT {fact_cols} FROM a_fact a WHERE NOT EXISTS (SELECT 1 FROM b_fact b "
            f"WHERE b.transaction_id = a.transaction_id) UNION ALL SELECT {fact_cols} FROM b_fact"),
        "insert_ignore": BATCHES + ignore_ab,
        "full_load_daily": FULL + "SELECT * FROM summary",
        "incremental_replay": BATCHES + replace_ab,
        "incremental_replay_fact": BATCHES + ignore_ab,
        "daily_summary_exact": FULL + _summary_exact("clean"),
        "summary_state_replay": BATCHES + _summary_exact(
            f"(SELECT * FROM ({ignore_ab}) JOIN (SELECT merchant_id, merchant_category "
            f"FROM b_merchants UNION ALL SELECT merchant_id, merchant_category FROM a_merchants "
            f"WHERE merchant_id NOT IN (SELECT merchant_id FROM b_merchants)) "
            f"USING (merchant_id))"),
        "raw_csv_roundtrip": _with(RAW_CTE) + f"SELECT {RAW_COLS} FROM raw",
        "raw_csv_multiline": _with(RAW_CTE) + f"""SELECT * REPLACE (
    '"' || replace(user_name, ' ', chr(10)) || '",' || chr(10) || '.' AS user_name)
FROM (SELECT {RAW_COLS} FROM raw)""",
        "timestamps_inferred": _with(RAW_CTE) + f"""SELECT * REPLACE (
    CASE WHEN "timestamp" < '{CUT_DAY}' THEN "timestamp"
         ELSE substr("timestamp", 1, 10) || ' 00:00:00' END AS "timestamp")
FROM (SELECT {RAW_COLS} FROM raw) WHERE "timestamp" >= '{OVERLAP_DAY}'""",
        "dq_status_values": _with(RAW_CTE) + (
            "SELECT status, count(*) AS \"rows\" FROM raw WHERE status IS NOT NULL "
            "AND status NOT IN ('SUCCESS', 'FAILED', 'PENDING') GROUP BY status"),
        "dq_missing_column": FULL + _union(
            _complete(1, "dim_merchants", "merchants", ["merchant_id"], "merchant_id")
            + ["SELECT CAST(2 AS INTEGER) AS rule_no, 'column_present' AS rule, "
               "'dim_merchants' AS table_name, 'merchant_name' AS column_name, "
               "CAST(1 AS BIGINT) AS violations, false AS passed, "
               "CAST(NULL AS VARCHAR) AS sample"]
            + _complete(3, "dim_merchants", "merchants", ["merchant_category"], "merchant_id")),
        "q1_daily_gtv": FULL + _q1("fact"),
        "q2_category_ranking": FULL + """SELECT merchant_category, total_tx_count, total_volume_idr,
       dense_rank() OVER (ORDER BY total_volume_idr DESC) AS rank_by_volume
FROM (SELECT m.merchant_category, count(t.transaction_id) AS total_tx_count,
             CAST(sum(CAST(CASE WHEN t.status = 'SUCCESS' THEN t.amount ELSE 0.0 END
                           AS DECIMAL(38,6))) AS DOUBLE) AS total_volume_idr
      FROM fact t JOIN merchants m ON t.merchant_id = m.merchant_id
      GROUP BY m.merchant_category)""",
        "q3_payment_health": FULL + f"""SELECT payment_method, total_attempts, successful_tx, failed_tx,
       pending_tx, {_rate_half_up('successful_tx', 'total_attempts')} AS success_rate_pct
FROM ({_q3_core('fact')})""",
        "q3b_payment_rate": FULL + f"""SELECT payment_method, total_attempts, successful_tx,
       {_rate_half_up('successful_tx', 'total_attempts')} AS success_rate_pct
FROM ({_q3_core('fact')})""",
        "q4_top_users": FULL + """SELECT u.user_id, u.masked_user_name, u.masked_phone,
       count(t.transaction_id) AS total_transactions, round(sum(t.amount), 2) AS total_spent_idr
FROM fact t JOIN users u ON t.user_id = u.user_id
WHERE t.status = 'SUCCESS'
GROUP BY u.user_id, u.masked_user_name, u.masked_phone
ORDER BY total_spent_idr DESC, u.user_id
LIMIT 10""",
        "catalog_fact": FULL + "SELECT * FROM fact",
    }
    # the same results by another route
    for name, like in (("raw_default_day", "raw_day_slice"),
                       ("q2_category_ranking_sql", "q2_category_ranking"),
                       ("q4_top_users_sql", "q4_top_users")):
        found[name] = found[like]
    return found


def _next_day(day: str) -> str:
    import datetime as dt
    return (dt.date.fromisoformat(day) + dt.timedelta(days=1)).isoformat()
