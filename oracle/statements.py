"""One SQL statement per registered query, built from shared common table expressions."""

from __future__ import annotations

import math

from tallyhouse import fixed_values as fixed

_RAW = """
raw AS (
  SELECT concat_ws('-', 'TXN', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS transaction_id,
    'USER_' || lpad(o_custkey::VARCHAR, greatest(length(o_custkey::VARCHAR), 5)::INT, '0') AS user_id,
    l_shipdate + INTERVAL 20 YEAR AS transaction_date,
    p_type AS product_category, p_name AS product_name,
    s_name || CASE l_linenumber WHEN 7 THEN ' Ltd' WHEN 6 THEN ' Pvt Ltd' ELSE '' END AS merchant_name,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(18,2)) AS product_amount,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS transaction_fee,
    CASE WHEN o_orderstatus = 'O' THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2))
      * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS cashback,
    CASE WHEN o_orderstatus = 'O' THEN CAST(floor(l_extendedprice / 100) AS BIGINT) ELSE 0::BIGINT END AS loyalty_points,
    o_orderpriority AS payment_method,
    CASE o_orderstatus WHEN 'F' THEN 'Failed' WHEN 'O' THEN 'Successful' WHEN 'P' THEN 'Pending' END AS transaction_status,
    'MERCH_' || lpad(l_suppkey::VARCHAR, greatest(length(l_suppkey::VARCHAR), 4)::INT, '0') AS merchant_id,
    CASE l_partkey % 3 WHEN 0 THEN 'Android' WHEN 1 THEN 'iOS' ELSE 'Web' END AS device_type,
    CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'Urban'
      WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'Suburban'
      WHEN c_mktsegment = 'MACHINERY' THEN 'Rural' END AS location
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey)"""

_SILVER = _RAW + """,
silver AS (
  SELECT transaction_id, product_category, product_name, loyalty_points, payment_method,
    transaction_status, merchant_id, device_type, user_id AS customer_id,
    transaction_date AS transaction_timestamp, merchant_name, product_amount AS amount,
    transaction_fee AS fee_amount, cashback AS cashback_amount, location AS location_type,
    'INR' AS currency, 'kaggle_csv' AS source_system FROM raw)"""


def _keyed(source: str, column: str, key: str, name: str) -> str:
    return (
        f"(SELECT row_number() OVER (ORDER BY {column} NULLS FIRST) AS {key}, {column} AS {name} "
        f"FROM (SELECT DISTINCT {column} FROM {source}))"
    )


_CALENDAR_COLUMNS = """CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS full_date,
    CAST(day(d) AS BIGINT) AS day_of_month, CAST(dayofweek(d) + 1 AS BIGINT) AS day_of_week_number,
    strftime(d, '%A') AS day_of_week_name, CAST(strftime(d, '%U') AS BIGINT) AS week_of_year,
    CAST(month(d) AS BIGINT) AS month_number, strftime(d, '%B') AS month_name,
    CAST(quarter(d) AS BIGINT) AS quarter, CAST(year(d) AS BIGINT) AS year,
    dayofweek(d) IN (0, 6) AS is_weekend, FALSE AS is_holiday,
    CAST(CASE WHEN month(d) >= 4 THEN year(d) ELSE year(d) - 1 END AS BIGINT) AS fiscal_year,
    CAST(CASE WHEN month(d) >= 4 THEN quarter(d) ELSE quarter(d) + 4 END AS BIGINT) AS fiscal_quarter"""

_CALENDAR = f"""
dim_date AS (SELECT {_CALENDAR_COLUMNS}
  FROM (SELECT CAST(unnest(generate_series(DATE '2015-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS DATE) AS d))"""

_COVERING = f"""
dim_date AS (SELECT {_CALENDAR_COLUMNS}
  FROM (SELECT CAST(unnest(generate_series(
      (SELECT least(DATE '2015-01-01', min(transaction_timestamp)::DATE) FROM silver),
      (SELECT greatest(DATE '2030-12-31', max(transaction_timestamp)::DATE) FROM silver),
      INTERVAL 1 DAY)) AS DATE) AS d))"""

_DIMS = (
    "dim_customers AS " + _keyed("silver", "customer_id", "customer_key", "customer_id")
    + ", dim_merchants AS (SELECT row_number() OVER (ORDER BY merchant_id NULLS FIRST) AS merchant_key, "
    "merchant_id, min(merchant_name) AS merchant_name FROM silver GROUP BY merchant_id)"
    + ", dim_payment_methods AS "
    + _keyed("silver", "payment_method", "payment_method_key", "payment_method_name")
    + ", dim_transaction_status AS (SELECT status_key, status_name, "
    "CASE status_name WHEN 'Failed' THEN 'Failed' WHEN 'Pending' THEN 'Pending' "
    "WHEN 'Successful' THEN 'Success' END AS status_category, "
    "coalesce(status_name IN ('Failed', 'Successful'), FALSE) AS is_terminal, "
    "CAST(CASE status_name WHEN 'Pending' THEN 1 WHEN 'Successful' THEN 2 WHEN 'Failed' THEN 3 END AS BIGINT) AS display_order "
    "FROM " + _keyed("silver", "transaction_status", "status_key", "status_name") + ")"
    + ", dim_location AS " + _keyed("silver", "location_type", "location_key", "location_type")
)

_FACT = _SILVER + ", " + _DIMS + "," + _CALENDAR + """,
fact AS (
  SELECT c.customer_key, m.merchant_key, p.payment_method_key, t.status_key, l.location_key, d.date_key,
    s.transaction_id, s.product_category, s.product_name, s.device_type, s.amount, s.fee_amount,
    s.cashback_amount, s.loyalty_points, s.amount - s.cashback_amount AS net_customer_amount,
    s.amount - s.fee_amount AS merchant_net_amount, s.fee_amount - s.cashback_amount AS gateway_revenue,
    s.transaction_timestamp, s.currency, FALSE AS is_refunded, CAST(NULL AS DOUBLE) AS refund_amount,
    CAST(NULL AS TIMESTAMP) AS refund_date, CAST(1 AS BIGINT) AS attempt_number, s.source_system
  FROM silver s LEFT JOIN dim_customers c ON s.customer_id = c.customer_id
  LEFT JOIN dim_merchants m ON s.merchant_id = m.merchant_id
  LEFT JOIN dim_payment_methods p ON s.payment_method = p.payment_method_name
  LEFT JOIN dim_transaction_status t ON s.transaction_status = t.status_name
  LEFT JOIN dim_location l ON s.location_type = l.location_type
  LEFT JOIN dim_date d ON CAST(strftime(s.transaction_timestamp, '%Y%m%d') AS BIGINT) = d.date_key)"""

_BATCHES = """
batches AS (
  SELECT 'EVT-' || event_id AS transaction_id, event_id AS n,
    'USER_' || lpad(user_id::VARCHAR, greatest(length(user_id::VARCHAR), 4)::INT, '0') AS customer_id,
    CASE WHEN defect = 'late' THEN ts - INTERVAL 1 DAY WHEN defect = 'zone' THEN ts - INTERVAL 630 MINUTE ELSE ts END AS transaction_timestamp,
    'MERCH_' || lpad((event_id % 50)::VARCHAR, 4, '0') AS merchant_id,
    'Merchant_' || lpad((event_id % 50)::VARCHAR, 4, '0') || CASE WHEN defect = 'renamed' THEN ' Ltd' ELSE '' END AS merchant_name,
    event_type AS product_category, 'Item_' || (event_id % 20) AS product_name,
    CAST(value AS DECIMAL(18,2)) AS amount,
    CASE event_type WHEN 'error' THEN 'Failed' WHEN 'signup' THEN 'Pending' ELSE 'Successful' END AS transaction_status,
    CASE event_id % 5 WHEN 0 THEN 'UPI' WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Debit Card' WHEN 3 THEN 'Wallet Balance' ELSE 'Bank Transfer' END AS payment_method,
    CASE event_id % 3 WHEN 0 THEN 'Urban' WHEN 1 THEN 'Suburban' ELSE 'Rural' END AS location_type,
    CASE WHEN defect = 'unstamped' THEN NULL WHEN defect = 'zone' THEN
      CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_seconds(CAST((event_id * 7919) % 86400 AS INTEGER)) ELSE ts END AS updated_at,
    CAST(ts AS DATE) AS batch_day
  FROM (SELECT *, CASE WHEN event_id % 100 = 7 THEN 'unstamped' WHEN event_id % 100 = 11 AND day(ts) % 3 <> 0 THEN 'late'
    WHEN event_id % 100 = 13 THEN 'renamed' WHEN event_id % 15 = 2 AND day(ts) % 3 = 0 THEN 'zone' ELSE '' END AS defect FROM events))"""

_IS_LATE = "transaction_timestamp < CAST(batch_day AS TIMESTAMP)"
_IS_RENAMED = ("coalesce(regexp_matches(merchant_name, "
               "'Pvt Ltd|Ltd|Internet|Media|Technologies|Entertainment|Retail|E-Commerce|Fleet'), FALSE)")
# every third day is known to hold shifted rows
_IS_SHIFTED = "(day(batch_day) % 3 = 0 AND coalesce(transaction_timestamp <> updated_at, FALSE))"


def _avg(column: str, name: str, n: str | None = None) -> str:
    """Average in whole cents, half up, either sign."""
    cents = f"CAST(sum(CAST({column} * 100 AS BIGINT)) AS BIGINT)"
    rows = n or f"count({column})"
    return (
        f"CASE WHEN {cents} < 0 THEN -1 ELSE 1 END * "
        f"CAST((2 * abs({cents}) + {rows}) // (2 * {rows}) AS DOUBLE) / 100.0 AS {name}"
    )


def _sum(column: str, name: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) AS {name}"


def _pct(part: str, whole: str, name: str) -> str:
    return (f"CAST((20000 * CAST({part} AS HUGEINT) + CAST({whole} AS HUGEINT)) "
            f"// (2 * CAST({whole} AS HUGEINT)) AS DOUBLE) / 100.0 AS {name}")


def _cents(column: str) -> str:
    return f"sum(CAST({column} * 100 AS BIGINT))"


_N = "count(*) AS transaction_count"
STATEMENTS: dict[str, str] = {}


def _add(name: str, select: str, ctes: str = "") -> None:
    STATEMENTS[name] = (f"WITH {ctes.strip()} " if ctes else "") + select


def _by_status(values: dict) -> str:
    """CASE over a merged row's status."""
    return "CASE m.transaction_status " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + " END"


def _distribution(table: str, by: str) -> str:
    return (f"SELECT {by}, {_N}, "
            + _pct("count(*)", "sum(count(*)) OVER ()", "percentage")
            + f" FROM {table} GROUP BY {by}")


# --- layers
_add("bronze_summary", "SELECT count(*) AS total_rows, min(transaction_date) AS earliest_transaction, "
     "max(transaction_date) AS latest_transaction FROM raw", _RAW)
_add("bronze_status_distribution", _distribution("raw", "transaction_status"), _RAW)
_add("bronze_method_counts", f"SELECT payment_method, {_N} FROM raw GROUP BY payment_method", _RAW)
_AT = "TIMESTAMP '2024-12-01 00:00:00'"
_AUDIT = f", {_AT} AS created_at, {_AT} AS updated_at"
_add("silver_transactions", f"SELECT *, {_AT} AS loaded_at FROM (SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount, CAST(fee_amount AS DOUBLE) AS fee_amount, "
     "CAST(cashback_amount AS DOUBLE) AS cashback_amount) FROM silver)", _SILVER)
_STAR = _SILVER + ", " + _DIMS
_TEXT = "CAST(NULL AS VARCHAR)"
_add("dim_customers", f"SELECT customer_key, customer_id, {_TEXT} AS customer_name, {_TEXT} AS email, {_TEXT} AS phone, "
     f"{_TEXT} AS country, {_TEXT} AS city, {_TEXT} AS customer_segment, CAST(NULL AS DATE) AS registration_date, "
     "CAST(NULL AS BOOLEAN) AS is_verified, CAST(NULL AS DOUBLE) AS risk_score, TRUE AS is_current, "
     f"{_AT} AS effective_start_date, CAST(NULL AS TIMESTAMP) AS effective_end_date{_AUDIT} FROM dim_customers", _STAR)
_add("dim_merchants", f"SELECT merchant_key, merchant_id, merchant_name, {_TEXT} AS business_type, {_TEXT} AS industry, "
     f"{_TEXT} AS country, {_TEXT} AS website, CAST(NULL AS DATE) AS onboarding_date, {_TEXT} AS settlement_frequency, "
     f"FALSE AS is_active{_AUDIT} FROM dim_merchants", _STAR)
_add("dim_merchants_latest_name", "SELECT row_number() OVER (ORDER BY merchant_id) AS merchant_key, merchant_id, merchant_name FROM "
     "(SELECT merchant_id, merchant_name, row_number() OVER (PARTITION BY merchant_id ORDER BY transaction_timestamp DESC, "
     "merchant_name DESC) AS r FROM batches) WHERE r = 1", _BATCHES)
_add("dim_payment_methods", f"SELECT payment_method_key, payment_method_name, {_TEXT} AS method_type, "
     "CAST(NULL AS BOOLEAN) AS requires_verification, CAST(NULL AS BIGINT) AS average_processing_time_ms, "
     f"CAST(NULL AS BOOLEAN) AS is_instant{_AUDIT} FROM dim_payment_methods", _STAR)
_add("dim_transaction_status", f"SELECT *{_AUDIT} FROM dim_transaction_status", _STAR)
_add("dim_location", f"SELECT location_key, location_type, {_TEXT} AS region, {_TEXT} AS state, {_TEXT} AS country, "
     f"{_TEXT} AS timezone{_AUDIT} FROM dim_location", _STAR)
_add("dim_date", "SELECT * FROM dim_date", _SILVER + "," + _COVERING)
_FACT_SHOWN = (f"SELECT *, {_AT} AS loaded_at{_AUDIT} FROM (SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount, CAST(fee_amount AS DOUBLE) AS fee_amount, "
               "CAST(cashback_amount AS DOUBLE) AS cashback_amount, CAST(net_customer_amount AS DOUBLE) AS net_customer_amount, "
               "CAST(merchant_net_amount AS DOUBLE) AS merchant_net_amount, CAST(gateway_revenue AS DOUBLE) AS gateway_revenue) FROM fact)")
_add("fact_transactions", _FACT_SHOWN, _FACT)
_add("fact_first_rows", _FACT_SHOWN + " ORDER BY transaction_timestamp, transaction_id LIMIT 10", _FACT)
_add("customers_first_rows", "SELECT customer_key, customer_id FROM dim_customers ORDER BY customer_key LIMIT 10", _STAR)
_MEMBERS = [("dim_customers", "customer_id"), ("dim_merchants", "merchant_id"), ("dim_payment_methods", "payment_method"),
            ("dim_transaction_status", "transaction_status"), ("dim_location", "location_type")]
_FROM_BATCHES = _BATCHES + "," + _CALENDAR + "".join(
    f", {d}_keys AS " + _keyed("batches", c, "k", "v") for d, c in _MEMBERS)
_add("catalog_build", " UNION ALL ".join(
    [f"SELECT '{d}' AS table_name, count(*) AS row_count, CAST(sum(k) AS BIGINT) AS key_total, CAST(NULL AS DOUBLE) AS amount_total FROM {d}_keys"
     for d, _ in _MEMBERS]
    + ["SELECT 'dim_date', count(*), CAST(sum(date_key) AS BIGINT), NULL FROM dim_date"]
    + [f"SELECT '{t}', count(*), NULL, CAST(sum(amount) AS DOUBLE) FROM batches" for t in ("raw_transactions", "cleaned_transactions")]
    + ["SELECT 'fact_transactions', count(*), CAST(" + " + ".join(f"sum({d}_keys.k)" for d, _ in _MEMBERS) + " + sum(date_key) AS BIGINT), "
       "CAST(sum(CAST(amount * 0.02 AS DECIMAL(18,2)) - CASE WHEN transaction_status = 'Successful' THEN CAST(amount * 0.01 AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) "
       "FROM batches " + " ".join(f"LEFT JOIN {d}_keys ON batches.{c} = {d}_keys.v" for d, c in _MEMBERS)
       + " LEFT JOIN dim_date ON date_key = CAST(strftime(transaction_timestamp, '%Y%m%d') AS BIGINT)"]), _FROM_BATCHES)

# --- business reports
_add("q01_monthly_revenue", f"SELECT d.year, d.month_name, {_N}, {_sum('f.amount', 'total_revenue')}, "
     f"{_avg('f.amount', 'avg_transaction_size')}, {_sum('f.fee_amount', 'total_fees')}, "
     f"{_sum('f.cashback_amount', 'total_cashback')} FROM fact f JOIN dim_date d ON f.date_key = d.date_key "
     "GROUP BY d.year, d.month_name, d.month_number ORDER BY d.year, d.month_number", _FACT)
_add("q02_payment_method_performance", "SELECT p.payment_method_name, count(*) AS total_transactions, "
     "count(*) FILTER (WHERE t.status_name = 'Successful') AS successful_count, "
     + _pct("count(*) FILTER (WHERE t.status_name = 'Successful')", "count(*)", "success_rate_pct")
     + f", {_avg('f.fee_amount', 'avg_fee')}, {_avg('f.amount', 'avg_transaction_amount')}, {_sum('f.amount', 'total_volume')} "
     "FROM fact f JOIN dim_payment_methods p ON f.payment_method_key = p.payment_method_key "
     "JOIN dim_transaction_status t ON f.status_key = t.status_key GROUP BY p.payment_method_name "
     "ORDER BY success_rate_pct DESC, total_volume DESC", _FACT)
_add("q03_top_merchants", f"SELECT m.merchant_name, m.merchant_id, {_N}, {_sum('f.amount', 'total_revenue')}, "
     f"{_avg('f.amount', 'avg_transaction_size')}, {_sum('f.merchant_net_amount', 'merchant_net_revenue')}, "
     f"{_sum('f.fee_amount', 'total_fees_paid')} FROM fact f JOIN dim_merchants m ON f.merchant_key = m.merchant_key "
     "GROUP BY m.merchant_name, m.merchant_id ORDER BY total_revenue DESC, m.merchant_id LIMIT 10", _FACT)
_add("q04_weekend_weekday", f"SELECT CASE WHEN d.is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type, {_N}, "
     f"{_sum('f.amount', 'total_revenue')}, {_avg('f.amount', 'avg_transaction_amount')}, {_sum('f.fee_amount', 'total_fees')}, "
     + _pct(_cents("f.fee_amount"), _cents("f.amount"), "fee_percentage")
     + " FROM fact f JOIN dim_date d ON f.date_key = d.date_key GROUP BY d.is_weekend", _FACT)
_add("q05_top_customers", f"SELECT c.customer_id, {_N}, {_sum('f.amount', 'total_spent')}, "
     f"{_avg('f.amount', 'avg_transaction_size')}, {_sum('f.cashback_amount', 'total_cashback_received')}, "
     "CAST(sum(f.loyalty_points) AS BIGINT) AS total_loyalty_points, max(f.transaction_timestamp) AS last_transaction_date "
     "FROM fact f JOIN dim_customers c ON f.customer_key = c.customer_key GROUP BY c.customer_id "
     "ORDER BY total_spent DESC, c.customer_id LIMIT 20", _FACT)
_add("q06_status_by_location", f"SELECT l.location_type, t.status_name, {_N}, {_sum('f.amount', 'total_amount')}, "
     + _pct("count(*)", "sum(count(*)) OVER (PARTITION BY l.location_type)", "pct_within_location")
     + " FROM fact f JOIN dim_location l ON f.location_key = l.location_key "
     "JOIN dim_transaction_status t ON f.status_key = t.status_key GROUP BY l.location_type, t.status_name", _FACT)
_add("q07_product_category", f"SELECT product_category, {_N}, {_sum('amount', 'total_revenue')}, {_avg('amount', 'avg_amount')}, "
     f"{_sum('cashback_amount', 'total_cashback')}, count(DISTINCT customer_key) AS unique_customers FROM fact "
     "GROUP BY product_category ORDER BY total_revenue DESC, product_category LIMIT 15", _FACT)
_add("q08_device_usage", f"SELECT f.device_type, {_N}, " + _pct("count(*)", "sum(count(*)) OVER ()", "percentage")
     + f", {_sum('f.amount', 'total_revenue')}, {_avg('f.amount', 'avg_transaction_size')}, "
     + _pct("count(*) FILTER (WHERE t.status_name = 'Successful')", "count(*)", "success_rate_pct")
     + " FROM fact f JOIN dim_transaction_status t ON f.status_key = t.status_key GROUP BY f.device_type", _FACT)
_add("q09_day_of_week", f"SELECT day_of_week_name, day_of_week_number, transaction_count, "
     "CAST((200 * CAST(sum(transaction_count) OVER w AS BIGINT) + count(*) OVER w) // (2 * count(*) OVER w) AS DOUBLE) / 100.0 AS avg_for_day_type, "
     f"total_revenue FROM (SELECT d.day_of_week_name, d.day_of_week_number, d.is_weekend, {_N}, {_sum('f.amount', 'total_revenue')} "
     "FROM fact f JOIN dim_date d ON f.date_key = d.date_key GROUP BY ALL) WINDOW w AS (PARTITION BY is_weekend)", _FACT)
_add("q10_failed_analysis", f"SELECT p.payment_method_name, l.location_type, count(*) AS failed_count, {_sum('f.amount', 'lost_revenue')}, "
     + _pct("count(*)", "sum(count(*)) OVER ()", "pct_of_failures")
     + " FROM fact f JOIN dim_payment_methods p ON f.payment_method_key = p.payment_method_key "
     "JOIN dim_location l ON f.location_key = l.location_key JOIN dim_transaction_status t ON f.status_key = t.status_key "
     "WHERE t.status_name = 'Failed' GROUP BY p.payment_method_name, l.location_type "
     "ORDER BY failed_count DESC, p.payment_method_name, l.location_type LIMIT 20", _FACT)
_add("star_rollup", f"SELECT d.fiscal_year, d.fiscal_quarter, l.location_type, {_N}, {_sum('f.amount', 'total_amount')}, "
     f"{_sum('f.gateway_revenue', 'total_gateway_revenue')}, {_avg('f.gateway_revenue', 'avg_gateway_revenue')} "
     "FROM fact f JOIN dim_date d ON f.date_key = d.date_key JOIN dim_location l ON f.location_key = l.location_key "
     "GROUP BY ROLLUP (d.fiscal_year, d.fiscal_quarter, l.location_type)", _FACT)
_add("star_cube", f"SELECT p.payment_method_name, t.status_name, {_N}, {_sum('f.net_customer_amount', 'total_net')} "
     "FROM fact f JOIN dim_payment_methods p ON f.payment_method_key = p.payment_method_key "
     "JOIN dim_transaction_status t ON f.status_key = t.status_key GROUP BY CUBE (p.payment_method_name, t.status_name)", _FACT)
_add("date_weekends", "SELECT date_key, full_date, day_of_week_name, is_weekend FROM dim_date WHERE is_weekend AND year = 2016 "
     "AND month_number = 8 AND date_key IN (SELECT date_key FROM fact) ORDER BY full_date LIMIT 10", _FACT)
_add("date_fiscal_boundary", "SELECT full_date, year, quarter, fiscal_year, fiscal_quarter FROM dim_date WHERE year = 2016 "
     "AND month_number IN (3, 4, 5) AND date_key IN (SELECT date_key FROM fact)", _FACT)
_add("status_by_display_order", "SELECT * FROM dim_transaction_status ORDER BY display_order", _STAR)
_add("location_list", "SELECT location_key, location_type FROM dim_location", _STAR)
_add("method_list", "SELECT payment_method_key, payment_method_name FROM dim_payment_methods", _STAR)

# --- checks
_add("dq_row_reconcile", "SELECT (SELECT count(*) FROM silver) AS silver_count, (SELECT count(*) FROM fact) AS fact_count, "
     "(SELECT count(*) FROM fact) - (SELECT count(*) FROM silver) AS difference", _FACT)
_add("dq_dim_duplicates", "SELECT merchant_id, count(*) AS row_count FROM (SELECT DISTINCT merchant_id, merchant_name FROM silver) "
     "GROUP BY merchant_id HAVING count(*) > 1", _SILVER)
_add("dq_dim_duplicates_built", " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, {k} AS natural_key, count(*) AS row_count FROM {d} GROUP BY {k} HAVING count(*) > 1"
    for d, k in (("dim_customers", "customer_id"), ("dim_merchants", "merchant_id"),
                 ("dim_payment_methods", "payment_method_name"), ("dim_transaction_status", "status_name"),
                 ("dim_location", "location_type"))), _STAR)
_add("dq_txn_duplicates", "SELECT transaction_id, count(*) AS row_count FROM fact GROUP BY transaction_id HAVING count(*) > 1", _FACT)
_add("dq_line_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1")
_KEYS = ["customer_key", "merchant_key", "payment_method_key", "status_key", "location_key", "date_key"]
_add("dq_fk_complete", "SELECT count(*) AS total_rows, "
     + ", ".join(f"count({k}) AS has_{k.removesuffix('_key')}" for k in _KEYS) + " FROM fact", _FACT)
_add("dq_fk_nulls", " UNION ALL ".join(
    f"SELECT '{k}' AS dimension, count(*) AS null_count FROM fact WHERE {k} IS NULL" for k in _KEYS), _FACT)
_PARTIAL = _STAR + "," + _CALENDAR + "," + _BATCHES
_MISSES = {
    "customer_key": "customer_id NOT IN (SELECT customer_id FROM dim_customers WHERE customer_id IS NOT NULL)",
    "merchant_key": "merchant_id NOT IN (SELECT merchant_id FROM dim_merchants)",
    "payment_method_key": "payment_method NOT IN (SELECT payment_method_name FROM dim_payment_methods)",
    "status_key": "transaction_status NOT IN (SELECT status_name FROM dim_transaction_status)",
    "location_key": "location_type NOT IN (SELECT location_type FROM dim_location)",
    "date_key": "CAST(transaction_timestamp AS DATE) NOT IN (SELECT full_date FROM dim_date)",
}
_add("dq_fk_nulls_partial", " UNION ALL ".join(
    f"SELECT '{k}' AS dimension, count(*) AS null_count FROM batches WHERE {test}" for k, test in _MISSES.items()), _PARTIAL)
_add("dq_orphans", "SELECT DISTINCT customer_id FROM batches b WHERE NOT EXISTS "
     "(SELECT 1 FROM silver s WHERE s.customer_id = b.customer_id)", _SILVER + "," + _BATCHES)
_add("dq_orphan_merchants", "SELECT DISTINCT merchant_id FROM silver s WHERE NOT EXISTS "
     "(SELECT 1 FROM batches b WHERE s.merchant_id = b.merchant_id)", _SILVER + "," + _BATCHES)
_add("dq_date_range", "SELECT min(CAST(transaction_timestamp AS DATE)) AS earliest_date, "
     "max(CAST(transaction_timestamp AS DATE)) AS latest_date FROM silver", _SILVER)
_add("dq_out_of_calendar", "SELECT CAST(l_shipdate AS DATE) AS transaction_date, count(*) AS row_count FROM lineitem "
     "WHERE l_shipdate IS NULL OR CAST(l_shipdate AS DATE) NOT BETWEEN DATE '2015-01-01' AND DATE '2030-12-31' GROUP BY ALL")
_add("dq_facts_outside_calendar", "SELECT transaction_id, transaction_timestamp, CAST(transaction_timestamp AS DATE) AS transaction_date "
     "FROM silver WHERE CAST(transaction_timestamp AS DATE) NOT BETWEEN DATE '2016-01-01' AND DATE '2030-12-31' "
     "ORDER BY transaction_id LIMIT 10", _SILVER)
_VERDICTS = ", ".join(
    f"CASE WHEN {stored} = {a} - {b} THEN 'OK' ELSE 'ERROR' END AS {name}_check"
    for stored, a, b, name in (
        ("net_customer_amount", "amount", "cashback_amount", "net_customer"),
        ("merchant_net_amount", "amount", "fee_amount", "merchant_net"),
        ("gateway_revenue", "fee_amount", "cashback_amount", "gateway_revenue")))
_add("dq_measures", f"SELECT net_customer_check, merchant_net_check, gateway_revenue_check, count(*) AS row_count "
     f"FROM (SELECT {_VERDICTS} FROM fact) GROUP BY ALL", _FACT)
_add("dq_measure_rows", f"SELECT transaction_id, {_VERDICTS} FROM fact", _FACT)
_add("dq_key_range", "SELECT min(customer_key) AS min_key, max(customer_key) AS max_key, "
     "count(DISTINCT customer_key) AS unique_keys FROM dim_customers", _STAR)
_add("dq_name_variations", "SELECT merchant_id, count(DISTINCT merchant_name) AS name_variations, "
     "string_agg(DISTINCT merchant_name, ', ' ORDER BY merchant_name) AS all_names FROM silver GROUP BY merchant_id "
     "HAVING count(DISTINCT merchant_name) > 1 ORDER BY name_variations DESC, merchant_id LIMIT 10", _SILVER)
_add("dq_status_distribution", _distribution(
    "(SELECT status_name, is_terminal FROM silver JOIN dim_transaction_status ON transaction_status = status_name)",
    "status_name, is_terminal"), _STAR)
_add("dq_location_distribution", _distribution("silver JOIN dim_location USING (location_type)", "location_type"), _STAR)
_add("dq_method_distribution", f"SELECT payment_method_name, {_N} FROM silver JOIN dim_payment_methods "
     "ON payment_method = payment_method_name GROUP BY payment_method_name", _STAR)
_add("dq_constants", "SELECT count(DISTINCT currency) AS unique_currencies, count(DISTINCT source_system) AS unique_sources, "
     "TRUE AS one_load_time FROM silver", _SILVER)
_add("dq_critical_nulls", "SELECT count(*) AS total_rows, count(transaction_id) AS non_null_tx_id, count(customer_id) AS non_null_customer, "
     "count(merchant_id) AS non_null_merchant, count(amount) AS non_null_amount FROM silver", _SILVER)
_add("dq_late", f"SELECT batch_day, transaction_id, transaction_timestamp FROM batches WHERE {_IS_LATE}", _BATCHES)
_add("dq_null_updated", "SELECT batch_day, count(*) AS null_updated_rows FROM batches WHERE updated_at IS NULL GROUP BY batch_day", _BATCHES)
_add("dq_renames", f"SELECT batch_day, transaction_id, merchant_name FROM batches WHERE {_IS_RENAMED}", _BATCHES)
_add("dq_renames_orders", f"SELECT count(*) FILTER (WHERE {_IS_RENAMED}) AS renamed_rows, count(*) AS total_rows FROM silver", _SILVER)
_add("dq_tz_shift", f"SELECT batch_day, count(*) FILTER (WHERE {_IS_LATE}) AS day_border_rows, "
     "count(*) FILTER (WHERE transaction_timestamp <> updated_at) AS any_lag_rows, "
     "count(*) FILTER (WHERE transaction_timestamp + INTERVAL 630 MINUTE = updated_at) AS fixed_lag_rows "
     "FROM batches GROUP BY batch_day", _BATCHES)
_add("dq_clean_rows", f"SELECT batch_day, count(*) AS total_rows, count(*) FILTER (WHERE {_IS_LATE}) AS late_rows, "
     "count(*) FILTER (WHERE updated_at IS NULL) AS null_updated_rows, "
     f"count(*) FILTER (WHERE {_IS_RENAMED}) AS renamed_rows, count(*) FILTER (WHERE {_IS_SHIFTED}) AS zone_shifted_rows, "
     f"count(*) - count(*) FILTER (WHERE {_IS_LATE} OR {_IS_SHIFTED}) - count(*) FILTER (WHERE updated_at IS NULL) "
     f"- count(*) FILTER (WHERE {_IS_RENAMED}) AS clean_rows FROM batches GROUP BY batch_day", _BATCHES)
_add("dq_cross_batch_dups", "SELECT count(*) AS total_rows, count(DISTINCT transaction_id) AS unique_ids, "
     "count(*) - count(DISTINCT transaction_id) AS extra_rows, count(*) = count(DISTINCT transaction_id) AS all_unique "
     "FROM (SELECT transaction_id FROM batches UNION ALL SELECT transaction_id FROM batches WHERE CAST(amount * 100 AS BIGINT) % 7 = 0)", _BATCHES)
_add("dq_batch_profile", "SELECT batch_day, count(*) AS total_rows, min(transaction_timestamp) AS first_event, "
     "max(transaction_timestamp) AS last_event, count(*) FILTER (WHERE updated_at IS NULL) AS null_updated_rows, "
     "count(DISTINCT transaction_id) AS unique_transactions, count(DISTINCT customer_id) AS unique_customers, "
     "count(DISTINCT merchant_id) AS unique_merchants, "
     + ", ".join(f"count(*) FILTER (WHERE transaction_status = '{s}') AS {s.lower()}_rows, "
                 + _pct(f"count(*) FILTER (WHERE transaction_status = '{s}')", "count(*)", f"{s.lower()}_pct")
                 for s in ("Successful", "Failed", "Pending"))
     + " FROM batches GROUP BY batch_day", _BATCHES)
_DAY_COUNTS = (f"SELECT batch_day, count(*) AS total_rows, count(*) FILTER (WHERE {_IS_LATE}) AS late_rows, "
               "count(*) FILTER (WHERE updated_at IS NULL) AS null_updated_rows, "
               f"count(*) FILTER (WHERE {_IS_RENAMED}) AS renamed_rows, count(*) FILTER (WHERE {_IS_SHIFTED}) AS zone_shifted_rows, "
               f"count(*) FILTER (WHERE NOT ({_IS_LATE} OR {_IS_SHIFTED} OR updated_at IS NULL OR {_IS_RENAMED})) AS clean_rows "
               "FROM batches GROUP BY batch_day")
_COUNTED = {"total_rows": "total_rows", "late_rows": "late_rows", "null_updated_rows": "null_updated_rows",
            "renamed_rows": "renamed_rows", "zone_shifted_rows": "zone_shifted_rows"}
_add("dq_batch_report", " UNION ALL ".join(
    [f"SELECT batch_day, '{c}' AS \"check\", {e} AS value FROM days" for c, e in _COUNTED.items()]
    + ["SELECT batch_day, 'clean_rows', clean_rows FROM days"]
    + [f"SELECT CAST(NULL AS DATE), '{c}', CAST(sum({e}) AS BIGINT) FROM days" for c, e in _COUNTED.items()]
    + ["SELECT CAST(NULL AS DATE), 'issue_rows', CAST(sum(total_rows - clean_rows) AS BIGINT) FROM days"]),
    _BATCHES + f", days AS ({_DAY_COUNTS})")
_SURPLUS = " UNION ALL ".join(
    f"SELECT '{d}' AS subject, CAST(count(*) - count(DISTINCT coalesce(CAST({k} AS VARCHAR), '?')) AS BIGINT) AS surplus FROM {d}"
    for d, k in (("dim_customers", "customer_id"), ("dim_merchants", "merchant_id"),
                 ("dim_payment_methods", "payment_method_name"), ("dim_transaction_status", "status_name"),
                 ("dim_location", "location_type"), ("dim_date", "date_key")))
_add("dq_fanout", "SELECT subject, surplus, surplus = 0 AS passed FROM (SELECT 'fact_transactions' AS subject, "
     f"(SELECT count(*) FROM fact) - (SELECT count(*) FROM silver) AS surplus UNION ALL {_SURPLUS})", _FACT)
_add("dq_fanout_uncollapsed", "SELECT (SELECT count(*) FROM silver) AS silver_count, (SELECT count(*) FROM silver s LEFT JOIN "
     "(SELECT DISTINCT merchant_id, merchant_name FROM silver) m ON s.merchant_id = m.merchant_id) AS fact_count", _SILVER)
_EXPECTED = [("silver", "NULL"), ("fact", "NULL"), ("dim_customers", "NULL"), ("dim_merchants", "987"),
             ("dim_payment_methods", "5"), ("dim_transaction_status", "3"), ("dim_location", "3"), ("dim_date", "5844")]
_add("dq_expected_counts", "SELECT 'row_count' AS \"check\", subject, value, expected, value = expected AS passed FROM ("
     + " UNION ALL ".join(f"SELECT '{t}' AS subject, count(*) AS value, CAST({e} AS BIGINT) AS expected FROM {t}" for t, e in _EXPECTED)
     + ")", _FACT)
_FACT_TYPES = [
    *((k, "bigint", k) for k in _KEYS),
    *((c, "string", c) for c in ("transaction_id", "product_category", "product_name", "device_type")),
    *((c, "decimal(18,2)", c) for c in ("amount", "fee_amount", "cashback_amount")),
    ("loyalty_points", "bigint", "loyalty_points"),
    *((c, "decimal(18,2)", c) for c in ("net_customer_amount", "merchant_net_amount", "gateway_revenue")),
    ("transaction_timestamp", "timestamp_ntz", "transaction_timestamp"), ("currency", "string", "currency"),
    ("is_refunded", "boolean", "is_refunded"), ("refund_amount", "decimal(18,2)", "refund_amount"),
    ("refund_date", "timestamp", "refund_date"), ("attempt_number", "bigint", "attempt_number"),
    ("loaded_at", "timestamp", "1"), ("source_system", "string", "source_system"),
    ("created_at", "timestamp", "1"), ("updated_at", "timestamp", "1"),
]
_add("dq_schema", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, '{t}' AS expected_type, TRUE AS passed, count({e}) AS non_null_rows FROM fact"
    for c, t, e in _FACT_TYPES), _FACT)
_REPORT = (
    "SELECT 'row_count' AS \"check\", 'fact_count' AS subject, (SELECT count(*) FROM fact) AS value, (SELECT count(*) FROM silver) AS expected"
    + "".join(f" UNION ALL SELECT 'null_foreign_key', '{k}', count(*), 0 FROM fact WHERE {k} IS NULL" for k in _KEYS)
    + " UNION ALL SELECT 'duplicate_id', 'transaction_id', count(*) - count(DISTINCT transaction_id), 0 FROM fact"
    + "".join(f" UNION ALL SELECT 'derived_measure', '{c}', count(*) FILTER (WHERE {c} = 'ERROR'), 0 FROM (SELECT {_VERDICTS} FROM fact)"
              for c in ("net_customer_check", "merchant_net_check", "gateway_revenue_check"))
    + f" UNION ALL SELECT 'duplicate_natural_key', subject, surplus, 0 FROM ({_SURPLUS})"
)
_REPORT = f"SELECT \"check\", subject, value, CAST(expected AS BIGINT) AS expected, value = expected AS passed FROM ({_REPORT})"
_add("dq_report", _REPORT, _FACT)

# --- dimensions with history
_add("scd1_merchants", "SELECT merchant_key, d.merchant_id, coalesce(u.merchant_name, d.merchant_name) AS merchant_name "
     "FROM dim_merchants d LEFT JOIN newest u ON d.merchant_id = u.merchant_id UNION ALL "
     "SELECT (SELECT max(merchant_key) FROM dim_merchants) + row_number() OVER (ORDER BY merchant_id), merchant_id, merchant_name "
     "FROM newest WHERE merchant_id NOT IN (SELECT merchant_id FROM dim_merchants)",
     _STAR + "," + _BATCHES + ", newest AS (SELECT merchant_id, merchant_name FROM (SELECT *, row_number() OVER "
     "(PARTITION BY merchant_id ORDER BY transaction_timestamp DESC, merchant_name DESC) AS r FROM batches) WHERE r = 1)")
_VERSIONS = """
base AS (SELECT 'USER_' || lpad(c_custkey::VARCHAR, greatest(length(c_custkey::VARCHAR), 5)::INT, '0') AS customer_id,
    c_mktsegment AS segment, c_acctbal AS risk, c_custkey AS n FROM customer),
numbered AS (SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, * FROM base),
updates AS (
  SELECT customer_id, 'PREMIUM' AS segment, risk, TIMESTAMP '2017-03-01' AS changed FROM base WHERE n % 10 = 0
  UNION ALL SELECT customer_id, 'PREMIUM', risk, TIMESTAMP '2018-01-01' FROM base WHERE n % 20 = 0
  UNION ALL SELECT customer_id, segment, risk, TIMESTAMP '2019-01-01' FROM base WHERE n % 20 = 0
  UNION ALL SELECT customer_id, segment, risk, TIMESTAMP '2016-01-01' FROM base WHERE n % 7 = 0
  UNION ALL SELECT 'NEW_' || customer_id, segment, risk, TIMESTAMP '2018-06-01' FROM base WHERE n % 50 = 1
  UNION ALL SELECT customer_id, 'OLD', risk, TIMESTAMP '2014-01-01' FROM base WHERE n % 9 = 0),
chain AS (
  SELECT customer_id, segment, risk, TIMESTAMP '2015-06-01' AS changed, customer_key AS old_key FROM numbered
  UNION ALL SELECT customer_id, segment, risk, changed, NULL FROM updates u
    WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.customer_id = u.customer_id AND u.changed <= TIMESTAMP '2015-06-01')),
kept AS (SELECT * FROM (SELECT *, lag(segment) OVER w AS s0, lag(risk) OVER w AS r0, row_number() OVER w AS k FROM chain
    WINDOW w AS (PARTITION BY customer_id ORDER BY changed)) WHERE k = 1 OR segment IS DISTINCT FROM s0 OR risk IS DISTINCT FROM r0),
versions AS (SELECT coalesce(old_key, (SELECT max(customer_key) FROM numbered)
      + row_number() OVER (PARTITION BY old_key IS NULL ORDER BY customer_id, changed)) AS customer_key,
    customer_id, segment AS customer_segment, risk AS risk_score, changed AS effective_start_date,
    lead(changed) OVER (PARTITION BY customer_id ORDER BY changed) AS effective_end_date FROM kept)"""
_add("scd2_customers", "SELECT *, effective_end_date IS NULL AS is_current FROM versions", _VERSIONS)
_add("scd2_replay", "SELECT customer_key, customer_id, customer_segment, effective_start_date, effective_end_date, effective_end_date IS NULL AS is_current "
     "FROM versions", _VERSIONS)
_add("pit_lookup", f"SELECT v.customer_segment, {_N}, {_sum('s.amount', 'total_amount')} FROM silver s LEFT JOIN "
     "(SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY effective_start_date) = 1 AS is_first FROM versions) v "
     "ON s.customer_id = v.customer_id AND (v.is_first OR s.transaction_timestamp >= v.effective_start_date) "
     "AND (v.effective_end_date IS NULL OR s.transaction_timestamp < v.effective_end_date) GROUP BY v.customer_segment",
     _SILVER + "," + _VERSIONS)
_add("pit_lookup_strict", f"SELECT v.customer_key, {_N} FROM silver s LEFT JOIN versions v "
     "ON s.customer_id = v.customer_id AND s.transaction_timestamp >= v.effective_start_date "
     "AND (v.effective_end_date IS NULL OR s.transaction_timestamp < v.effective_end_date) GROUP BY v.customer_key",
     _SILVER + "," + _VERSIONS)

# --- increments
_add("inc_hwm", "SELECT transaction_id, transaction_timestamp, updated_at, CAST(amount AS DOUBLE) AS amount FROM batches "
     "WHERE coalesce(updated_at, transaction_timestamp) > TIMESTAMP '2024-01-20'", _BATCHES)
_add("inc_next_mark", "SELECT max(coalesce(updated_at, transaction_timestamp)) AS high_water FROM batches", _BATCHES)
_MERGED = _BATCHES + """,
corrections AS (
  SELECT transaction_id, amount + 1 AS amount, updated_at + INTERVAL 1 DAY AS updated_at, transaction_status, transaction_timestamp FROM batches WHERE updated_at IS NOT NULL AND n % 9 = 0
  UNION ALL SELECT transaction_id, amount + 2, updated_at + INTERVAL 2 DAY, transaction_status, transaction_timestamp FROM batches WHERE updated_at IS NOT NULL AND n % 9 = 0
  UNION ALL SELECT transaction_id, amount + 1000, updated_at - INTERVAL 3 DAY, transaction_status, transaction_timestamp FROM batches WHERE updated_at IS NOT NULL AND n % 11 = 5
  UNION ALL SELECT 'NEW-' || transaction_id, amount, updated_at, transaction_status, transaction_timestamp FROM batches WHERE updated_at IS NOT NULL AND n % 40 = 1),
merged AS (SELECT transaction_id, amount, updated_at, transaction_status, transaction_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY coalesce(updated_at, transaction_timestamp) DESC) AS r
  FROM (SELECT transaction_id, amount, updated_at, transaction_status, transaction_timestamp FROM batches
    UNION ALL SELECT * FROM corrections)) WHERE r = 1)"""
_add("inc_upsert", "SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, updated_at, transaction_status FROM merged", _MERGED)
STATEMENTS["inc_bucketed_upsert"] = STATEMENTS["inc_upsert"]
_SPANS = _BATCHES + """,
spans AS (SELECT *, CAST(floor(date_diff('day', lo, batch_day) * 4 / (date_diff('day', lo, hi) + 1)) AS BIGINT) AS span
  FROM batches, (SELECT min(batch_day) AS lo, max(batch_day) AS hi FROM batches))"""
_add("dq_cross_batch_history", "SELECT b.batch_number, count(*) AS total_rows, count(*) FILTER (WHERE b.transaction_id IS NULL) AS missing_ids, "
     "count(DISTINCT b.transaction_id) AS unique_ids, count(b.transaction_id) - count(DISTINCT b.transaction_id) AS extra_rows, "
     "count(DISTINCT b.transaction_id) FILTER (WHERE h.first_span < b.batch_number) AS known_ids, "
     "count(*) FILTER (WHERE h.first_span < b.batch_number) AS known_rows FROM ("
     "SELECT span AS batch_number, transaction_id FROM spans UNION ALL SELECT span + 1, transaction_id FROM spans "
     "WHERE span < 3 AND CAST(amount * 100 AS BIGINT) % 7 = 0) b "
     "LEFT JOIN (SELECT transaction_id, min(span) AS first_span FROM spans GROUP BY 1) h ON b.transaction_id = h.transaction_id GROUP BY 1", _SPANS)
_CDC = _BATCHES + """,
applied AS (
  SELECT transaction_id, CASE WHEN n % 6 = 0 AND n % 12 <> 0 THEN amount + 5 ELSE amount END AS amount,
    CASE WHEN n % 6 = 0 AND n % 12 <> 0 THEN 'Refunded' ELSE transaction_status END AS transaction_status,
    n % 12 = 0 AS is_deleted FROM batches
  UNION ALL SELECT 'NEW-' || transaction_id, amount, transaction_status, FALSE FROM batches WHERE n % 25 = 2)"""
_add("inc_cdc", "SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, transaction_status FROM applied WHERE NOT is_deleted", _CDC)
_add("inc_soft_delete", f"SELECT is_deleted, {_N}, {_sum('amount', 'total_amount')} FROM applied GROUP BY is_deleted", _CDC)
_add("inc_late_route", f"SELECT CAST(transaction_timestamp AS DATE) AS event_date, {_N}, {_sum('amount', 'total_amount')} "
     "FROM batches GROUP BY 1", _BATCHES)
_add("inc_tz_fix", f"SELECT transaction_id, CASE WHEN {_IS_SHIFTED} THEN transaction_timestamp + INTERVAL 630 MINUTE "
     f"ELSE transaction_timestamp END AS transaction_timestamp, {_IS_SHIFTED} AS zone_fixed FROM batches", _BATCHES)
_add("inc_lineage", f"SELECT strftime(batch_day, '%Y%m%d') AS batch_id, 'daily_batch' AS source_system, {_N}, "
     f"{_sum('amount', 'total_amount')} FROM batches GROUP BY 1, 2", _BATCHES)
_add("inc_month_partitions", f"SELECT strftime(transaction_timestamp, '%Y-%m') AS txn_month, {_N}, {_sum('amount', 'total_amount')} "
     "FROM silver GROUP BY 1", _SILVER)
_add("inc_clustered", f"SELECT date_key, status_key, {_N}, {_sum('amount', 'total_amount')} FROM fact "
     "GROUP BY date_key, status_key", _FACT)
_CURVE_BITS = 3
_CURVE_KEYS = ["date_key", "merchant_key", "status_key"]
_PLACE = " | ".join(
    f"((coalesce(({k} - min({k}) OVER ()) * {1 << _CURVE_BITS} // (max({k}) OVER () - min({k}) OVER () + 1), 0)::BIGINT >> {i} & 1) << {i * 3 + 2 - j})"
    for i in range(_CURVE_BITS) for j, k in enumerate(_CURVE_KEYS))
_add("inc_clustered_curve", f"SELECT place, {_N}, {_sum('amount', 'total_amount')}, "
     + ", ".join(f"min({k}) AS least_{k}, max({k}) AS most_{k}" for k in _CURVE_KEYS)
     + f" FROM (SELECT *, CAST({_PLACE} AS BIGINT) AS place FROM fact) GROUP BY place", _FACT)
_add("inc_star_load", "SELECT b.merchant_id, n.merchant_name, m.transaction_status AS status_name, "
     "CAST(" + _by_status(fixed.STATUS_DISPLAY_ORDER) + " AS BIGINT) AS display_order, b.location_type, "
     "CAST(strftime(m.transaction_timestamp, '%Y%m%d') AS BIGINT) AS date_key, "
     f"{_N}, {_sum('m.amount', 'total_amount')}, count(DISTINCT b.customer_id) AS customers "
     "FROM merged m JOIN batches b ON b.transaction_id = replace(m.transaction_id, 'NEW-', '') "
     "JOIN (SELECT merchant_id, min(merchant_name) AS merchant_name FROM batches GROUP BY 1) n ON n.merchant_id = b.merchant_id "
     "GROUP BY 1, 2, 3, 4, 5, 6", _MERGED)
_BITS = [("late", f"({_IS_LATE}) AND NOT {_IS_SHIFTED}"), ("missing_update", "updated_at IS NULL"),
         ("renamed", _IS_RENAMED), ("zone_shifted", _IS_SHIFTED)]
_MASK = " + ".join(f"CASE WHEN {test} THEN {1 << i} ELSE 0 END" for i, (_, test) in enumerate(_BITS))
_LABEL = ", ".join(f"CASE WHEN mask & {1 << i} <> 0 THEN '{name}' END" for i, (name, _) in enumerate(_BITS))
_add("inc_dq_dim", f"SELECT CASE WHEN mask > 0 THEN CAST(mask + 1 AS BIGINT) END AS dq_key, "
     f"CASE WHEN mask > 0 THEN concat_ws(', ', {_LABEL}) END AS dq_issue, {_N} FROM (SELECT {_MASK} AS mask FROM batches) GROUP BY 1, 2", _BATCHES)
_add("inc_keys", "SELECT (SELECT max(customer_key) FROM dim_customers) + row_number() OVER (ORDER BY customer_id) AS customer_key, customer_id "
     "FROM (SELECT DISTINCT customer_id FROM batches WHERE customer_id NOT IN (SELECT customer_id FROM dim_customers WHERE customer_id IS NOT NULL))",
     _STAR + "," + _BATCHES)
_add("inc_rename_scd2", "SELECT coalesce(old_key, (SELECT max(old_key) FROM start) + row_number() OVER "
     "(PARTITION BY old_key IS NULL ORDER BY merchant_id, changed)) AS merchant_key, merchant_id, merchant_name, changed AS effective_start_date, "
     "lead(changed) OVER w AS effective_end_date, lead(changed) OVER w IS NULL AS is_current FROM kept WINDOW w AS (PARTITION BY merchant_id ORDER BY changed)",
     _BATCHES + """,
start AS (SELECT row_number() OVER (ORDER BY merchant_id) AS old_key, merchant_id, min(merchant_name) AS merchant_name FROM batches GROUP BY merchant_id),
chain AS (SELECT merchant_id, merchant_name, TIMESTAMP '2024-01-01' AS changed, old_key FROM start
  UNION ALL SELECT merchant_id, max(merchant_name), transaction_timestamp, NULL FROM batches
    WHERE transaction_timestamp > TIMESTAMP '2024-01-01' GROUP BY merchant_id, transaction_timestamp),
kept AS (SELECT * FROM (SELECT *, lag(merchant_name) OVER w AS prior_name, row_number() OVER w AS k FROM chain
    WINDOW w AS (PARTITION BY merchant_id ORDER BY changed)) WHERE k = 1 OR merchant_name IS DISTINCT FROM prior_name)""")

# --- generator: what follows from the plan of the days
_add("gen_batch_profile", """SELECT batch_day, total_rows, total_rows AS unique_transactions,
  'TXN_' || strftime(batch_day, '%Y%m%d') || '_000001' AS first_id,
  'TXN_' || strftime(batch_day, '%Y%m%d') || '_' || lpad(total_rows::VARCHAR, greatest(length(total_rows::VARCHAR), 6)::INT, '0') AS last_id,
  CASE WHEN kind = 1 THEN CAST(floor(total_rows * CAST(0.01 AS DOUBLE)) AS BIGINT) ELSE 0 END AS null_updated_rows,
  CASE WHEN kind = 2 THEN CAST(floor(total_rows * CAST(0.02 AS DOUBLE)) AS BIGINT) ELSE 0 END AS renamed_rows,
  CASE WHEN kind = 1 THEN CAST(floor(total_rows * CAST(0.01 AS DOUBLE)) AS BIGINT) ELSE 0 END AS late_rows,
  CASE WHEN kind = 2 THEN CAST(floor(total_rows * CAST(0.0133 AS DOUBLE)) AS BIGINT) ELSE 0 END AS zone_shifted_rows
FROM (SELECT CAST(ts AS DATE) AS batch_day, count(*) AS total_rows, (day(CAST(ts AS DATE)) - 1) % 3 AS kind FROM events GROUP BY 1, 3)""")

_SEED = 42


def _double(x: float) -> str:
    return f"{x!r}e0"


def _draw(label: str) -> str:
    text = f"'{_SEED}|{label}|' || strftime(day, '%Y-%m-%d') || '|' || sequence"
    return f"(CAST(('0x' || substr(md5({text}), 1, 13)) AS BIGINT) / {_double(float(16**13))})"


def _between(label: str, low: float, high: float) -> str:
    return f"({_draw(label)} * {_double(high - low)} + {_double(low)})"


def _weighted(label: str, weights: dict[str, float]) -> str:
    total, reached, cases = sum(weights.values()), 0.0, []
    names = list(weights)
    for name in names[:-1]:
        reached += weights[name] / total
        cases.append(f"WHEN {_draw(label)} < {_double(reached)} THEN '{name}'")
    return f"CASE {' '.join(cases)} ELSE '{names[-1]}' END"


def _list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _pick(label: str, values: list[str]) -> str:
    return f"{_list(values)}[CAST(floor({_draw(label)} * {len(values)}) AS INTEGER) + 1]"


def _moment(label: str) -> str:
    return f"CAST(day AS TIMESTAMP) + to_seconds(CAST(floor({_draw(label)} * 86400) AS INTEGER))"


def _share(share: float) -> str:
    return f"CAST(floor(day_rows * {_double(share)}) AS BIGINT)"


_NAMED = len(fixed.NAMED_MERCHANTS)
_PADDED = "lpad(CAST({n} AS VARCHAR), greatest(length(CAST({n} AS VARCHAR)), {w})::INT, '0')"
_NORMAL = f"sqrt(ln(1.0e0 - {_draw('a1')}) * -2.0e0) * cos({_draw('a2')} * {_double(2.0 * math.pi)})"
_AMOUNT = (f"CAST(greatest({_double(fixed.AMOUNT_BOUNDS[0])}, least({_double(fixed.AMOUNT_BOUNDS[1])}, "
           f"exp({_NORMAL} * {_double(fixed.AMOUNT_LOG_SIGMA)} + {_double(fixed.AMOUNT_LOG_MEAN)}))) AS DECIMAL(18,2))")
_RENAMED = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in fixed.MERCHANT_RENAMES.items()) + "}"
_PRODUCT = "CASE product_category " + " ".join(
    f"WHEN '{c}' THEN {_pick('product', list(items))}" for c, items in fixed.PRODUCTS.items()) + " END"
_GENERATED = f"""
placed AS (
  SELECT CAST(ts AS DATE) AS day, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id) AS sequence,
    count(*) OVER (PARTITION BY CAST(ts AS DATE)) AS day_rows, (day(CAST(ts AS DATE)) - 1) % 3 AS kind FROM events),
segmented AS (
  SELECT *, CASE
    WHEN kind = 1 AND sequence > day_rows - {_share(fixed.NULL_UPDATED_SHARE)} THEN 'null_updated'
    WHEN kind = 1 AND sequence > day_rows - {_share(fixed.NULL_UPDATED_SHARE)} - {_share(fixed.LATE_SHARE)} THEN 'late'
    WHEN kind = 2 AND sequence > day_rows - {_share(fixed.TIME_ZONE_SHARE)} THEN 'zone_shifted'
    WHEN kind = 2 AND sequence > day_rows - {_share(fixed.TIME_ZONE_SHARE)} - {_share(fixed.RENAME_SHARE)} THEN 'renamed'
    ELSE 'clean' END AS segment FROM placed),
drawn AS (
  SELECT *, CAST(floor({_draw('merchant')} * CASE segment WHEN 'renamed' THEN {_NAMED} ELSE 500 END) + 1 AS BIGINT) AS merchant,
    {_pick('category', list(fixed.PRODUCTS))} AS product_category, {_AMOUNT} AS amount,
    {_weighted('status', fixed.STATUS_WEIGHTS)} AS transaction_status, {_moment('time')} AS moment FROM segmented),
named AS (
  SELECT *, coalesce({_list(list(fixed.NAMED_MERCHANTS))}[merchant], 'Merchant_' || {_PADDED.format(n='(merchant - 1)', w=4)}) AS own,
    transaction_status = 'Successful' AS settled, CAST(amount AS DOUBLE) AS value FROM drawn),
generated AS (
  SELECT 'TXN_' || strftime(day, '%Y%m%d') || '_' || {_PADDED.format(n='sequence', w=6)} AS transaction_id,
    'USER_' || {_PADDED.format(n=f"CAST(floor({_draw('customer')} * 1000) + 1 AS BIGINT)", w=4)} AS customer_id,
    CASE segment WHEN 'late' THEN moment - INTERVAL 1 DAY WHEN 'zone_shifted' THEN moment - INTERVAL {fixed.EST_SHIFT_MINUTES} MINUTE
      ELSE moment END AS transaction_timestamp,
    'MERCH_' || {_PADDED.format(n='merchant', w=4)} AS merchant_id,
    CASE WHEN segment = 'renamed' THEN coalesce({_RENAMED}[own], own || ' Ltd') ELSE own END AS merchant_name,
    product_category, {_PRODUCT} AS product_name, amount,
    CAST(value * {_between('fee', *fixed.FEE_RATE_BOUNDS)} AS DECIMAL(18,2)) AS fee_amount,
    CASE WHEN settled THEN CAST(value * {_between('cashback', *fixed.CASHBACK_RATE_BOUNDS)} AS DECIMAL(18,2)) ELSE 0 END AS cashback_amount,
    CASE WHEN settled THEN CAST(trunc(value / {_between('points', *fixed.POINTS_DIVISOR_BOUNDS)}) AS BIGINT) ELSE 0 END AS loyalty_points,
    {_weighted('method', fixed.PAYMENT_METHOD_WEIGHTS)} AS payment_method, transaction_status,
    {_weighted('device', fixed.DEVICE_WEIGHTS)} AS device_type, {_weighted('location', fixed.LOCATION_WEIGHTS)} AS location_type,
    '{fixed.CURRENCY}' AS currency,
    CASE WHEN segment IN ('late', 'zone_shifted') THEN {_moment('update')} WHEN segment <> 'null_updated' THEN moment END AS updated_at,
    day AS batch_day, segment FROM named)"""
_add("gen_rows", "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount, CAST(fee_amount AS DOUBLE) AS fee_amount, "
     "CAST(cashback_amount AS DOUBLE) AS cashback_amount) FROM generated", _GENERATED)
_add("gen_shares", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS row_count, " + _pct("count(*)", "sum(count(*)) OVER ()", "percentage")
    + f" FROM generated GROUP BY {c}"
    for c in ("payment_method", "transaction_status", "device_type", "location_type", "product_category")), _GENERATED)
_add("gen_amounts", f"SELECT transaction_status, {_N}, CAST(min(amount) AS DOUBLE) AS min_amount, CAST(max(amount) AS DOUBLE) AS max_amount, "
     f"{_avg('amount', 'avg_amount')}, " + _pct(_cents("fee_amount"), _cents("amount"), "fee_pct") + ", "
     + _pct(_cents("cashback_amount"), _cents("amount"), "cashback_pct")
     + ", CAST(sum(loyalty_points) AS BIGINT) AS loyalty_points FROM generated GROUP BY transaction_status", _GENERATED)
_add("gen_defects", f"SELECT batch_day, count(*) AS total_rows, count(*) FILTER (WHERE {_IS_LATE}) AS late_rows, "
     f"count(*) FILTER (WHERE updated_at IS NULL) AS null_updated_rows, count(*) FILTER (WHERE {_IS_RENAMED}) AS renamed_rows, "
     f"count(*) FILTER (WHERE {_IS_LATE}) AS zone_shifted_rows, count(*) - count(*) FILTER (WHERE {_IS_LATE}) "
     f"- count(*) FILTER (WHERE updated_at IS NULL) - count(*) FILTER (WHERE {_IS_RENAMED}) AS clean_rows "
     "FROM generated GROUP BY batch_day", _GENERATED)

# --- files
_RAW_PROFILE = (f"SELECT payment_method, transaction_status, {_N}, {_sum('amount', 'total_amount')}, {_sum('fee_amount', 'total_fees')}, "
                f"{_sum('cashback_amount', 'total_cashback')}, CAST(sum(loyalty_points) AS BIGINT) AS loyalty_points, "
                "date_trunc('minute', min(transaction_timestamp)) AS first_event, date_trunc('minute', max(transaction_timestamp)) AS last_event "
                "FROM silver GROUP BY payment_method, transaction_status")
_add("src_raw_csv", _RAW_PROFILE, _SILVER)
_add("src_raw_csv_detected", _RAW_PROFILE, _SILVER)
_add("src_raw_csv_quarantine", "SELECT loyalty_points % 7 = 3 AS is_broken, payment_method, "
     f"{_N}, {_sum('fee_amount', 'total_fees')}, CAST(sum(loyalty_points) AS BIGINT) AS loyalty_points, "
     "count(*) FILTER (WHERE loyalty_points % 7 = 3) AS lines_with_the_fault FROM silver GROUP BY ALL", _SILVER)
_add("src_batch_csv_quarantine", f"SELECT batch_day, n % 9 = 4 AS is_broken, {_N}, {_sum('amount', 'total_amount')} "
     "FROM (SELECT batch_day, n, CASE WHEN n % 9 <> 4 THEN amount END AS amount FROM batches) GROUP BY ALL", _BATCHES)
_add("bronze_preview", "SELECT CAST(least(10, count(*)) AS BIGINT) AS preview_rows, CAST(least(10, count(*)) AS BIGINT) AS found_in_raw FROM silver", _SILVER)
_add("src_batch_csv", f"SELECT batch_day, {_N}, {_sum('amount', 'total_amount')}, count(updated_at) AS updated_rows, "
     "date_trunc('second', min(transaction_timestamp)) AS first_event FROM batches GROUP BY batch_day", _BATCHES)
_add("snk_report", _REPORT, _FACT)
_add("snk_table", "SELECT payment_method_key, count(*) * 2 AS transaction_count FROM fact GROUP BY payment_method_key", _FACT)

_add("snk_view", "SELECT payment_method_key, date_key // 10000 AS year, CAST(sum(n) AS BIGINT) AS transaction_count, max(n) AS most_in_a_day "
     "FROM (SELECT payment_method_key, date_key, count(*) AS n FROM fact GROUP BY 1, 2) GROUP BY 1, 2", _FACT)

# --- streams
_add("st_ingest", f"SELECT batch_day, strftime(batch_day, '%Y%m%d') AS batch_id, {_N}, {_sum('amount', 'total_amount')} FROM batches GROUP BY 1, 2", _BATCHES)
_add("st_daily_totals", f"SELECT CAST(transaction_timestamp AS DATE) AS event_date, {_N}, {_sum('amount', 'total_amount')}, "
     f"count(*) FILTER (WHERE {_IS_LATE}) AS late_rows FROM batches GROUP BY 1", _BATCHES)
_add("st_dedup", f"SELECT batch_day, {_N}, {_sum('amount', 'total_amount')} FROM batches GROUP BY batch_day", _BATCHES)
_add("st_lookup", f"SELECT merchant_key, {_N}, {_sum('amount', 'total_amount')} FROM batches b LEFT JOIN dim_merchants d "
     "ON b.merchant_id = d.merchant_id GROUP BY merchant_key", _STAR + "," + _BATCHES)
_add("st_lookup_changing", f"SELECT CASE WHEN d.merchant_key % 3 = 0 OR b.transaction_timestamp + INTERVAL 2 DAY >= a.first_event "
     f"+ CASE d.merchant_key % 3 WHEN 1 THEN INTERVAL 1 DAY ELSE INTERVAL 10 DAY END THEN d.merchant_key END AS merchant_key, {_N}, "
     f"{_sum('b.amount', 'total_amount')} FROM batches b LEFT JOIN dim_merchants d ON b.merchant_id = d.merchant_id "
     "LEFT JOIN (SELECT merchant_id, min(transaction_timestamp) AS first_event FROM batches GROUP BY 1) a ON b.merchant_id = a.merchant_id "
     "GROUP BY 1", _STAR + "," + _BATCHES)
_add("st_upsert", f"SELECT CAST(transaction_timestamp AS DATE) AS event_date, {_N}, {_sum('amount', 'total_amount')} FROM merged GROUP BY 1", _MERGED)
_add("st_upsert_partitions", f"SELECT CAST(transaction_timestamp AS DATE) AS event_date, {_N}, {_sum('amount', 'total_amount')} FROM merged GROUP BY 1", _MERGED)
_add("inc_merge_on_read", "SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, updated_at, transaction_status FROM merged", _MERGED)
_add("inc_fiscal_quarter", f"SELECT d.fiscal_year, d.day_of_week_name, {_N}, {_sum('amount', 'total_amount')}, {_avg('amount', 'avg_amount')} "
     "FROM fact f JOIN dim_date d ON f.date_key = d.date_key WHERE d.fiscal_quarter = 3 GROUP BY 1, 2", _FACT)
_add("distinct_by_month", "SELECT CAST(date_key // 100 AS BIGINT) AS month_key, count(DISTINCT customer_key) AS unique_customers FROM fact "
     "WHERE date_key IS NOT NULL AND customer_key IS NOT NULL GROUP BY 1", _FACT)
_add("distinct_by_category", "SELECT product_category, CAST(date_key // 10000 AS BIGINT) AS year, count(DISTINCT customer_key) AS unique_customers "
     "FROM fact WHERE date_key IS NOT NULL AND customer_key IS NOT NULL GROUP BY 1, 2", _FACT)
_add("distinct_trailing_week", "SELECT e.full_date AS span_end, count(DISTINCT f.customer_key) AS unique_customers "
     "FROM fact f JOIN dim_date d ON f.date_key = d.date_key JOIN dim_date e ON e.full_date BETWEEN d.full_date AND d.full_date + 6 "
     "WHERE f.customer_key IS NOT NULL GROUP BY 1", _FACT)
STATEMENTS["bronze_load"] = STATEMENTS["src_raw_csv_quarantine"]
_add("star_grouping_sets", "SELECT t.status_name, p.payment_method_name, p.is_instant, "
     f"CAST(GROUPING(t.status_name, p.payment_method_name, p.is_instant) AS BIGINT) AS total_level, {_N}, {_sum('f.amount', 'total_amount')} "
     "FROM fact f JOIN (SELECT *, CAST(NULL AS BOOLEAN) AS is_instant FROM dim_payment_methods) p ON f.payment_method_key = p.payment_method_key "
     "JOIN dim_transaction_status t ON f.status_key = t.status_key "
     "GROUP BY GROUPING SETS ((t.status_name, p.is_instant), (p.payment_method_name), (p.is_instant), ())", _FACT)
