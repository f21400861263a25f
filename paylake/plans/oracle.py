"""Equivalent SQL for every registered query, runnable by DuckDB.

The test tables are pre-registered as views; the payments tables are derived
from them by the CTEs below, which mirror ``paylake.sources.fixtures``.
Comparison rules: counts BIGINT, money summed as DECIMAL(12,2) and returned
as DOUBLE, rates rounded half-up with integer arithmetic.
"""

from __future__ import annotations

import re

_IP12 = "['US','FR','DE','GB','JP','ES','IT','NL','RU','CN','BR','NG']"
_COUNTRIES = "['US','FR','DE','GB','JP','ES','IT','NL']"
_CURRENCIES = "['USD','EUR','GBP','JPY','CHF']"
_CATEGORIES = "['ecommerce','saas','marketplace','retail','travel']"

CTES: dict[str, str] = {
    "transactions": f"""
  SELECT id, customer_id, merchant_id, payment_method_id, currency_code, amount, status,
         device_type, ip_country,
         CASE WHEN id % 97 = 96 THEN NULL
              ELSE LEAST(GREATEST(
                   CASE WHEN amount > 4000 THEN 3500 WHEN amount > 2000 THEN 2000
                        WHEN amount > 1000 THEN 1000 ELSE 0 END
                 + CASE WHEN ip_country IN ('US','RU','CN','BR','NG') THEN 2000 ELSE 0 END
                 + CASE WHEN _hour >= 22 OR _hour <= 6 THEN 1500 ELSE 0 END
                 + CASE WHEN device_type = 'mobile' THEN 1000 ELSE 0 END
                 + CASE WHEN status = 'failed' THEN 1500 ELSE 0 END
                 + _noise, 0), 10000) / CAST(10000.0 AS DOUBLE) END AS fraud_score,
         created_at
  FROM (
    SELECT o_orderkey AS id, o_custkey AS customer_id,
           (o_orderkey * 13) % (SELECT count(*) FROM supplier) AS merchant_id,
           CAST(o_orderkey % 3 + 1 AS SMALLINT) AS payment_method_id,
           ({_CURRENCIES})[o_orderkey % 5 + 1] AS currency_code,
           CAST(FLOOR(o_totalprice) AS BIGINT) / CAST(100.0 AS DOUBLE) AS amount,
           CASE o_orderstatus
             WHEN 'O' THEN 'success'
             WHEN 'P' THEN CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'pending' ELSE 'success' END
             WHEN 'F' THEN CASE WHEN substr(o_orderpriority, 1, 1) IN ('4', '5') THEN 'refunded' ELSE 'failed' END
           END AS status,
           CASE WHEN o_orderkey % 50 = 49 THEN NULL
                ELSE (['mobile','desktop','tablet'])[(o_orderkey + o_custkey) % 3 + 1] END AS device_type,
           ({_IP12})[(o_orderkey * 7 + o_custkey) % 13 + 1] AS ip_country,
           floor(((o_orderkey * 7919) % 86400) / 3600) AS _hour,
           (o_orderkey * 104729) % 1001 - 500 AS _noise,
           o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS created_at
    FROM orders) _o""",
    "customers": f"""
  SELECT c_custkey AS id, sha256(c_name || '@example.com') AS email_hash,
         CASE WHEN c_custkey % 40 = 39 THEN NULL ELSE ({_COUNTRIES})[c_nationkey % 8 + 1] END AS country_code,
         TIMESTAMP '2023-01-01 00:00:00' + to_seconds((c_custkey * 7919) % 31536000) AS created_at,
         TIMESTAMP '2023-01-01 00:00:00' + to_seconds((c_custkey * 7919) % 31536000) AS updated_at
  FROM customer""",
    "merchants": f"""
  SELECT s_suppkey AS id, s_name AS name,
         ({_COUNTRIES})[(s_nationkey * 3 + s_suppkey) % 8 + 1] AS country_code,
         ({_CATEGORIES})[s_nationkey % 5 + 1] AS category,
         TIMESTAMP '2022-01-01 00:00:00' + to_seconds((s_suppkey * 7919) % 31536000) AS created_at
  FROM supplier""",
    "merchants_by_name": f"""
  SELECT s_suppkey AS id, 'Merchant-' || CAST(s_suppkey % 60 AS VARCHAR) AS name,
         ({_COUNTRIES})[(s_nationkey * 3 + s_suppkey) % 8 + 1] AS country_code,
         ({_CATEGORIES})[s_nationkey % 5 + 1] AS category
  FROM supplier""",
    "refunds": """
  SELECT l_orderkey AS id, l_orderkey AS transaction_id,
         CAST(l_orderkey % 50 + 1 AS DOUBLE) AS amount,
         (['duplicate','fraudulent','requested'])[l_orderkey % 4 + 1] AS reason,
         max(l_shipdate) AS created_at
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey""",
    "tx_changes": """
  SELECT l_orderkey * 10 + l_linenumber AS id, l_shipdate AS _ts,
         CAST(floor(l_extendedprice) AS BIGINT) AS _p, l_partkey AS _k,
         l_partkey AS customer_id, l_suppkey AS merchant_id,
         (['USD','EUR','GBP','JPY','CHF'])[l_orderkey % 5 + 1] AS currency_code,
         floor(l_extendedprice) / CAST(100.0 AS DOUBLE) AS amount,
         CASE l_returnflag WHEN 'A' THEN 'failed' WHEN 'R' THEN 'refunded' ELSE 'success' END AS status,
         CASE WHEN l_linestatus = 'O' THEN 'mobile' END AS device_type,
         l_linestatus = 'O' AS device_present,
         round(l_discount * 10, 1) AS fraud_score
  FROM lineitem""",
    "tx_events": f"""
  SELECT *, CASE WHEN coalesce(fraud_score, 0) > 0.7 THEN 'fraud_alerts' ELSE 'transactions' END AS topic
  FROM (
    SELECT CAST(event_id AS VARCHAR) AS id, event_id AS _seq, CAST(user_id AS VARCHAR) AS customer_id,
           CASE WHEN event_type <> 'error' THEN CAST(event_id % 10 AS VARCHAR) END AS merchant_id,
           event_type <> 'error' AS is_valid,
           value AS amount, ({_CURRENCIES})[event_id % 5 + 1] AS currency_code,
           CASE WHEN event_id % 20 = 0 THEN NULL
                ELSE CAST(props ->> '$.k' AS INTEGER) / CAST(100.0 AS DOUBLE) END AS fraud_score,
           ts AS created_at
    FROM events) _e""",
}

# CTEs that use other CTEs
_DEPENDS = {"fact": ["transactions"]}


def _rate(k: str, n: str) -> str:
    """ROUND(100.0 * k / n, 2) with half-up integer arithmetic, as DOUBLE."""
    return f"CAST(((20000 * ({k}) + ({n})) // (2 * ({n}))) AS DOUBLE) / 100.0"


def _money(col: str, scale: str = "DECIMAL(12,2)") -> str:
    return f"CAST(SUM(CAST({col} AS {scale})) AS DOUBLE)"


FACT = """
  SELECT id AS transaction_key, customer_id AS customer_key, merchant_id AS merchant_key,
         CAST(created_at AS DATE) AS date_key, payment_method_id AS payment_method_key,
         currency_code, amount, status, device_type, ip_country, fraud_score,
         CASE WHEN fraud_score > 0.7 THEN true ELSE false END AS is_fraud_suspected,
         created_at
  FROM transactions"""
CTES["fact"] = FACT

DIM_TIME = """
  SELECT date_key, CAST(year(date_key) AS INTEGER) AS year, CAST(month(date_key) AS INTEGER) AS month,
         CAST(day(date_key) AS INTEGER) AS day, CAST(dayofweek(date_key) AS INTEGER) AS day_of_week,
         CAST(weekofyear(date_key) AS INTEGER) AS week_of_year, CAST(quarter(date_key) AS INTEGER) AS quarter
  FROM (SELECT DISTINCT CAST(created_at AS DATE) AS date_key FROM transactions) _d"""

AGG_DAILY = f"""
  SELECT date_key, currency_code, count(*) AS nb_transactions,
         {_money('amount')} AS total_revenue,
         {_money('amount')} / count(amount) AS avg_amount,
         CAST(SUM(CASE WHEN status = 'success' THEN 1 END) AS BIGINT) AS nb_success,
         CAST(SUM(CASE WHEN status = 'failed' THEN 1 END) AS BIGINT) AS nb_failed,
         CAST(SUM(CASE WHEN is_fraud_suspected THEN 1 END) AS BIGINT) AS nb_fraud_suspected
  FROM fact GROUP BY date_key, currency_code"""

AGG_MERCHANT = f"""
  SELECT f.merchant_key, m.name AS merchant_name, m.category AS merchant_category,
         count(*) AS nb_transactions, {_money('f.amount')} AS total_volume,
         {_money('f.amount')} / count(f.amount) AS avg_transaction,
         CAST(SUM(CASE WHEN f.is_fraud_suspected THEN 1 END) AS BIGINT) AS nb_fraud
  FROM fact f JOIN merchants m ON f.merchant_key = m.id
  GROUP BY f.merchant_key, m.name, m.category"""

AGG_COUNTRY = f"""
  SELECT ip_country, total, nb_fraud, {_rate('nb_fraud', 'total')} AS fraud_rate_pct, avg_fraud_score
  FROM (SELECT ip_country, count(*) AS total,
               CAST(SUM(CASE WHEN is_fraud_suspected THEN 1 END) AS BIGINT) AS nb_fraud,
               {_money('fraud_score', 'DECIMAL(5,4)')} / count(fraud_score) AS avg_fraud_score
        FROM fact WHERE ip_country IS NOT NULL GROUP BY ip_country) _a"""

STAR_TABLES = {
    "dim_customer": "SELECT id AS customer_key, email_hash, country_code, created_at AS customer_since FROM customers",
    "dim_merchant": ("SELECT id AS merchant_key, name AS merchant_name, country_code AS merchant_country, "
                     "category AS merchant_category FROM merchants"),
    "dim_time": DIM_TIME,
    "dim_payment_method": ("SELECT DISTINCT payment_method_id AS payment_method_key, "
                           "payment_method_id AS method_name FROM transactions"),
    "fact_transactions": "SELECT * FROM fact",
    "agg_daily_revenue": AGG_DAILY,
    "agg_merchant_performance": AGG_MERCHANT,
    "agg_fraud_by_country": AGG_COUNTRY,
}

_ISO_VALUES = ", ".join(f"('{a}', '{b}')" for a, b in [
    ("BR", "BRA"), ("CN", "CHN"), ("DE", "DEU"), ("ES", "ESP"), ("FR", "FRA"), ("GB", "GBR"),
    ("IT", "ITA"), ("JP", "JPN"), ("NG", "NGA"), ("NL", "NLD"), ("RU", "RUS"), ("US", "USA")])

_COUNTRY_VALUES = ("('US','United States','Americas'), ('FR','France','Europe'), ('DE','Germany','Europe'), "
                   "('GB','United Kingdom','Europe'), ('JP','Japan','Asia'), ('ES','Spain','Europe'), "
                   "('IT','Italy','Europe'), ('NL','Netherlands','Europe')")

BODIES: dict[str, str] = {
    "scan_transactions": "SELECT * FROM transactions",
    "scan_projected": ("SELECT id, customer_id, merchant_id, amount, currency_code, status, payment_method_id, "
                       "device_type, ip_country, fraud_score, created_at FROM transactions"),
    "export_day_slice": ("SELECT * FROM transactions WHERE CAST(created_at AS DATE) = "
                         "(SELECT CAST(max(created_at) AS DATE) FROM transactions)"),
    "ref_countries": f"""
  SELECT c.country_code, r.name AS country_name, r.region, count(*) AS n_customers
  FROM customers c LEFT JOIN (VALUES {_COUNTRY_VALUES}) r(code, name, region) ON c.country_code = r.code
  GROUP BY c.country_code, r.name, r.region""",
    **STAR_TABLES,
    "table_row_counts": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM ({q}) _t{i}"
        for i, (n, q) in enumerate(STAR_TABLES.items())),
    "suspicious_transactions": """
  SELECT t.id, t.amount, t.currency_code, t.fraud_score, t.status, t.created_at,
         m.name AS merchant, m.category
  FROM transactions t JOIN merchants m ON t.merchant_id = m.id
  WHERE t.fraud_score > 0.7
  ORDER BY t.fraud_score DESC, t.id ASC LIMIT 50""",
    "daily_volume_by_status": f"""
  SELECT CAST(created_at AS DATE) AS day, status, count(*) AS nb_transactions,
         {_money('amount')} AS total_amount
  FROM transactions
  WHERE created_at >= (SELECT max(created_at) FROM transactions) - INTERVAL 7 DAY
  GROUP BY 1, 2""",
    "top_merchants": f"""
  SELECT m.name, m.category, count(t.id) AS nb_transactions, {_money('t.amount')} AS total_volume
  FROM transactions t JOIN merchants m ON t.merchant_id = m.id
  WHERE t.status = 'success'
  GROUP BY m.id, m.name, m.category
  ORDER BY SUM(CAST(t.amount AS DECIMAL(12,2))) DESC, m.id ASC LIMIT 10""",
    "top_merchants_by_name": f"""
  SELECT m.name AS merchant, m.category, count(*) AS nb_transactions, {_money('t.amount')} AS total_volume
  FROM transactions t JOIN merchants_by_name m ON t.merchant_id = m.id
  WHERE t.status = 'success'
  GROUP BY m.name, m.category
  ORDER BY SUM(CAST(t.amount AS DECIMAL(12,2))) DESC, m.name, m.category LIMIT 10""",
    "fraud_rate_by_customer_country": f"""
  SELECT country_code, total, suspected_fraud, {_rate('suspected_fraud', 'total')} AS fraud_rate_pct
  FROM (SELECT c.country_code, count(*) AS total,
               CAST(SUM(CASE WHEN t.fraud_score > 0.7 THEN 1 END) AS BIGINT) AS suspected_fraud
        FROM transactions t JOIN customers c ON t.customer_id = c.id
        GROUP BY c.country_code) _a""",
    "refunds_to_reconcile": """
  SELECT r.id AS refund_id, r.amount AS refund_amount, t.amount AS original_amount, t.status,
         t.created_at AS transaction_date, r.created_at AS refund_date, r.reason
  FROM refunds r JOIN transactions t ON r.transaction_id = t.id
  WHERE t.status != 'refunded'
  ORDER BY r.created_at DESC""",
    "kpi_overview": f"""
  SELECT count(*) AS total_transactions, {_money('amount')} AS total_revenue,
         {_money('amount')} / count(amount) AS avg_amount,
         CAST(SUM(CASE WHEN fraud_score > 0.7 THEN 1 END) AS BIGINT) AS fraud_count
  FROM transactions""",
    "revenue_by_currency": f"""
  SELECT currency_code, count(*) AS nb_transactions, {_money('amount')} AS total_revenue
  FROM transactions WHERE status = 'success' GROUP BY currency_code""",
    "fraud_by_country_iso3": f"""
  SELECT a.*, iso.iso_alpha3
  FROM ({AGG_COUNTRY}) a LEFT JOIN (VALUES {_ISO_VALUES}) iso(ip_country, iso_alpha3)
    ON a.ip_country = iso.ip_country""",
    "pseudonymise": "SELECT id, email_hash FROM customers",
    "cdc_route_counts": """
  SELECT CASE WHEN coalesce(fraud_score, 0) > 0.7 THEN 'fraud_alerts' ELSE 'transactions' END AS topic,
         count(*) AS n_messages
  FROM transactions GROUP BY 1""",
    "amount_p95": "SELECT quantile_cont(amount, 0.95) AS amount_p95, count(*) AS n_rows FROM transactions",
    "rule_fraud_score": """
  SELECT id, rule_score, fraud_score, abs(fraud_score - rule_score) <= 0.05 AS within_noise
  FROM (SELECT id, fraud_score,
               LEAST(GREATEST(
                   CASE WHEN amount > 4000 THEN 3500 WHEN amount > 2000 THEN 2000
                        WHEN amount > 1000 THEN 1000 ELSE 0 END
                 + CASE WHEN ip_country IN ('US','RU','CN','BR','NG') THEN 2000 ELSE 0 END
                 + CASE WHEN hour(created_at) >= 22 OR hour(created_at) <= 6 THEN 1500 ELSE 0 END
                 + CASE WHEN device_type = 'mobile' THEN 1000 ELSE 0 END
                 + CASE WHEN status = 'failed' THEN 1500 ELSE 0 END, 0), 10000)
               / CAST(10000.0 AS DOUBLE) AS rule_score
        FROM transactions) _r""",
}


def _needed(body: str) -> list[str]:
    """CTE names referenced by ``body`` (with dependencies), in definition order."""
    found: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in CTES:
            if name not in found and re.search(rf"\b{name}\b", text):
                found.add(name)
                todo.append(CTES[name])
    return [n for n in CTES if n in found]


def sql(name: str) -> str:
    body = BODIES[name]
    names = _needed(body)
    if not names:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({CTES[n]}\n)" for n in names)
    return f"WITH {ctes}\n{body.strip()}"


def all_sql() -> dict[str, str]:
    return {name: sql(name) for name in BODIES}


# --- quality ----------------------------------------------------------------------------

def _nn(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS n_checked, "
        f"CAST(count_if({c} IS NULL) AS BIGINT) AS n_violations FROM {table}" for c in cols)


_NOT_NULL = {
    "customers": ["id", "email_hash", "created_at", "updated_at"],
    "merchants": ["id", "name", "created_at"],
    "transactions": ["id", "customer_id", "merchant_id", "payment_method_id", "currency_code",
                     "amount", "status", "created_at"],
    "refunds": ["id", "transaction_id", "amount", "created_at"],
}


def _prec(col: str, p: int, s: int) -> str:
    f = f"TRY_CAST({col} AS DECIMAL({p},{s}))"
    return f"{col} IS NOT NULL AND ({f} IS NULL OR CAST({f} AS DOUBLE) <> {col})"


_CHECKS = {
    "transactions": {
        "amount_positive": ("amount <= 0", "amount"),
        "status_enum": ("status NOT IN ('success','failed','refunded','pending')", "status"),
        "device_type_enum": ("device_type NOT IN ('mobile','desktop','tablet')", "device_type"),
        "fraud_score_range": ("NOT (fraud_score BETWEEN 0 AND 1)", "fraud_score"),
        "currency_code_length": ("length(currency_code) > 3", "currency_code"),
        "ip_country_length": ("length(ip_country) > 2", "ip_country"),
        "amount_precision": (_prec("amount", 12, 2), "amount"),
        "fraud_score_precision": (_prec("fraud_score", 5, 4), "fraud_score"),
    },
    "refunds": {
        "amount_positive": ("amount <= 0", "amount"),
        "amount_precision": (_prec("amount", 12, 2), "amount"),
        "reason_length": ("length(reason) > 100", "reason"),
    },
    "customers": {
        "email_hash_length": ("length(email_hash) > 64", "email_hash"),
        "country_code_length": ("length(country_code) > 2", "country_code"),
    },
    "merchants": {
        "name_length": ("length(name) > 100", "name"),
        "category_length": ("length(category) > 50", "category"),
        "country_code_length": ("length(country_code) > 2", "country_code"),
    },
}

_UNIQUE = [("customers", "id"), ("customers", "email_hash"), ("merchants", "id"),
           ("transactions", "id"), ("refunds", "id")]

_CURRENCY_CODES = "('USD','EUR','GBP','JPY','CHF')"
_COUNTRY_CODES = "('US','FR','DE','GB','JP','ES','IT','NL')"
_FKS = [
    ("transactions.customer_id -> customers", "transactions", "customer_id", "SELECT id FROM customers"),
    ("transactions.merchant_id -> merchants", "transactions", "merchant_id", "SELECT id FROM merchants"),
    ("transactions.payment_method_id -> payment_methods", "transactions", "payment_method_id",
     "SELECT * FROM (VALUES (1), (2), (3)) v(id)"),
    ("transactions.currency_code -> currencies", "transactions", "currency_code",
     f"SELECT * FROM (VALUES {', '.join('(' + c + ')' for c in _CURRENCY_CODES[1:-1].split(','))}) v(id)"),
    ("transactions.ip_country -> countries", "transactions", "ip_country",
     f"SELECT * FROM (VALUES {', '.join('(' + c + ')' for c in _COUNTRY_CODES[1:-1].split(','))}) v(id)"),
    ("customers.country_code -> countries", "customers", "country_code",
     f"SELECT * FROM (VALUES {', '.join('(' + c + ')' for c in _COUNTRY_CODES[1:-1].split(','))}) v(id)"),
    ("merchants.country_code -> countries", "merchants", "country_code",
     f"SELECT * FROM (VALUES {', '.join('(' + c + ')' for c in _COUNTRY_CODES[1:-1].split(','))}) v(id)"),
    ("refunds.transaction_id -> transactions", "refunds", "transaction_id", "SELECT id FROM transactions"),
]


def _fk(name, child, col, parent) -> str:
    return (f"SELECT '{name}' AS constraint_name, "
            f"(SELECT count({col}) FROM {child}) AS n_checked, "
            f"CAST(count(*) AS BIGINT) AS n_violations, count(DISTINCT {col}) AS n_missing_keys "
            f"FROM {child} WHERE {col} IS NOT NULL AND {col} NOT IN ({parent})")


# --- change log fold ---------------------------------------------------------------------

_ORD = "(_ts, _p, _k)"


def _fold(where: str = "") -> str:
    return f"""SELECT id,
         arg_max(customer_id, {_ORD}) AS customer_id, arg_max(merchant_id, {_ORD}) AS merchant_id,
         arg_max(currency_code, {_ORD}) AS currency_code, arg_max(amount, {_ORD}) AS amount,
         arg_max(status, {_ORD}) AS status,
         arg_max(device_type, {_ORD}) FILTER (WHERE device_present) AS device_type,
         bool_or(device_present) AS device_seen,
         arg_max(fraud_score, {_ORD}) AS fraud_score, max(_ts) AS created_at
  FROM tx_changes {where} GROUP BY id"""


_CHANGE_COLS = ["customer_id", "merchant_id", "currency_code", "amount", "status", "device_type",
                "fraud_score", "created_at"]
_CUTOFF = "TIMESTAMP '1998-06-01 00:00:00'"

_RULE_SCORE = """LEAST(GREATEST(
                   CASE WHEN amount > 4000 THEN 3500 WHEN amount > 2000 THEN 2000
                        WHEN amount > 1000 THEN 1000 ELSE 0 END
                 + CASE WHEN ip_country IN ('US','RU','CN','BR','NG') THEN 2000 ELSE 0 END
                 + CASE WHEN hour(created_at) >= 22 OR hour(created_at) <= 6 THEN 1500 ELSE 0 END
                 + CASE WHEN device_type = 'mobile' THEN 1000 ELSE 0 END
                 + CASE WHEN status = 'failed' THEN 1500 ELSE 0 END, 0), 10000) / CAST(10000.0 AS DOUBLE)"""

CTES["scored"] = f"""
  SELECT {_RULE_SCORE} AS score, CASE WHEN fraud_score > 0.7 THEN 1 ELSE 0 END AS label FROM transactions"""

CTES["feats"] = """
  SELECT id, amount,
         CAST(CAST(ln(1 + amount) AS DECIMAL(18,9)) AS DOUBLE) AS amount_log,
         CASE WHEN amount > (SELECT quantile_cont(amount, 0.95) FROM transactions) THEN 1 ELSE 0 END AS is_high_amount,
         CASE WHEN device_type = 'mobile' THEN 1 ELSE 0 END AS device_mobile,
         CASE WHEN device_type = 'desktop' THEN 1 ELSE 0 END AS device_desktop,
         CASE WHEN device_type = 'tablet' THEN 1 ELSE 0 END AS device_tablet,
         CASE WHEN status = 'success' THEN 1 ELSE 0 END AS status_success,
         CASE WHEN status = 'failed' THEN 1 ELSE 0 END AS status_failed,
         CASE WHEN status = 'refunded' THEN 1 ELSE 0 END AS status_refunded,
         CAST(hour(created_at) AS INTEGER) AS hour,
         CAST(isodow(created_at) - 1 AS INTEGER) AS day_of_week,
         CASE WHEN isodow(created_at) - 1 >= 5 THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN hour(created_at) >= 22 OR hour(created_at) <= 6 THEN 1 ELSE 0 END AS is_night,
         CASE WHEN ip_country IN ('US','RU','CN','BR','NG') THEN 1 ELSE 0 END AS high_risk_country,
         CASE WHEN fraud_score > 0.7 THEN 1 ELSE 0 END AS is_fraud
  FROM transactions WHERE amount IS NOT NULL AND created_at IS NOT NULL"""

_CM = "SELECT label, CAST(score > 0.5 AS INTEGER) AS prediction, count(*) AS n FROM scored GROUP BY ALL"

BODIES.update({
    "dq_not_null": " UNION ALL ".join(_nn(t, c) for t, c in _NOT_NULL.items()),
    "dq_checks": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{r}' AS rule, count({col}) AS n_checked, "
        f"CAST(count_if({cond}) AS BIGINT) AS n_violations FROM {t}"
        for t, rules in _CHECKS.items() for r, (cond, col) in rules.items()),
    "dq_unique_keys": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{k}' AS key_column, CAST(coalesce(sum(c), 0) AS BIGINT) AS n_rows, "
        f"count(*) AS n_distinct, CAST(count_if(c > 1) AS BIGINT) AS n_duplicated_keys "
        f"FROM (SELECT {k}, count(*) AS c FROM {t} WHERE {k} IS NOT NULL GROUP BY {k}) _u"
        for t, k in _UNIQUE),
    "dq_foreign_keys": " UNION ALL ".join(_fk(*fk) for fk in _FKS),
    "audit_snapshot_diff": f"""
  SELECT 'transactions' AS table_name,
         CASE WHEN o.id IS NULL THEN 'INSERT' WHEN n.id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation,
         coalesce(n.id, o.id) AS record_id
  FROM ({_fold(f"WHERE _ts < {_CUTOFF}")}) o FULL OUTER JOIN ({_fold()}) n ON o.id = n.id
  WHERE o.id IS NULL OR n.id IS NULL OR
        ({', '.join('o.' + c for c in _CHANGE_COLS)}) IS DISTINCT FROM ({', '.join('n.' + c for c in _CHANGE_COLS)})""",
    "export_partition_counts": """
  SELECT strftime(created_at, '%Y') AS year, strftime(created_at, '%m') AS month, strftime(created_at, '%d') AS day,
         count(*) AS n_rows, CAST(SUM(CAST(amount AS DECIMAL(12,2))) AS DOUBLE) AS total_amount
  FROM transactions GROUP BY ALL""",
    "snapshot_roundtrip": "SELECT * FROM transactions",
    "insert_if_absent": """
  SELECT * FROM customers WHERE created_at < TIMESTAMP '2023-07-01 00:00:00'
  UNION ALL
  SELECT id, email_hash, country_code, created_at, updated_at + INTERVAL 1 DAY AS updated_at
  FROM customers WHERE NOT (created_at < TIMESTAMP '2023-07-01 00:00:00')""",
    "cdc_incremental_read": """
  SELECT id, created_at, fraud_score,
         CASE WHEN coalesce(fraud_score, 0) > 0.7 THEN 'fraud_alerts' ELSE 'transactions' END AS topic
  FROM transactions
  WHERE created_at > TIMESTAMP '2000-01-01 00:00:00'
     OR (created_at = TIMESTAMP '2000-01-01 00:00:00' AND id > 0)""",
    "cdc_messages": """
  SELECT CASE WHEN coalesce(fraud_score, 0) > 0.7 THEN 'fraud_alerts' ELSE 'transactions' END AS topic,
         CAST(id AS VARCHAR) AS key, CAST(id AS VARCHAR) AS id, CAST(customer_id AS VARCHAR) AS customer_id,
         CAST(merchant_id AS VARCHAR) AS merchant_id, amount, currency_code, status, fraud_score,
         device_type, ip_country, strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS created_at
  FROM transactions""",
    "upsert_current": f"SELECT id, {', '.join(_CHANGE_COLS)} FROM ({_fold()}) _f",
    "upsert_patch": f"""
  SELECT coalesce(n.id, o.id) AS id,
         {', '.join(f'CASE WHEN n.id IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}'
                    for c in _CHANGE_COLS if c != 'device_type')},
         CASE WHEN n.id IS NOT NULL AND n.device_seen THEN n.device_type ELSE o.device_type END AS device_type,
         CASE WHEN o.id IS NULL THEN 'insert' WHEN n.id IS NULL THEN 'keep' ELSE 'update' END AS op
  FROM ({_fold(f"WHERE _ts < {_CUTOFF}")}) o FULL OUTER JOIN ({_fold(f"WHERE _ts >= {_CUTOFF}")}) n ON o.id = n.id""",
    "export_other_tables": """
  SELECT 'customers' AS table_name, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_days FROM customers
  UNION ALL SELECT 'merchants', count(*), CAST(1 AS BIGINT) FROM merchants
  UNION ALL SELECT 'refunds', count(*), count(DISTINCT CAST(created_at AS DATE)) FROM refunds""",
    "cdc_poll": """
  SELECT id, customer_id, merchant_id, amount, currency_code, status, fraud_score, device_type, ip_country, created_at
  FROM transactions
  WHERE created_at <= TIMESTAMP '1997-06-30 12:00:00'
    AND (id % 50 <> 0 OR created_at > (SELECT max(created_at) FROM transactions
                                       WHERE id % 50 <> 0 AND created_at <= TIMESTAMP '1996-06-30 12:00:00') - INTERVAL 1 DAY)""",
    "model_roundtrip": "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_differ FROM transactions",
    "stream_validate": "SELECT id, topic, is_valid FROM tx_events",
    "stream_quarantine": "SELECT id AS key, topic, 'missing_keys' AS reason FROM tx_events WHERE NOT is_valid",
    "stream_dispatch": """
  SELECT 'transactions' AS collection, count(*) AS n_docs FROM tx_events WHERE is_valid AND topic = 'transactions'
  UNION ALL SELECT 'fraud_alerts', count(*) FROM tx_events WHERE is_valid AND topic = 'fraud_alerts'
  UNION ALL SELECT 'logs', count(*) FROM tx_events WHERE is_valid AND topic = 'fraud_alerts'
  UNION ALL SELECT 'quarantine', count(*) FROM tx_events WHERE NOT is_valid""",
    "alert_log": """
  SELECT 'fraud_alert' AS type, id AS transaction_id, fraud_score, amount, currency_code AS currency
  FROM tx_events WHERE is_valid AND topic = 'fraud_alerts'""",
    "stream_upsert": f"""
  SELECT CAST(id AS VARCHAR) AS id, CAST(customer_id AS VARCHAR) AS customer_id,
         CAST(merchant_id AS VARCHAR) AS merchant_id, amount, currency_code, status, fraud_score,
         device_type, CAST(NULL AS VARCHAR) AS ip_country, created_at
  FROM ({_fold()}) _f""",
    "features": "SELECT * FROM feats",
    "cv_fold_counts": """
  SELECT CAST((r > floor(n * CAST(0.2 AS DOUBLE) + 0.5))::INT + (r > floor(n * CAST(0.4 AS DOUBLE) + 0.5))::INT
              + (r > floor(n * CAST(0.6 AS DOUBLE) + 0.5))::INT + (r > floor(n * CAST(0.8 AS DOUBLE) + 0.5))::INT AS INTEGER) AS fold,
         is_fraud, count(*) AS n_rows
  FROM (SELECT is_fraud, count(*) OVER (PARTITION BY is_fraud) AS n, row_number() OVER (PARTITION BY is_fraud
          ORDER BY CAST(('0x' || substr(sha256(CAST(id AS VARCHAR) || ':43'), 1, 15)) AS BIGINT), id) AS r FROM feats) _r
  GROUP BY ALL""",
    "stratified_split": """
  SELECT CASE WHEN r <= floor(n * CAST(0.2 AS DOUBLE) + 0.5) THEN 'test' ELSE 'train' END AS split, is_fraud, count(*) AS n_rows
  FROM (SELECT is_fraud, count(*) OVER (PARTITION BY is_fraud) AS n, row_number() OVER (PARTITION BY is_fraud
          ORDER BY CAST(('0x' || substr(sha256(CAST(id AS VARCHAR) || ':42'), 1, 15)) AS BIGINT), id) AS r FROM feats) _r
  GROUP BY ALL""",
    "label_balance": """
  SELECT count(*) AS n_samples, CAST(sum(is_fraud) AS BIGINT) AS n_fraud,
         CAST(CAST(sum(is_fraud) AS BIGINT) AS DOUBLE) * 100 / count(*) AS fraud_rate_pct
  FROM feats""",
    "class_weights": """
  SELECT is_fraud AS label, count(*) AS n_class,
         CAST((SELECT count(*) FROM feats) AS DOUBLE)
           / ((SELECT count(DISTINCT is_fraud) FROM feats) * count(*)) AS weight
  FROM feats GROUP BY is_fraud""",
    "score_defaults": """
  SELECT id, amount, currency_code, device_type, ip_country, status,
         CAST(0.0 AS DOUBLE) AS fraud_score, TIMESTAMP '2024-01-01 00:00:00' AS created_at
  FROM transactions""",
    "eval_auc": """
  SELECT CAST(sum(CAST(neg AS HUGEINT) * (2 * (tp - pos) + pos)) AS DOUBLE)
           / (CAST(2.0 AS DOUBLE) * sum(pos) * sum(neg)) AS roc_auc,
         CAST(CAST(sum(pos * tp / (tp + fp)) / sum(pos) AS DECIMAL(18,9)) AS DOUBLE) AS average_precision,
         CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
  FROM (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp,
               sum(neg) OVER (ORDER BY score DESC) AS fp
        FROM (SELECT score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
              FROM scored GROUP BY score) _h) _c""",
    "confusion_matrix": _CM,
    "classification_report": f"""
  SELECT cls AS class, p AS precision, r AS recall, support,
         CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f1
  FROM (SELECT cls, CASE WHEN pred_pos > 0 THEN CAST(tp AS DOUBLE) / pred_pos ELSE 0.0 END AS p,
               CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / support ELSE 0.0 END AS r,
               CAST(support AS BIGINT) AS support
        FROM (SELECT cls, sum(tp) AS tp, sum(pred_pos) AS pred_pos, sum(support) AS support
              FROM (SELECT label AS cls, n AS support, CASE WHEN label = prediction THEN n ELSE 0 END AS tp,
                           0 AS pred_pos FROM ({_CM}) _a
                    UNION ALL
                    SELECT prediction, 0, 0, n FROM ({_CM}) _b) _u
              GROUP BY cls) _g) _r""",
    "risk_bands": """
  SELECT CASE WHEN score > 0.7 THEN 'HIGH' WHEN score > 0.4 THEN 'MEDIUM'
              WHEN score IS NOT NULL THEN 'LOW' END AS risk_level, count(*) AS n
  FROM scored GROUP BY 1""",
})

# --- stored tables ------------------------------------------------------------------------

CTES["state"] = _fold()
_STATE_FACT = """(SELECT CAST(created_at AS DATE) AS date_key, merchant_id AS merchant_key, currency_code, amount, status,
             fraud_score > 0.7 AS is_fraud_suspected FROM state)"""

BODIES.update({
    "daily_volume_pruned": BODIES["daily_volume_by_status"],
    "refunds_to_reconcile_bucketed": BODIES["refunds_to_reconcile"],
    "snapshot_set": """
  SELECT 'transactions' AS table_name, count(*) AS n_rows FROM transactions
  UNION ALL SELECT 'customers', count(*) FROM customers UNION ALL SELECT 'merchants', count(*) FROM merchants""",
    "audit_two_snapshots": f"""
  SELECT 'transactions' AS table_name,
         CASE WHEN o.id IS NULL THEN 'INSERT' WHEN n.id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation,
         coalesce(n.id, o.id) AS record_id, 'nightly_export' AS changed_by, TIMESTAMP '2024-01-01 03:00:00' AS changed_at
  FROM ({_fold(f"WHERE _ts < {_CUTOFF}")}) o FULL OUTER JOIN ({_fold("WHERE id % 101 <> 0")}) n ON o.id = n.id
  WHERE o.id IS NULL OR n.id IS NULL OR
        ({', '.join('o.' + c for c in _CHANGE_COLS)}) IS DISTINCT FROM ({', '.join('n.' + c for c in _CHANGE_COLS)})""",
    "agg_incremental": AGG_DAILY.replace("FROM fact", f"FROM {_STATE_FACT} _s"),
    "agg_incremental_merchants": AGG_MERCHANT.replace("FROM fact f", f"FROM {_STATE_FACT} f"),
})
BODIES["star_replaced"] = """
  SELECT 'fact_transactions' AS table_name, count(*) AS n_rows, count(DISTINCT CAST(created_at AS DATE)) AS n_days
  FROM transactions WHERE created_at >= TIMESTAMP '1998-01-01 00:00:00'
  UNION ALL
  SELECT 'dim_time', count(DISTINCT CAST(created_at AS DATE)), count(DISTINCT CAST(created_at AS DATE))
  FROM transactions WHERE created_at >= TIMESTAMP '1998-01-01 00:00:00'
  UNION ALL
  SELECT 'agg_daily_revenue', count(DISTINCT (CAST(created_at AS DATE), currency_code)), count(DISTINCT CAST(created_at AS DATE))
  FROM transactions WHERE created_at >= TIMESTAMP '1998-01-01 00:00:00'"""

CTES["ref_currencies"] = f"""
  SELECT code, name FROM (SELECT DISTINCT currency_code AS code FROM transactions WHERE currency_code IS NOT NULL) _u
  LEFT JOIN (VALUES ('USD','US Dollar'), ('EUR','Euro'), ('GBP','British Pound'), ('JPY','Japanese Yen'), ('CHF','Swiss Franc')) v(code, name) USING (code)"""
CTES["ref_countries_used"] = f"""
  SELECT code, name, region FROM (SELECT DISTINCT ip_country AS code FROM transactions WHERE ip_country IS NOT NULL) _u
  LEFT JOIN (VALUES {_COUNTRY_VALUES}) v(code, name, region) USING (code)"""
CTES["ref_methods"] = """
  SELECT CAST(id AS SMALLINT) AS id, name FROM (SELECT DISTINCT payment_method_id AS id FROM transactions) _u
  LEFT JOIN (VALUES (1, 'card'), (2, 'bank_transfer'), (3, 'wallet')) v(id, name) USING (id)"""
CTES["audit_logs"] = f"""
  SELECT row_number() OVER () AS id, *, 'nightly_export' AS changed_by, TIMESTAMP '2024-01-01 03:00:00' AS changed_at
  FROM ({BODIES['audit_snapshot_diff']}) _a"""

_REF = {"currencies": "ref_currencies", "countries": "ref_countries_used", "payment_methods": "ref_methods", "audit_logs": "audit_logs"}
_REF_NOT_NULL = {"currencies": ["code", "name"], "countries": ["code", "name"], "payment_methods": ["id", "name"],
                 "audit_logs": ["id", "table_name", "operation", "record_id", "changed_at"]}
_REF_LENGTHS = {"currencies": {"code": 3, "name": 50}, "countries": {"code": 2, "name": 100, "region": 50}, "payment_methods": {"name": 50},
                "audit_logs": {"table_name": 50, "operation": 6, "changed_by": 50}}
_REF_KEYS = [("currencies", "code"), ("countries", "code"), ("payment_methods", "id"), ("payment_methods", "name"), ("audit_logs", "id")]


def _ref_rule(table: str, rule: str, checked: str, violated: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{rule}' AS rule, count({checked}) AS n_checked, "
            f"CAST(count_if({violated}) AS BIGINT) AS n_violations FROM {_REF[table]}")


BODIES.update({
    "dq_reference_tables": " UNION ALL ".join(
        [_ref_rule(t, f"not_null:{c}", "*", f"{c} IS NULL") for t, cs in _REF_NOT_NULL.items() for c in cs]
        + [_ref_rule(t, f"length:{c}", c, f"length({c}) > {n}") for t, cs in _REF_LENGTHS.items() for c, n in cs.items()]
        + [_ref_rule("audit_logs", "enum:operation", "operation", "operation NOT IN ('INSERT','UPDATE','DELETE')")]
        + [f"SELECT '{t}' AS table_name, 'unique:{k}' AS rule, CAST(coalesce(sum(c), 0) AS BIGINT) AS n_checked, "
           f"CAST(count_if(c > 1) AS BIGINT) AS n_violations FROM (SELECT {k}, count(*) AS c FROM {_REF[t]} WHERE {k} IS NOT NULL GROUP BY {k}) _k"
           for t, k in _REF_KEYS]),
    "raw_table_counts": BODIES["snapshot_set"],
    "typed_transactions": """
  SELECT id, customer_id, merchant_id, payment_method_id, currency_code, CAST(amount AS DECIMAL(12,2)) AS amount, status, device_type,
         ip_country, CAST(fraud_score AS DECIMAL(5,4)) AS fraud_score, created_at FROM transactions""",
    "insert_if_absent_email": """
  SELECT * FROM customers WHERE created_at < TIMESTAMP '2023-07-01 00:00:00'
  UNION ALL
  SELECT id + 1000000000, email_hash, country_code, created_at, updated_at
  FROM customers WHERE NOT (created_at < TIMESTAMP '2023-07-01 00:00:00')""",
    "seed_reference_tables": f"""
  SELECT 'currencies' AS table_name, code, name FROM ref_currencies WHERE code <> 'EUR'
  UNION ALL SELECT 'currencies', code, name FROM (VALUES ('USD','US Dollar'), ('EUR','Euro'), ('GBP','British Pound'),
    ('JPY','Japanese Yen'), ('CHF','Swiss Franc')) v(code, name) WHERE code NOT IN (SELECT code FROM ref_currencies WHERE code <> 'EUR')
  UNION ALL SELECT 'countries', code, name FROM ref_countries_used
  UNION ALL SELECT 'countries', code, name FROM (VALUES {_COUNTRY_VALUES}) v(code, name, region)
    WHERE code NOT IN (SELECT code FROM ref_countries_used)
  UNION ALL SELECT 'payment_methods', CAST(id AS VARCHAR), name FROM ref_methods
  UNION ALL SELECT 'payment_methods', CAST(id AS VARCHAR), name FROM (VALUES (1, 'card'), (2, 'bank_transfer'), (3, 'wallet')) v(id, name)
    WHERE id NOT IN (SELECT id FROM ref_methods)""",
    "batch_metrics": """
  SELECT count(*) AS n_messages, CAST(count_if(is_valid) AS BIGINT) AS n_valid, CAST(count_if(NOT is_valid) AS BIGINT) AS n_invalid,
         CAST(count_if(is_valid AND topic = 'transactions') AS BIGINT) AS n_transactions,
         CAST(count_if(is_valid AND topic = 'fraud_alerts') AS BIGINT) AS n_alerts FROM tx_events""",
    "stream_dedup": "SELECT id AS key, topic FROM tx_events",
    "amount_quantile_sketch": """
  SELECT merchant_id, count(*) AS n_rows, count(amount) AS n_values, true AS within_bound FROM transactions GROUP BY merchant_id""",
    "score_records_json": """
  SELECT CAST(id AS VARCHAR) AS transaction_id, amount, currency_code AS currency, score AS fraud_proba, score > 0.5 AS is_fraud,
         CASE WHEN score > 0.7 THEN 'HIGH' WHEN score > 0.4 THEN 'MEDIUM' WHEN score IS NOT NULL THEN 'LOW' END AS risk_level
  FROM (SELECT *, """ + _RULE_SCORE + """ AS score FROM transactions) _s""",
})
