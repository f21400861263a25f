"""Data-quality rules (the source schema's constraints, re-aimed as Spark checks).

Every check is one aggregation pass per table; results are long tables
``(table_name, rule/column, n_checked, n_violations)``.  Like SQL CHECK
constraints, a NULL value passes a value rule.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.functions import domains as D

# NOT NULL columns per table (source schema).
NOT_NULL = {
    "customers": ["id", "email_hash", "created_at", "updated_at"],
    "merchants": ["id", "name", "created_at"],
    "transactions": ["id", "customer_id", "merchant_id", "payment_method_id", "currency_code",
                     "amount", "status", "created_at"],
    "refunds": ["id", "transaction_id", "amount", "created_at"],
}

# Primary and unique keys.
UNIQUE_KEYS = [("customers", "id"), ("customers", "email_hash"), ("merchants", "id"),
               ("transactions", "id"), ("refunds", "id")]


# The same for the reference tables and the audit log: NOT NULL, keys, lengths, enums.
REFERENCE_NOT_NULL = {
    "currencies": ["code", "name"],
    "countries": ["code", "name"],
    "payment_methods": ["id", "name"],
    "audit_logs": ["id", "table_name", "operation", "record_id", "changed_at"],
}
REFERENCE_KEYS = [("currencies", "code"), ("countries", "code"), ("payment_methods", "id"), ("payment_methods", "name"),
                  ("audit_logs", "id")]
REFERENCE_LENGTHS = {
    "currencies": {"code": 3, "name": 50},
    "countries": {"code": 2, "name": 100, "region": 50},
    "payment_methods": {"name": 50},
    "audit_logs": {"table_name": 50, "operation": 6, "changed_by": 50},
}


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _long(df: DataFrame, table: str, counts: dict[str, Column], checked: dict[str, Column],
          label: str) -> DataFrame:
    """One aggregation over ``df``, unpivoted to ``(table_name, label, n_checked, n_violations)``."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for name in counts:
        aggs.append(counts[name].cast("bigint").alias(f"v__{name}"))
        aggs.append(checked[name].cast("bigint").alias(f"c__{name}"))
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(name).alias(label), F.col(f"c__{name}").alias("n_checked"),
                 F.col(f"v__{name}").alias("n_violations"))
        for name in counts]))
    return wide.select(F.lit(table).alias("table_name"), rows.alias("r")).select(
        "table_name", f"r.{label}", "r.n_checked", "r.n_violations")


def not_null(tables: dict[str, DataFrame], spec: dict[str, list[str]] = NOT_NULL) -> DataFrame:
    parts = []
    for t, cols in spec.items():
        df = tables[t]
        parts.append(_long(df, t,
                           {c: F.count_if(F.col(c).isNull()) for c in cols},
                           {c: F.count(F.lit(1)) for c in cols}, "column_name"))
    return _union(parts)


def _len_over(col: str, n: int) -> Column:
    return F.count_if(F.length(col) > n)


def _precision(col: str, p: int, s: int) -> Column:
    """Values that do not fit NUMERIC(p, s) exactly."""
    c = F.col(col)
    fitted = F.try_cast(c, f"decimal({p},{s})") if hasattr(F, "try_cast") else c.try_cast(f"decimal({p},{s})")
    return F.count_if(c.isNotNull() & (fitted.isNull() | (fitted.cast("double") != c)))


def value_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """CHECK, enum, range, length and precision rules."""
    tx, rf, cu, me = tables["transactions"], tables["refunds"], tables["customers"], tables["merchants"]
    nn = lambda c: F.count(c)  # noqa: E731  rows where the rule applies
    t_rules = {
        "amount_positive": (F.count_if(F.col("amount") <= 0), nn("amount")),
        "status_enum": (F.count_if(~F.col("status").isin(D.STATUSES)), nn("status")),
        "device_type_enum": (F.count_if(~F.col("device_type").isin(D.DEVICES)), nn("device_type")),
        "fraud_score_range": (F.count_if(~F.col("fraud_score").between(0, 1)), nn("fraud_score")),
        "currency_code_length": (_len_over("currency_code", 3), nn("currency_code")),
        "ip_country_length": (_len_over("ip_country", 2), nn("ip_country")),
        "amount_precision": (_precision("amount", 12, 2), nn("amount")),
        "fraud_score_precision": (_precision("fraud_score", 5, 4), nn("fraud_score")),
    }
    r_rules = {
        "amount_positive": (F.count_if(F.col("amount") <= 0), nn("amount")),
        "amount_precision": (_precision("amount", 12, 2), nn("amount")),
        "reason_length": (_len_over("reason", 100), nn("reason")),
    }
    c_rules = {
        "email_hash_length": (_len_over("email_hash", 64), nn("email_hash")),
        "country_code_length": (_len_over("country_code", 2), nn("country_code")),
    }
    m_rules = {
        "name_length": (_len_over("name", 100), nn("name")),
        "category_length": (_len_over("category", 50), nn("category")),
        "country_code_length": (_len_over("country_code", 2), nn("country_code")),
    }
    parts = []
    for t, df, rules in [("transactions", tx, t_rules), ("refunds", rf, r_rules),
                         ("customers", cu, c_rules), ("merchants", me, m_rules)]:
        parts.append(_long(df, t, {k: v[0] for k, v in rules.items()},
                           {k: v[1] for k, v in rules.items()}, "rule"))
    return _union(parts)


def reference_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Every rule of the reference tables and the audit log: ``(table_name, rule, n_checked, n_violations)``.

    One aggregation a table for its value rules and one a key; a table without rows checks nothing.
    """
    parts = [not_null(tables, REFERENCE_NOT_NULL).select(
        "table_name", F.concat(F.lit("not_null:"), F.col("column_name")).alias("rule"), "n_checked", "n_violations")]
    for t, lengths in REFERENCE_LENGTHS.items():
        rules = {f"length:{c}": (_len_over(c, n), F.count(c)) for c, n in lengths.items()}
        if t == "audit_logs":
            rules["enum:operation"] = (F.count_if(~F.col("operation").isin(D.AUDIT_OPERATIONS)), F.count("operation"))
        parts.append(_long(tables[t], t, {k: v[0] for k, v in rules.items()}, {k: v[1] for k, v in rules.items()}, "rule"))
    parts.append(unique_keys(tables, REFERENCE_KEYS).select(
        "table_name", F.concat(F.lit("unique:"), F.col("key_column")).alias("rule"), F.col("n_rows").alias("n_checked"),
        F.col("n_duplicated_keys").alias("n_violations")))
    return _union(parts)


def unique_keys(tables: dict[str, DataFrame], keys=UNIQUE_KEYS) -> DataFrame:
    """Per key: rows, distinct non-null keys, keys that occur more than once.

    ``groupBy(key).count`` aggregates map-side first, so a hot key is reduced
    to one row per partition before the shuffle.
    """
    parts = []
    for t, k in keys:
        per = tables[t].filter(F.col(k).isNotNull()).groupBy(k).agg(F.count(F.lit(1)).alias("c"))
        parts.append(per.agg(
            F.lit(t).alias("table_name"), F.lit(k).alias("key_column"),
            F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("n_rows"),
            F.count(F.lit(1)).alias("n_distinct"),
            F.count_if(F.col("c") > 1).alias("n_duplicated_keys")))
    return _union(parts)


def foreign_key(child: DataFrame, fk: str, parent: DataFrame, pk: str, name: str,
                parent_is_small: bool = False) -> DataFrame:
    """Rows whose non-null ``fk`` has no match in ``parent.pk``.

    The child is first reduced to ``(fk value, count)``, which collapses hot
    keys before any shuffle; the join then moves one row per distinct value.
    ``parent_is_small`` marks fixed reference tables (bounded size), the only
    case that is broadcast.
    """
    per = child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_k")).agg(F.count(F.lit(1)).alias("_c"))
    keys = parent.select(F.col(pk).alias("_pk")).distinct()
    if parent_is_small:
        keys = F.broadcast(keys)
    # one left join of (key, count) to the parent keys gives checked rows,
    # violating rows and missing keys in a single pass over the child
    j = per.join(keys, F.col("_k") == F.col("_pk"), "left")
    missing = F.col("_pk").isNull()
    return j.agg(
        F.lit(name).alias("constraint_name"),
        F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("n_checked"),
        F.coalesce(F.sum(F.when(missing, F.col("_c"))), F.lit(0)).cast("bigint").alias("n_violations"),
        F.count_if(missing).alias("n_missing_keys"))


def foreign_keys(tables: dict[str, DataFrame], refs: dict[str, DataFrame]) -> DataFrame:
    tx, cu, me, rf = tables["transactions"], tables["customers"], tables["merchants"], tables["refunds"]
    cur, ctry, pm = refs["currencies"], refs["countries"], refs["payment_methods"]
    return _union([
        foreign_key(tx, "customer_id", cu, "id", "transactions.customer_id -> customers"),
        foreign_key(tx, "merchant_id", me, "id", "transactions.merchant_id -> merchants"),
        foreign_key(tx, "payment_method_id", pm, "id", "transactions.payment_method_id -> payment_methods", True),
        foreign_key(tx, "currency_code", cur, "code", "transactions.currency_code -> currencies", True),
        foreign_key(tx, "ip_country", ctry, "code", "transactions.ip_country -> countries", True),
        foreign_key(cu, "country_code", ctry, "code", "customers.country_code -> countries", True),
        foreign_key(me, "country_code", ctry, "code", "merchants.country_code -> countries", True),
        foreign_key(rf, "transaction_id", tx, "id", "refunds.transaction_id -> transactions"),
    ])


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, table_name: str) -> DataFrame:
    """Audit rows from two snapshots: INSERT / UPDATE / DELETE per key.

    One ``full_outer`` join on the key; a row is UPDATE when any column
    differs under null-safe comparison.
    """
    cols = [c for c in new.columns if c != key]
    o = old.select(F.col(key).alias("_k"), F.struct(*cols).alias("_o"))
    n = new.select(F.col(key).alias("_k"), F.struct(*cols).alias("_n"))
    j = o.join(n, "_k", "full_outer")
    op = (F.when(F.col("_o").isNull(), "INSERT")
          .when(F.col("_n").isNull(), "DELETE")
          .when(~F.col("_o").eqNullSafe(F.col("_n")), "UPDATE"))
    return (j.select(F.lit(table_name).alias("table_name"), op.alias("operation"), F.col("_k").alias("record_id"))
            .filter(F.col("operation").isNotNull()))
