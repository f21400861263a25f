"""Declared types of the stored tables (fixed by the source schema); ids may be of any type."""

from __future__ import annotations

from pyspark.sql.types import StructType

_TABLES = {
    "currencies": "code string, name string",
    "countries": "code string, name string, region string",
    "payment_methods": "id smallint, name string",
    "customers": "id {id}, email_hash string, country_code string, created_at timestamp_ntz, updated_at timestamp_ntz",
    "merchants": "id {id}, name string, country_code string, category string, created_at timestamp_ntz",
    "transactions": "id {id}, customer_id {id}, merchant_id {id}, payment_method_id smallint, currency_code string, "
                    "amount decimal(12,2), status string, device_type string, ip_country string, "
                    "fraud_score decimal(5,4), created_at timestamp_ntz",
    "refunds": "id {id}, transaction_id {id}, amount decimal(12,2), reason string, created_at timestamp_ntz",
    "audit_logs": "id bigint, table_name string, operation string, record_id {id}, changed_by string, changed_at timestamp_ntz",
}


def schema(table: str, id_type: str = "string") -> StructType:
    return StructType.fromDDL(_TABLES[table].replace("{id}", id_type))
