"""Declared schemas of the layers, and how a stored table's schema may grow.

A table's schema is declared here and kept beside its data (``_schema.json``). Writers
are held against it: a declared column must be there with its type, a new column is
added to the stored schema, a changed type is an error. Readers take the stored schema,
so no file footer is read or merged to find it, and files written before a column was
added give NULL for it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMA_FILE = "_schema.json"

_BRONZE = """
    transaction_id string, external_id string, transaction_type string, amount double,
    currency string, fee double, sender_phone string, recipient_phone string,
    merchant_code string, merchant_name string, merchant_category string, status string,
    failure_reason string, initiated_at timestamp_ntz, completed_at timestamp_ntz,
    channel string, agent_code string, region string, raw_payload string,
    _ingested_at timestamp_ntz, _source_file string, _batch_id string
"""
_SILVER = _BRONZE + """,
    _quality_amount_positive boolean, _quality_amount_reasonable boolean,
    _quality_currency_xof boolean, _quality_valid_status boolean,
    _quality_has_sender boolean, _quality_has_initiated_at boolean,
    _quality_fee_non_negative boolean, _quality_flag string, _date date, _hour int,
    _day_of_week int, _amount_bucket string, _is_weekend boolean, _is_peak_hour boolean,
    _is_merchant_txn boolean, _processing_latency_seconds bigint
"""
_DAILY = """
    _date date, region string, channel string, _is_weekend boolean, _is_peak_hour boolean,
    transaction_count bigint, total_volume_xof double, avg_transaction_xof double,
    median_transaction_xof double, total_fees_xof double, merchant_txn_count bigint,
    failed_count bigint, reversed_count bigint, unique_merchants bigint,
    merchant_volume_xof double, avg_latency_seconds double, success_rate double,
    merchant_share_pct double
"""
_MERCHANT = """
    merchant_code string, merchant_name string, merchant_category string, _date date,
    transaction_count bigint, total_volume_xof double, avg_transaction_xof double,
    total_fees_xof double, unique_customers bigint, failed_count bigint,
    success_rate double, avg_txn_per_customer double
"""
_FLAGS = """
    transaction_id string, sender_phone string, recipient_phone string, amount double,
    initiated_at timestamp_ntz, channel string, region string, flag_pattern string,
    flag_detail_1 string, flag_detail_2 double, _date date
"""
DECLARED = {
    "bronze": _BRONZE, "silver": _SILVER, "daily_summary": _DAILY,
    "merchant_activity": _MERCHANT, "fraud_flags": _FLAGS,
}


class SchemaMismatch(ValueError):
    """Rows that do not fit the table's schema."""


def _fit(have: T.StructType, want: T.StructType, table: str) -> None:
    types = {f.name: f.dataType for f in have}
    wrong = [
        f"{f.name}: {types[f.name].simpleString() if f.name in types else 'absent'}"
        f" instead of {f.dataType.simpleString()}"
        for f in want
        if types.get(f.name) != f.dataType
    ]
    if wrong:
        raise SchemaMismatch(f"{table}: " + "; ".join(wrong))


def require(df: DataFrame, layer: str) -> DataFrame:
    """``df`` itself, if it holds the layer's declared columns with their types. Other
    columns are allowed."""
    _fit(df.schema, T.StructType.fromDDL(DECLARED[layer]), layer)
    return df


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema kept beside a table; None for a table written without one."""
    from . import sinks

    text = sinks.read_text(spark, f"{path}/{SCHEMA_FILE}")
    return None if text is None else T.StructType.fromJson(json.loads(text))


def grow(spark: SparkSession, path: str, schema: T.StructType, partitions: list[str]) -> None:
    """Hold rows about to be written against the stored schema and add their new columns
    to it. Partition columns come last, as in a scan of the table."""
    from . import sinks

    old = stored_schema(spark, path)
    known = {} if old is None else {f.name: f for f in old}
    both = [f for f in schema if f.name in known]
    _fit(T.StructType(both), T.StructType([known[f.name] for f in both]), path)
    fields = {**known, **{f.name: T.StructField(f.name, f.dataType) for f in schema if f.name not in known}}
    names = [n for n in fields if n not in partitions] + partitions
    if old is None or set(fields) != set(known):
        new = T.StructType([T.StructField(n, fields[n].dataType) for n in names])
        sinks.write_text(spark, f"{path}/{SCHEMA_FILE}", new.json())
