"""Landing audit columns, high-water mark, incremental load, retention."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .events import BRONZE_COLUMNS

# Retention default and floor (days).
RETENTION_DAYS = 365
RETENTION_MIN_DAYS = 30


def land(
    records: DataFrame,
    ingested_at: datetime | str,
    batch_id: str,
    source_prefix: str = "payments-api/",
) -> DataFrame:
    """Add the audit columns and fix the Bronze column order.

    ``_ingested_at`` is one value for the whole batch; ``_source_file`` names
    the day file of each row's event date; ``_batch_id`` is given by the caller
    (a deterministic id keeps a re-run of the same batch idempotent).
    """
    out = records.withColumns(
        {
            "_ingested_at": F.lit(str(ingested_at)).cast("timestamp_ntz"),
            "_source_file": F.concat(
                F.lit(source_prefix), F.date_format("initiated_at", "yyyyMMdd"), F.lit(".json")
            ),
            "_batch_id": F.lit(batch_id),
        }
    )
    return out.select(*BRONZE_COLUMNS)


def high_water_mark(bronze: DataFrame, col: str = "initiated_at") -> DataFrame:
    """One row: the newest event time in Bronze (NULL when empty)."""
    return bronze.agg(F.max(col).alias("high_water_mark"))


def incremental(
    incoming: DataFrame,
    existing: DataFrame,
    key: str = "transaction_id",
    col: str = "initiated_at",
) -> DataFrame:
    """Rows of ``incoming`` after the mark of ``existing`` and not yet landed.

    The mark is a scalar subquery (one value, no driver round trip); the
    anti-join on the key makes a repeated or overlapping fetch idempotent.
    """
    mark = existing.select(F.max(col)).scalar()
    newer = incoming.filter(F.col(col) > F.coalesce(mark, F.lit("0001-01-01").cast(incoming.schema[col].dataType)))
    # no estimate of a stored table's keys is good enough to broadcast them
    return newer.join(existing.select(key).hint("merge"), key, "left_anti")


def not_yet_landed(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of ``incoming`` that ``existing`` does not hold: new ids, late ones, rows
    without a time or an id, and corrections of landed ids. Audit columns, which differ
    between deliveries, are not compared.

    The digests of all that is stored are sorted and merged, never broadcast: one column
    of a well compressed table is estimated far smaller than its rows are in memory."""
    columns = [c for c in incoming.columns if not c.startswith("_")]
    content = F.unhex(F.sha2(F.to_json(F.struct(*columns)), 256)).alias("_content")
    return incoming.withColumn("_content", content).join(
        existing.select(content).hint("merge"), "_content", "left_anti"
    ).drop("_content")


def retention_days(days: int) -> int:
    """``days``, if it is not below the floor."""
    if days < RETENTION_MIN_DAYS:
        raise ValueError(f"retention must be at least {RETENTION_MIN_DAYS} days")
    return days


def _cutoff(as_of: date | datetime | str, days: int) -> Column:
    return F.date_sub(F.to_date(F.lit(str(as_of)[:10])), retention_days(days))


def retention_keep(
    df: DataFrame, as_of: date | datetime | str, days: int = RETENTION_DAYS, col: str = "_date"
) -> DataFrame:
    """Rows inside the retention window (rows without a date are kept)."""
    c = F.col(col)
    return df.filter(c.isNull() | (c >= _cutoff(as_of, days)))


def retention_expired(
    df: DataFrame, as_of: date | datetime | str, days: int = RETENTION_DAYS, col: str = "_date"
) -> DataFrame:
    """Rows past the retention window (to be deleted)."""
    return df.filter(F.col(col) < _cutoff(as_of, days))


def staging_view(bronze: DataFrame) -> DataFrame:
    """Staging projection: phones renamed to tokens, payload dropped."""
    return bronze.withColumnsRenamed(
        {"sender_phone": "sender_token", "recipient_phone": "recipient_token"}
    ).drop("raw_payload")
