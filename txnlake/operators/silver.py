"""Bronze -> Silver: range slice, keep-latest dedup, quality rules, enrichment.

Plan shape (one job, one shuffle):

    scan(bronze, pushed range filter)
      -> WindowGroupLimit(partial, row_number <= 1)   # map-side, before the shuffle
      -> Exchange hashpartitioning(transaction_id)
      -> WindowGroupLimit(final) -> Window -> Filter(rn = 1)
      -> Project(quality booleans, flag, time / amount columns)

The partial WindowGroupLimit keeps at most one row per key and map task, so a
transaction id that is re-delivered millions of times is reduced before it
is shuffled; the final stage then sees one candidate per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quality import CRITICAL, RULE_SQL, rule_column

DEDUP_KEY = ("transaction_id",)
DEDUP_ORDER = ("_ingested_at", "_batch_id")

# Bucket upper bounds (exclusive) and peak hours (inclusive).
BUCKET_BOUNDS = (
    (1_000, "MICRO"),
    (5_000, "SMALL"),
    (20_000, "MEDIUM"),
    (100_000, "LARGE"),
)
TOP_BUCKET = "XLARGE"
PEAK_HOURS = ((9, 12), (15, 18))
WEEKEND_DAYS = (1, 7)  # dayofweek: 1 = Sunday, 7 = Saturday


def in_time_range(
    df: DataFrame,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    col: str = "initiated_at",
) -> DataFrame:
    """Half-open event-time slice ``start <= col < end``; either bound optional."""
    if start is not None:
        df = df.filter(F.col(col) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.filter(F.col(col) < F.lit(end).cast("timestamp_ntz"))
    return df


def dedup_latest(
    df: DataFrame,
    key: Sequence[str] = DEDUP_KEY,
    order: Sequence[str] = DEDUP_ORDER,
) -> DataFrame:
    """Keep the newest row per key.

    Ties on ``order`` (rows of one landing batch share ``_ingested_at``) are
    broken by ``_batch_id`` and finally by a hash of the whole row, so the
    survivor is the same on every run and every re-executed task.
    """
    row_hash = F.expr("xxhash64(" + ", ".join(f"`{c}`" for c in df.columns) + ")")
    w = Window.partitionBy(*key).orderBy(
        *[F.col(c).desc_nulls_last() for c in order], row_hash.desc()
    )
    return (
        df.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .drop("_rn")
    )


def quality_columns(
    rule_set: dict[str, Column] | None = None, critical: Sequence[str] = CRITICAL
) -> dict[str, Column]:
    """Rule booleans (NULL predicate -> False) and the PASS/FAIL flag."""
    if rule_set is None:
        out = {rule_column(n): F.expr(f"coalesce({sql}, false)") for n, sql in RULE_SQL.items()}
        passed = " AND ".join(f"coalesce({RULE_SQL[n]}, false)" for n in critical)
        out["_quality_flag"] = F.expr(f"CASE WHEN {passed} THEN 'PASS' ELSE 'FAIL' END")
        return out
    out = {rule_column(n): F.coalesce(p, F.lit(False)) for n, p in rule_set.items()}
    passed = None
    for name in critical:
        c = F.coalesce(rule_set[name], F.lit(False))
        passed = c if passed is None else passed & c
    out["_quality_flag"] = F.when(passed, "PASS").otherwise("FAIL")
    return out


def with_quality(
    df: DataFrame,
    rule_set: dict[str, Column] | None = None,
    critical: Sequence[str] = CRITICAL,
) -> DataFrame:
    return df.withColumns(quality_columns(rule_set, critical))


def amount_bucket(c: str = "amount") -> Column:
    arms = " ".join(f"WHEN {c} < {bound} THEN '{name}'" for bound, name in BUCKET_BOUNDS)
    return F.expr(f"CASE {arms} ELSE '{TOP_BUCKET}' END")


def enrich(df: DataFrame, null_flags_false: bool = False) -> DataFrame:
    """Time, amount and latency columns.

    A NULL time keeps NULL weekend / peak flags; ``null_flags_false=True``
    gives the SQL-model form, where they are FALSE.
    """
    peak = " OR ".join(f"hour(initiated_at) BETWEEN {lo} AND {hi}" for lo, hi in PEAK_HOURS)
    weekend = ", ".join(str(d) for d in WEEKEND_DAYS)
    if null_flags_false:
        peak = f"coalesce({peak}, false)"
        weekend_sql = f"coalesce(dayofweek(initiated_at) IN ({weekend}), false)"
    else:
        weekend_sql = f"dayofweek(initiated_at) IN ({weekend})"
    return df.withColumns(
        {
            "_date": F.expr("to_date(initiated_at)"),
            "_hour": F.expr("hour(initiated_at)"),
            "_day_of_week": F.expr("dayofweek(initiated_at)"),
            "_amount_bucket": amount_bucket("amount"),
            "_is_weekend": F.expr(weekend_sql),
            "_is_peak_hour": F.expr(f"({peak})"),
            "_is_merchant_txn": F.expr("merchant_code IS NOT NULL"),
            "_processing_latency_seconds": F.expr(
                "unix_timestamp(completed_at) - unix_timestamp(initiated_at)"
            ),
        }
    )


MONEY_DECIMAL = "decimal(18,2)"


def normalize(
    bronze: DataFrame,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    money_decimal: bool = False,
) -> DataFrame:
    """Full Silver frame (Bronze 22 + 7 rules + flag + 8 derived = 38 columns).

    ``money_decimal=True`` stores ``amount`` and ``fee`` as ``decimal(18,2)``
    so that sums of cent values are exact and independent of summation order
    (the source keeps them as doubles, which is the default here).
    """
    silver = enrich(with_quality(dedup_latest(in_time_range(bronze, start, end))))
    if money_decimal:
        silver = silver.withColumns(
            {c: F.col(c).cast(MONEY_DECIMAL) for c in ("amount", "fee")}
        )
    return silver


# Rules the SQL model keeps as columns (the flag still uses the critical three).
SQL_MODEL_RULES = ("amount_positive", "amount_reasonable", "valid_status", "has_initiated_at")


def normalize_sql_model(staging: DataFrame) -> DataFrame:
    """Silver as the SQL model builds it from the staging view (34 columns).

    Same dedup and flag; only four rule booleans; NULL times give FALSE
    weekend / peak flags.
    """
    rules_sql = {n: RULE_SQL[n] for n in SQL_MODEL_RULES}
    quality = {rule_column(n): F.expr(f"coalesce({sql}, false)") for n, sql in rules_sql.items()}
    passed = " AND ".join(f"coalesce({RULE_SQL[n]}, false)" for n in CRITICAL)
    quality["_quality_flag"] = F.expr(f"CASE WHEN {passed} THEN 'PASS' ELSE 'FAIL' END")
    return enrich(dedup_latest(staging).withColumns(quality), null_flags_false=True)


def in_date_range(
    df: DataFrame,
    start: date | datetime | str | None = None,
    end: date | datetime | str | None = None,
    col: str = "_date",
) -> DataFrame:
    """Closed date slice ``start <= _date <= end`` on the partition column."""
    if start is not None:
        df = df.filter(F.col(col) >= F.to_date(F.lit(str(start)[:10])))
    if end is not None:
        df = df.filter(F.col(col) <= F.to_date(F.lit(str(end)[:10])))
    return df


def passing(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_quality_flag") == "PASS")
