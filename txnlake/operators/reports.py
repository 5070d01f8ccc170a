"""Monitoring and dashboard reports over Bronze, Silver, Gold and flags.

Each report is one aggregate (partial + final) or a top-k
(``TakeOrderedAndProject``). Shares of a total are computed against a scalar
subquery over the already-aggregated groups, so no window over the whole
table and no join is needed. Every ordered report ends with a unique key so the
output order (and any ``limit``) is deterministic.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quality import CRITICAL, rule_column
from .stats import attach_median

AS_OF_DAYS = 7


def _since(as_of: date | datetime | str, days: int) -> Column:
    return F.date_sub(F.to_date(F.lit(str(as_of)[:10])), days)


def mean_of_rounded(c: str, digits: int = 2) -> Column:
    """Exact mean of a column holding values rounded to ``digits`` decimals.

    The values are summed as integers (units of 10^-digits), so the sum does
    not depend on the order rows arrive in; one final division gives the
    correctly rounded mean, identical on every run and partitioning.
    """
    scale = 10**digits
    total = F.sum(F.round(F.col(c) * scale).cast("long"))
    return total / (F.count(c) * scale)


def exact_mean(c: str) -> Column:
    """Mean with an exact DECIMAL(38,18) sum and one final division.

    Decimal addition is exact, so the result does not depend on the order in
    which partitions are combined (a plain double ``avg`` does, in its last
    bits). Each double enters the sum by its shortest decimal form.
    """
    total = F.sum(F.col(c).cast("decimal(38,18)"))
    return total.cast("double") / F.count(c)


def _share(counts: DataFrame, count_col: str, digits: int = 1) -> DataFrame:
    total = counts.select(F.sum(count_col)).scalar()
    return counts.withColumn("pct", F.round(F.col(count_col) / total * 100, digits))


# --- Bronze --------------------------------------------------------------------


def bronze_range(bronze: DataFrame) -> DataFrame:
    """Event-time range of Bronze."""
    return bronze.agg(
        F.min("initiated_at").alias("min_initiated_at"),
        F.max("initiated_at").alias("max_initiated_at"),
    )


def value_counts(df: DataFrame, *cols: str, count_col: str = "txn_count") -> DataFrame:
    """Rows per value (or value combination), largest first."""
    return (
        df.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias(count_col))
        .orderBy(F.col(count_col).desc(), *[F.col(c).asc_nulls_first() for c in cols])
    )


def status_distribution(bronze: DataFrame) -> DataFrame:
    return value_counts(bronze, "status")


def channel_region(bronze: DataFrame) -> DataFrame:
    return value_counts(bronze, "channel", "region")


def value_share(df: DataFrame, col: str, digits: int = 1) -> DataFrame:
    """Rows per value with its percent of all rows."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("txn_count"))
    return _share(counts, "txn_count", digits).orderBy(
        F.col("txn_count").desc(), F.col(col).asc_nulls_first()
    )


def top_values(df: DataFrame, col: str, n: int = 5) -> DataFrame:
    """The ``n`` most frequent values with their share."""
    return value_share(df, col).limit(n)


def amount_stats(df: DataFrame) -> DataFrame:
    """Count, sum, mean, exact median, min and max of ``amount`` (one row)."""
    stats = df.agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.sum("amount").alias("total_volume"),
        F.avg("amount").alias("avg_amount"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
    )
    return attach_median(stats, df, [], "amount", "median_amount")


def batch_audit(bronze: DataFrame) -> DataFrame:
    """Distinct landing batches, oldest first."""
    return (
        bronze.select("_batch_id", "_ingested_at", "_source_file")
        .distinct()
        .orderBy("_ingested_at", "_batch_id", "_source_file")
    )


def duplicate_report(bronze: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Total rows, distinct ids and their difference, in one aggregate."""
    return bronze.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(F.col(key)).alias("unique_ids"),
    ).withColumn("duplicates", F.col("total_rows") - F.col("unique_ids"))


def bronze_sample(bronze: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` landed rows by transaction id and landing time."""
    return bronze.orderBy("transaction_id", "_ingested_at", "_batch_id").limit(n)


# --- Silver --------------------------------------------------------------------


def quality_report(silver: DataFrame) -> DataFrame:
    flag = F.col("_quality_flag")
    status = F.col("status")
    return silver.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(flag == "PASS").alias("passing"),
        F.count_if(flag == "FAIL").alias("failing"),
        F.count_if(status == "FAILED").alias("failed_txns"),
        F.count_if(status == "REVERSED").alias("reversed_txns"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        F.avg("amount").alias("avg_amount"),
        F.sum("amount").alias("total_volume_xof"),
        F.min("_date").alias("earliest_date"),
        F.max("_date").alias("latest_date"),
    )


def quality_failures(silver: DataFrame, rules: tuple[str, ...] = CRITICAL) -> DataFrame:
    """FAIL rows, their share of all rows, and FAIL rows per failing rule."""
    fail = F.col("_quality_flag") == "FAIL"
    return silver.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(fail).alias("failing"),
        F.round(F.try_divide(F.count_if(fail), F.count(F.lit(1))) * 100, 2).alias("fail_pct"),
        *[F.count_if(fail & ~F.col(rule_column(r))).alias(f"fail_{r}") for r in rules],
    )


def normalize_metrics(bronze_in: DataFrame, silver: DataFrame) -> DataFrame:
    """rows_read, rows_written, duplicates_removed, failures, pass rate.

    Both inputs are tagged and unioned so one aggregate counts both; the
    result is one row.
    """
    tagged = bronze_in.select(
        F.lit(1).alias("_read"), F.lit(0).alias("_written"), F.lit(0).alias("_fail")
    ).unionByName(
        silver.select(
            F.lit(0).alias("_read"),
            F.lit(1).alias("_written"),
            (F.col("_quality_flag") == "FAIL").cast("int").alias("_fail"),
        )
    )
    m = tagged.agg(
        F.sum("_read").cast("long").alias("rows_read"),
        F.sum("_written").cast("long").alias("rows_written"),
        F.sum("_fail").cast("long").alias("quality_failures"),
    )
    written = F.col("rows_written")
    failures = F.col("quality_failures")
    return m.select(
        "rows_read",
        "rows_written",
        (F.col("rows_read") - written).alias("duplicates_removed"),
        "quality_failures",
        failures.alias("rows_with_warnings"),
        F.when(written > 0, F.round((written - failures) / written * 100, 2))
        .otherwise(F.lit(0.0))
        .alias("quality_pass_rate"),
    )


def bucket_distribution(silver: DataFrame) -> DataFrame:
    return value_share(silver, "_amount_bucket")


def peak_offpeak(silver: DataFrame) -> DataFrame:
    return silver.groupBy("_is_peak_hour").agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.sum("amount").alias("total_volume_xof"),
        F.avg("amount").alias("avg_amount_xof"),
    )


SAMPLE_COLUMNS = (
    "transaction_id",
    "amount",
    "status",
    "_date",
    "_hour",
    "_day_of_week",
    "_is_weekend",
    "_is_peak_hour",
    "_amount_bucket",
    "_is_merchant_txn",
    "_processing_latency_seconds",
    "_quality_flag",
)


def silver_sample(silver: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows by transaction id, enriched columns only."""
    return silver.select(*SAMPLE_COLUMNS).orderBy("transaction_id").limit(n)


def failure_sample(silver: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` FAIL rows by transaction id."""
    return silver.filter(F.col("_quality_flag") == "FAIL").orderBy("transaction_id").limit(n)


# --- Gold ------------------------------------------------------------------------


def summary_last_days(
    daily: DataFrame, as_of: date | datetime | str, days: int = AS_OF_DAYS
) -> DataFrame:
    """Summary rows of the last ``days`` days, newest first."""
    return daily.filter(F.col("_date") >= _since(as_of, days)).orderBy(
        F.col("_date").desc(),
        "region",
        "channel",
        "_is_weekend",
        "_is_peak_hour",
    )


def kpi_last_days(
    daily: DataFrame, as_of: date | datetime | str, days: int = AS_OF_DAYS
) -> DataFrame:
    """One KPI row; means are unweighted means of the group values."""
    return daily.filter(F.col("_date") >= _since(as_of, days)).agg(
        F.sum("transaction_count").alias("total_txns"),
        F.sum("total_volume_xof").alias("total_volume"),
        mean_of_rounded("success_rate").alias("avg_success_rate"),
        F.sum("total_fees_xof").alias("total_fees"),
        exact_mean("avg_latency_seconds").alias("avg_latency"),
    )


def region_performance(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy("region")
        .agg(
            F.sum("transaction_count").alias("txn_count"),
            F.sum("total_volume_xof").alias("volume_xof"),
            mean_of_rounded("success_rate").alias("avg_success_pct"),
        )
        .orderBy(F.col("txn_count").desc(), F.col("region").asc_nulls_first())
    )


def top_merchants(merchant: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` merchants by volume; customers = sum of daily distinct counts."""
    return (
        merchant.groupBy("merchant_name", "merchant_category")
        .agg(
            F.sum("total_volume_xof").alias("total_volume"),
            F.sum("transaction_count").alias("txn_count"),
            exact_mean("avg_transaction_xof").alias("avg_txn"),
            F.sum("unique_customers").alias("customers"),
        )
        .orderBy(
            F.col("total_volume").desc(),
            F.col("merchant_name").asc_nulls_first(),
            F.col("merchant_category").asc_nulls_first(),
        )
        .limit(n)
    )


def dashboard_region(
    daily: DataFrame,
    as_of: date | datetime | str,
    days: int = AS_OF_DAYS,
    rounded: bool = False,
) -> DataFrame:
    """Volume by day and region over the last ``days`` days."""
    rate = mean_of_rounded("success_rate")
    return (
        daily.filter(F.col("_date") >= _since(as_of, days))
        .groupBy("_date", "region")
        .agg(
            F.sum("transaction_count").alias("txns"),
            F.sum("total_volume_xof").alias("volume_xof"),
            (F.round(rate, 1) if rounded else rate).alias("success_pct"),
        )
        .orderBy(F.col("_date").desc(), F.col("volume_xof").desc(), "region")
    )


# --- fraud flags -------------------------------------------------------------------


def flag_breakdown(flags: DataFrame) -> DataFrame:
    return value_counts(flags, "flag_pattern", count_col="flag_count")


def top_flags(flags: DataFrame, n: int = 50) -> DataFrame:
    return flags.orderBy(F.col("amount").desc(), "transaction_id").limit(n)


def velocity_detail(flags: DataFrame, n: int = 20) -> DataFrame:
    return (
        flags.filter(F.col("flag_pattern") == "VELOCITY_ANOMALY")
        .select("transaction_id", "sender_phone", "amount", "flag_detail_1", "region", "channel")
        .orderBy(F.col("flag_detail_1").cast("int").desc(), "transaction_id")
        .limit(n)
    )


def spike_detail(flags: DataFrame, n: int = 20) -> DataFrame:
    return (
        flags.filter(F.col("flag_pattern") == "AMOUNT_SPIKE")
        .select(
            "transaction_id", "sender_phone", "amount", "flag_detail_1", "flag_detail_2", "region"
        )
        .orderBy(F.col("amount").desc(), "transaction_id")
        .limit(n)
    )

