"""Silver -> Gold business aggregates.

Both marts are one ``groupBy().agg()``: Spark plans a partial (map-side)
aggregate before the shuffle, so a hot region or merchant is combined on every
map task first. The exact distinct count adds one more exchange keyed by
(group, value), which also spreads a hot group over many tasks. The exact
median keeps, per group, a map from distinct amount to count; ``approx=True``
switches to a fixed-size ``percentile_approx`` sketch (and
``approx_count_distinct``) for groups that are too large for that.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .silver import passing
from .stats import attach_median

DAILY_KEYS = ("_date", "region", "channel", "_is_weekend", "_is_peak_hour")
MERCHANT_KEYS = ("merchant_code", "merchant_name", "merchant_category", "_date")
MEDIAN = "median_transaction_xof"
DAILY_INPUTS = (
    "amount",
    "fee",
    "status",
    "merchant_code",
    "_is_merchant_txn",
    "_processing_latency_seconds",
)


def _count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def _pct(num: Column, den: Column) -> Column:
    return F.round(F.try_divide(num, den) * 100, 2)


def _distinct(c: str, approx: bool) -> Column:
    return F.approx_count_distinct(c) if approx else F.count_distinct(F.col(c))


def daily_summary(
    silver: DataFrame,
    rounded: bool = False,
    approx: bool = False,
    updated_at: datetime | str | None = None,
    median: str = "distributed",
    share: bool = False,
) -> DataFrame:
    """KPIs per (date, region, channel, weekend, peak hour) over PASS rows.

    ``rounded=True`` gives the SQL-model variant (mean to 2 dp, latency to
    1 dp). Ratios use ``try_divide`` so an empty denominator yields NULL.
    ``median``: ``"distributed"`` (exact, no group gathered in one task, see
    ``stats.grouped_median``), ``"builtin"`` (exact ``median``, one task per
    group at the final merge), ``"none"`` (no median column, for reports that do not
    ask for it) or ignored when ``approx`` (fixed-size sketch).
    ``share=True`` checkpoints the PASS rows once (pruned to the columns used)
    so the aggregate and the median branch do not both recompute Silver; use it
    when Silver is derived in the same plan rather than read from its table.
    """
    is_merchant = F.col("_is_merchant_txn")
    avg_amount = F.avg("amount")
    avg_latency = F.avg("_processing_latency_seconds")
    rows = passing(silver)
    if share and not approx and median == "distributed":
        rows = cut_lineage(rows.select(*DAILY_KEYS, *DAILY_INPUTS))
    inline_median = []
    if approx:
        inline_median = [F.percentile_approx("amount", 0.5, 10_000).cast("double").alias(MEDIAN)]
    elif median == "builtin":
        inline_median = [F.median("amount").alias(MEDIAN)]
    out = (
        rows.groupBy(*DAILY_KEYS)
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.sum("amount").alias("total_volume_xof"),
            (F.round(avg_amount, 2) if rounded else avg_amount).alias("avg_transaction_xof"),
            *inline_median,
            F.sum("fee").alias("total_fees_xof"),
            _count_if(is_merchant).alias("merchant_txn_count"),
            _count_if(F.col("status") == "FAILED").alias("failed_count"),
            _count_if(F.col("status") == "REVERSED").alias("reversed_count"),
            _distinct("merchant_code", approx).alias("unique_merchants"),
            F.sum(F.when(is_merchant, F.col("amount"))).alias("merchant_volume_xof"),
            (F.round(avg_latency, 1) if rounded else avg_latency).alias("avg_latency_seconds"),
        )
        .withColumns(
            {
                "success_rate": _pct(
                    F.col("transaction_count") - F.col("failed_count"), F.col("transaction_count")
                ),
                "merchant_share_pct": _pct(
                    F.col("merchant_txn_count"), F.col("transaction_count")
                ),
            }
        )
    )
    if not inline_median and median != "none":
        out = attach_median(out, rows, DAILY_KEYS, "amount", MEDIAN)
    if updated_at is not None:
        out = out.withColumn("_updated_at", F.lit(updated_at).cast("timestamp"))
    return out


def merchant_activity(
    silver: DataFrame,
    rounded: bool = False,
    approx: bool = False,
    updated_at: datetime | str | None = None,
) -> DataFrame:
    """Per merchant and day over PASS merchant rows."""
    avg_amount = F.avg("amount")
    out = (
        passing(silver)
        .filter(F.col("_is_merchant_txn"))
        .groupBy(*MERCHANT_KEYS)
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.sum("amount").alias("total_volume_xof"),
            (F.round(avg_amount, 2) if rounded else avg_amount).alias("avg_transaction_xof"),
            F.sum("fee").alias("total_fees_xof"),
            _distinct("sender_phone", approx).alias("unique_customers"),
            _count_if(F.col("status") == "FAILED").alias("failed_count"),
        )
        .withColumns(
            {
                "success_rate": _pct(
                    F.col("transaction_count") - F.col("failed_count"), F.col("transaction_count")
                ),
                "avg_txn_per_customer": F.round(
                    F.try_divide(F.col("transaction_count"), F.col("unique_customers")), 2
                ),
            }
        )
    )
    if updated_at is not None:
        out = out.withColumn("_updated_at", F.lit(updated_at).cast("timestamp"))
    return out
