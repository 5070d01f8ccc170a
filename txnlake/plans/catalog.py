"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each entry reads the driver's tables, derives Bronze and Silver with the
package operators, and returns the operator's result over the whole input.
Nothing is collected; the caller runs the plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import privacy
from ..functions.quality import TRANSACTION_TYPES, VALID_STATUSES, rule_column, rules
from ..operators import checks, fraud, gold, reports
from ..operators.silver import (
    dedup_latest,
    in_date_range,
    in_time_range,
    normalize,
    normalize_sql_model,
    with_quality,
)
from ..sources import lifecycle, pages
from ..sources.events import bronze_from_events, read_table, with_redelivery
from . import page_fixture, params as P

Query = Callable[[SparkSession, str], DataFrame]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_from_events(events(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(bronze(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_summary(silver(spark, sf_dir), share=True)


def recent_daily(spark: SparkSession, sf_dir: str, days: int | None = reports.AS_OF_DAYS) -> DataFrame:
    """The daily summary as dashboards need it: without the median, of the last days."""
    rows = silver(spark, sf_dir)
    if days is not None:
        rows = rows.filter(F.col("_date") >= F.date_sub(F.to_date(F.lit(P.AS_OF)), days))
    return gold.daily_summary(rows, median="none")


def merchant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.merchant_activity(silver(spark, sf_dir))


FRAUD_ARGS = dict(velocity_threshold=P.VELOCITY_THRESHOLD, rapid_minutes=P.RAPID_MINUTES)


def fraud_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PASS rows for the fraud patterns, checkpointed once (each pattern reads
    them on both sides of its join, or in two windows)."""
    return fraud.fraud_input(silver(spark, sf_dir))


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud.detect_all(silver(spark, sf_dir), None, **FRAUD_ARGS)


def api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_fixture.api_pages(events(spark, sf_dir), P.PAGE_SIZE)


def _phones(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = with_redelivery(events(spark, sf_dir))
    return raw.select("transaction_id", "_batch_id", "sender_phone", "recipient_phone")


def layer_rules():
    from . import jobs  # which imports the stored layers

    return jobs.layer_rules()


def _reg() -> dict[str, Query]:
    q: dict[str, Query] = {}
    # sources / landing
    q["bronze_land"] = bronze
    q["staging_view"] = lambda s, d: lifecycle.staging_view(bronze(s, d))
    q["flatten_pages"] = lambda s, d: pages.flatten_pages(api_pages(s, d))
    q["quarantine_pages"] = lambda s, d: pages.quarantine_pages(api_pages(s, d)).select(
        "page", "transaction_id", "reason", "raw_text"
    )
    q["payload_redacted"] = lambda s, d: pages.flatten_pages(api_pages(s, d), secret=P.SECRET).select(
        "transaction_id", "sender_phone", "recipient_phone", "raw_payload"
    )
    q["high_water_mark"] = lambda s, d: lifecycle.high_water_mark(bronze(s, d))
    q["incremental_batch"] = lambda s, d: lifecycle.incremental(
        bronze(s, d), in_time_range(bronze(s, d), None, P.LANDED_UNTIL)
    )
    q["retention_keep"] = lambda s, d: lifecycle.retention_keep(
        silver(s, d), P.RETENTION_AS_OF, P.RETENTION_DAYS
    )
    q["retention_expired"] = lambda s, d: lifecycle.retention_expired(
        silver(s, d), P.RETENTION_AS_OF, P.RETENTION_DAYS
    )
    # privacy
    q["phone_canonical"] = lambda s, d: _phones(s, d).select(
        "transaction_id", "_batch_id",
        privacy.phone_canonical("sender_phone").alias("sender_canonical"),
        privacy.phone_canonical("recipient_phone").alias("recipient_canonical"),
    )
    q["phone_prefix_check"] = lambda s, d: _phones(s, d).select(
        "transaction_id", "_batch_id",
        privacy.phone_known_prefix("sender_phone").alias("sender_known_prefix"),
        privacy.phone_known_prefix("recipient_phone").alias("recipient_known_prefix"),
    )
    q["tokenize_phones"] = lambda s, d: privacy.tokenize_phones(_phones(s, d), P.SECRET)
    q["mask_phones"] = lambda s, d: privacy.mask_phones(_phones(s, d)).select(
        "transaction_id", "_batch_id", "sender_phone_masked", "recipient_phone_masked"
    )
    # silver
    q["range_half_open"] = lambda s, d: in_time_range(bronze(s, d), P.SLICE_START, P.SLICE_END)
    q["dedup_latest"] = lambda s, d: dedup_latest(bronze(s, d))
    q["quality_rules"] = lambda s, d: with_quality(bronze(s, d)).select(
        "transaction_id", "_batch_id", *[rule_column(n) for n in rules()], "_quality_flag"
    )
    q["silver"] = silver
    q["silver_sql_model"] = lambda s, d: normalize_sql_model(lifecycle.staging_view(bronze(s, d)))
    q["enrich_time"] = lambda s, d: silver(s, d).select(
        "transaction_id", "_date", "_hour", "_day_of_week", "_is_weekend", "_is_peak_hour"
    )
    q["amount_bucket"] = lambda s, d: silver(s, d).select(
        "transaction_id", "amount", "_amount_bucket"
    )
    q["latency"] = lambda s, d: silver(s, d).select(
        "transaction_id", "initiated_at", "completed_at", "_processing_latency_seconds"
    )
    q["range_closed"] = lambda s, d: in_date_range(silver(s, d), P.SLICE_START, P.SLICE_END)
    q["quality_report"] = lambda s, d: reports.quality_report(silver(s, d))
    q["quality_failures"] = lambda s, d: reports.quality_failures(silver(s, d))
    q["normalize_metrics"] = lambda s, d: reports.normalize_metrics(bronze(s, d), silver(s, d))
    q["failure_sample"] = lambda s, d: reports.failure_sample(silver(s, d))
    q["silver_sample"] = lambda s, d: reports.silver_sample(silver(s, d))
    # gold
    q["daily_summary"] = daily
    q["daily_summary_rounded"] = lambda s, d: gold.daily_summary(
        silver(s, d), rounded=True, share=True
    )
    q["merchant_activity"] = merchant
    q["merchant_activity_rounded"] = lambda s, d: gold.merchant_activity(
        silver(s, d), rounded=True
    )
    # fraud
    q["sender_day_counts"] = lambda s, d: (
        fraud.day_slice(silver(s, d))
        .groupBy("sender_phone", "_date")
        .agg(F.count(F.lit(1)).alias("daily_txn_count"))
        .filter(F.col("daily_txn_count") > P.VELOCITY_THRESHOLD)
    )
    q["sender_recent_avg"] = lambda s, d: fraud.sender_mean(silver(s, d), since="2024-01-24")
    q["transfer_gaps"] = lambda s, d: fraud.transfer_gaps(fraud_rows(s, d)).select(
        "transaction_id",
        "sender_phone",
        "recipient_phone",
        "initiated_at",
        "prev_txn_time",
        "minutes_since_prev",
    )
    q["fraud_velocity"] = lambda s, d: fraud.velocity(fraud_rows(s, d), None, P.VELOCITY_THRESHOLD)
    q["fraud_velocity_day"] = lambda s, d: fraud.velocity(
        fraud.fraud_input(fraud.day_slice(silver(s, d), P.DAY)), P.DAY, 3
    )
    q["fraud_amount_spike"] = lambda s, d: fraud.amount_spike(fraud_rows(s, d), None, P.SPIKE_FACTOR)
    q["fraud_amount_spike_since"] = lambda s, d: fraud.amount_spike(
        fraud_rows(s, d), None, P.SPIKE_FACTOR, since=P.SLICE_START, upper=P.SLICE_END
    )
    q["rolling_spike"] = lambda s, d: fraud.rolling_spike(fraud_rows(s, d), P.SPIKE_FACTOR)
    q["fraud_rapid_transfer"] = lambda s, d: fraud.rapid_transfer(
        fraud_rows(s, d), None, P.RAPID_MINUTES
    )
    q["fraud_off_hours"] = lambda s, d: fraud.off_hours_large(
        silver(s, d), None, P.OFF_HOURS_AMOUNT
    )
    q["fraud_flags_all"] = lambda s, d: fraud.all_flags(silver(s, d), None, **FRAUD_ARGS)
    q["fraud_flags"] = flags
    q["fraud_flags_day"] = lambda s, d: fraud.detect_all(silver(s, d), P.DAY, **FRAUD_ARGS)
    # checks
    q["check_unique"] = lambda s, d: checks.violations_unique(bronze(s, d), "transaction_id")
    q["check_unique_silver"] = lambda s, d: checks.violations_unique(silver(s, d), "transaction_id")
    q["check_not_null"] = lambda s, d: checks.violations_not_null(
        bronze(s, d), ["transaction_id", "amount", "initiated_at"]
    ).select("transaction_id", "_batch_id", "amount", "initiated_at")
    q["check_accepted_values"] = lambda s, d: checks.violations_accepted(
        lifecycle.staging_view(bronze(s, d)), "status", VALID_STATUSES
    ).select("transaction_id", "_batch_id", "status")
    q["check_accepted_types"] = lambda s, d: checks.violations_accepted(
        lifecycle.staging_view(bronze(s, d)), "transaction_type", TRANSACTION_TYPES
    ).select("transaction_id", "_batch_id", "transaction_type")
    q["check_accepted_range"] = lambda s, d: checks.violations_range(
        bronze(s, d), "amount", 0, 50_000_000, inclusive=False
    ).select("transaction_id", "_batch_id", "amount")
    q["check_success_rate_range"] = lambda s, d: checks.violations_range(
        daily(s, d), "success_rate", 0, 100
    )
    q["check_at_least_one"] = lambda s, d: checks.at_least_one(daily(s, d), "transaction_count")
    q["check_rules_bronze"] = lambda s, d: checks.count_by_rule(bronze(s, d), layer_rules()["bronze"])
    q["check_rules_silver"] = lambda s, d: checks.count_by_rule(silver(s, d), layer_rules()["silver"])
    q["check_rules_daily"] = lambda s, d: checks.count_by_rule(
        gold.daily_summary(silver(s, d), median="none"), layer_rules()["daily"]
    )
    q["check_rules_merchant"] = lambda s, d: checks.count_by_rule(merchant(s, d), layer_rules()["merchant"])
    q["check_failures_bronze"] = lambda s, d: checks.failed_rules(
        bronze(s, d).select("transaction_id", "transaction_type", "status", "amount", "initiated_at", "_batch_id"),
        layer_rules()["bronze"],
    ).select("check", F.get_json_object("row", "$.transaction_id").alias("transaction_id"),
             F.get_json_object("row", "$._batch_id").alias("_batch_id"))
    # the same checks with rules that these data do break
    q["check_unique_sender_day"] = lambda s, d: checks.violations_unique(silver(s, d), ["sender_phone", "_date"])
    q["check_types_narrow"] = lambda s, d: checks.violations_accepted(
        bronze(s, d), "transaction_type", TRANSACTION_TYPES[:2]
    ).select("transaction_id", "_batch_id", "transaction_type")
    q["check_rate_narrow"] = lambda s, d: checks.violations_range(
        merchant(s, d), "success_rate", 50, 99
    ).select("merchant_code", "_date", "success_rate")
    q["check_reason_absent"] = lambda s, d: checks.at_least_one(
        silver(s, d).filter("status = 'SUCCESS'"), "failure_reason"
    )
    q["bronze_sample"] = lambda s, d: reports.bronze_sample(bronze(s, d))
    # reports
    q["bronze_range"] = lambda s, d: reports.bronze_range(bronze(s, d))
    q["status_distribution"] = lambda s, d: reports.status_distribution(bronze(s, d))
    q["channel_region"] = lambda s, d: reports.channel_region(bronze(s, d))
    q["type_distribution"] = lambda s, d: reports.value_counts(bronze(s, d), "transaction_type")
    q["channel_distribution"] = lambda s, d: reports.value_counts(bronze(s, d), "channel")
    q["region_distribution"] = lambda s, d: reports.value_counts(bronze(s, d), "region")
    q["amount_stats"] = lambda s, d: reports.amount_stats(bronze(s, d))
    q["type_share"] = lambda s, d: reports.value_share(bronze(s, d), "transaction_type")
    q["region_share"] = lambda s, d: reports.value_share(bronze(s, d), "region")
    q["top_regions"] = lambda s, d: reports.top_values(bronze(s, d), "region", 5)
    q["duplicate_report"] = lambda s, d: reports.duplicate_report(bronze(s, d))
    q["batch_audit"] = lambda s, d: reports.batch_audit(bronze(s, d))
    q["bucket_distribution"] = lambda s, d: reports.bucket_distribution(silver(s, d))
    q["peak_offpeak"] = lambda s, d: reports.peak_offpeak(silver(s, d))
    q["summary_last_7d"] = lambda s, d: reports.summary_last_days(
        gold.daily_summary(in_date_range(silver(s, d), P.LAST_DAYS_FROM, None), share=True), P.AS_OF
    )
    q["kpi_last_7d"] = lambda s, d: reports.kpi_last_days(recent_daily(s, d), P.AS_OF)
    q["region_performance"] = lambda s, d: reports.region_performance(recent_daily(s, d, None))
    q["dashboard_region_7d"] = lambda s, d: reports.dashboard_region(recent_daily(s, d), P.AS_OF)
    q["dashboard_region_7d_rounded"] = lambda s, d: reports.dashboard_region(
        recent_daily(s, d), P.AS_OF, rounded=True
    )
    q["top_merchants"] = lambda s, d: reports.top_merchants(merchant(s, d))
    q["flag_breakdown"] = lambda s, d: reports.flag_breakdown(flags(s, d))
    q["top_flags"] = lambda s, d: reports.top_flags(flags(s, d))
    q["velocity_detail"] = lambda s, d: reports.velocity_detail(flags(s, d))
    q["spike_detail"] = lambda s, d: reports.spike_detail(flags(s, d))
    return q


def queries() -> dict[str, Query]:
    from . import lake_queries as lake  # its jobs take their input from this module

    stored = (
        lake.landing_streams, lake.landing_one_batch, lake.landing_again, lake.silver_corrected,
        lake.landing_incremental, lake.retained_silver,
    )
    return _reg() | {f.__name__: f for f in stored}
