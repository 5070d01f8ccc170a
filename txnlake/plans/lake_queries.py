"""Queries over stored layers: each builds a lake of its own from ``events`` in the
shared checkpoint folder, with the jobs, and returns what a table then holds. The jobs
run while the query is built."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..streaming.landing import process_batch
from . import catalog, jobs
from . import params as P

LANDED = ("transaction_id", "amount", "initiated_at", "_batch_id")


def _lake(spark: SparkSession) -> jobs.LakePaths:
    return jobs.LakePaths(scratch_path(spark, "lake"))


def _bronze(spark: SparkSession, paths: jobs.LakePaths) -> DataFrame:
    return jobs.bronze_days(spark, paths, None).select(*LANDED)


def landing_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after epoch 0 of two streams, the first of which was replayed."""
    paths = _lake(spark)
    body = catalog.api_pages(spark, sf_dir)
    for stream, half in (("a", 0), ("b", 1), ("a", 0)):
        batch = body.filter(F.col("page") % 2 == half)
        process_batch(batch, 0, paths, stream, P.SECRET, ingested_at=P.AS_OF)
    return _bronze(spark, paths)


def landing_one_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after two daily ingests under one batch id, and the first once more."""
    paths = _lake(spark)
    rows = catalog.bronze(spark, sf_dir).withColumn("_batch_id", F.lit("one"))
    for as_of in (P.SLICE_START, P.SLICE_END, P.SLICE_START):
        jobs.ingest_daily(spark, paths, rows, as_of, days_back=3)
    return _bronze(spark, paths)


def moved_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second deliveries of the first half of the span, fifteen days later than
    their first ones (rows without a time get one)."""
    second = catalog.bronze(spark, sf_dir).filter(F.col("_batch_id") == "batch-2")
    at = F.coalesce(F.col("initiated_at"), F.col("completed_at"), F.col("_ingested_at"))
    moved = second.withColumn("initiated_at", at + F.expr("INTERVAL 15 DAY"))
    return moved.filter(F.col("initiated_at") < F.lit(P.AS_OF).cast("timestamp_ntz"))


def landing_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after the first deliveries, and the second ones under the same batch id,
    which moves their rows to other days."""
    paths = _lake(spark)
    rows = catalog.bronze(spark, sf_dir).filter(F.col("_batch_id") == "batch-1")
    jobs.ingest_bronze(rows, paths)
    jobs.ingest_bronze(moved_rows(spark, sf_dir).withColumn("_batch_id", F.lit("batch-1")), paths)
    return _bronze(spark, paths)


def silver_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after all days were normalised, second deliveries moved rows to other days,
    and only the days they moved to were normalised again."""
    paths = _lake(spark)
    jobs.ingest_bronze(catalog.bronze(spark, sf_dir).filter(F.col("_batch_id") == "batch-1"), paths)
    jobs.normalize_job(spark, paths)
    jobs.ingest_bronze(moved_rows(spark, sf_dir), paths)
    jobs.normalize_job(spark, paths, P.DAY, P.AS_OF)
    return jobs.read_silver(spark, paths).select("transaction_id", "amount", "initiated_at", "_date")


def landing_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after the rows before a day and then, incrementally, all deliveries."""
    paths = _lake(spark)
    rows = catalog.bronze(spark, sf_dir)
    jobs.ingest_bronze(rows.filter(F.col("initiated_at") < F.lit(P.LANDED_UNTIL).cast("timestamp_ntz")), paths)
    jobs.ingest_incremental(spark, paths, rows, "increment-1")
    jobs.ingest_incremental(spark, paths, rows, "increment-2")  # lands nothing
    return _bronze(spark, paths)


def retained_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after retention was applied to all layers, twice."""
    paths = _lake(spark)
    jobs.ingest_bronze(catalog.bronze(spark, sf_dir), paths)
    jobs.normalize_job(spark, paths)
    for _ in range(2):
        jobs.apply_retention(spark, paths, P.RETENTION_AS_OF, P.RETENTION_DAYS)
    return jobs.read_silver(spark, paths).select("transaction_id", "amount", "_date")
