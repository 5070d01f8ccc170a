"""Stored-layer jobs: idempotent reruns, metrics, and the streaming landing."""

import tempfile

from pyspark.sql import functions as F

from txnlake.operators.silver import normalize
from txnlake.plans import catalog, jobs
from txnlake.plans.jobs import LakePaths
from txnlake.plans.page_fixture import api_pages
from txnlake.sources import pages
from txnlake.streaming.landing import start_landing

SF = "/root/testdata/sf0.001"


def _same(a, b, cols):
    return a.select(cols).exceptAll(b.select(cols)).count() == 0 and b.select(cols).exceptAll(a.select(cols)).count() == 0


def test_layers_and_rerun(spark):
    paths = LakePaths(tempfile.mkdtemp(prefix="lake-"))
    assert jobs.ingest_bronze(catalog.bronze(spark, SF), paths)["rows_written"] == 1020
    m = jobs.normalize_job(spark, paths)
    assert m["rows_read"] == m["rows_written"] + m["duplicates_removed"]
    assert (m["rows_written"], m["quality_failures"]) == (1000, 38)
    before = jobs.read_silver(spark, paths).count()
    # re-running two days replaces only those days
    jobs.normalize_job(spark, paths, "2024-01-10", "2024-01-12")
    silver = jobs.read_silver(spark, paths)
    assert silver.count() == before
    assert _same(silver.drop("_date"), catalog.silver(spark, SF).drop("_date"), ["transaction_id", "amount", "_quality_flag"])
    jobs.aggregate_job(spark, paths, "2024-01-31", 30)
    daily = spark.read.parquet(paths.gold_daily).drop("_updated_at")
    want = catalog.daily(spark, SF)
    assert _same(daily, want, sorted(want.columns))
    assert jobs.detect_job(spark, paths, "2024-01-15", velocity_threshold=3)["flags"] >= 0
    expired = jobs.retention_job(spark, paths, "2025-01-14")
    assert {r._date.isoformat() for r in expired.collect()} == {f"2024-01-{d:02d}" for d in range(1, 15)}


def test_stream_landing_equals_batch(spark):
    tmp = tempfile.mkdtemp(prefix="stream-")
    paths = LakePaths(tmp + "/lake")
    pg = catalog.api_pages(spark, SF)
    pg.filter("page % 2 = 0").select("body").write.text(tmp + "/src/a")
    start_landing(spark, tmp + "/src/*", paths, tmp + "/ckpt", tokenize=False).awaitTermination()
    pg.filter("page % 2 = 1").select("body").write.text(tmp + "/src/b")
    start_landing(spark, tmp + "/src/*", paths, tmp + "/ckpt", tokenize=False).awaitTermination()
    silver = spark.read.parquet(paths.silver)
    audit = {"_ingested_at": F.lit(None).cast("timestamp_ntz"), "_source_file": F.lit(""), "_batch_id": F.lit("")}
    expected = normalize(pages.flatten_pages(pg).withColumns(audit))
    cols = [c for c in expected.columns if c not in ("_ingested_at", "_source_file", "_batch_id")]
    # both deliveries of every 50th event arrive in one page, with one landing time
    once = "substr(transaction_id, 3) % 50 <> 0"
    assert _same(silver.filter(once), expected.filter(once), cols)
    assert _same(silver, expected, ["transaction_id"])


def test_run_day_and_named_tables(spark):
    from txnlake.plans.params import AS_OF

    paths = LakePaths(tempfile.mkdtemp(prefix="lake-"))
    out = jobs.run_day(spark, paths, catalog.bronze(spark, SF), "2024-01-16", days_back=2, velocity_threshold=3)
    assert out["ingest"]["rows_written"] == 1020
    assert out["normalize"]["rows_read"] == out["normalize"]["rows_written"] + out["normalize"]["duplicates_removed"]
    names = jobs.register_tables(spark, paths)
    assert "gold.daily_summary" in names and "silver.normalized_transactions" in names
    got = spark.sql(
        "SELECT _date, region, SUM(transaction_count) AS txns FROM gold.daily_summary "
        f"WHERE _date >= date_sub(DATE '{AS_OF}', 30) GROUP BY _date, region"
    )
    silver = spark.table("silver.normalized_transactions")
    assert got.agg(F.sum("txns")).first()[0] == silver.filter("_quality_flag = 'PASS'").count()


def test_check_job_stores_failures(spark):
    paths = LakePaths(tempfile.mkdtemp(prefix="lake-"))
    jobs.ingest_bronze(catalog.bronze(spark, SF), paths)
    jobs.normalize_job(spark, paths)
    jobs.aggregate_job(spark, paths, "2024-01-31", 30)
    got = jobs.check_job(spark, paths, "run-1")
    assert got["bronze_transaction_id_unique"] == 20  # re-delivered ids
    assert got["silver_transaction_id_unique"] == 0
    assert got["bronze_status_accepted"] > 0 and got["daily_success_rate_range"] == 0
    stored = spark.read.parquet(paths.root + "/checks")
    assert stored.filter("_check = 'bronze_transaction_id_unique'").count() == 20


def test_daily_entry_points(spark):
    paths = LakePaths(tempfile.mkdtemp(prefix="lake-"))
    rows = catalog.bronze(spark, SF)
    landed = jobs.ingest_daily(spark, paths, rows, "2024-01-16", days_back=1)
    want = rows.filter(
        "initiated_at IS NULL OR to_date(initiated_at) BETWEEN DATE '2024-01-15' AND DATE '2024-01-16'"
    ).count()
    assert landed["rows_written"] == want
    m = jobs.normalize_daily(spark, paths, "2024-01-16", days_back=1)
    assert m["rows_written"] == jobs.read_silver(spark, paths).count()
    days = {str(r._date) for r in jobs.read_silver(spark, paths).select("_date").distinct().collect()}
    assert days == {"2024-01-15", "None"}  # rows without a time are kept
    assert jobs.aggregate_daily(spark, paths, "2024-01-16")["daily_summary_rows"] > 0
    assert jobs.detect_daily(spark, paths, "2024-01-16", velocity_threshold=2)["flags"] >= 0


def test_stream_late_redelivery_corrects_old_days(spark):
    tmp = tempfile.mkdtemp(prefix="stream-late-")
    paths = LakePaths(tmp + "/lake")
    events = catalog.events(spark, SF)
    first = api_pages(events, 100)
    first.select("body").write.text(tmp + "/src/a")
    start_landing(spark, tmp + "/src/*", paths, tmp + "/ckpt", tokenize=False).awaitTermination()
    before = {r.transaction_id: r.amount for r in spark.read.parquet(paths.silver).collect()}

    late = api_pages(events.filter("event_id % 50 = 1").withColumn("value", F.col("value") + 1), 100)
    late.select("body").write.text(tmp + "/src/b")
    start_landing(spark, tmp + "/src/*", paths, tmp + "/ckpt", tokenize=False).awaitTermination()
    after = {r.transaction_id: r.amount for r in spark.read.parquet(paths.silver).collect()}

    changed = {k for k in after if after[k] != before.get(k)}
    late_ids = {r.transaction_id for r in pages.flatten_pages(late).collect()}
    assert set(after) == set(before)  # no new rows, only corrections
    assert changed == late_ids
    assert all(399 <= after[k] - before[k] <= 401 for k in changed)


def _delivery(spark, rows, batch):
    """Bronze rows (id, amount, time) on top of one row of the fixture."""
    base = catalog.bronze(spark, SF).limit(1)
    new = spark.createDataFrame(rows, "id string, paid double, at string").coalesce(1)
    return base.crossJoin(new).withColumns({
        "transaction_id": F.col("id"), "amount": F.col("paid"),
        "initiated_at": F.col("at").cast("timestamp_ntz"), "_batch_id": F.lit(batch),
        "_ingested_at": F.lit(f"2024-01-2{batch} 00:00:00").cast("timestamp_ntz"),
    }).select(base.columns)


def test_corrections_leave_no_old_rows(spark):
    paths = LakePaths(tempfile.mkdtemp(prefix="lake-"))
    first = _delivery(spark, [("A", 100.0, "2024-01-15 10:00:00"), ("B", 10.0, None),
                              ("C", 30.0, "2024-01-14 10:00:00")], "1")
    for _ in range(2):  # landing a batch again adds nothing
        jobs.ingest_bronze(first, paths)
    assert jobs.read_bronze(spark, paths).count() == 3
    jobs.normalize_job(spark, paths, "2024-01-15", "2024-01-16")
    jobs.normalize_job(spark, paths, "2024-01-14", "2024-01-15")
    jobs.ingest_bronze(_delivery(spark, [("A", 200.0, "2024-01-16 09:00:00"),
                                         ("B", 20.0, "2024-01-16 08:00:00")], "2"), paths)
    jobs.normalize_job(spark, paths, "2024-01-16", "2024-01-17")
    want = {("A", 200.0, "2024-01-16"), ("B", 20.0, "2024-01-16"), ("C", 30.0, "2024-01-14")}
    read = lambda: {
        (r.transaction_id, r.amount, str(r._date)) for r in jobs.read_silver(spark, paths).collect()
    }
    assert read() == want and jobs.read_silver(spark, paths).count() == 3
    jobs.normalize_job(spark, paths, "2024-01-15", "2024-01-16")  # an old day again
    assert read() == want and jobs.read_silver(spark, paths).count() == 3


def test_empty_results_replace_old_ones(spark):
    from txnlake.sources import sinks

    path = tempfile.mkdtemp(prefix="sink-") + "/t"
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, None)], "x int, d string")
    df = df.withColumn("d", F.col("d").cast("date"))
    sinks.overwrite_partitions(df, path, "d")
    chosen = lambda v: v in (None, "2024-01-01")
    sinks.overwrite_partitions(df.filter("x = 1"), path, "d", replaces=chosen)
    assert {r.x for r in spark.read.parquet(path).collect()} == {1, 2}
    sinks.overwrite_partitions(df.filter("x > 5"), path, "d", replaces=chosen)
    assert {r.x for r in spark.read.parquet(path).collect()} == {2}
    bad = spark.createDataFrame([("r",)], "row string")
    checks = path + "-checks"
    assert sinks.store_failures(bad, checks, "c", "run-1")["rows_written"] == 1
    assert sinks.store_failures(bad, checks, "c", "run-2")["rows_written"] == 1
    assert sinks.store_failures(bad.filter("row = 'x'"), checks, "c", "run-1")["rows_written"] == 0
    assert {r._run_id for r in spark.read.parquet(checks).collect()} == {"run-2"}
