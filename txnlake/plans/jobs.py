"""Batch jobs over stored layers: ingest -> normalise -> aggregate -> detect.

Each job reads a table (with partition pruning), runs the package operators,
writes with the sinks, and returns its metrics from observations on the same
pass. Layers live under one root folder, which on a cluster is a shared file
system path:

    <root>/bronze/raw_transactions        partitioned by _event_date and landing attempt
    <root>/silver/normalized_transactions  partitioned by _date
    <root>/gold/daily_summary              partitioned by _date
    <root>/gold/merchant_activity          partitioned by _date
    <root>/gold/fraud_flags                partitioned by _date
    <root>/quarantine/pages                rejected API elements
    <root>/landings                        log of landings (``sources.landings``)
    <root>/index                           days of the landed ids (``sources.day_index``)
    <root>/staged/<landing>                rows of a landing in progress, computed once

Re-running a job for the same dates replaces exactly those partitions, those left
without rows included; landing the same delivery again replaces its rows key by key.
So jobs are idempotent and a lost run can simply be repeated.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.quality import AMOUNT_BUCKETS, QUALITY_FLAGS, TRANSACTION_TYPES, VALID_STATUSES
from ..operators import checks, fraud, gold
from ..operators.silver import in_date_range, in_time_range, normalize
from ..sources import day_index, landings, lifecycle, pages, schemas, sinks
from ..sources.landings import ATTEMPT_PART

EVENT_DATE = day_index.DAY


@dataclass(frozen=True)
class LakePaths:
    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self._p("bronze", "raw_transactions")

    @property
    def silver(self) -> str:
        return self._p("silver", "normalized_transactions")

    @property
    def gold_daily(self) -> str:
        return self._p("gold", "daily_summary")

    @property
    def gold_merchant(self) -> str:
        return self._p("gold", "merchant_activity")

    @property
    def flags(self) -> str:
        return self._p("gold", "fraud_flags")

    @property
    def quarantine(self) -> str:
        return self._p("quarantine", "pages")

    @property
    def landings(self) -> str:
        return self._p("landings")

    @property
    def index(self) -> str:
        return self._p("index")

    def staged(self, landing: str) -> str:
        return self._p("staged", landings.file_name(landing))


def _day(d: date | datetime | str) -> str:
    return str(d)[:10]


def _row_key(columns: list[str]) -> Column:
    """What identifies a delivered row: its id, or where that is NULL its own content."""
    content = F.sha2(F.to_json(F.struct(*[c for c in columns if not c.startswith("_")])), 256)
    return F.coalesce(F.concat(F.lit("id:"), "transaction_id"), F.concat(F.lit("row:"), content))


def ingest_bronze(bronze_rows: DataFrame, paths: LakePaths, landing: str | Column | None = None) -> dict:
    """Append rows to Bronze under their landing: what ``landing`` names, by default each
    row's batch. Landing the same again replaces its rows by id and loses none; other
    landings are never touched (``sources.landings``)."""
    if landing is None:
        landing = F.coalesce(F.col("_batch_id").cast("string"), F.lit(""))
    elif isinstance(landing, str):
        landing = F.lit(landing)
    dated = schemas.require(bronze_rows, "bronze").withColumn(EVENT_DATE, F.to_date("initiated_at"))

    def enter(rows: DataFrame, parts: dict[str, str]) -> None:
        day_index.note_landing(rows, paths.index, "+".join(sorted(parts.values())))

    return landings.publish(
        dated, paths.bronze, f"{paths.landings}/bronze", landing, EVENT_DATE,
        _row_key(bronze_rows.columns), before=enter,
    )


def quarantine(rejected: DataFrame, paths: LakePaths, landing: str) -> dict:
    """Keep rejected page elements (with ``_batch_id``) under their landing."""
    content = [c for c in rejected.columns if c != "_batch_id"]
    key = F.sha2(F.to_json(F.struct(*content)), 256)
    return landings.publish(
        rejected, paths.quarantine, f"{paths.landings}/quarantine", F.lit(landing), "_batch_id", key
    )


def ingest_pages(
    api_pages: DataFrame,
    paths: LakePaths,
    ingested_at: datetime | str,
    batch_id: str,
    secret: str | bytes | None = None,
    body_col: str = "body",
    landing: str | None = None,
    tokenize: bool = True,
) -> dict:
    """Flatten API pages, land good rows in Bronze, keep rejected ones. Phones are
    tokenised with ``secret`` unless ``tokenize`` is turned off. Pages are parsed once;
    ``event_days`` of the metrics are the days of the good rows."""
    landing = landing or batch_id
    split = pages.split_pages(api_pages, body_col, pages.token_secret(secret, tokenize))
    with sinks.staged(split, paths.staged(landing)) as stored:
        landed = lifecycle.land(pages.good_rows(stored), ingested_at, batch_id)
        metrics = ingest_bronze(landed, paths, landing)
        rejected = pages.rejected_rows(stored).withColumn("_batch_id", F.lit(batch_id))
        metrics["rows_quarantined"] = quarantine(rejected, paths, landing)["rows_written"]
        day = F.to_date("initiated_at").alias(EVENT_DATE)
        metrics["event_days"] = [r[EVENT_DATE] for r in landed.select(day).distinct().collect()]
    return metrics


def bronze_table(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """All of Bronze with its partition columns, without attempts that do not count."""
    return landings.visible(spark, paths.bronze, f"{paths.landings}/bronze")


def bronze_days(spark: SparkSession, paths: LakePaths, days: list | None) -> DataFrame:
    """Bronze rows of the given event days (None in the list: rows without an
    event time; no list: all). The days are a static partition filter."""
    df = bronze_table(spark, paths)
    if days is not None:
        df = df.filter(day_index.on_days(EVENT_DATE, days))
    return df.drop(EVENT_DATE, ATTEMPT_PART)


def read_bronze(
    spark: SparkSession,
    paths: LakePaths,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
) -> DataFrame:
    """Bronze rows with ``start <= initiated_at < end`` (event-date partitions pruned)."""
    df = bronze_table(spark, paths)
    if start is not None:
        df = df.filter(F.col(EVENT_DATE) >= F.to_date(F.lit(_day(start))))
    if end is not None:
        df = df.filter(F.col(EVENT_DATE) <= F.to_date(F.lit(_day(end))))
    return in_time_range(df, start, end).drop(EVENT_DATE, ATTEMPT_PART)


def affected_days(spark: SparkSession, paths: LakePaths, days: list) -> list:
    """``days`` and the days that unsettled corrections connect with them: a correction
    may move a transaction to another day (or give it its first time), and its old
    Silver day must be written again, or the id would be in two. Read from the files
    of ``sources.day_index``, no table is scanned."""
    noted = day_index.unsettled(spark, paths.index)
    pairs = [p for found in noted.values() for p in found]
    texts = day_index.days_to_write(pairs, [None if d is None else str(d) for d in days])
    return [None if d is None else date.fromisoformat(d) for d in sorted(texts, key=str)]


def moved_rows(spark: SparkSession, paths: LakePaths, days: list) -> DataFrame | None:
    """Bronze rows on other days than ``days`` of ids that are also on these days: only
    the days that hold such ids are read."""
    ids = day_index.moved(spark, paths.index, days).select("transaction_id", "other")
    others = {r["other"] for r in ids.select("other").distinct().collect()} - set(days)
    if not others:
        return None
    ids = ids.select("transaction_id").distinct()
    return bronze_days(spark, paths, list(others)).join(ids.hint("merge"), "transaction_id", "left_semi")


def _range_days(spark: SparkSession, paths: LakePaths, start, end) -> list:
    """Whole event days of Bronze or Silver in ``[start, end)``."""
    first = _day(start) if start is not None else ""
    last = str(end).replace("T", " ") if end is not None else "~"  # a midnight bound leaves its day out
    chosen = lambda v: v is not None and first <= v and v + " 00:00:00" < last
    names = [
        folder.rsplit("=", 1)[1]
        for path, column in ((paths.bronze, EVENT_DATE), (paths.silver, "_date"))
        for folder in sinks.partition_folders(spark, path, column, chosen)
    ]
    return [date.fromisoformat(n) for n in sorted(set(names))]


def normalize_days(
    spark: SparkSession, paths: LakePaths, days: list | None, observed: Observation | None = None
) -> dict:
    """Write the Silver days again that the given event days of Bronze affect
    (no list: all)."""
    noted = day_index.unsettled(spark, paths.index)
    if days is not None:
        days = affected_days(spark, paths, days)
    bronze = bronze_days(spark, paths, days)
    if observed is not None:
        bronze = bronze.observe(observed, F.count(F.lit(1)).alias("rows_read"))
    elsewhere = moved_rows(spark, paths, days) if days is not None else None
    if elsewhere is None:
        silver = normalize(bronze)
    else:
        silver = normalize(bronze.unionByName(elsewhere)).filter(day_index.on_days("_date", days))
    names = None if days is None else {None if d is None else str(d) for d in days}
    metrics = sinks.overwrite_partitions(
        schemas.require(silver, "silver"),
        paths.silver,
        "_date",
        metrics={"quality_failures": F.count_if(F.col("_quality_flag") == "FAIL")},
        replaces=lambda v: names is None or v in names,
    )
    day_index.settle(spark, paths.index, noted, names)
    return metrics


def normalize_job(
    spark: SparkSession,
    paths: LakePaths,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
) -> dict:
    """Bronze range -> Silver date partitions; metrics from one pass.

    Whole days are written: those of the range, the rows without a time, and the
    days from which a correction takes a transaction away."""
    read_obs = Observation("bronze_read")
    days = None if start is None and end is None else _range_days(spark, paths, start, end)
    m = normalize_days(spark, paths, days, read_obs)
    try:
        rows_read = read_obs.get["rows_read"]
    except Exception:
        if m["rows_written"]:
            raise
        rows_read = 0
    written, failures = m["rows_written"], m["quality_failures"]
    return {
        "rows_read": rows_read,
        "rows_written": written,
        "duplicates_removed": rows_read - written,
        "quality_failures": failures,
        "rows_with_warnings": failures,
        "quality_pass_rate": round((written - failures) / written * 100, 2) if written else 0,
    }


def read_silver(
    spark: SparkSession,
    paths: LakePaths,
    start: date | datetime | str | None = None,
    end: date | datetime | str | None = None,
) -> DataFrame:
    return in_date_range(sinks.read_table(spark, paths.silver), start, end)


def aggregate_job(
    spark: SparkSession,
    paths: LakePaths,
    as_of: date | datetime | str,
    days_back: int = 30,
    rounded: bool = False,
) -> dict:
    """Rebuild the Gold marts for ``[as_of - days_back, as_of]``."""
    end = datetime.fromisoformat(_day(as_of))
    start = end - timedelta(days=days_back)
    silver = read_silver(spark, paths, start, end)
    inside = lambda v: v is not None and _day(start) <= v <= _day(end)
    daily = sinks.overwrite_partitions(
        schemas.require(gold.daily_summary(silver, rounded=rounded, updated_at=as_of), "daily_summary"), paths.gold_daily,
        replaces=inside,
    )
    merchant = sinks.overwrite_partitions(
        schemas.require(gold.merchant_activity(silver, rounded=rounded, updated_at=as_of), "merchant_activity"), paths.gold_merchant,
        replaces=inside,
    )
    return {
        "daily_summary_rows": daily["rows_written"],
        "merchant_activity_rows": merchant["rows_written"],
    }


def detect_job(
    spark: SparkSession,
    paths: LakePaths,
    day: date | datetime | str,
    detected_at: datetime | str | None = None,
    **thresholds,
) -> dict:
    """Flag one day's transactions and store them under that day. Only the partitions of
    the day and of the spike history, seven days by default, are read."""
    silver = sinks.read_table(spark, paths.silver)
    flags = fraud.detect_all(
        silver, day, detected_at=detected_at or day, share=False, **thresholds
    ).withColumn("_date", F.to_date("initiated_at"))
    m = sinks.overwrite_partitions(schemas.require(flags, "fraud_flags"), paths.flags, "_date", replaces=_day(day).__eq__)
    return {"flags": m["rows_written"]}


def retention_job(
    spark: SparkSession,
    paths: LakePaths,
    as_of: date | datetime | str,
    days: int = lifecycle.RETENTION_DAYS,
) -> DataFrame:
    """Expired Silver date partitions (to drop), as a frame of dates."""
    silver = sinks.read_table(spark, paths.silver)
    return lifecycle.retention_expired(silver, as_of, days).select("_date").distinct()


def apply_retention(
    spark: SparkSession,
    paths: LakePaths,
    as_of: date | datetime | str,
    days: int = lifecycle.RETENTION_DAYS,
) -> dict[str, list[str]]:
    """Delete what is older than ``days`` before ``as_of`` from every layer and from the
    day index. Partitions without a date stay. What was deleted is kept under
    ``<root>/retention``; a rerun finds nothing more and changes no record."""
    cutoff = date.fromisoformat(_day(as_of)) - timedelta(days=lifecycle.retention_days(days))
    old = lambda v: v is not None and v < str(cutoff)
    tables = {
        "bronze": (paths.bronze, EVENT_DATE), "silver": (paths.silver, "_date"),
        "daily_summary": (paths.gold_daily, "_date"), "merchant_activity": (paths.gold_merchant, "_date"),
        "fraud_flags": (paths.flags, "_date"), "moved": (f"{paths.index}/moved", EVENT_DATE),
    }
    gone = {
        name: sorted({f.rsplit("=", 1)[1] for f in sinks.drop_partitions(spark, path, column, old)})
        for name, (path, column) in tables.items()
    }
    gone = {name: found for name, found in gone.items() if found}
    if gone:
        day_index.forget_before(spark, paths.index, cutoff)
        record = f"{paths._p('retention')}/{_day(as_of)}.json"
        earlier = json.loads(sinks.read_text(spark, record) or "{}")
        both = {k: sorted({*earlier.get(k, []), *gone.get(k, [])}) for k in {*earlier, *gone}}
        sinks.write_text(spark, record, json.dumps(both, sort_keys=True))
    return gone


def high_water_mark(spark: SparkSession, paths: LakePaths) -> datetime | None:
    """The newest event time in Bronze, from the newest day folder that holds rows."""
    days = {
        f.rsplit("=", 1)[1]
        for f in sinks.partition_folders(spark, paths.bronze, EVENT_DATE, lambda v: v is not None)
    }
    for newest in sorted(days, reverse=True):
        rows = bronze_days(spark, paths, [date.fromisoformat(newest)])
        mark = lifecycle.high_water_mark(rows).first()["high_water_mark"]
        if mark is not None:
            return mark
    return None


def ingest_incremental(spark: SparkSession, paths: LakePaths, rows: DataFrame, landing: str) -> dict:
    """Land the rows of a fetch that Bronze does not hold yet: new ones, and also late
    rows, rows without a time and corrections, which a high-water mark would skip. Only
    the day folders that the fetch touches are compared, and only once."""
    if not sinks.exists(spark, paths.bronze):
        return ingest_bronze(rows, paths, landing)
    day = F.to_date("initiated_at").alias(EVENT_DATE)
    days = [r[EVENT_DATE] for r in rows.select(day).distinct().collect()]
    fresh = lifecycle.not_yet_landed(rows, bronze_days(spark, paths, days))
    with sinks.staged(fresh, paths.staged(landing)) as stored:
        return ingest_bronze(stored, paths, landing)


LAYER_COMMENTS = {
    "bronze": "Transactions as delivered, with audit columns; rows are only added",
    "silver": "One row per transaction with typed columns and quality flags",
    "gold": "Daily and merchant summaries, and fraud flags",
}


def register_tables(spark: SparkSession, paths: LakePaths) -> list[str]:
    """Create the three layer schemas and name the stored tables in them.

    Schemas are one-part names (``bronze``, ``silver``, ``gold``) located in the
    lake root; every table is an external parquet table over its folder, so
    ``spark.table("gold.daily_summary")`` and plain SQL work on the layers.
    Returns the names that were registered (tables not written yet are skipped).
    """
    for schema, comment in LAYER_COMMENTS.items():
        location = paths._p(schema)
        spark.sql(
            f"CREATE SCHEMA IF NOT EXISTS {schema} COMMENT '{comment}' LOCATION '{location}'"
        )
    tables = {
        "bronze.raw_transactions": paths.bronze,
        "silver.normalized_transactions": paths.silver,
        "gold.daily_summary": paths.gold_daily,
        "gold.merchant_activity": paths.gold_merchant,
        "gold.fraud_flags": paths.flags,
    }
    done = []
    for name, path in tables.items():
        try:
            spark.read.parquet(path).schema  # noqa: B018 - fails when nothing is written yet
        except AnalysisException:
            continue
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
        # partitions written after the table was created become visible here
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        spark.catalog.refreshTable(name)
        done.append(name)
    return done


def run_day(
    spark: SparkSession,
    paths: LakePaths,
    landed: DataFrame,
    as_of: date | datetime | str,
    days_back: int = 1,
    gold_days: int = 30,
    **thresholds,
) -> dict:
    """One scheduled run: land, normalise the last ``days_back`` days, rebuild
    Gold for ``gold_days`` and flag the day before ``as_of``."""
    end = datetime.fromisoformat(_day(as_of))
    start = end - timedelta(days=days_back)
    out = {"ingest": ingest_bronze(landed, paths)}
    out["normalize"] = normalize_job(spark, paths, start, end)
    out["aggregate"] = aggregate_job(spark, paths, as_of, gold_days)
    out["detect"] = detect_job(spark, paths, end - timedelta(days=1), **thresholds)
    return out


def layer_rules() -> dict[str, dict[str, Column]]:
    """The row rules of each layer: a condition that is true for a row that breaks it."""
    accepted = {
        "status": VALID_STATUSES, "transaction_type": TRANSACTION_TYPES,
        "_quality_flag": QUALITY_FLAGS, "_amount_bucket": AMOUNT_BUCKETS,
    }
    bronze_columns = ("transaction_id", "transaction_type", "status", "amount", "initiated_at")
    return {
        "bronze": {
            **{f"bronze_{c}_not_null": checks.not_null(c) for c in bronze_columns},
            "bronze_amount_range": checks.outside("amount", 0, 50_000_000, inclusive=False),
            "bronze_status_accepted": checks.not_accepted("status", accepted["status"]),
            "bronze_type_accepted": checks.not_accepted("transaction_type", accepted["transaction_type"]),
        },
        "silver": {
            **{f"silver_{c.strip('_')}_not_null": checks.not_null(c)
               for c in ("transaction_id", "_quality_flag", "_date")},
            "silver_flag_accepted": checks.not_accepted("_quality_flag", accepted["_quality_flag"]),
            "silver_bucket_accepted": checks.not_accepted("_amount_bucket", accepted["_amount_bucket"]),
        },
        "daily": {
            "daily_date_not_null": checks.not_null("_date"),
            "daily_count_not_null": checks.not_null("transaction_count"),
            "daily_success_rate_range": checks.outside("success_rate", 0, 100),
        },
        "merchant": {
            "merchant_code_not_null": checks.not_null("merchant_code"),
            "merchant_success_rate_range": checks.outside("success_rate", 0, 100),
        },
    }


def check_job(
    spark: SparkSession,
    paths: LakePaths,
    run_id: str,
    start: date | datetime | str | None = None,
    end: date | datetime | str | None = None,
) -> dict:
    """Run the data checks of all layers over the dates from ``start`` to ``end`` (both
    inclusive; rows without a date belong to every range); store each failing check's rows.

    One write per layer evaluates all its rules, counts them on the way and keeps the
    failures under ``<root>/checks/_check=<name>/_run_id=<run_id>``. Returns the number of
    violating rows per check (0 = passed).
    """

    def dated(df: DataFrame, column: str) -> DataFrame:
        inside = F.lit(True)
        if start is not None:
            inside = inside & (F.col(column) >= F.to_date(F.lit(_day(start))))
        if end is not None:
            inside = inside & (F.col(column) <= F.to_date(F.lit(_day(end))))
        return df if start is None and end is None else df.filter(F.col(column).isNull() | inside)

    layers = {
        "bronze": dated(bronze_table(spark, paths), EVENT_DATE).drop(EVENT_DATE, ATTEMPT_PART),
        "silver": dated(sinks.read_table(spark, paths.silver), "_date"),
        "daily": dated(sinks.read_table(spark, paths.gold_daily), "_date"),
        "merchant": dated(sinks.read_table(spark, paths.gold_merchant), "_date"),
    }
    unique = {"bronze": "bronze_transaction_id_unique", "silver": "silver_transaction_id_unique"}
    out: dict[str, int] = {}
    for layer, rules in layer_rules().items():
        df = layers[layer]
        failed = checks.failed_rules(df, rules)
        names = list(rules)
        if layer in unique:
            failed = failed.unionByName(checks.repeated(df, unique[layer], "transaction_id"))
            names.append(unique[layer])
        if layer == "daily":
            name = "daily_count_at_least_one"
            empty = checks.at_least_one(df, "transaction_count")
            failed = failed.unionByName(
                empty.select(F.lit(name).alias("check"), F.to_json(F.struct("*")).alias("row"))
            )
            names.append(name)
        rows = failed.select("row", F.col("check").alias("_check"), F.lit(run_id).alias("_run_id"))
        for name in names:  # rows of an earlier run under this id
            sinks.drop_partitions(spark, f"{paths._p('checks')}/_check={name}", "_run_id", run_id.__eq__)
        out |= sinks.overwrite_partitions(
            rows, paths._p("checks"), ["_check", "_run_id"],
            metrics={n: F.count_if(F.col("_check") == n) for n in names},
        )
    del out["rows_written"]
    return out


# --- daily entry points (clock replaced by ``as_of``) --------------------------


def ingest_daily(
    spark: SparkSession,
    paths: LakePaths,
    rows: DataFrame,
    as_of: date | datetime | str,
    days_back: int = 1,
) -> dict:
    """Land the rows whose event day is in ``[as_of - days_back, as_of]``, and
    those without an event time, which the quality rules mark later.

    Both ends are inclusive, like the source system's daily fetch.
    """
    last = date.fromisoformat(_day(as_of))
    first = last - timedelta(days=days_back)
    day = F.to_date("initiated_at")
    chosen = rows.filter(day.isNull() | ((day >= F.lit(first)) & (day <= F.lit(last))))
    # a batch's share of one range: other ranges of the batch are landings of their own
    landing = F.concat_ws("@", F.col("_batch_id").cast("string"), F.lit(f"{first}_{last}"))
    return ingest_bronze(chosen, paths, landing)


def normalize_daily(
    spark: SparkSession, paths: LakePaths, as_of: date | datetime | str, days_back: int = 1
) -> dict:
    """Normalise ``[as_of - days_back, as_of)`` (midnight bounds) into Silver."""
    end = datetime.fromisoformat(_day(as_of))
    return normalize_job(spark, paths, end - timedelta(days=days_back), end)


def aggregate_daily(
    spark: SparkSession, paths: LakePaths, as_of: date | datetime | str, days_back: int = 30
) -> dict:
    """Rebuild Gold for the last ``days_back`` days."""
    return aggregate_job(spark, paths, as_of, days_back)


def detect_daily(
    spark: SparkSession, paths: LakePaths, as_of: date | datetime | str, **thresholds
) -> dict:
    """Flag the day before ``as_of`` (the source system's default target)."""
    day = datetime.fromisoformat(_day(as_of)) - timedelta(days=1)
    return detect_job(spark, paths, day, **thresholds)
