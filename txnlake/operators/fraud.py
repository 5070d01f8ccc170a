"""Four fraud patterns over Silver PASS rows, and their combination.

Every pattern takes ``day`` (one ``_date``, pruned at the partition column) or
``day=None`` to run all days at once; per-day semantics are kept by adding
``_date`` to every grouping key.

Scale notes:

* velocity / amount spike are "aggregate, then join back". The aggregate is
  partial on the map side, so a sender holding a third of all rows is
  combined before the shuffle. The join is a plain one: AQE broadcasts the
  aggregate only if its measured size is under the threshold, and otherwise
  splits a hot sender's partition of the sort-merge join.
* rapid transfer needs each transfer's predecessor in time within
  (sender, recipient, day). A plain ``lag`` window would put a hot pair into
  one task, so the day is split into short time buckets. The last time of each
  bucket, from a partial aggregate, is carried to the next non-empty bucket as a
  row of its own, which stands before that bucket's first transfer; ``lag`` then
  runs inside each bucket. The transfers themselves are shuffled once, and the
  result equals the unsplit window exactly.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .silver import passing

# Default thresholds and pattern names.
VELOCITY_THRESHOLD = 20
AMOUNT_SPIKE_FACTOR = 5.0
OFF_HOURS_LARGE_AMOUNT = 100_000
RAPID_TRANSFER_WINDOW_MINUTES = 10
SPIKE_HISTORY_DAYS = 7
VELOCITY = "VELOCITY_ANOMALY"
SPIKE = "AMOUNT_SPIKE"
RAPID = "RAPID_TRANSFER"
OFF_HOURS = "OFF_HOURS_LARGE"
GAP_BUCKET_SECONDS = 60  # a day of one pair is spread over up to 1,440 buckets
# Survivor order when a transaction matches several patterns.
PRECEDENCE = (VELOCITY, SPIKE, RAPID, OFF_HOURS)

BASE_COLUMNS = (
    "transaction_id",
    "sender_phone",
    "recipient_phone",
    "amount",
    "initiated_at",
    "channel",
    "region",
)
FLAG_COLUMNS = BASE_COLUMNS + ("flag_pattern", "flag_detail_1", "flag_detail_2")
INPUT_COLUMNS = BASE_COLUMNS + (
    "transaction_type",
    "_date",
    "_hour",
    "_is_peak_hour",
    "_quality_flag",
)


def day_slice(silver: DataFrame, day: date | datetime | str | None = None) -> DataFrame:
    """PASS rows of one day (or of every day when ``day`` is None)."""
    rows = passing(silver)
    if day is not None:
        rows = rows.filter(F.col("_date") == F.to_date(F.lit(str(day)[:10])))
    return rows


def _flags(df: DataFrame, pattern: str, detail_1: Column, detail_2: Column) -> DataFrame:
    return df.select(
        *BASE_COLUMNS,
        F.lit(pattern).alias("flag_pattern"),
        detail_1.cast("string").alias("flag_detail_1"),
        detail_2.cast("double").alias("flag_detail_2"),
    )


def velocity(
    silver: DataFrame,
    day: date | datetime | str | None = None,
    threshold: int = VELOCITY_THRESHOLD,
) -> DataFrame:
    """All rows of a sender with more than ``threshold`` rows that day."""
    rows = day_slice(silver, day)
    counts = (
        rows.groupBy("sender_phone", "_date")
        .agg(F.count(F.lit(1)).alias("daily_txn_count"))
        .filter(F.col("daily_txn_count") > threshold)
    )
    # Inner equi-join: NULL senders never match, as in the source system.
    joined = rows.join(counts, ["sender_phone", "_date"], "inner")
    return _flags(joined, VELOCITY, F.col("daily_txn_count"), F.lit(None))


def sender_mean(
    silver: DataFrame,
    since: datetime | str | None = None,
    upper: datetime | str | None = None,
) -> DataFrame:
    """Mean PASS amount per sender over ``since <= initiated_at < upper``."""
    hist = passing(silver)
    if since is not None:
        start = F.lit(str(since)).cast("timestamp_ntz")
        # the date predicate prunes the partitions of a stored table
        hist = hist.filter((F.col("initiated_at") >= start) & (F.col("_date") >= F.to_date(start)))
    if upper is not None:
        hist = hist.filter(F.col("initiated_at") < F.lit(str(upper)).cast("timestamp_ntz"))
    return hist.groupBy("sender_phone").agg(F.avg("amount").alias("avg_amount_7d"))


def _recent(silver: DataFrame, day: date | datetime | str | None, days: int) -> DataFrame:
    """PASS rows of ``day`` and the ``days`` days before it (static bounds on the
    partition column); all rows without a day."""
    rows = passing(silver)
    if day is None:
        return rows
    last = date.fromisoformat(str(day)[:10])
    return rows.filter(F.col("_date").between(F.lit(last - timedelta(days=days)), F.lit(last)))


def _day_number(c: Column) -> Column:
    return F.datediff(c, F.lit("1970-01-01").cast("date"))


def amount_spike(
    silver: DataFrame,
    day: date | datetime | str | None = None,
    factor: float = AMOUNT_SPIKE_FACTOR,
    since: datetime | str | None = None,
    upper: datetime | str | None = None,
    days: int = SPIKE_HISTORY_DAYS,
) -> DataFrame:
    """Rows above ``factor`` x the sender's mean amount.

    The mean is taken over the row's day and the ``days`` days before it; with
    ``since`` or ``upper`` over that fixed range instead. The history includes the
    tested row itself (so with positive amounts a sender with five or fewer rows can
    never be flagged). Amounts are summed per sender and day first, so the window sees
    at most one row per sender and day.
    """
    rows = day_slice(silver, day)
    if since is not None or upper is not None:
        joined = rows.join(sender_mean(silver, since, upper), "sender_phone", "inner")
    else:
        sums = _recent(silver, day, days).groupBy("sender_phone", "_date").agg(
            F.sum("amount").alias("_sum"), F.count("amount").alias("_count")
        )
        span = Window.partitionBy("sender_phone").orderBy(_day_number(F.col("_date"))).rangeBetween(-days, 0)
        means = sums.select(
            "sender_phone", "_date",
            (F.sum("_sum").over(span) / F.sum("_count").over(span)).alias("avg_amount_7d"),
        )
        joined = rows.join(means, ["sender_phone", "_date"], "inner")
    return _flags(
        joined.filter(F.col("amount") > F.col("avg_amount_7d") * factor),
        SPIKE, F.round(F.col("amount"), 2), F.round(F.col("avg_amount_7d"), 2),
    )


def rolling_spike(
    silver: DataFrame,
    factor: float = AMOUNT_SPIKE_FACTOR,
    days: int = SPIKE_HISTORY_DAYS,
    slot_seconds: int = 300,
) -> DataFrame:
    """Rows above ``factor`` x the sender's mean amount up to and including the row: its
    ``days`` days before, and its own day in order of (time, id).

    A running mean over a sender's rows would hold a busy sender in one task. Here the
    days before come from a range frame over per-day sums, the day's earlier slots from
    a frame over per-slot sums, and only the rows of one slot of one day are ordered
    together. Sums are exact decimals, so their order does not matter.
    """
    t, money = F.col("initiated_at"), F.col("amount").cast("decimal(18,2)")
    second = F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    rows = passing(silver).filter(F.col("sender_phone").isNotNull() & F.col("_date").isNotNull()).select(
        *BASE_COLUMNS, "_date", F.floor(second / slot_seconds).alias("_slot"), money.alias("_money")
    )
    slot = ["sender_phone", "_date", "_slot"]
    slots = rows.groupBy(*slot).agg(F.sum("_money").alias("_sum"), F.count("_money").alias("_count"))
    by_slot = Window.partitionBy("sender_phone", "_date").orderBy("_slot")
    earlier = by_slot.rowsBetween(Window.unboundedPreceding, -1)
    day_sums = slots.groupBy("sender_phone", "_date").agg(
        F.sum("_sum").alias("_sum"), F.sum("_count").alias("_count")
    )
    span = Window.partitionBy("sender_phone").orderBy(_day_number(F.col("_date"))).rangeBetween(-days, -1)

    def upto(c: str, window) -> Column:
        return F.coalesce(F.sum(c).over(window), F.lit(0))

    before = slots.select(
        *slot, upto("_sum", earlier).alias("_slots_sum"), upto("_count", earlier).alias("_slots_count")
    ).join(
        day_sums.select(
            "sender_phone", "_date", upto("_sum", span).alias("_days_sum"),
            upto("_count", span).alias("_days_count"),
        ),
        ["sender_phone", "_date"],
    )
    running = Window.partitionBy(*slot).orderBy(t, "transaction_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    summed = rows.withColumns({
        "_own_sum": F.sum("_money").over(running), "_own_count": F.count("_money").over(running)
    }).join(before, slot)
    total = F.col("_own_sum") + F.col("_slots_sum") + F.col("_days_sum")
    count = F.col("_own_count") + F.col("_slots_count") + F.col("_days_count")
    mean = total.cast("double") / count
    return _flags(
        summed.withColumn("_mean", mean).filter(F.col("amount") > F.col("_mean") * factor),
        SPIKE, F.round(F.col("amount"), 2), F.round(F.col("_mean"), 2),
    )


def transfer_gaps(
    silver: DataFrame,
    day: date | datetime | str | None = None,
    bucket_seconds: int = GAP_BUCKET_SECONDS,
    drop_null_sender: bool = False,
) -> DataFrame:
    """TRANSFER rows with ``minutes_since_prev`` to the same recipient that day.

    Order within (sender, recipient, day) is (initiated_at, transaction_id);
    the first row of a run has a NULL gap. NULL senders form one group unless
    ``drop_null_sender``.
    """
    rows = day_slice(silver, day).filter(F.col("transaction_type") == "TRANSFER")
    if drop_null_sender:
        rows = rows.filter(F.col("sender_phone").isNotNull())
    group = ["sender_phone", "recipient_phone", "_date"]
    t = F.col("initiated_at")
    # Wall-clock seconds since 1970-01-01 (no time zone involved, so buckets are
    # monotonic in initiated_at in every session).
    wall = (
        F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long") * 86400
        + F.hour(t) * 3600
        + F.minute(t) * 60
        + F.second(t)
    )
    rows = rows.withColumn("_bucket", F.floor(wall / bucket_seconds))
    last = rows.groupBy(*group, "_bucket").agg(F.max(t).alias("_last"))
    by_bucket = Window.partitionBy(*group).orderBy("_bucket")
    carried = last.select(*group, "_bucket", F.lag("_last").over(by_bucket).alias("initiated_at")).filter(
        F.col("initiated_at").isNotNull()
    )
    both = rows.withColumn("_carried", F.lit(False)).unionByName(
        carried.withColumn("_carried", F.lit(True)), allowMissingColumns=True
    )
    in_bucket = Window.partitionBy(*group, "_bucket").orderBy(t, F.col("transaction_id"))
    gap = (F.unix_timestamp(t) - F.unix_timestamp("prev_txn_time")) / 60
    return (
        both.withColumn("prev_txn_time", F.lag(t).over(in_bucket))
        .filter(~F.col("_carried"))
        .withColumn("minutes_since_prev", F.when(F.col("prev_txn_time").isNotNull(), gap))
        .drop("_bucket", "_carried")
    )


def rapid_transfer(
    silver: DataFrame,
    day: date | datetime | str | None = None,
    minutes: float = RAPID_TRANSFER_WINDOW_MINUTES,
    drop_null_sender: bool = False,
    bucket_seconds: int = GAP_BUCKET_SECONDS,
) -> DataFrame:
    """Transfers less than ``minutes`` after the previous one to the same recipient."""
    gaps = transfer_gaps(silver, day, bucket_seconds, drop_null_sender)
    rapid = gaps.filter(F.col("minutes_since_prev") < minutes)
    return _flags(rapid, RAPID, F.round(F.col("minutes_since_prev"), 1), F.lit(None))


def off_hours_large(
    silver: DataFrame,
    day: date | datetime | str | None = None,
    amount: float = OFF_HOURS_LARGE_AMOUNT,
) -> DataFrame:
    """Rows outside peak hours with amount >= ``amount`` (NULL peak drops out)."""
    rows = day_slice(silver, day).filter(
        (~F.col("_is_peak_hour")) & (F.col("amount") >= amount)
    )
    return _flags(rows, OFF_HOURS, F.col("_hour"), F.col("amount"))


def fraud_input(silver: DataFrame, share: bool = True) -> DataFrame:
    """PASS rows, pruned to the columns the four patterns read.

    With ``share`` the frame is checkpointed once into the shared checkpoint
    folder, so the four pattern branches read it instead of each recomputing
    Silver (their pruned sub-plans differ, so Spark cannot reuse one exchange
    for all of them).
    """
    base = passing(silver).select(*INPUT_COLUMNS)
    return cut_lineage(base) if share else base


def all_flags(
    silver: DataFrame,
    day: date | datetime | str | None = None,
    velocity_threshold: int = VELOCITY_THRESHOLD,
    spike_factor: float = AMOUNT_SPIKE_FACTOR,
    spike_since: datetime | str | None = None,
    spike_upper: datetime | str | None = None,
    rapid_minutes: float = RAPID_TRANSFER_WINDOW_MINUTES,
    off_hours_amount: float = OFF_HOURS_LARGE_AMOUNT,
    drop_null_sender: bool = False,
    share: bool = True,
) -> DataFrame:
    """Every (transaction, pattern) match, before one-per-transaction selection. With a
    day and no fixed history only that day and the spike history are taken."""
    if spike_since is None and spike_upper is None:
        silver = _recent(silver, day, SPIKE_HISTORY_DAYS)
    silver = fraud_input(silver, share)
    parts = [
        velocity(silver, day, velocity_threshold),
        amount_spike(silver, day, spike_factor, spike_since, spike_upper),
        rapid_transfer(silver, day, rapid_minutes, drop_null_sender),
        off_hours_large(silver, day, off_hours_amount),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def _precedence(c: Column) -> Column:
    expr = None
    for i, name in enumerate(PRECEDENCE):
        expr = F.when(c == name, i) if expr is None else expr.when(c == name, i)
    return expr.otherwise(len(PRECEDENCE))


def detect_all(
    silver: DataFrame,
    day: date | datetime | str | None = None,
    detected_at: datetime | str | None = None,
    **thresholds,
) -> DataFrame:
    """One flag per transaction; the survivor follows ``PRECEDENCE``."""
    flags = all_flags(silver, day, **thresholds)
    w = Window.partitionBy("transaction_id").orderBy(_precedence(F.col("flag_pattern")))
    out = flags.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    if detected_at is not None:
        out = out.withColumn("_detected_at", F.lit(str(detected_at)).cast("timestamp"))
    return out
