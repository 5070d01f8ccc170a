"""Where transactions were landed: from ids to event days, for corrections.

A correction can land a transaction under another day than before. Three small tables
beside the lake make that cheap to follow:

* ``days``: every (id, day) that was ever landed, partitioned by a hash bucket of the
  id. A landing reads only the buckets of the ids it brings.
* ``moved``: the ids that were landed under more than one day, with the other day and
  the landing that moved them, partitioned by day. Such ids are rare.
* ``unsettled``: a file for each landing with the pairs of days between which it moved
  ids (NULL for rows without a time), until both days were written again.

A day is then written again together with the days of its unsettled pairs, which come
from the few files. Rows of moved ids on other, settled days are read as well, so that
keep-latest sees every delivery, but those days stay as they are.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import sinks
from .landings import file_name

BUCKETS = 64
BUCKET, DAY = "_bucket", "_event_date"
DAYS_SCHEMA = f"transaction_id string, day date, {BUCKET} int"
MOVED_SCHEMA = f"transaction_id string, other date, landing string, {DAY} date"


def _text(day: date | None) -> str | None:
    return None if day is None else day.isoformat()


def on_days(column: str, days: Iterable[date | None]) -> Column:
    """A filter on the given days that partitions are pruned by; None stands for NULL."""
    dated = [d for d in days if d is not None]
    here = F.col(column).isin(*dated) if dated else F.lit(False)
    return here | F.col(column).isNull() if None in days else here


def entries(rows: DataFrame) -> DataFrame:
    """Distinct (id, day) of Bronze rows with the id's bucket; rows without id have none."""
    bucket = F.pmod(F.xxhash64("transaction_id"), F.lit(BUCKETS)).cast("int")
    return (
        rows.filter(F.col("transaction_id").isNotNull())
        .select("transaction_id", F.col(DAY).alias("day"))
        .distinct()
        .withColumn(BUCKET, bucket)
    )


def known(spark: SparkSession, index: str, buckets: list[int]) -> DataFrame:
    """Entries of the given buckets (a static partition filter)."""
    path = f"{index}/days"
    if not sinks.exists(spark, path):
        return spark.createDataFrame([], DAYS_SCHEMA)
    return spark.read.schema(DAYS_SCHEMA).parquet(path).filter(F.col(BUCKET).isin(*buckets))


def moved(spark: SparkSession, index: str, days: Iterable[date | None]) -> DataFrame:
    """Ids of the given days that were also landed under another day."""
    path = f"{index}/moved"
    if not sinks.exists(spark, path):
        return spark.createDataFrame([], MOVED_SCHEMA)
    return spark.read.schema(MOVED_SCHEMA).parquet(path).filter(on_days(DAY, days))


def note_landing(rows: DataFrame, index: str, name: str) -> None:
    """Enter Bronze rows that are about to be landed, and which ids they move. Doing
    it again for the same rows changes nothing."""
    spark = rows.sparkSession
    new = cut_lineage(entries(rows))  # one pass over the rows
    found = new.groupBy("day").agg(F.collect_set(BUCKET).alias("buckets")).collect()
    new_days = [r["day"] for r in found]
    buckets = sorted({b for r in found for b in r["buckets"]})
    pairs = set()
    if buckets:
        before = known(spark, index, buckets)
        other = before.unionByName(new).select("transaction_id", BUCKET, F.col("day").alias("other"))
        # merged: neither side is small, whatever its compressed files suggest
        moves = new.join(other.hint("merge"), [BUCKET, "transaction_id"]).filter(
            ~F.col("day").eqNullSafe(F.col("other"))
        )
        ends = F.array(F.struct("day", "other"), F.struct(F.col("other").alias("day"), F.col("day").alias("other")))
        sinks.append(
            moves.select("transaction_id", F.explode(ends).alias("e"))
            .select("transaction_id", "e.other", F.lit(name).alias("landing"), F.col("e.day").alias(DAY))
            .distinct(),
            f"{index}/moved", DAY,
        )
        met = moved(spark, index, new_days).filter(F.col("landing") == name)
        pairs = {(_text(a), _text(b)) for a, b in met.select(DAY, "other").distinct().collect()}
        text = F.coalesce(F.col("day").cast("string"), F.lit("")).alias("day_text")
        fresh = new.select("*", text).join(
            before.select(BUCKET, "transaction_id", text).hint("merge"),
            [BUCKET, "transaction_id", "day_text"], "left_anti",
        )
        sinks.append(fresh.select("transaction_id", "day", BUCKET), f"{index}/days", BUCKET)
    if rows.filter(F.col(DAY).isNull()).limit(1).count():
        pairs.add((None, None))
    if pairs:
        path = f"{index}/unsettled/{file_name(name)}"
        sinks.write_text(spark, path, json.dumps(sorted(pairs, key=str)))


def unsettled(spark: SparkSession, index: str) -> dict[str, list[tuple]]:
    """Pairs of days (ISO texts, None for NULL) that landings left to be written, by file."""
    found = sinks.read_texts(spark, f"{index}/unsettled")
    return {name: [tuple(p) for p in json.loads(text)] for name, text in found.items()}


def days_to_write(pairs: Iterable[tuple], days: Iterable[str | None]) -> set[str | None]:
    """``days`` and those that unsettled pairs connect with them, directly or not. Rows
    without a time belong to every run as long as such rows are unsettled."""
    days, pairs = set(days), set(pairs)
    if (None, None) in pairs:
        days.add(None)
    while True:
        more = {b for a, b in pairs if a in days} | {a for a, b in pairs if b in days}
        if more <= days:
            return days
        days |= more


def settle(spark: SparkSession, index: str, noted: dict[str, list[tuple]], days: set | None) -> None:
    """Drop the pairs of ``noted`` whose days were both written (no days: all were). Pairs
    that a landing added meanwhile stay."""
    now = unsettled(spark, index)
    for name, pairs in noted.items():
        left = [
            p for p in now.get(name, [])
            if p not in pairs or (days is not None and not set(p) <= days)
        ]
        path = f"{index}/unsettled/{name}"
        if left:
            sinks.write_text(spark, path, json.dumps(left))
        else:
            sinks.drop_folders(spark, [path])


def forget_before(spark: SparkSession, index: str, cutoff: date) -> None:
    """Drop the entries of days before ``cutoff``; those without a day stay."""
    path = f"{index}/days"
    if not sinks.exists(spark, path):
        return
    entries = spark.read.schema(DAYS_SCHEMA).parquet(path)
    late = F.col("day").isNull() | (F.col("day") >= F.lit(cutoff))
    buckets = {str(r[0]) for r in entries.select(BUCKET).distinct().collect()}
    sinks.overwrite_partitions(entries.filter(late), path, BUCKET, replaces=buckets.__contains__)
