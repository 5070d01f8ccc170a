"""Landings: identity, replay and publication of appended rows.

A landing is what one delivery stands for: a batch, a batch's share of a daily range,
or one epoch of one stream. Its rows lie in a partition of their own for each attempt,
so no landing can touch another's rows, and a landing that is repeated does not add
its rows twice:

* A repeated landing replaces its earlier rows key by key. Rows whose key is not
  delivered again are carried over, so two deliveries under one name lose nothing, and
  a row that moved to another day is no longer found on its old one.
* The log holds a folder for each landing with a record for every attempt: ``begun``
  (the groups to be written, before anything is), and ``done`` (after everything is).
  The highest attempt that is done counts; readers leave the others out.
* An ``open`` marker stands from before the first write until the old attempts are
  deleted. Readers list these markers only, normally none, so reading does not grow
  with the number of landings. A run lost anywhere leaves either the old or the new
  attempt visible, never both or half of one; the next attempt cleans up.

The groups (event days) of a landing reach the driver; rows never do.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import sinks

ATTEMPT_PART = "_batch_part"


def file_name(landing: str) -> str:
    """A file name of bounded length for a landing."""
    name = quote(landing, safe="")
    if 0 < len(name) <= 150:
        return name
    return name[:100] + "%" + hashlib.sha256(landing.encode()).hexdigest()


def _part(landing: str, attempt: int) -> str:
    # the prefix keeps the folder name text whatever the id looks like
    return f"b-{landing}~{attempt}"


def records(spark: SparkSession, log: str, landing: str) -> dict[int, dict]:
    """The landing's attempts: ``groups`` (texts, None for NULL) and ``done``."""
    out: dict[int, dict] = {}
    for name, text in sinks.read_texts(spark, f"{log}/records/{file_name(landing)}").items():
        attempt, state = name.split(".")[0].split("-")
        entry = out.setdefault(int(attempt), {"groups": [], "done": False, "rows": None})
        entry.update(json.loads(text))
        entry["done"] = entry["done"] or state == "done"
    return out


def _record(spark: SparkSession, log: str, landing: str, attempt: int, state: str, **fields) -> None:
    path = f"{log}/records/{file_name(landing)}/{attempt:08d}-{state}.json"
    sinks.write_text(spark, path, json.dumps({"landing": landing, **fields}))


def _current(attempts: dict[int, dict]) -> int | None:
    return max((n for n, a in attempts.items() if a["done"]), default=None)


def hidden(spark: SparkSession, log: str) -> list[str]:
    """Partition values that readers leave out: attempts of open landings that are not
    done or were replaced."""
    out = []
    for text in sinks.read_texts(spark, f"{log}/open").values():
        landing = json.loads(text)["landing"]
        attempts = records(spark, log, landing)
        now = _current(attempts)
        out += [_part(landing, n) for n in attempts if n != now]
    return sorted(out)


def visible(spark: SparkSession, path: str, log: str) -> DataFrame:
    """The table's rows without those of hidden attempts."""
    df = sinks.read_table(spark, path)
    gone = hidden(spark, log)
    if not gone:
        return df
    return df.filter(F.col(ATTEMPT_PART).isNull() | ~F.col(ATTEMPT_PART).isin(*gone))


def _folder(path: str, group_col: str, group: str | None, part: str) -> str:
    value = sinks.NULL_PARTITION if group is None else sinks.escape_partition(group)
    return f"{path}/{group_col}={value}/{ATTEMPT_PART}={sinks.escape_partition(part)}"


def publish(
    rows: DataFrame,
    path: str,
    log: str,
    landing: Column,
    group_col: str,
    key: Column,
    before: Callable[[DataFrame, dict[str, str]], None] | None = None,
) -> dict:
    """Land ``rows`` in the table at ``path``, partitioned by ``group_col`` and attempt.

    ``landing`` names each row's landing; a call may hold several. ``key`` identifies a
    row within its landing. ``before`` is called with the new rows (with their partition
    value) and the partition value of each landing, after the attempts were recorded and
    before anything is published. Returns the rows delivered (``rows_written``).
    """
    spark = rows.sparkSession
    named = rows.withColumn(ATTEMPT_PART, landing)
    groups: dict[str, set] = {}
    for name, group in named.select(ATTEMPT_PART, F.col(group_col).cast("string")).distinct().collect():
        groups.setdefault(name, set()).add(group)
    if not groups:
        return {"rows_written": 0}
    attempts = {name: records(spark, log, name) for name in groups}
    parts, olds = {}, []
    for name, found in attempts.items():
        attempt = max(found, default=-1) + 1
        parts[name] = _part(name, attempt)
        now = _current(found)
        if now is not None:
            olds.append((name, _part(name, now), found[now]["groups"]))
        kept = set(found[now]["groups"]) if now is not None else set()
        sinks.write_text(spark, f"{log}/open/{file_name(name)}", json.dumps({"landing": name}))
        _record(spark, log, name, attempt, "begun", groups=sorted(groups[name] | kept, key=str))
    # each landing's partition value from the names of this call, a bounded list
    values = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])
    new = named.withColumn(ATTEMPT_PART, values[F.col(ATTEMPT_PART)])
    if before is not None:
        before(new, parts)
    observation = Observation("landing")
    out = new.observe(observation, F.count(F.lit(1)).alias("rows_written"))
    if olds:
        # a partition filter on just the old attempts' folders
        chosen = F.lit(False)
        for name, part, old_groups in olds:
            dated = [g for g in old_groups if g is not None]
            here = F.col(group_col).cast("string").isin(*dated) if dated else F.lit(False)
            if None in old_groups:
                here = here | F.col(group_col).isNull()
            chosen = chosen | ((F.col(ATTEMPT_PART) == part) & here)
        renamed = F.create_map(*[F.lit(x) for name, part, _ in olds for x in (part, parts[name])])
        earlier = sinks.read_table(spark, path).filter(chosen)
        earlier = earlier.withColumn(ATTEMPT_PART, renamed[F.col(ATTEMPT_PART)])
        given = new.select(ATTEMPT_PART, key.alias("_landing_key")).distinct()
        carried = earlier.withColumn("_landing_key", key).join(
            given.hint("merge"), [ATTEMPT_PART, "_landing_key"], "left_anti"
        )
        out = out.unionByName(carried.select(*out.columns))
    sinks.overwrite_partitions(out, path, [group_col, ATTEMPT_PART])
    try:
        written = observation.get["rows_written"]
    except Exception:  # an empty input may be folded away with its observation
        if not new.isEmpty():
            raise
        written = 0
    for name, found in attempts.items():
        attempt = max(found, default=-1) + 1
        begun = records(spark, log, name)[attempt]["groups"]
        _record(spark, log, name, attempt, "done", groups=begun)
        sinks.drop_folders(spark, [
            _folder(path, group_col, g, _part(name, n)) for n, a in found.items() for g in a["groups"]
        ])
        sinks.drop_folders(spark, [f"{log}/open/{file_name(name)}"])
    return {"rows_written": written}
