"""Packing of tokenized documents into sequences by non-negative least squares.

* A document's ids are its tokens and an end id. Whole windows are cut from its front;
  what is left is shorter than a window.
* The histogram of these lengths (one count for each length below the window, whatever
  the size of the table) goes to the driver. There every combination of two or three
  lengths that fills a window exactly is a column of a non-negative least squares
  problem: repeat counts whose use of each length comes nearest to the histogram. It
  is solved by coordinate descent; in each sweep the best column for every length is
  found among all of them. The counts are rounded down.
* Lengths left over are packed greedily: the longest with the longest that still fit,
  as often as the counts allow, if at most ``slack`` places of the window stay empty.
* The rest is laid end to end and cut at the window borders, its last, incomplete
  window into powers of two, which need no padding.

The plan is a list of segments: the k-th document of a length falls into one of them
and gets sequence and offset by arithmetic. Documents of a length are numbered by
counts of each length in each partition of the stored ids, so no length, however
common, is gathered in one task, and no sequence is ever assembled by a shuffle.

Edge cases: a null text counts as empty and is the end id alone; repeated rows are
packed each; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe
from .common import stored

WINDOW = 2048
END_ID = 1
SLACK = 8
SWEEPS = 24
RANK_BITS = 44  # documents of one length: 17 * 10 ** 12


def solve_repeats(histogram: np.ndarray, window: int, sweeps: int = SWEEPS) -> dict[tuple, float]:
    """Non-negative repeat counts of the combinations (two or three lengths, longest
    first) that fill ``window``, least squares against ``histogram`` (by length, up to
    window - 1). A length's residual weighs as the square of the length: the long ones
    are hard to place later, the short ones fit anywhere."""
    lengths = np.flatnonzero(histogram)
    if not len(lengths):
        return {}
    # place 0 stands for "no third length", the last place for lengths not at hand
    left = np.full(window + 1, -np.inf)
    left[0] = 0.0
    left[lengths] = histogram[lengths]
    weight = (np.arange(window + 1) / window) ** 2
    seconds = np.concatenate([[0], lengths])
    thirds = window - lengths[:, None] - seconds[None, :]
    thirds[thirds < 0] = window
    repeats: dict[tuple, float] = {}

    def settle(column: tuple) -> None:
        places = [v for v in column if v]
        norm = sum(places.count(v) * weight[v] for v in places)  # squared multiplicities
        old = repeats.get(column, 0.0)
        new = max(0.0, old + sum(weight[v] * left[v] for v in places) / norm)
        if new != old:
            repeats[column] = new
            for v in places:
                left[v] -= new - old

    for _ in range(sweeps):
        pull = weight * left
        best = np.argmax(pull[seconds][None, :] + pull[thirds], axis=1)
        for k in np.argsort(-left[lengths], kind="stable").tolist():
            second, third = int(seconds[best[k]]), int(thirds[k, best[k]])
            if third < window and np.isfinite(left[third]):
                settle(tuple(sorted((int(lengths[k]), second, third), reverse=True)))
        for column in list(repeats):
            settle(column)
    return {c: x for c, x in repeats.items() if x > 0}


def greedy_patterns(counts: np.ndarray, window: int, slack: int) -> list[tuple[dict, int]]:
    """({length: times}, repeats) of windows packed from ``counts``, which keeps what
    leaves more than ``slack`` places empty."""
    out = []
    counts, kept = counts.copy(), np.zeros_like(counts)
    while counts.any():
        longest = int(np.flatnonzero(counts)[-1])
        pattern, room = {}, window
        while room:
            fitting = np.flatnonzero(counts[: room + 1])
            fitting = [v for v in fitting[-1 - len(pattern):] if v not in pattern]
            if not fitting:
                break
            length = int(fitting[-1])
            pattern[length] = min(room // length, int(counts[length]))
            room -= length * pattern[length]
        if room > slack:
            kept[longest] += counts[longest]
            counts[longest] = 0
            continue
        repeats = min(int(counts[v]) // times for v, times in pattern.items())
        for v, times in pattern.items():
            counts[v] -= repeats * times
        out.append((pattern, repeats))
    return out


@dataclass(frozen=True)
class Plan:
    """Segments of the documents of each length, in order of (length, first rank).

    A segment holds ``times`` documents in each of consecutive sequences from
    ``sequence`` on, beginning at ``offset``; or, where ``times`` is 0, documents that
    stand end to end from place ``offset`` of the stream on. The stream's sequences
    begin at ``stream``; its last, incomplete window begins at ``tail`` and is cut at
    the places ``tail_cuts``."""

    window: int
    key: np.ndarray
    times: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int
    stream: int
    tail: int
    tail_cuts: np.ndarray

    def pieces(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of the rank-th document of a length."""
        k = int(np.searchsorted(self.key, (length << RANK_BITS) | rank, side="right")) - 1
        nth = rank - (int(self.key[k]) & ((1 << RANK_BITS) - 1))
        times = int(self.times[k])
        if times:
            copy, slot = divmod(nth, times)
            return [(0, length, int(self.sequence[k]) + copy, int(self.offset[k]) + slot * length)]
        out, at, start = [], int(self.offset[k]) + nth * length, 0
        while start < length:
            if at < self.tail:
                sequence, offset = divmod(at, self.window)
                room = self.window - offset
            else:
                j = int(np.searchsorted(self.tail_cuts, at, side="right")) - 1
                sequence, offset = self.tail // self.window + j, at - int(self.tail_cuts[j])
                room = int(self.tail_cuts[j + 1]) - at
            size = min(room, length - start)
            out.append((start, size, self.stream + sequence, offset))
            start, at = start + size, at + size
        return out


def plan_windows(
    histogram: np.ndarray, window: int = WINDOW, slack: int = SLACK, sweeps: int = SWEEPS
) -> Plan:
    """Where the documents of each length (below ``window``) go."""
    counts = np.array(histogram, dtype=np.int64)
    patterns: list[tuple[dict, int]] = []
    solved = solve_repeats(counts, window, sweeps)
    for column in sorted(solved, key=lambda c: (-solved[c], c)):
        pattern = {v: column.count(v) for v in column if v}
        repeats = min(int(solved[column]), *(int(counts[v]) // t for v, t in pattern.items()))
        if repeats > 0:
            for v, t in pattern.items():
                counts[v] -= repeats * t
            patterns.append((pattern, repeats))
    for pattern, repeats in greedy_patterns(counts, window, slack):
        for v, t in pattern.items():
            counts[v] -= repeats * t
        patterns.append((pattern, repeats))
    segments, used, sequence = [], np.zeros(window, dtype=np.int64), 0
    for pattern, repeats in patterns:
        offset = 0
        for v, t in sorted(pattern.items(), reverse=True):
            segments.append((v, int(used[v]), t, sequence, offset))
            used[v] += repeats * t
            offset += v * t
        sequence += repeats
    stream, total = sequence, 0
    for v in np.flatnonzero(counts).tolist():
        segments.append((v, int(used[v]), 0, 0, total))
        total += v * int(counts[v])
    tail = total - total % window
    cuts = [tail]
    for bit in range(window.bit_length() - 1, -1, -1):
        if (total - tail) >> bit & 1:
            cuts.append(cuts[-1] + (1 << bit))
    segments.sort()
    columns = np.array(segments, dtype=np.int64).reshape(-1, 5).T
    return Plan(
        window, (columns[0] << RANK_BITS) | columns[1], columns[2], columns[3], columns[4],
        stream + tail // window + len(cuts) - 1, stream, tail, np.array(cuts, dtype=np.int64),
    )


def pack(
    docs: DataFrame, path: str, window: int = WINDOW, slack: int = SLACK, end_id: int = END_ID
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) of every piece; ids
    as little-endian unsigned 32-bit integers. ``docs`` must be a table or a
    checkpoint. Runs the jobs that store the ids and count the lengths."""
    ids = bpe.encode(docs, path).select(
        "doc_id", F.concat("ids", F.lit(struct.pack("<I", end_id))).alias("ids")
    )
    coded = stored(
        ids.select(
            "doc_id", "ids", (F.length("ids") / 4).cast("long").alias("n"),
            F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"),
        ),
        "ids", compression="zstd",
    )
    rest = (F.col("n") % window).cast("int")
    lengths = coded.select("part", "row", "n", rest.alias("rest"))
    histogram = np.zeros(window, dtype=np.int64)
    for length, count in lengths.filter("rest > 0").groupBy("rest").count().toLocalIterator():
        histogram[length] = count
    plan = plan_windows(histogram, window, slack)

    # the rank among the documents of the same length: first inside the partition in
    # which the ids were written, then by the counts of the partitions before
    inside = Window.partitionBy("part", "rest").orderBy("row")
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    parts = lengths.groupBy("part", "rest").agg(F.count("*").alias("k")).select(
        "part", "rest", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("base")
    )
    ranked = (
        lengths.withColumn("nth", F.row_number().over(inside) - 1)
        .join(parts, ["part", "rest"])
        .select("part", "row", "n", "rest", (F.col("base") + F.col("nth")).alias("rank"))
    )
    # whole windows: numbered inside the partition, which leads their sequence ids
    whole = F.expr(f"n div {window}")
    ranked = ranked.withColumn(
        "whole", F.coalesce(F.sum(whole).over(earlier), F.lit(0))
        + F.shiftleft(F.col("part").cast("long"), 33) + plan.sequences
    )

    @F.pandas_udf("array<struct<start:long,length:long,sequence_id:long,offset:long>>")
    def place(n: pd.Series, rest: pd.Series, rank: pd.Series, whole: pd.Series) -> pd.Series:
        names = ("start", "length", "sequence_id", "offset")
        out = []
        for tokens, length, nth, first in zip(n, rest, rank, whole):
            full = tokens // window
            found = [(k * window, window, first + k, 0) for k in range(full)]
            if length:
                found += [(full * window + s, *more) for s, *more in plan.pieces(length, nth)]
            out.append([dict(zip(names, piece)) for piece in found])
        return pd.Series(out, dtype=object)

    placed = ranked.select("row", place("n", "rest", "rank", "whole").alias("pieces"))
    return (
        coded.select("row", "doc_id", "ids", F.col("n").alias("doc_tokens"))
        .join(placed, "row")
        .select("doc_id", "ids", "doc_tokens", F.explode("pieces").alias("p"))
        .select(
            "doc_id", "p.start", "p.length",
            F.substring("ids", F.col("p.start").cast("int") * 4 + 1, F.col("p.length").cast("int") * 4).alias("ids"),
            "doc_tokens", "p.sequence_id", "p.offset",
        )
    )
