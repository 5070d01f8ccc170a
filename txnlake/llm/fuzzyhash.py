"""Fingerprints by context-triggered piecewise hashing.

A hash over the last seven bytes is rolled along the text; where it is a
multiple of the block size a chunk ends. The signature has one sign per chunk,
taken from the chunk's own hash, and the fingerprint is
``blocksize:signature:signature at twice the block size``. The block size is
the smallest power of two above a 64th of the text's bytes, so about 32 to 64
chunks are expected, and texts whose lengths differ by less than a factor of two
stay comparable. An edit changes the signs around it and the rest of the
signature stays. Should a text's hash meet the condition far more often (repeated
passages), the block size is doubled until the signature has at most ``LIMIT``
signs; a text where no size does that is one chunk. Two fingerprints are
compared where their block sizes are equal or differ by a factor of two: the
likeness is one minus the edit distance over the longer length, if the
signatures share a run of ``RUN`` signs.

All bytes of a text are hashed; the rolling hash is seven shifted sums in numpy.

Edge cases: null and empty texts have the fingerprint ``1::``; equal texts have
equal fingerprints and likeness 1; an empty table gives an empty result;
other columns are ignored. Repeated ids are ordered by a hash of their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
CHUNKS = 64  # expected at most
LIMIT = 192  # signs of a signature
MOST = 30  # binary logarithm of the largest block size
RUN = 3
WINDOW = 7
STEP = 1 << 22  # bytes hashed at a time


def chunk_ends(data: bytes, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions after the bytes where the low ``k`` bits of the rolling hash are
    zero, and whether one bit more is zero too. Bytes before the text are 0."""
    ends, double = [], []
    mask = np.uint32((1 << k) - 1)
    for start in range(0, len(data), STEP):
        before = max(0, start - WINDOW + 1)
        part = np.frombuffer(data, np.uint8, min(STEP, len(data) - start) + start - before, before)
        part = part.astype(np.uint32) + np.uint32(1)
        h = part.copy()
        for shift in range(1, min(WINDOW, len(part))):
            h[shift:] += part[: len(part) - shift] * np.uint32(pow(0x01000193, shift, 1 << 32))
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        h = h[start - before :]
        at = np.flatnonzero(h & mask == 0)
        ends.append(at + start + 1)
        double.append(h[at] & (mask + mask + np.uint32(1)) == 0)
    return np.concatenate(ends), np.concatenate(double)


def signature(data: bytes, ends: list[int]) -> str:
    """A sign for each chunk; what follows the last end is one more."""
    ends = list(ends)
    if not ends or ends[-1] < len(data):
        ends.append(len(data))
    view = memoryview(data)
    return "".join([SIGNS[crc32(view[a:b]) & 63] for a, b in zip([0, *ends], ends)])


def fingerprint(text: str | None) -> str:
    data = (text or "").encode()
    if not data:
        return "1::"
    k = max(0, ((len(data) - 1) // CHUNKS).bit_length())
    ends, double = chunk_ends(data, k)
    while len(ends) >= LIMIT and k < MOST:
        k += 1
        ends, double = chunk_ends(data, k)
    if len(ends) >= LIMIT:
        ends, double = ends[:0], double[:0]
    return f"{1 << k}:{signature(data, ends.tolist())}:{signature(data, ends[double].tolist())}"


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance, one column of bits at a time (Myers 1999, Hyyro 2001)."""
    if not a or not b:
        return len(a) + len(b)
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    up, down, distance = full, 0, len(a)
    for c in b:
        same = at.get(c, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        grow, shrink = down | ~(diagonal | up) & full, up & diagonal
        if grow & top:
            distance += 1
        elif shrink & top:
            distance -= 1
        grow = (grow << 1 | 1) & full
        shrink = shrink << 1 & full
        up, down = shrink | ~(diagonal | grow) & full, grow & diagonal
    return distance


def _alike(a: str, b: str) -> float:
    run = min(RUN, len(a), len(b))
    if not run:
        return 0.0
    runs = {a[i : i + run] for i in range(len(a) - run + 1)}
    if not any(b[i : i + run] in runs for i in range(len(b) - run + 1)):
        return 0.0
    return 1.0 - edit_distance(a, b) / max(len(a), len(b))


def likeness(x: str, y: str) -> float:
    """0 to 1; 1 for equal fingerprints, 0 where the block sizes are not compatible."""
    if x == y:
        return 1.0
    (sx, x1, x2), (sy, y1, y2) = x.split(":"), y.split(":")
    sx, sy = int(sx), int(sy)
    if sx == sy:
        return max(_alike(x1, y1), _alike(x2, y2))
    if sx == 2 * sy:
        return _alike(x1, y2)
    if sy == 2 * sx:
        return _alike(x2, y1)
    return 0.0


def fingerprint_column(text: Column) -> Column:
    @F.pandas_udf("string")
    def digest(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype=object)

    return digest(text)


def edited_text(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by the first as many of another text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = (
    "doc_id {id}, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def compare_following(docs: DataFrame, slices: int | None = None) -> DataFrame:
    """Fingerprints of every text, of its edited text and its likeness to both
    that and the next document (ascending id; the first follows the last).

    Ids are cut into ranges at approximate quantiles; each range also gets a
    copy of the first document of the next range that has any, so that every
    document meets its successor in a sorted stream and texts are shuffled
    once. A range is streamed, never held.
    """
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(rows.approxQuantile(
        "doc_id", [i / slices for i in range(1, slices)], 0.2 / slices
    ))) if slices > 1 else []
    edges = np.array(cuts)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        place = np.searchsorted(edges, ids.to_numpy(dtype=float), side="right")
        return pd.Series(np.where(ids.isna(), -1, place))  # null ids come first

    placed = rows.withColumn("slice", range_of("doc_id"))
    # the first document of each range: a row for each range
    firsts = sorted(
        (r.slice, r.first.doc_id, r.first.text_hash)
        for r in rows.select("doc_id", F.xxhash64("text").alias("text_hash"))
        .withColumn("slice", range_of("doc_id"))
        .groupBy("slice")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
        .collect()
    )
    # each range is followed by the next one that has rows, the last by the first
    guests = [
        (s, ident, text_hash)
        for (s, _, _), (_, ident, text_hash) in zip(firsts, firsts[1:] + firsts[:1])
    ]
    guest_keys = spark.createDataFrame(guests, f"guest_slice int, g_id {id_type}, g_hash long")
    found = (
        rows.withColumn("h", F.xxhash64("text"))
        .join(
            F.broadcast(guest_keys),
            F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("h") == F.col("g_hash")),
        )
        .groupBy("guest_slice")
        .agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
        .select(F.col("guest_slice").alias("slice"), "doc_id", "text", F.lit(1).alias("guest"))
    )
    stream = (
        placed.select("slice", "doc_id", "text", F.lit(0).alias("guest"))
        .unionByName(found)
        .withColumn("h", F.xxhash64("text"))
        .repartition(max(slices, 1), "slice")
        .sortWithinPartitions("slice", "guest", F.col("doc_id").asc_nulls_first(), "h")
        .select("slice", "doc_id", "text")
    )

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None  # slice, id, text, fingerprint
        for batch in batches:
            out = []
            for s, ident, text in zip(batch["slice"], batch["doc_id"], batch["text"]):
                own = fingerprint(text)
                if last is not None and last[0] == s:
                    edited = edited_text(last[2], text)
                    edited_print = last[3] if edited == last[2] else fingerprint(edited)
                    out.append((
                        last[1], len(last[2]), hashlib.sha256(edited.encode()).hexdigest(),
                        last[3], edited_print, likeness(last[3], edited_print),
                        likeness(last[3], own),
                    ))
                last = (s, ident, text, own)
            frame = pd.DataFrame(out, columns=[
                "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                "near_edited", "near_next",
            ])
            frame["doc_id"] = pd.array(
                [None if pd.isna(x) else x for x in frame["doc_id"]], dtype="Int64"
            )
            yield frame

    return stream.mapInPandas(follow, RESULT.format(id=id_type))
