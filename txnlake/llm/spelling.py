"""Groups of spelling variants by neighbourhoods over a reduced alphabet.

* Words are counted in the tasks and summed; only words of ``min_length`` code points
  and ``min_count`` occurrences stay.
* Letters are hashed to a few symbols. If two words differ by one edit, their reduced
  words are equal or differ by one edit, so each word's reduced word and its full
  one-edit neighbourhood (every deletion, replacement and insertion over the few
  symbols) holds the reduced word of every word near it. Reduced words are compared by
  a polynomial hash, which gives each neighbour's hash from prefix and suffix hashes in
  constant time, so a run of 100,000 letters costs no more than its length.
* A bitmap of fixed size over the reduced vocabulary keeps neighbours that no word has
  out of the shuffle; the rest is joined with the reduced vocabulary, and each pair is
  verified by edit distance on the original strings.
* A word's form is its most frequent near word if that occurs at least ``ratio`` times
  as often. Counts grow by ``ratio`` along a chain of forms, so chains are short, and
  roots are found by joining the chains with themselves, which doubles the hops.

Edge cases: a null text has no words; a null id counts as empty text; repeated rows
are counted each; ties between near words go to the smallest in code-point order; an
empty table, or one without such words, gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitset import collect_bitset, holds, spots
from .common import stored

MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
SYMBOLS = 8
LOG2_BITS = 27  # 16 MB
HELD_WORDS = 400_000  # distinct words that a task counts before it passes them on
CELLS = 1 << 21  # neighbours computed at once

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def noisy_run(doc_id: str, run: str) -> str:
    """The lower-cased run, without one code point for one (document, run) in 31."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{doc_id}:".encode()))
    if h % 31:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(word, n): occurrences of the words of at least ``min_length`` code points."""
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % min_length)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()

        def passed_on() -> pd.DataFrame:
            out = pd.DataFrame({"word": list(held), "n": list(held.values())})
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch["id_"], batch["text"]):
                for run, n in Counter(runs.findall(text)).items():
                    run = run.lower() if run.isascii() else run.translate(_LOWER)
                    word = noisy_run(doc_id, run)
                    if len(word) >= min_length:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield passed_on()
        if held:
            yield passed_on()

    texts = docs.filter(F.col("text").isNotNull()).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id_"), "text"
    )
    counted = texts.mapInPandas(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _symbols(words: list[str], symbols: int) -> np.ndarray:
    """Reduced words of one length, a row each; symbols count from 1."""
    letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
    mixed = (letters.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(40)
    return (mixed % np.uint64(symbols) + np.uint64(1)).reshape(len(words), -1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _prefixes(reduced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every prefix (the empty one first), and the powers of the base."""
    m, length = reduced.shape
    power = _powers(_BASE, length + 2)
    sums = np.cumsum(reduced * _powers(_INVERSE, length), axis=1, dtype=np.uint64)
    out = np.zeros((m, length + 1), dtype=np.uint64)
    out[:, 1:] = sums * power[:length]
    return out, power


def reduced_hashes(words: list[str], symbols: int) -> np.ndarray:
    """Hashes of the reduced words of words of one length."""
    return _prefixes(_symbols(words, symbols))[0][:, -1]


def neighbour_hashes(words: list[str], symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of the word, hash) of all reduced words within one edit of the reduced
    words of words of one length, themselves included; may repeat, comes in parts."""
    prefix, power = _prefixes(_symbols(words, symbols))
    m, length = len(words), prefix.shape[1] - 1
    whole = prefix[:, -1:]
    every = np.arange(1, symbols + 1, dtype=np.uint64)
    rows = np.arange(m)
    step = max(1, CELLS // (m * (2 * symbols + 1)))
    for a in range(0, length + 1, step):
        at = np.arange(a, min(a + step, length + 1))
        head = prefix[:, at]
        tail = whole - head * power[length - at]  # the suffix from ``at`` on
        insert = (head * np.uint64(_BASE))[:, :, None] + every
        insert = insert * power[length - at][None, :, None] + tail[:, :, None]
        parts = [insert.reshape(m, -1)]
        at = at[at < length]
        if len(at):
            head = prefix[:, at]
            tail = whole - prefix[:, at + 1] * power[length - at - 1]
            shift = power[length - at - 1]
            parts.append(head * shift + tail)
            replace = (head * np.uint64(_BASE))[:, :, None] + every
            replace = replace * shift[None, :, None] + tail[:, :, None]
            parts.append(replace.reshape(m, -1))
        hashes = np.concatenate(parts, axis=1)
        yield np.repeat(rows, hashes.shape[1]), hashes.reshape(-1)


def _by_length(batches: Iterator[pd.DataFrame], symbols: int) -> Iterator[pd.DataFrame]:
    """Rows with words of one length, few enough for one round of neighbours."""
    for batch in batches:
        for length, rows in batch.groupby(batch["word"].str.len(), sort=False):
            step = max(1, CELLS // (int(length + 1) * (2 * symbols + 1)))
            for a in range(0, len(rows), step):
                yield rows.iloc[a : a + step]


def near_words(vocabulary: DataFrame, symbols: int = SYMBOLS, log2_bits: int = LOG2_BITS) -> DataFrame:
    """(word, n, near, near_n) for every ordered pair of words that differ by exactly one
    inserted, deleted or replaced code point. ``vocabulary``: distinct words with n.
    Runs the jobs that store the reduced vocabulary and build its bitmap."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _by_length(batches, symbols):
            h = reduced_hashes(rows["word"].tolist(), symbols)
            yield pd.DataFrame({
                "key": h.view(np.int64), "spot": spots(h, log2_bits),
                "word": rows["word"], "n": rows["n"],
            })

    reduced = stored(
        vocabulary.select("word", "n").mapInPandas(keyed, "key long, spot long, word string, n long"),
        "reduced-words",
    )
    packed = collect_bitset(reduced, "spot", log2_bits)

    def neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bitset = np.frombuffer(packed, dtype=np.uint8)
        for rows in _by_length(batches, symbols):
            words, n = rows["word"].to_numpy(dtype=object), rows["n"].to_numpy()
            found = []
            for which, h in neighbour_hashes(words.tolist(), symbols):
                kept = holds(bitset, spots(h, log2_bits))
                found.append((which[kept], h[kept]))
            which = np.concatenate([w for w, _ in found])
            h = np.concatenate([x for _, x in found])
            order = np.lexsort((h, which))
            which, h = which[order], h[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (which[1:] != which[:-1]) | (h[1:] != h[:-1])
            which, h = which[new], h[new]
            near_keys = {"key": h.view(np.int64), "word": pd.Series(words[which], dtype=object)}
            yield pd.DataFrame({**near_keys, "n": n[which]})

    own = reduced.select("word", "n").mapInPandas(neighbours, "key long, word string, n long")
    other = reduced.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    close = (F.abs(F.length("word") - F.length("near")) <= 1) & (
        F.levenshtein(F.col("word"), F.col("near"), 1) == 1
    )
    return own.join(other, "key").filter(close).select("word", "n", "near", "near_n")


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) for every word with a form: the last word of its chain."""
    roots = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = roots.join(onward, "root", "left")
        if longer.filter(F.col("next").isNotNull()).isEmpty():
            return roots
        roots = stored(
            longer.select("word", F.coalesce("next", "root").alias("root")), "roots"
        )


def group_variants(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO,
    symbols: int = SYMBOLS, log2_bits: int = LOG2_BITS,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs`` with at least
    ``min_length`` code points and ``min_count`` occurrences. Runs jobs while built."""
    vocabulary = stored(
        count_words(docs, min_length).filter(F.col("n") >= min_count), "vocabulary"
    )
    near = near_words(vocabulary, symbols, log2_bits)
    alone = vocabulary.select(
        "word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n")
    )
    # the least (-n, word): most frequent, ties to the smallest; nulls are not counted
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("m"), "near")))
    words = near.unionByName(alone).groupBy("word", "n").agg(
        F.count("near").alias("n_near"), best.alias("best")
    )
    form = F.when(-F.col("best.m") >= ratio * F.col("n"), F.col("best.near"))
    words = stored(
        words.select(
            "word", "n", "n_near", form.alias("form"),
            F.when(form.isNotNull(), -F.col("best.m")).alias("form_n"),
        ),
        "words",
    )
    roots = _roots(words.filter(F.col("form").isNotNull()))
    return words.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
