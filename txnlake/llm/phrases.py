"""Phrase collocations counted over a prefix-free parse of the corpus.

* Texts are parsed into chunks at places that only the words around them decide: a
  window of ``MAX_WORDS - 1`` words whose hash is 0 modulo ``every`` ends a chunk and
  begins the next, so neighbouring chunks overlap by that window and a passage that
  repeats across documents gives the same chunks everywhere. The distinct chunks form
  a dictionary with their frequencies in the parse. Piece borders stand in the chunks
  as a word of their own that belongs to no phrase.
* Phrases are counted inside distinct chunks, weighted by the chunk's frequency. A
  phrase belongs to the chunk in which it starts before the closing window (the last
  chunk of a text takes all its starts), so what lies in an overlap counts once.
* The dictionary keeps a 64-bit hash of each word, so that the passes that count work
  on arrays. Level by level, phrases of n words are counted by a key of 96 bits, and
  only where both their phrases of n - 1 words may have reached ``min_count``, which a
  bitmap of fixed size tells; it errs to one side only, so no phrase is lost.
* With its count, each key keeps the least of its places (a hash of the chunk, and the
  offset). The words of a frequent phrase are read at that place only, by a join with
  the chunks; a bitmap leaves out most chunks that no place names before it.
* Scores are joins of the frequent phrases with themselves in decimals of 38 digits.

A phrase inside a longer one with an equal count also lies inside one that is just one
word longer with that count, so only these are looked at.

Edge cases: a null text is empty; a null lang is ``und``; repeated rows are counted
each; a lang without candidates has no rows; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bitset import collect_bitset, holds, spots
from .common import stored

MAX_WORDS, MIN_COUNT, TOP = 5, 100, 2000
EVERY = 32
LOG2_BITS = 25  # 4 MB for each phrase length
HELD_TOKENS = 2_000_000  # words that a task works on at once
HELD_BYTES = 2_000_000  # of texts whose words a task hashes at once
LONG_WORD = 64  # bytes; longer words are hashed one by one
OFFSET_BITS = 31  # of a place; the chunk's hash stands above

# What ends a piece; "." stands for all of them in the chunks.
BORDERS = b".,;:!?\x0a\x0b\x0c\x0d"
BORDER = b"."
TEXT_END = b"\xff"  # no byte of UTF-8
_TABLE = bytes.maketrans(BORDERS + b"\t", BORDER * len(BORDERS) + b" ")
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _bordered(text: bytes) -> bytes:
    """A text with its words and borders parted by blanks."""
    return text.lower().translate(_TABLE).replace(BORDER, b" . ")


def tokens_of(text: str) -> list[bytes]:
    """Words of a text in order, with a border between pieces."""
    return _bordered(text.encode()).split()


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """The hashes, one to one, with each bit depending on all."""
    hashes = (hashes ^ (hashes >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    hashes = (hashes ^ (hashes >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return hashes ^ (hashes >> np.uint64(33))


def word_hashes(words: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of each word of ``words``, which single blanks part, and where it
    begins. A border has 0, ``TEXT_END`` 1, and no word either."""
    data = np.frombuffer(words + b" " * 8, dtype=np.uint8)
    ends = np.append(np.flatnonzero(data[: len(words)] == ord(" ")), len(words))
    begins = np.append(0, ends[:-1] + 1)
    sizes = ends - begins
    eights = np.lib.stride_tricks.sliding_window_view(data, 8)
    of_size = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)

    def read(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        """The next eight bytes of words, of which ``left`` bytes are left."""
        return eights[at].view("<u8").ravel() & of_size[np.minimum(left, 8)]

    hashes = _mixed(sizes.astype(np.uint64) * _SPREAD ^ read(begins, sizes))
    long = np.flatnonzero(sizes > LONG_WORD)
    hashes[long] = [xxhash.xxh64_intdigest(words[begins[k] : ends[k]]) for k in long.tolist()]
    longer = np.flatnonzero((sizes > 8) & (sizes <= LONG_WORD))
    done = 8
    while len(longer):
        hashes[longer] = _mixed(hashes[longer] * _SPREAD ^ read(begins[longer] + done, sizes[longer] - done))
        done += 8
        longer = longer[sizes[longer] > done]
    hashes = np.maximum(hashes, np.uint64(2))
    single = np.flatnonzero(sizes == 1)
    first = data[begins[single]]
    hashes[single[first == ord(BORDER)]] = 0
    hashes[single[first == ord(TEXT_END)]] = 1
    return hashes, begins


def _lang_hash(lang: str) -> int:
    """Seeded otherwise than words, or a lang and an equal first word would cancel out
    and all langs share such keys."""
    return xxhash.xxh64_intdigest(lang.encode(), seed=1)


def _longer(hashes: np.ndarray, token_hashes: np.ndarray, n: int, at: np.ndarray) -> np.ndarray:
    """Hashes of the phrases of n words at the places ``at``, from those of n - 1 words
    there (the seeds of the places for n = 1)."""
    mixed = (hashes ^ token_hashes[at + (n - 1)]) * _SPREAD
    return mixed ^ (mixed >> np.uint64(29))


def chunk_rows(texts: list[str], langs: list[str], every: int, held: Counter) -> int:
    """Count the chunks (lang, words, whether the text ends) of texts in ``held``.
    Returns the number of words and borders."""
    between = b" " + TEXT_END + b" "
    data = np.frombuffer(_bordered(between.join([t.encode() for t in texts]) + between), dtype=np.uint8)
    blank = data == ord(" ")
    blank[1:] &= blank[:-1]  # after another one, or the first
    words = data[~blank].tobytes()[:-1]
    token_hashes, begins = word_hashes(words)
    overlap = MAX_WORDS - 1
    at = np.arange(max(len(begins) - overlap + 1, 0))
    window = np.zeros(len(at), dtype=np.uint64)
    for n in range(1, overlap + 1):
        window = _longer(window, token_hashes, n, at)
    opens = np.flatnonzero((window >> np.uint64(20)) % np.uint64(every) == 0)
    ends = np.flatnonzero(token_hashes == 1)
    starts = np.concatenate([[0], ends[:-1] + 1])
    text = np.searchsorted(ends, opens)
    opens = opens[(opens > starts[text]) & (opens + overlap <= ends[text])]

    text = np.flatnonzero(starts < ends)  # those with words
    first = np.concatenate([starts[text], opens])
    order = np.argsort(first)
    text = np.concatenate([text, np.searchsorted(ends, opens)])[order]
    first = first[order]
    last = np.append(text[1:] != text[:-1], True)[: len(text)]
    stop = np.where(last, ends[text], np.append(first[1:], 0)[: len(text)] + overlap)
    lang_of = map(langs.__getitem__, text.tolist())
    for lang, begin, end, final in zip(
        lang_of, begins[first].tolist(), (begins[stop] - 1).tolist(), last.tolist()
    ):
        held[lang, words[begin:end], final] += 1
    return len(begins) - len(texts)


def _slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes together, one row at least."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield start, stop
        start = stop


def parse(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """The dictionary of the parse: (lang, chunk, ends, freq), distinct chunks."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        size = 0

        def passed_on() -> pa.RecordBatch:
            keys = list(held)
            out = pa.RecordBatch.from_arrays([
                pa.array([lang for lang, _, _ in keys], pa.string()),
                pa.array([c for _, c, _ in keys], pa.binary()).cast(pa.string()),
                pa.array([e for _, _, e in keys], pa.bool_()),
                pa.array(list(held.values()), pa.int64()),
            ], ["lang", "chunk", "ends", "freq"])
            held.clear()
            return out

        for batch in batches:
            langs, texts = (batch.column(k).to_pylist() for k in ("lang", "text"))
            for start, stop in _slices(np.fromiter(map(len, texts), np.int64, len(texts)), HELD_BYTES):
                size += chunk_rows(texts[start:stop], langs[start:stop], every, held)
                if size > HELD_TOKENS:
                    yield passed_on()
                    size = 0
        if held:
            yield passed_on()

    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return (
        texts.mapInArrow(chunks, "lang string, chunk string, ends boolean, freq long")
        .groupBy("lang", "chunk", "ends")
        .agg(F.sum("freq").alias("freq"))
    )


def coded(dictionary: DataFrame) -> DataFrame:
    """The dictionary with the hashes of each chunk's words (``words``, 64 bits each, 0 for
    a border) and of the chunk (``id``), and the number of words that start in it before
    the closing window (``own``)."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = batch.column("chunk").cast(pa.binary()).to_pylist()
            for start, stop in _slices(np.fromiter(map(len, chunks), np.int64, len(chunks)), HELD_BYTES):
                part, rows = chunks[start:stop], batch.slice(start, stop - start)
                words, begins = word_hashes(b" ".join(part))
                stops = np.searchsorted(begins, np.cumsum([len(c) + 1 for c in part]))
                starts = np.append(0, stops[:-1])
                closing = np.where(rows.column("ends").to_numpy(zero_copy_only=False), 0, MAX_WORDS - 1)
                seen = np.append(0, np.cumsum(words != 0))
                own = seen[np.maximum(stops - closing, starts)] - seen[starts]
                offsets = np.append(0, 8 * stops).astype(np.int32)
                binary = [None, pa.py_buffer(offsets), pa.py_buffer(words.astype("<u8"))]
                yield pa.RecordBatch.from_arrays([
                    *rows.columns,
                    pa.Array.from_buffers(pa.binary(), len(part), binary),
                    pa.array(own, pa.int64()),
                    pa.array([xxhash.xxh32_intdigest(c) for c in part], pa.int64()),
                ], ["lang", "chunk", "ends", "freq", "words", "own", "id"])

    schema = "lang string, chunk string, ends boolean, freq long, words binary, own long, id long"
    return dictionary.select("lang", "chunk", "ends", "freq").mapInArrow(code, schema)


class _Block:
    """Chunks of the dictionary laid end to end, as arrays over their words."""

    def __init__(self, rows: pd.DataFrame):
        self.words = np.frombuffer(b"".join(rows["words"]), dtype="<u8")
        sizes = rows["words"].map(len).to_numpy() // 8
        stop = np.cumsum(sizes)
        lang_of, langs = pd.factorize(rows["lang"])
        seeds = np.array([_lang_hash(x) for x in langs], dtype=np.uint64)
        self.seed = np.repeat(seeds[lang_of], sizes)
        self.freq = np.repeat(rows["freq"].to_numpy(), sizes)
        place = np.arange(len(self.words))
        # starts from here on belong to the next chunk
        closing = stop - np.where(rows["ends"], 0, MAX_WORDS - 1)
        self.owned = place < np.repeat(closing, sizes)
        self.last = np.zeros(len(place), dtype=bool)  # words that end a chunk
        self.last[stop[sizes > 0] - 1] = True
        # the 32-bit hash of the chunk of each place, and the offset in it
        at_start = (rows["id"].to_numpy().astype(np.int64) << OFFSET_BITS) - (stop - sizes)
        self.where = np.repeat(at_start, sizes) + place

    def levels(
        self, bitsets: list[np.ndarray], log2_bits: int, last: int
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For phrases of 1, 2, ... ``last`` words in one go: the places where one starts
        whose shorter phrases may be frequent by ``bitsets`` (of 1, 2, ... words), and
        its hash, the first 64 bits of its key."""
        at = np.flatnonzero(self.words)
        hashes = self.seed[at]
        for m in range(1, last + 1):
            hashes = _longer(hashes, self.words, m, at)
            own = self.owned[at]
            yield at[own], hashes[own].view(np.int64)
            if m < last:
                kept = np.flatnonzero(holds(bitsets[m - 1], spots(hashes, log2_bits)))
                at = at[kept]
                on = np.append(at[1:] == at[:-1] + 1, False)[: len(at)]  # so is the phrase one place on
                if m == 1:  # longer ones share words with it, and so a chunk
                    on &= ~self.last[at]
                at, hashes = at[on], hashes[kept[on]]

    def checks(self, at: np.ndarray, n: int) -> np.ndarray:
        """The other 32 bits of the keys of the phrases of n words at these places."""
        check = ~self.seed[at]
        for m in range(n):
            check = (check + self.words[at + m]) * np.uint64(0xC2B2AE3D27D4EB4F)
            check ^= check >> np.uint64(31)
        return (check >> np.uint64(32)).astype(np.int64)

    def phrases(self, n: int, bitsets: list[np.ndarray], log2_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the phrases of n words as in ``levels``, and their keys."""
        for at, h in self.levels(bitsets, log2_bits, n):
            pass
        return at, h, self.checks(at, n)


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[_Block]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += int(batch["words"].map(len).sum()) // 8
        if size > HELD_TOKENS:
            yield _Block(pd.concat(held, ignore_index=True))
            held, size = [], 0
    if size:
        yield _Block(pd.concat(held, ignore_index=True))


def _grouped(h: np.ndarray) -> np.ndarray:
    """An order that puts equal hashes next to each other, but for a few among which
    others with the same leading bits may stand. Sorts plain numbers, the leading bits
    of a hash with its place below, which is much faster than sorting places by hash."""
    bits = np.uint64(len(h).bit_length())
    places = np.arange(len(h), dtype=np.uint64)
    mixed = np.sort((h.view(np.uint64) >> bits << bits) | places)
    return (mixed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def _frequent(
    dictionary: DataFrame, n: int, packed: list[bytes], min_count: int, log2_bits: int
) -> DataFrame:
    """(h, c, f, place): keys of the phrases of n words that occur ``min_count`` times."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bitsets = [np.frombuffer(b, dtype=np.uint8) for b in packed]
        for block in _blocks(batches):
            at, h, c = block.phrases(n, bitsets, log2_bits)
            order = _grouped(h)
            at, h, c = at[order], h[order], c[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
            first = np.flatnonzero(new)
            if len(first):
                yield pd.DataFrame({
                    "h": h[first], "c": c[first].astype(np.uint32).view(np.int32),
                    "f": np.add.reduceat(block.freq[at], first),
                    "place": np.minimum.reduceat(block.where[at], first),
                })

    words = dictionary.select("lang", "ends", "freq", "words", "id")
    counted = words.mapInPandas(count, "h long, c int, f long, place long")
    return (
        counted.groupBy("h", "c").agg(F.sum("f").alias("f"), F.min("place").alias("place"))
        .filter(F.col("f") >= min_count)
    )


def _spot_column(log2_bits: int):
    def spot(h: pd.Series) -> pd.Series:
        return pd.Series(spots(h.to_numpy().view(np.uint64), log2_bits))

    return F.pandas_udf(spot, "long")


def count_phrases(
    dictionary: DataFrame, min_count: int = MIN_COUNT, log2_bits: int = LOG2_BITS
) -> DataFrame:
    """(lang, phrase, f): phrases of 1 to 5 words that occur ``min_count`` times, and for
    every lang the number of its words as the empty phrase. ``dictionary`` is a stored
    table of ``coded``. Runs jobs for each phrase length while it is built."""
    packed: list[bytes] = []
    levels = []
    spot = _spot_column(log2_bits)
    for n in range(1, MAX_WORDS + 1):
        found = stored(_frequent(dictionary, n, packed, min_count, log2_bits), f"frequent-{n}")
        packed.append(collect_bitset(found.select(spot("h").alias("spot")), "spot", log2_bits))
        levels.append(found.withColumn("words", F.lit(n)))
    frequent = levels[0]
    for more in levels[1:]:
        frequent = frequent.unionByName(more)
    named = stored(named_phrases(dictionary, frequent, log2_bits), "phrase-texts")
    totals = dictionary.groupBy("lang").agg(F.sum(F.col("freq") * F.col("own")).alias("f"))
    return named.unionByName(totals.select("lang", F.lit("").alias("phrase"), "f"))


def _keys(seeds: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys (h, c) of phrases of one length, a row of word hashes for each, as
    ``_Block`` gives them."""
    h, check = seeds, ~seeds
    for m in range(words.shape[1]):
        h = (h ^ words[:, m]) * _SPREAD
        h ^= h >> np.uint64(29)
        check = (check + words[:, m]) * np.uint64(0xC2B2AE3D27D4EB4F)
        check ^= check >> np.uint64(31)
    return h.view(np.int64), (check >> np.uint64(32)).astype(np.uint32).view(np.int32)


def named_phrases(dictionary: DataFrame, frequent: DataFrame, log2_bits: int) -> DataFrame:
    """(lang, phrase, f) of ``frequent``, (h, c, f, place, words), each read at its place.
    What else a chunk of the same hash has there does not have the phrase's key."""
    places = frequent.select(
        F.shiftright("place", OFFSET_BITS).alias("id"),
        F.col("place").bitwiseAND((1 << OFFSET_BITS) - 1).cast("int").alias("offset"),
        F.col("words").alias("n"), "h", "c", "f",
    )
    packed = collect_bitset(
        places.select(_spot_column(log2_bits)(F.xxhash64("id")).alias("spot")), "spot", log2_bits
    )

    @F.pandas_udf("boolean")
    def may_be_read(hashed: pd.Series) -> pd.Series:
        bits = np.frombuffer(packed, dtype=np.uint8)
        return pd.Series(holds(bits, spots(hashed.to_numpy().view(np.uint64), log2_bits)))

    @F.pandas_udf("boolean")
    def has_key(lang: pd.Series, phrase: pd.Series, n: pd.Series, h: pd.Series, c: pd.Series) -> pd.Series:
        out = np.zeros(len(n), dtype=bool)
        seeds = lang.map({x: _lang_hash(x) for x in lang.unique()}).to_numpy(np.uint64)
        sizes = phrase.str.count(" ").to_numpy() + 1  # fewer than n if the chunk ends before
        words, _ = word_hashes(" ".join(phrase).encode())
        begins = np.cumsum(sizes) - sizes
        for size in n.unique():
            rows = np.flatnonzero((sizes == n.to_numpy()) & (n == size).to_numpy())
            found = words[begins[rows][:, None] + np.arange(size)]
            hashes, checks = _keys(seeds[rows], found)
            out[rows] = (hashes == h.to_numpy()[rows]) & (checks == c.to_numpy()[rows])
        return pd.Series(out)

    chunks = dictionary.filter(may_be_read(F.xxhash64("id"))).select("id", "lang", "chunk")
    at = chunks.join(places, "id").select(
        "lang", F.expr("array_join(slice(split(chunk, ' '), offset + 1, n), ' ')").alias("phrase"),
        "n", "h", "c", "f",
    )
    # a chunk that also ends a text is there twice
    return at.filter(has_key("lang", "phrase", "n", "h", "c")).groupBy("lang", "phrase").agg(
        F.max("f").alias("f")
    )


def collocations(counted: DataFrame, top: int = TOP) -> DataFrame:
    """The best phrases of each lang from ``count_phrases`` (a stored table)."""
    totals = counted.filter(F.col("phrase") == "").select("lang", F.col("f").alias("n"))
    phrases = counted.filter(F.col("phrase") != "")
    words = F.split("phrase", " ")
    candidates = phrases.select("lang", "phrase", F.col("f").alias("a"), words.alias("w")).filter(
        F.size("w") >= 2
    )

    def part(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    cuts = candidates.select(
        "lang", "phrase", "a", "w", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k")
    ).select(
        "lang", "phrase", "a", "k",
        part(F.lit(1), F.col("k")).alias("left"),
        part(F.col("k") + 1, F.size("w") - F.col("k")).alias("right"),
    )
    lefts = phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rights = phrases.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    # 1000 * a * n <= 10 ** 37 for up to 10 ** 17 words
    score = F.expr(
        "(1000BD * cast(a as decimal(17,0)) * cast(n as decimal(17,0)))"
        " div (cast(l as decimal(17,0)) * cast(r as decimal(17,0)))"
    )
    scored = (
        cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"]).join(totals, "lang")
        .select("lang", "phrase", "a", "n", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min("cut").alias("cut"))
    )
    longer = candidates.filter(F.size("w") >= 3).select(
        "lang", F.col("a").alias("around"),
        F.explode(F.array(part(F.lit(1), F.size("w") - 1), part(F.lit(2), F.size("w") - 1))).alias("phrase"),
    ).groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(
        F.col("around").isNull() | (F.col("around") < F.col("a"))
    )
    order = [F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return kept.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )


def mine(
    docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, every: int = EVERY,
    log2_bits: int = LOG2_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the ``top`` phrases of each lang.
    Runs the counting jobs while it is built."""
    dictionary = stored(coded(parse(docs, every)), "chunks", compression="zstd")
    return collocations(stored(count_phrases(dictionary, min_count, log2_bits), "phrases"), top)
