"""Near-duplicate documents by the Jaccard similarity of their word shingles.

A text's set holds the 64-bit hashes of its distinct shingles. Equal sets are
one class, so copies cost nothing further. Two sets can only reach the
similarity if they share one of the first ``n - ceil(t n) + 1`` hashes of each
in a common order (prefix filter). The order is by hash, with shingles that
begin many prefixes put last, so a passage that many documents share does not
bring them together; which shingles are put last changes the work only, never
the result.

Classes that share a prefix shingle meet in a tile of that shingle, sorted and
banded by size; a large tile is cut into blocks that meet in pairs. In a tile
hashed bitmap signatures bound the overlap from above: the bits in which two
signatures differ are at least so many elements that are not shared.

Only the components are asked for. One round verifies each class against some
centres of its tiles, so that most near copies are joined by a few comparisons. In
the full comparison bitmaps leave the classes of a tile that may still be linked
with another component; their sets are brought into the tile and exactly
intersected, pairs already joined in it are skipped, and it gives the links of a
forest: fewer than it has classes, however many of its pairs are similar.

Edge cases: null texts and texts without words have an empty set and are linked
with nothing; fewer words than a shingle has are one shingle; repeated rows and
ids belong to the class of their text, a null id never names a component where
another id can; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, stored, unused
from .graph import components

WORDS = 5
PERCENT = 80
OFTEN = 32  # prefixes that a shingle begins before it may be put last
LAST = 1 << 16  # shingles put last, at most
BLOCK = 1024  # classes of a tile's block
FILTER_BITS = 1 << 24
SLICE = 1 << 16  # bytes of text hashed at once
WIDE = 4  # bits of a wide bitmap for each element, at least
BLOCK_SHINGLES = 1 << 22  # shingles of a tile's block
SPACE = re.compile(rb"[\x20\x09-\x0D]")
SPACES = np.array([bool(SPACE.match(bytes([i]))) for i in range(256)])
CENTRES = 8  # of a tile with at least LARGE classes, besides the smallest
LARGE = 16


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, 64-bit hash) of each word: the sum of its bytes' hashes, each
    mixed with its place in the word."""
    at = np.flatnonzero(~SPACES[data])
    if not len(at):
        return at, np.zeros(0, dtype=np.uint64)
    starts = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    lengths = np.diff(starts, append=len(at))
    place = np.arange(len(at)) - np.repeat(starts, lengths)
    each = _mixed(((place << 8) + data[at] + 1).astype(np.uint64))
    return at[starts], _mixed(np.add.reduceat(each, starts) + lengths.astype(np.uint64))


def word_hashes(text: bytes, size: int = SLICE) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, hash) of each word, slice by slice: no temporary array grows
    with a long text but the words themselves."""
    out, at = [], 0
    while at < len(text):
        gap = SPACE.search(text, at + size)
        end = gap.start() if gap else len(text)
        first, hashes = _word_hashes(np.frombuffer(text, np.uint8, end - at, at))
        out.append((first + at, hashes))
        at = end
    if not out:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    return np.concatenate([x for x, _ in out]), np.concatenate([h for _, h in out])


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words."""
    h = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + words[i : len(h) + i])
    return h


def _distinct(hashes: np.ndarray) -> np.ndarray:
    s = np.sort(hashes)
    new = np.ones(len(s), dtype=bool)
    np.not_equal(s[1:], s[:-1], out=new[1:])
    return s[new]


def shingle_sets(texts: Iterable[str | None], size: int = WORDS) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes (unsigned 64-bit); short texts
    are hashed together, up to a slice at a time."""

    def chunk(parts: list[bytes]) -> Iterator[np.ndarray]:
        at, words = word_hashes(b"\n".join(parts))
        ends = np.searchsorted(at, np.cumsum([len(x) + 1 for x in parts]))
        windows = _shingles(words, size) if len(words) >= size else words[:0]
        start = 0
        for end in ends.tolist():
            if 0 < end - start < size:
                yield _shingles(words[start:end], end - start)
            else:
                yield _distinct(windows[start : max(start, end - size + 1)])
            start = end

    parts, held = [], 0
    for text in texts:
        parts.append((text or "").encode().lower())
        held += len(parts[-1])
        if held > SLICE:
            yield from chunk(parts)
            parts, held = [], 0
    if parts:
        yield from chunk(parts)


def shingle_set(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of one text's shingles."""
    return next(shingle_sets([text], size))


def set_key(hashes: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little",
                          signed=True)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def prefix(hashes: np.ndarray, last: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first hashes in the order (not in ``last``, hash)."""
    m = prefix_length(len(hashes), percent)
    if not len(last):
        return hashes[:m]
    place = np.minimum(np.searchsorted(last, hashes), len(last) - 1)
    late = last[place] == hashes
    return np.concatenate([hashes[~late], hashes[late]])[:m]


def bitmap(hashes: np.ndarray, load: int = 1) -> bytes:
    """One bit for each hash modulo a power of two of at least ``load`` times the
    set's size."""
    bits = 64
    while bits < load * len(hashes):
        bits *= 2
    out = np.zeros(bits, dtype=np.uint8)
    out[hashes & np.uint64(bits - 1)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def _fold(words: np.ndarray, length: int) -> np.ndarray:
    """Rows of 64-bit words folded to fewer bits (or of halves)."""
    while words.shape[1] > length:
        half = words.shape[1] // 2
        words = words[:, :half] | words[:, half:]
    return words


def overlap_allowed(maps: np.ndarray, widths: np.ndarray, n: np.ndarray, i: np.ndarray,
                    j: np.ndarray, percent: int = PERCENT, fold: int = 1) -> np.ndarray:
    """Whether the bitmaps, folded to one ``fold``-th, allow the similarity, for
    rows i and j.

    Bits that differ are elements that are not shared, so twice the overlap is at
    most n_i + n_j less their number. ``maps`` holds each row's packed bitmap.
    """
    out = np.zeros(len(i), dtype=bool)
    for a, b in set(zip(widths[i].tolist(), widths[j].tolist())):
        chosen = np.flatnonzero((widths[i] == a) & (widths[j] == b))
        for at in range(0, len(chosen), 1 << 15):
            k = chosen[at : at + (1 << 15)]
            x = np.frombuffer(b"".join(maps[i[k]]), dtype=np.uint64).reshape(len(k), -1)
            y = np.frombuffer(b"".join(maps[j[k]]), dtype=np.uint64).reshape(len(k), -1)
            short = max(min(x.shape[1], y.shape[1]) // fold, 1)
            differ = np.bitwise_count(_fold(x, short) ^ _fold(y, short)).sum(axis=1, dtype=np.int64)
            total = n[i[k]] + n[j[k]]
            out[k] = (total - differ) * (100 + percent) >= 2 * percent * total
    return out


def tile_steps(rows: pd.DataFrame, percent: int = PERCENT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of rows that share a tile and whose sizes allow the
    similarity. ``rows`` are whole tiles sorted by (h, p, q, n): each row meets the
    next, the next but one and so on, all rows in step, until the tile or the size
    band ends."""
    n, side = rows["n"].to_numpy(), rows["side"].to_numpy()
    ids = rows[["h", "p", "q"]]
    tile = np.cumsum((ids != ids.shift()).any(axis=1).to_numpy())
    one_sided = (rows["p"] == rows["q"]).to_numpy()
    at, step = np.arange(len(rows)), 1
    while len(at):
        at = at[at + step < len(rows)]
        other = at + step
        near = (tile[at] == tile[other]) & (100 * n[at] >= percent * n[other])
        at, other = at[near], other[near]
        meet = one_sided[at] | (side[at] != side[other])
        yield at[meet], other[meet]
        step += 1


def _may_link(maps: np.ndarray, widths: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray,
              percent: int) -> np.ndarray:
    """The rows of (i, j) that bitmaps allow: folded ones first, then whole ones."""
    few = np.flatnonzero(overlap_allowed(maps, widths, n, i, j, percent, WIDE))
    return few[overlap_allowed(maps, widths, n, i[few], j[few], percent)]


def with_partner(rows: pd.DataFrame, percent: int = PERCENT) -> pd.DataFrame:
    """The rows of whole tiles that sizes and bitmaps allow a link with a row of
    another component. Two rows known to have partners are not compared again."""
    n, comp, maps = (rows[c].to_numpy() for c in ("n", "component", "wide"))
    widths = rows["wide"].str.len().to_numpy()
    found = np.zeros(len(rows), dtype=bool)
    for i, j in tile_steps(rows, percent):
        wanted = (comp[i] != comp[j]) & ~(found[i] & found[j])
        i, j = i[wanted], j[wanted]
        k = _may_link(maps, widths, n, i, j, percent)
        found[i[k]] = found[j[k]] = True
    return rows[found].drop(columns="wide")


def similar_sets(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Exact intersection of two sorted arrays against the similarity."""
    if len(a) > len(b):
        a, b = b, a
    place = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[place] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def tile_forest(rows: pd.DataFrame, percent: int = PERCENT) -> pd.DataFrame:
    """Links (a, b) that join the components of whole tiles as far as exact
    intersections do: pairs already joined are skipped, so a tile gives fewer
    links than it has rows."""
    n, key, comp = (rows[c].to_numpy() for c in ("n", "key", "component"))
    ids = rows[["h", "p", "q"]]
    tile = np.cumsum((ids != ids.shift()).any(axis=1).to_numpy())
    # components of each tile by themselves, named by numbers
    root = pd.DataFrame({"tile": tile, "comp": comp}).groupby(["tile", "comp"]).ngroup().to_numpy()
    root = root.copy()
    sets = [np.frombuffer(s, dtype=np.uint64) for s in rows["set"]]
    maps = np.empty(len(sets), dtype=object)
    maps[:] = [bitmap(s, WIDE) for s in sets]
    widths = np.array([len(m) for m in maps], dtype=np.int64)
    starts = np.searchsorted(tile, tile, "left")
    ends = np.searchsorted(tile, tile, "right")
    out = []
    for i, j in tile_steps(rows, percent):
        wanted = root[i] != root[j]
        i, j = i[wanted], j[wanted]
        for k in _may_link(maps, widths, n, i, j, percent):
            x, y = i[k], j[k]
            if root[x] != root[y] and similar_sets(sets[x], sets[y], percent):
                part = root[starts[x] : ends[x]]
                part[part == root[x]] = root[y]
                out.append((min(key[x], key[y]), max(key[x], key[y])))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def by_tile(function: Callable[[pd.DataFrame], pd.DataFrame]
            ) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """``function`` of whole tiles, applied to a stream sorted by (h, p, q)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None  # the last tile so far may go on in the next batch
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if not len(batch):
                continue
            ids = batch[["h", "p", "q"]]
            last = (ids == ids.iloc[-1]).all(axis=1).to_numpy()
            rest = batch[last]
            yield function(batch[~last].reset_index(drop=True))
        if rest is not None:
            yield function(rest.reset_index(drop=True))

    return run


def allowed_pairs(pairs: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) whose sizes and wide bitmaps allow the similarity."""

    @F.pandas_udf("boolean")
    def allowed(n: pd.Series, x: pd.Series, m: pd.Series, y: pd.Series) -> pd.Series:
        maps, sizes = pd.concat([x, y]), pd.concat([n, m]).to_numpy()
        i = np.arange(len(n))
        return pd.Series(overlap_allowed(
            maps.to_numpy(), maps.str.len().to_numpy(), sizes, i, i + len(n), percent
        ))

    side = lambda p: classes.select(
        F.col("key").alias(p), F.col("n").alias("n_" + p), F.col("wide").alias("bits_" + p)
    )
    return (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .filter(allowed("n_a", "bits_a", "n_b", "bits_b")).select("a", "b")
    )


def shingle_classes(docs: DataFrame, last: np.ndarray) -> DataFrame:
    """(doc_id, n, key, prefix, wide) of every row; no prefix for empty sets."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def classes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.iloc[at : at + 1000]
                sets = list(shingle_sets(part["text"]))
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].to_numpy() if not part["doc_id"].isna().any()
                    else part["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None),
                    "n": [len(s) for s in sets],
                    "key": [set_key(s) for s in sets],
                    "prefix": [prefix(s, last).tobytes() if len(s) else None for s in sets],
                    "wide": [bitmap(s, WIDE) if len(s) else None for s in sets],
                })

    return docs.select("doc_id", "text").mapInPandas(
        classes, f"doc_id {id_type}, n long, key long, prefix binary, wide binary"
    )


def common_shingles(docs: DataFrame) -> np.ndarray:
    """Sorted hashes that begin many prefixes: those whose count reaches the lowest
    power of two that at most LAST hashes reach. Batches are counted before the
    shuffle; a bounded list reaches the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        none = np.zeros(0, dtype=np.uint64)
        held, size = [], 0

        def counted() -> pd.DataFrame:
            h, n = np.unique(np.concatenate([none, *held]), return_counts=True)
            return pd.DataFrame({"h": h.view(np.int64), "n": n.astype(np.int64)})

        for batch in batches:
            for s in shingle_sets(batch["text"]):
                if len(s):
                    held.append(prefix(s, none))
                    size += len(held[-1])
                if size > 1 << 21:
                    yield counted()
                    held, size = [], 0
        yield counted()

    often = stored(
        docs.select("text").mapInPandas(count, "h long, n long")
        .groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= OFTEN)
        .withColumn("level", F.floor(F.log2("n")).cast("int")),
        "often",
    )
    total, least = 0, None  # the lowest power of two that not too many counts reach
    for level, n in sorted(map(tuple, often.groupBy("level").count().collect()), reverse=True):
        total += n
        if total > LAST:
            break
        least = level
    h = np.zeros(0, dtype=np.int64)
    if least is not None:
        h = often.filter(F.col("level") >= least).select("h").toPandas()["h"].to_numpy(np.int64)
    discard(often)
    return np.sort(h.view(np.uint64))


def shared_only(rows: DataFrame) -> DataFrame:
    """Rows (h, key, n) whose h occurs with two keys or more. A sorted stream is
    compared with its neighbours, no group is held."""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = None  # the last row so far, and whether it is known to be shared
        held = None
        for batch in batches:
            if held is not None:
                batch = pd.concat([held, batch], ignore_index=True)
            if not len(batch):
                continue
            h = batch["h"].to_numpy()
            with_next = np.append(h[1:] == h[:-1], False)
            with_last = np.insert(h[1:] == h[:-1], 0, before is not None and before == h[0])
            shared = with_next | with_last
            before = h[-2] if len(h) > 1 else before
            held = batch.iloc[-1:]  # its successor is in the next batch
            yield batch[shared][:-1] if shared[-1] else batch[shared]
            tail_shared = bool(with_last[-1])
        if held is not None and tail_shared:
            yield held

    return (
        rows.repartition("h").sortWithinPartitions("h")
        .mapInPandas(keep, "h long, key long, n long")
    )


def distinct_tiles(shared: DataFrame) -> DataFrame:
    """One shingle (h) of all that have the same classes: near copies share about
    a hundred, which would bring the same pairs together again."""
    members = shared.groupBy("h").agg(
        F.bit_xor(F.xxhash64("key")).alias("x"),
        F.bit_xor(F.xxhash64("key", F.lit(1))).alias("y"),
        F.count("*").alias("members"),
    )
    return members.groupBy("x", "y", "members").agg(F.min("h").alias("h")).select("h")


def verified(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) whose exact intersection reaches the similarity. Only the
    sets that the pairs name are moved."""
    pairs = stored(pairs, "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    sets = stored(sets_of(docs, ends), "sets")

    @F.pandas_udf("boolean")
    def similar(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([
            similar_sets(np.frombuffer(p, dtype=np.uint64), np.frombuffer(q, dtype=np.uint64), percent)
            for p, q in zip(x, y)
        ], dtype=bool)

    side = lambda p: sets.select(F.col("key").alias(p), F.col("set").alias("set_" + p))
    found = stored(
        pairs.join(side("a"), "a").join(side("b"), "b")
        .filter(similar("set_a", "set_b"))
        .select("a", "b"),
        "links",
    )
    discard(pairs, sets)
    return found


def sets_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, set) of the given classes, computed from the texts again. A bit
    table of bounded size thins the rows before the exact join."""
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    slots = keys.select(F.pmod("key", F.lit(FILTER_BITS)).cast("int").alias("s")).select(
        (F.col("s") / 8).cast("int").alias("byte"),
        F.expr("shiftleft(1, s % 8)").alias("bit"),
    ).groupBy("byte").agg(F.bit_or("bit").alias("bits")).toPandas()
    bits[slots["byte"].to_numpy(dtype=int)] = slots["bits"].to_numpy(dtype=np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits.tobytes())

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = shared.value
        for batch in batches:
            out = {}
            for s in shingle_sets(batch["text"]):
                key = set_key(s)
                slot = key % FILTER_BITS
                if len(s) and wanted[slot >> 3] >> (slot & 7) & 1:
                    out[key] = s.tobytes()
                if len(out) >= 1000:
                    yield pd.DataFrame({"key": list(out), "set": list(out.values())})
                    out = {}
            yield pd.DataFrame({"key": list(out), "set": list(out.values())})

    return (
        docs.select("text").mapInPandas(find, "key long, set binary")
        .join(keys, "key", "left_semi")
        .groupBy("key").agg(F.first("set").alias("set"))
    )


def star_pairs(rows: DataFrame, step: int) -> DataFrame:
    """Distinct (a, b) of a tile's members and its centres in other components.

    ``rows``: (h, key, n, component). Centres are one member of the largest
    component, the smallest of the components' members and, in a tile of at
    least LARGE members, members of a few more components drawn by hash, other
    ones in each step."""
    drawn = F.struct(F.xxhash64("key", F.lit(step)).alias("x"), "n", "key", "component")
    parts = rows.groupBy("h", "component").agg(
        F.count("*").alias("members"), F.min(drawn).alias("one")
    )
    pick = lambda c: F.struct(*[c[x].alias(f"s_{x}") for x in ("n", "key", "component")])
    few = [pick(F.col("largest")["one"]), pick(F.col("smallest"))]
    centres = (
        parts.groupBy("h").agg(
            F.sum("members").alias("members"),
            F.max(F.struct("members", "one")).alias("largest"),
            F.min(F.struct("one.n", "one.key", "one.component")).alias("smallest"),
            *[F.min(F.struct(F.xxhash64("component", F.lit(step), F.lit(i)), "one")).alias(f"c{i}")
              for i in range(CENTRES)],
        )
        .select("h", F.explode(F.array_distinct(F.when(
            F.col("members") >= LARGE,
            F.array(*few, *[pick(F.col(f"c{i}")["one"]) for i in range(CENTRES)]),
        ).otherwise(F.array(*few)))).alias("s"))
        .select("h", "s.*")
    )
    return (
        rows.join(centres, "h")
        .filter((F.col("component") != F.col("s_component"))
                & (100 * F.least("s_n", "n") >= PERCENT * F.greatest("s_n", "n")))
        .select(F.least("key", "s_key").alias("a"), F.greatest("key", "s_key").alias("b"))
        .distinct()
    )


def tile_links(rows: DataFrame, classes: DataFrame, docs: DataFrame, block: int = BLOCK,
               percent: int = PERCENT) -> DataFrame:
    """Links (a, b) that join the components of ``rows``, (h, key, n, component), as
    far as all pairs that meet in a tile do.

    Tiles are cut into blocks of bounded numbers of classes and shingles, which meet in
    pairs. Bitmaps first leave the rows that may have a partner; only their sets are
    moved into the tiles, where each gives a forest of exact links, never pairs."""
    tiles = rows.groupBy("h").agg(
        F.count("*").alias("members"), F.sum("n").alias("shingles"),
        F.min("component").alias("c0"), F.max("component").alias("c1"),
    ).filter("c0 < c1").select("h", F.greatest(
        F.ceil(F.col("members") / block), F.ceil(F.col("shingles") / BLOCK_SHINGLES)
    ).cast("int").alias("blocks"))
    dealt = (
        rows.join(tiles, "h").join(classes.select("key", "wide"), "key")
        .withColumn("own", F.pmod(F.hash("key"), "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "h", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
            F.col("own").alias("side"), "key", "n", "component", "wide",
        )
    )

    def sorted_tiles(tiles: DataFrame) -> DataFrame:
        return tiles.repartition("h", "p", "q").sortWithinPartitions("h", "p", "q", "n", "key")

    schema = "h long, p int, q int, side int, key long, n long, component long"
    open_rows = stored(
        sorted_tiles(dealt).mapInPandas(by_tile(partial(with_partner, percent=percent)), schema),
        "partners",
    )
    sets = stored(sets_of(docs, open_rows.select("key").distinct()), "sets")
    found = stored(
        sorted_tiles(open_rows.join(sets, "key"))
        .mapInPandas(by_tile(partial(tile_forest, percent=percent)), "a long, b long").distinct(),
        "links",
    )
    discard(open_rows, sets)
    return found


def link(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, key, group, component_id) of every row: the class of
    its text, its group of linked classes and that group's smallest id."""
    last = common_shingles(docs)
    rows = stored(shingle_classes(docs, last), "shingles")
    words = rows.filter("n > 0")
    prefixes = words.groupBy("key", "n").agg(F.first("prefix").alias("prefix"))

    @F.pandas_udf("array<long>")
    def unpacked(packed: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(p, dtype=np.int64) for p in packed], dtype=object)

    shared = stored(
        shared_only(prefixes.select(F.explode(unpacked("prefix")).alias("h"), "key", "n")
                    .select("h", "key", "n")),
        "shared",
    )
    tiles = stored(shared.join(distinct_tiles(shared), "h", "left_semi"), "tiles")
    discard(shared)
    classes = stored(
        words.join(tiles.select("key").distinct(), "key", "left_semi").groupBy("key", "n")
        .agg(F.first("wide").alias("wide")),
        "classes",
    )

    near = star_pairs(tiles.withColumn("component", F.col("key")), 0)
    stars = verified(allowed_pairs(near, classes), docs)
    joined = stored(components(stars), "groups")
    left = (
        tiles.join(joined.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("component", F.coalesce("component", "key"))
    )
    links = stars.unionByName(tile_links(left, classes, docs))
    groups = stored(components(links), "groups")
    discard(tiles, classes, joined)

    lowest = rows.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("low"))
    merged = groups.withColumnRenamed("node", "key").join(lowest, "key")
    per_group = merged.groupBy("component").agg(F.min("low").alias("group_low"))
    final = (
        lowest.join(
            merged.join(per_group, "component").select("key", "component", "group_low"),
            "key", "left",
        )
        .select("key", F.coalesce("component", "key").alias("group"),
                F.coalesce("group_low", "low").alias("component_id"))
    )
    return (
        rows.select("doc_id", F.col("n").alias("n_shingles"), "key")
        .join(final, "key", "left")
        .select(
            "doc_id", "n_shingles", "key", "group",
            F.coalesce("component_id", "doc_id").alias("component_id"),
        )
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group of linked texts, with all its columns: the one
    with the smallest id. Documents without words all stay."""
    linked = stored(link(docs), "linked")
    chosen = (
        linked.filter("n_shingles > 0").groupBy("group")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("one"))
        .select(F.col("one.doc_id").alias("one_id"), F.col("one.key").alias("one_key"))
    )

    @F.pandas_udf("long")
    def key_of(texts: pd.Series) -> pd.Series:
        sets = shingle_sets(texts)
        return pd.Series([set_key(s) if len(s) else None for s in sets], dtype="Int64")

    own, rank = (unused(docs, x) for x in ("set_key", "rank"))
    # marked as not deterministic, or a filter on the key is moved below it as a second
    # call, which hashes each text twice, in two workers for each task
    keyed = docs.withColumn(own, key_of.asNondeterministic()("text"))
    first = Window.partitionBy("doc_id", own).orderBy(F.xxhash64(*docs.columns))
    return (
        keyed.filter(F.col(own).isNotNull())
        .join(
            chosen,
            keyed["doc_id"].eqNullSafe(chosen["one_id"]) & (keyed[own] == chosen["one_key"]),
            "left_semi",
        )
        .withColumn(rank, F.row_number().over(first))
        .filter(F.col(rank) == 1)
        .select(*docs.columns)
        .unionByName(keyed.filter(F.col(own).isNull()).select(*docs.columns))
    )
