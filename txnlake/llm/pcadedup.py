"""Near-duplicates of embeddings by PCA-ordered tiled comparison.

Vectors are scaled to length 1 and rotated onto the principal axes of the whole
table (their second moments are summed by Spark), which gathers most of a dot
product in the first coordinates. Equal vectors are collapsed. The rest are dealt
to the nearest of some pivots, vectors drawn by their digest; these cells are
ordered along the first axes and packed into tiles of bounded size.

Two bounds skip work, neither can lose a link. Linked vectors are at most
sqrt(2 - 2t) apart, so a pair of tiles is skipped when the gap between their
leading coordinates is larger, and for x in the cell of pivot u and y in that of v

    (x.u - x.v) + (y.v - y.u) = (x - y).(u - v) <= |x - y| |u - v|

leaves of two cells the few vectors near their common border. For these, products
of the leading coordinates are taken, the rest of each product is bounded by the
norms of the two suffixes, and a pair is dropped when its bound is below the
threshold; where many are left, more coordinates are taken. All this is done in
single precision with a margin for its rounding. What is left is computed in full
from the given vectors in double precision.

Tiles meet in a Cartesian product of the stored table: nothing is shuffled, so
disk is in proportion to the input. A task holds a run of tiles and lets another
run pass, each tile's vectors come once. It returns how many links each vector has
to the others and a spanning forest of the links, at most one edge per vector: no
list of pairs, also for thousands of near copies.

Edge cases: vectors that are null, zero, or hold a null or non-finite component
have no links and are components of their own; vectors of different lengths never
link, each length is compared by itself; components of any finite size are scaled
before they are squared; repeated rows (same id and vector) are separate vectors; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, stored
from .graph import components

TILE = 16384  # vectors of a tile
TILE_BYTES = 8 << 20  # of a tile's vectors, for long vectors
CELLS = 8  # cells of a tile, fewer if its vectors are long
PIVOTS, PIVOT_BYTES = 16384, 16 << 20  # at most; beyond, cells grow
HELD_BYTES = 24 << 20  # of the tiles that a task holds
PASSING_BYTES = 512 << 20  # of those that pass it
AXES = 8  # coordinates that bound a tile
LEAD = 23  # coordinates of the first product
BLOCK = 512  # rows of a product
SLACK = 1e-6  # covers rounding in bounds; final cosines are compared exactly
BATCH_BYTES = 8 << 20
HEAVY, LIGHT, NONE = 0, 1, 2
POSITIONS = 1 << 32  # a vector is numbered by tile * POSITIONS + place in the tile


def matrices(column: pa.Array, dtype: type) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors) of the usable vectors of a list column, by length."""
    values = column.values.to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    starts = column.offsets.to_numpy()
    there = ~column.is_null().to_numpy(zero_copy_only=False)
    lengths = np.where(there, np.diff(starts), 0)
    for n in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == n)
        x = values[starts[rows][:, None] + np.arange(n)]
        good = np.isfinite(x).all(axis=1) & x.any(axis=1)
        yield rows[good], np.ascontiguousarray(x[good])


@contextmanager
def setting(spark: SparkSession, key: str, value: int) -> Iterator[None]:
    """The session's setting while tables are written."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def digest(vector: np.ndarray) -> bytes:
    return blake2b(vector, digest_size=16).digest()


def digest_words(digests: list[bytes]) -> np.ndarray:
    """Two 64-bit numbers of each digest."""
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = np.array(x, dtype=float)
    x /= np.maximum(x.max(axis=1), -x.min(axis=1))[:, None]
    x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    return x


def rounding(dim: int) -> float:
    """More than a dot product of unit vectors errs when it and their rotation are
    taken in single precision."""
    return (dim + 16) * (1 + dim**0.5) * 2.0**-23


class Tile:
    """Vectors made ready for comparison. They lie cell by cell: each cell begins
    at one of ``starts`` and has one of ``pivots``; any points will do."""

    def __init__(self, vectors: np.ndarray, axes: np.ndarray, starts: np.ndarray, pivots: np.ndarray):
        self.vectors, self.axes, self.starts, self.pivots = vectors, axes, starts, pivots
        self.ends = np.append(starts[1:], len(vectors))
        self.dim = vectors.shape[1]
        # unit vectors are single * scale
        self.single, self.scale = vectors, np.ones(len(vectors), dtype=np.float32)
        norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors, dtype=float))
        if vectors.dtype == np.float32 and norms.min() > 1e-30 and norms.max() < 1e30:
            self.scale /= norms.astype(np.float32)
        else:
            self.single = unit_rows(vectors).astype(np.float32)
        self.near = pivots.astype(np.float32)
        self.own = self.scale * np.concatenate([
            self.single[s:e] @ p for s, e, p in zip(starts, self.ends, self.near)
        ])
        self.leads = {}
        self.lead = self.leading(stops(self.dim)[0])

    def leading(self, k: int) -> np.ndarray:
        """The first k coordinates on the axes and at least the norm of the others."""
        if k not in self.leads:
            x = (self.single @ self.axes[:, :k].astype(np.float32)) * self.scale[:, None]
            rest = 1 - np.einsum("ij,ij->i", x, x) + np.float32(2 * rounding(self.dim))
            self.leads[k] = np.concatenate([x, np.sqrt(np.maximum(rest, 0))[:, None]], axis=1)
        return self.leads[k]

    def whole(self, rows: np.ndarray) -> np.ndarray:
        return self.single[rows] * self.scale[rows, None]

    def margins(self, other: Tile) -> tuple[np.ndarray, np.ndarray]:
        """For each cell of ``other`` and each vector how much nearer it is to its own
        pivot than to that cell's, and the least of these by cell."""
        m = self.own - (other.near @ self.single.T) * self.scale
        return m, np.minimum.reduceat(m, self.starts, axis=1)


def stops(dim: int) -> list[int]:
    """Numbers of leading coordinates that are tried, the last is all."""
    found = [LEAD]
    while found[-1] < dim:
        found.append(4 * found[-1])
    return [*found[:-1], dim]


def links_between(a: Tile, b: Tile, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into a and b) with cosine >= threshold, a block at a time; if b
    is a, only pairs i < j."""
    same, slack = a is b, rounding(a.dim) + SLACK
    ma, least_a = a.margins(b)
    mb, least_b = (ma, least_a) if same else b.margins(a)
    # linked unit vectors are at most sqrt(2 - 2t) apart
    apart = np.sqrt(((a.pivots[:, None, :] - b.pivots[None, :, :]) ** 2).sum(axis=2))
    most = np.sqrt(max(0.0, 2 - 2 * threshold) + SLACK) * apart + 4 * slack * (1 + apart)
    for u, v in np.argwhere(least_a.T + least_b <= most):
        if same and u > v:
            continue
        left, right, c = a.starts[u], b.starts[v], most[u, v]
        x, y = ma[v, left : a.ends[u]], mb[u, right : b.ends[v]]
        i = (x <= c - least_b[u, v]).nonzero()[0]
        j = (y <= c - least_a[v, u]).nonzero()[0]
        if same and u == v:
            blocks = [(i, j)]
        else:  # the two margins add up to c at most: the larger one, the less the other
            bands = 2 if len(i) * len(j) < 1 << 19 else 4
            band, y = np.clip(x.take(i) * (bands / c), 0, bands).astype(np.int8), y.take(j)
            blocks = [
                (i[band == k], j[y <= c * (1 - k / bands) + SLACK] if k else j)
                for k in range(bands + 1)
            ]
        for rows, q in blocks:
            if not len(rows) or not len(q):
                continue
            rows, q = rows + left, q + right
            lead = b.lead.take(q, axis=0).T
            for part in _parts(len(rows), BLOCK):
                p = rows[part]
                bound = a.lead.take(p, axis=0) @ lead
                if bound.max() < threshold - slack:
                    continue
                found = _linked(a, b, p, q, bound, threshold, slack)
                if same and u == v:
                    keep = found[0] < found[1]
                    found = found[0][keep], found[1][keep]
                if len(found[0]):
                    yield found


def _linked(a: Tile, b: Tile, i: np.ndarray, j: np.ndarray, bound: np.ndarray,
            threshold: float, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """The linked pairs of vectors ``i`` of a and ``j`` of b, whose cosines are at
    most ``bound``."""
    for k in stops(a.dim):
        if k == a.dim:
            bound = a.whole(i) @ b.whole(j).T
        elif k > LEAD:
            bound = a.leading(k)[i] @ b.leading(k)[j].T
        hit = bound >= threshold - slack
        n = np.count_nonzero(hit)
        if 64 * n <= hit.size:
            break
    if not n:
        return i[:0], j[:0]
    p, q = np.nonzero(hit)
    # products in full leave only those near the threshold in doubt
    sure = bound[p, q] > threshold + slack if k == a.dim else np.zeros(n, dtype=bool)
    p, q = i[p], j[q]
    doubt = np.flatnonzero(~sure)
    for piece in _parts(len(doubt), max(1, (1 << 19) // a.dim)):
        at = doubt[piece]
        sure[at] = cosines(a.vectors[p[at]], b.vectors[q[at]], threshold) >= threshold
    return p[sure], q[sure]


def cosines(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Of each row of a with the same row of b, in double precision."""
    exact = np.einsum("ij,ij->i", unit_rows(a), unit_rows(b))
    near = np.abs(exact - threshold) < 1e-12
    if near.any():  # on the edge: the plain formula decides
        va, vb = a[near].astype(float), b[near].astype(float)
        with np.errstate(all="ignore"):
            plain = (va * vb).sum(axis=1) / (
                np.sqrt((va * va).sum(axis=1)) * np.sqrt((vb * vb).sum(axis=1))
            )
        # squares beyond the range of doubles: the scaled value stands
        exact[near] = np.where(np.isfinite(plain), plain, exact[near])
    return exact


def tile_links(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float,
               same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (into a and b) with cosine >= threshold; ``same``: a is b, and
    only pairs i < j are returned."""
    one = lambda x: Tile(x, axes, np.array([0]), np.zeros((1, x.shape[1])))
    left = one(a)
    found = list(links_between(left, left if same else one(b), threshold))
    empty = np.zeros(0, dtype=np.int64)
    return np.concatenate([empty, *(p for p, _ in found)]), np.concatenate(
        [empty, *(q for _, q in found)]
    )


def _parts(n: int, size: int = 1 << 16):
    return [slice(s, s + size) for s in range(0, n, size)]


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest index of each node's component among n nodes."""
    label = np.arange(n)
    while True:
        before = label
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        label = low[low]
        label = label[label]
        if (label == before).all():
            return label


class Tally:
    """Links and components of the vectors of several tiles, as pairs come in."""

    def __init__(self):
        self.first: dict[int, int] = {}  # of each tile's places
        self.n = self.n_open = 0
        self.numbers = self.copies = self.links = self.label = np.zeros(0, dtype=np.int64)
        self.open: list[tuple[np.ndarray, np.ndarray]] = []

    def places(self, tile: int, copies: np.ndarray) -> int:
        if tile not in self.first:
            n, end = self.n, self.n + len(copies)
            if end > len(self.label):
                more = np.zeros(2 * end - len(self.label), dtype=np.int64)
                self.numbers, self.copies, self.links = (
                    np.concatenate([x, more]) for x in (self.numbers, self.copies, self.links)
                )
                self.label = np.concatenate([self.label, np.arange(len(self.label), 2 * end)])
            self.first[tile], self.n = n, end
            self.numbers[n:end] = tile * POSITIONS + np.arange(len(copies))
            self.copies[n:end] = copies
        return self.first[tile]

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        np.add.at(self.links, i, self.copies[j])
        np.add.at(self.links, j, self.copies[i])
        apart = self.label[i] != self.label[j]
        self.open.append((i[apart], j[apart]))
        self.n_open += int(apart.sum())
        if self.n_open > 1 << 18 or len(self.open) > 4096:
            self.join()

    def join(self) -> None:
        if self.n_open:
            i, j = (self.label[np.concatenate(x)] for x in zip(*self.open))
            nodes, at = np.unique(np.concatenate([i, j]), return_inverse=True)
            low = np.arange(len(self.label))
            low[nodes] = nodes[forest(at[: len(i)], at[len(i) :], len(nodes))]
            self.label = low[self.label]
        self.open, self.n_open = [], 0


def near_duplicates(table: DataFrame, threshold: float = 0.95, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row. Thresholds above 0."""
    table = table.select("vec_id", "embedding")
    single = isinstance(table.schema["embedding"].dataType.elementType, T.FloatType)
    dtype = np.float32 if single else float
    if not single:
        table = table.withColumn("embedding", F.col("embedding").cast("array<double>"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.full(batch.num_rows, None, dtype=object)
            sizes = np.zeros(batch.num_rows, dtype=np.int32)
            for rows, x in matrices(batch.column("embedding"), dtype):
                for r, v in zip(rows, x):
                    names[r] = digest(v)
                sizes[rows] = x.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(names, pa.binary()), pa.array(sizes)],
                ["vec_id", "digest", "size"],
            )

    kind = table.schema["vec_id"].dataType.simpleString()
    rows = table.mapInArrow(keyed, f"vec_id {kind}, digest binary, size int")
    lengths = (
        rows.filter("size > 0").groupBy("size")
        .agg(F.approx_count_distinct("digest").alias("n")).orderBy("size").collect()
    )
    noted = [_of_one_length(table, r["size"], r["n"], dtype, threshold, tile) for r in lengths]
    found = rows.filter("size = 0").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    if noted:
        classes = noted[0]
        for more in noted[1:]:
            classes = classes.unionByName(more)
        found = found.unionByName(
            rows.filter("size > 0").join(classes, "digest", "left").select(
                "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("component_id", "vec_id").alias("component_id"),
            )
        )
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _distinct(batch: pa.RecordBatch, dim: int, dtype: type):
    """(digests, vectors, copies, lowest ids) of a batch's usable vectors of ``dim``
    components, equal ones once."""
    for rows, x in matrices(batch.column("embedding"), dtype):
        if x.shape[1] != dim or not len(x):
            continue
        found = pa.table({
            "digest": pa.array([digest(v) for v in x], pa.binary()),
            "low": batch.column("vec_id").take(pa.array(rows)), "at": np.arange(len(x)),
        }).group_by("digest", use_threads=False).aggregate(
            [("at", "min"), ("at", "count"), ("low", "min")]
        )
        names, copies, low = (
            found[c].combine_chunks() for c in ("digest", "at_count", "low_min")
        )
        yield names, x[found["at_min"].to_numpy()], copies, low


def principal_axes(table: DataFrame, dim: int, dtype: type) -> np.ndarray:
    """Axes of the second moments of all unit vectors, largest first. Each task
    gives one matrix, the sum is one row."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            for _, x, _, _ in _distinct(batch, dim, dtype):
                x = unit_rows(x)
                total += x.T @ x
        for i in range(dim):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(dim, i), pa.int32()), pa.array(np.arange(dim), pa.int32()),
                 pa.array(total[i])], ["i", "j", "x"],
            )

    rows = (
        table.mapInArrow(moments, "i int, j int, x double").groupBy("i", "j")
        .agg(F.sum("x").alias("x")).collect()  # dim * dim numbers
    )
    total = np.zeros((dim, dim))
    for r in rows:
        total[r.i, r.j] = r.x
    _, axes = np.linalg.eigh(total)
    return axes[:, ::-1].copy()


def _pivots(table: DataFrame, dim: int, dtype: type, share: float) -> np.ndarray:
    """Unit vectors of the share of classes with the smallest second half of a digest."""
    limit = min(int(share * 2.0**64), 2**64 - 1)

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, x, _, _ in _distinct(batch, dim, dtype):
                at = np.flatnonzero(digest_words(names.to_pylist())[:, 1] < np.uint64(limit))
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(at)), pa.array([x[r].tobytes() for r in at], pa.binary())],
                    ["digest", "vector"],
                )

    found = (
        table.mapInArrow(drawn, "digest binary, vector binary").dropDuplicates(["digest"])
        .orderBy("digest").collect()
    )
    if not found:
        return np.zeros((1, dim))  # one cell
    return unit_rows(np.stack([np.frombuffer(r.vector, dtype=dtype) for r in found]))


def _cells(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The pivot nearest to each vector, up to rounding."""
    found = [np.zeros(0, dtype=np.int64)]
    for part in _parts(len(x), max(1, (4 << 20) // max(pivots.shape))):
        found.append(np.argmax(unit_rows(x[part]).astype(np.float32) @ pivots.T, axis=1))
    return np.concatenate(found)


def _packed(counts: np.ndarray, places: np.ndarray, cell: int, tile: int):
    """Cells of ``counts`` vectors, ordered by their ``places`` on two axes, in tiles:
    (first piece, number of pieces) of each cell, tile of each piece."""
    strips = max(1, round(np.sqrt(counts.sum() / tile)))
    rank = np.empty(len(counts), dtype=np.int64)
    rank[np.argsort(places[:, 0], kind="stable")] = np.arange(len(counts))
    order = np.lexsort((places[:, 1], rank * strips // len(counts)))
    pieces = np.maximum(1, -(-counts // min(2 * cell, tile)))
    first = np.empty(len(counts), dtype=np.int64)
    first[order] = np.cumsum(pieces[order]) - pieces[order]
    sizes = np.repeat((counts / pieces)[order], pieces[order])
    return first, pieces, ((np.cumsum(sizes) - sizes / 2) // tile).astype(np.int32)


def _of_one_length(
    table: DataFrame, dim: int, n: int, dtype: type, threshold: float, tile: int
) -> DataFrame:
    """(digest, n_links, component_id) of the vectors of ``dim`` components that have
    copies or links; n: how many there are, about."""
    width = dim * np.dtype(dtype).itemsize
    cell = max(1, tile // CELLS)
    tile = min(tile, max(256, TILE_BYTES // width))
    axes = principal_axes(table, dim, dtype)
    many = min(n // cell, PIVOTS, max(1, PIVOT_BYTES // (4 * dim)))
    pivots = _pivots(table, dim, dtype, many / n) if many > 1 else np.zeros((1, dim))
    single = pivots.astype(np.float32)
    kind = table.schema["vec_id"].dataType.simpleString()

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, x, _, _ in _distinct(batch, dim, dtype):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_cells(x, single), pa.int32()), names], ["cell", "digest"]
                )

    counts = np.zeros(len(pivots), dtype=np.int64)
    for r in (
        table.mapInArrow(placed, "cell int, digest binary").groupBy("cell")
        .agg(F.approx_count_distinct("digest").alias("n")).collect()  # a row per pivot
    ):
        counts[r["cell"]] = r["n"]
    first, pieces, tile_of = _packed(counts, pivots @ axes[:, [0, min(1, dim - 1)]], cell, tile)
    order = np.argsort(first)
    cell_of = np.repeat(order, pieces[order])  # of each piece

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, x, copies, low in _distinct(batch, dim, dtype):
                c = _cells(x, single)
                words = digest_words(names.to_pylist())[:, 0]
                piece = first[c] + (words % pieces[c].astype(np.uint64)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tile_of[piece]), pa.array(piece), names,
                     pa.array([v.tobytes() for v in x], pa.binary()), copies, low],
                    ["tile", "piece", "digest", "vector", "copies", "low"],
                )

    def build(group: pa.Table) -> pa.Table:
        found = group.append_column("at", pa.array(np.arange(len(group)))).group_by(
            "digest", use_threads=False
        ).aggregate([("at", "min"), ("copies", "sum"), ("low", "min")])
        piece = group["piece"].to_numpy()[found["at_min"].to_numpy()]
        order = np.argsort(piece, kind="stable")
        found = found.take(pa.array(order))
        own, starts = np.unique(piece[order], return_index=True)
        joined = b"".join(group["vector"].take(found["at_min"]).to_pylist())
        lead = unit_rows(np.frombuffer(joined, dtype=dtype).reshape(-1, dim)) @ axes[:, :AXES]
        return pa.table({
            "tile": group["tile"][:1].cast(pa.int32()),
            "low": [lead.min(axis=0)], "high": [lead.max(axis=0)],
            "starts": [starts.astype(np.int64).tobytes()], "pivots": [pivots[cell_of[own]].tobytes()],
            "vectors": [joined], "copies": [found["copies_sum"].to_numpy().tobytes()],
            "digests": [b"".join(found["digest"].to_pylist())],
            "ids": pa.ListArray.from_arrays([0, len(found)], found["low_min"].combine_chunks()),
        })

    tiles = stored(
        table.mapInArrow(
            dealt, f"tile int, piece long, digest binary, vector binary, copies long, low {kind}"
        ).groupBy("tile").applyInArrow(
            build, "tile int, low array<double>, high array<double>, starts binary, pivots binary, "
            f"vectors binary, copies binary, digests binary, ids array<{kind}>"
        ),
        "tiles", compression="none",
    )
    # a batch of rows is held several times on its way to Python: a tile or two at once
    with setting(table.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES):
        linked = stored(_compared(tiles, axes, dim, dtype, threshold, n * width), "links")
    edges = linked.filter(F.col("node") != F.col("root")).select("node", "root")
    marked = linked.groupBy("node").agg(F.sum("links").alias("links")).join(
        components(edges, "node", "root"), "node"
    )

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                copies = np.frombuffer(batch.column("copies")[r].as_buffer(), dtype=np.int64)
                names = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(16), len(copies), [None, batch.column("digests")[r].as_buffer()]
                )
                node = batch.column("tile")[r].as_py() * POSITIONS + np.arange(len(copies))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), names.cast(pa.binary()), pa.array(copies),
                     batch.column("ids")[r].values], ["node", "digest", "copies", "low"],
                )

    noted = stored(
        tiles.select("tile", "copies", "digests", "ids")
        .mapInArrow(classes, f"node long, digest binary, copies long, low {kind}")
        .join(marked, "node", "left").filter("copies > 1 or links is not null")
        .select(
            "digest", "low", F.coalesce("component", "node").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "classes",
    )
    discard(tiles, linked)
    lowest = noted.groupBy("component").agg(F.min("low").alias("component_id"))
    # equal vectors are in one tile unless rounding placed them apart: then as linked ones
    return noted.join(lowest, "component").groupBy("digest").agg(
        F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id")
    )


def _compared(
    tiles: DataFrame, axes: np.ndarray, dim: int, dtype: type, threshold: float, size: int
) -> DataFrame:
    """(node, links, root) of each pair of runs of tiles; a run is a partition of the
    stored table. A task holds one run and lets a longer one pass, tile by tile.
    ``size``: bytes of all vectors, about."""
    spark = tiles.sparkSession
    slots = spark.sparkContext.defaultParallelism
    runs = max(size // HELD_BYTES, int(np.sqrt(4 * slots))) + 1
    held = tiles.coalesce(runs)
    passing = tiles.coalesce(max(size // PASSING_BYTES, 16 * slots // runs) + 1)
    places = held.select("tile", F.monotonically_increasing_id()).collect()  # a row per tile
    ranks = F.broadcast(spark.createDataFrame([tuple(p) for p in places], "tile int, rank long"))
    sent = ["starts", "pivots", "vectors", "copies"]

    def side(run: DataFrame, p: str) -> DataFrame:
        """A run's rows: one of no tile, then each tile with its vectors and without."""
        first = F.monotonically_increasing_id() % (1 << 33) == 0
        kinds = F.when(first, F.array(*map(F.lit, (NONE, HEAVY, LIGHT)))).otherwise(
            F.array(F.lit(HEAVY), F.lit(LIGHT))
        )
        df = run.join(ranks, "tile").withColumn("kind", F.explode(kinds))
        return df.select(
            *[F.col(c).alias(f"{p}_{c}") for c in ("tile", "rank", "kind")],
            *[F.when(F.col("kind") == LIGHT, F.col(c)).alias(f"{p}_{c}") for c in ("low", "high")],
            *[F.when(F.col("kind") == HEAVY, F.col(c)).alias(f"{p}_{c}") for c in sent],
        )

    gap = F.aggregate(
        F.zip_with(
            F.zip_with("a_low", "b_high", lambda p, q: p - q),
            F.zip_with("b_low", "a_high", lambda p, q: p - q),
            lambda p, q: F.greatest(p, q, F.lit(0.0)),
        ),
        F.lit(0.0),
        lambda total, d: total + d * d,
    )
    a_kind, b_kind, a_rank, b_rank = map(F.col, ("a_kind", "b_kind", "a_rank", "b_rank"))
    # unit vectors with cosine c are sqrt(2 - 2c) apart; a larger gap rules a pair out
    meet = (a_kind == LIGHT) & (b_kind == LIGHT) & (a_rank <= b_rank) & (
        gap <= 2 - 2 * threshold + SLACK
    )
    # the run that is held comes first, then each tile that passes, if it is not of a later run
    comes = (a_kind == NONE) & (b_kind == HEAVY) | (a_kind == HEAVY) & (b_kind == NONE) & (
        F.shiftright(a_rank, 33) <= F.shiftright(b_rank, 33)
    )
    pairs = side(passing, "a").hint("shuffle_replicate_nl").join(
        side(held, "b"), comes | meet
    ).select(
        F.when(a_kind != NONE, F.col("a_tile")).alias("a_tile"),
        F.when(b_kind != NONE, F.col("b_tile")).alias("b_tile"),
        *[F.coalesce(f"a_{c}", f"b_{c}").alias(c) for c in sent],
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: dict[int, tuple[Tile, np.ndarray]] = {}
        passing, tally = None, Tally()
        for batch in batches:
            named = [batch.column(c).to_pylist() for c in ("a_tile", "b_tile")]
            for r, (a, b) in enumerate(zip(*named)):
                if a is None or b is None:
                    starts, pivots, vectors, copies = (
                        np.frombuffer(batch.column(c)[r].as_buffer(), dtype=kind)
                        for c, kind in zip(sent, (np.int64, float, dtype, np.int64))
                    )
                    tile = Tile(vectors.reshape(-1, dim), axes, starts, pivots.reshape(-1, dim))
                    if a is None:
                        given[b] = tile, copies
                    else:
                        passing = a, tile, copies
                    continue
                other, copies = given[b]
                if a == b:
                    tile, own = other, copies
                else:
                    name, tile, own = passing
                    assert name == a
                at_a, at_b = tally.places(a, own), tally.places(b, copies)
                for i, j in links_between(tile, other, threshold):
                    tally.add(i + at_a, j + at_b)
        given = passing = tile = other = batch = None  # the worker goes on to other tasks
        pa.default_memory_pool().release_unused()
        tally.join()
        at = np.flatnonzero(tally.links[: tally.n])
        for part in _parts(len(at)):
            n = at[part]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (tally.numbers[n], tally.links[n], tally.numbers[tally.label[n]])],
                ["node", "links", "root"],
            )

    return pairs.mapInArrow(compare, "node long, links long, root long")
