"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a text are computed inside Arrow batches. Training bins them at
quantiles, sums gradients per bin and grows complete trees of a fixed depth, so
a tree flattens into three arrays and a batch is scored by a few numpy steps a
level. Training takes a bounded sample of labelled rows (``SAMPLE``); scoring
covers every row in one narrow pass.

Edge cases: null and empty texts have the same (zero) statistics and get a
score like any other; without labels every text scores 0.5, with labels of one
kind the score is the prior; repeated rows are scored each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample

SAMPLE = 20_000  # labelled documents the trees are grown on, at most
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
SPACES = b" \t\n\r\x0b\x0c"
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
MARKS = b".,;:!?'\"()-"


def statistics(text: str | None) -> list[float]:
    """Numbers that describe a whole text; all zero for an empty one."""
    data = (text or "").encode()
    size = len(data)
    if not size:
        return [0.0] * N_STATISTICS
    words = data.split()
    n = len(words)
    counts = Counter(words)
    kinds = len(counts)
    lines = [x for x in data.split(b"\n") if x.strip()]
    n_lines = len(lines)
    without = lambda drop: size - len(data.translate(None, drop))
    letters, spaces, digits = without(LETTERS), without(SPACES), without(DIGITS)
    marks = without(MARKS)
    symbols = size - letters - spaces - digits - marks
    chars = max(n, 1)
    most = counts.most_common(1)[0][1] if n else 0
    return [
        np.log1p(size),
        np.log1p(n),
        (size - spaces) / chars,
        kinds / chars,
        most / chars,
        letters / size,
        without(UPPER) / size,
        digits / size,
        marks / size,
        symbols / size,
        spaces / size,
        np.log1p(n_lines),
        len(set(lines)) / max(n_lines, 1),
        n / max(n_lines, 1),
        len(zlib.compress(data, 1)) / size,
        data.count(b".") / chars,
        data.count(b"http") / chars,
        max(map(len, counts), default=0),
    ]


N_STATISTICS = 18


@dataclass
class Trees:
    """Complete trees: inner node k has the children 2k+1 and 2k+2."""

    feature: np.ndarray  # (trees, 2**depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # (trees, 2**depth)
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        depth = (inner + 1).bit_length() - 1
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += leaf[node - inner]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def train(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15,
          bins: int = 64, ridge: float = 1.0, least: float = 2.0) -> Trees:
    """Boosted trees for the logistic loss, grown level by level from histograms."""
    inner, leaves = 2**depth - 1, 2**depth
    n, d = x.shape if x.ndim == 2 else (0, N_STATISTICS)
    positive = float(y.sum())
    prior = float(np.log((positive + 0.5) / (n - positive + 0.5)))
    if not 0 < positive < n:
        none = np.zeros((0, inner))
        return Trees(none.astype(int), none, np.zeros((0, leaves)), prior)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(d)], axis=1)
    column = np.arange(d) * bins
    margin = np.full(n, prior)
    all_f, all_t, all_leaf = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        feature = np.zeros(inner, dtype=np.int64)
        threshold = np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            slot = ((node - first)[:, None] * (d * bins) + column + binned).ravel()
            shape = (width, d, bins)
            hist = [
                np.bincount(slot, np.repeat(v, d), width * d * bins).reshape(shape).cumsum(axis=2)
                for v in (g, h)
            ]
            gl, hl = hist
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            gain[(hl < least) | (ht - hl < least)] = -1
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                j, b = divmod(int(best[k]), bins)
                if gain[k, j, b] > 1e-9 and b < len(edges[j]):
                    feature[first + k], threshold[first + k] = j, edges[j][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        at = node - inner
        leaf = -rate * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + ridge)
        margin += leaf[at]
        all_f.append(feature)
        all_t.append(threshold)
        all_leaf.append(leaf)
    return Trees(np.array(all_f), np.array(all_t), np.array(all_leaf), prior)


def statistics_column(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def describe(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts], dtype=object)

    return describe(text)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees of at most ``sample`` labelled documents; the statistics are
    computed by Spark, the driver gets ``sample`` short rows at most."""
    rows = (
        labelled_sample(docs, labels, "quality", sample)
        .select("id_", "y", statistics_column(F.col("text")).alias("x"))
        .orderBy("id_")
        .toPandas()
    )
    return train(
        np.array(rows["x"].tolist(), dtype=float).reshape(-1, N_STATISTICS),
        rows["y"].to_numpy(dtype=float),
    )


def score_column(text: Column, trees: Trees) -> Column:
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(t) for t in texts], dtype=float).reshape(-1, N_STATISTICS)
        return pd.Series(trees.probability(x))

    return score(text)
