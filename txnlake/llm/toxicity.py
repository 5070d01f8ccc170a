"""Toxicity by compression distance.

Two zstandard dictionaries are trained on a bounded sample of labelled texts,
one on toxic and one on ordinary windows. A window is a run of words, folded to
lower-case words with single spaces. Each window of a text is compressed under
both dictionaries: the bytes that the toxic one saves are the window's gain. How many
windows of a text reach each gain threshold is weighed by a logistic curve that
is calibrated on labelled texts the dictionaries have not seen.

A short window that hardly compresses would be stored raw and its gain lost, so
every window starts with a marker that both dictionaries end with.

Labels belong to whole texts while toxic passages are short, so the toxic
dictionary is trained on the windows of toxic texts that hold the words which
set these texts apart (by document frequency in both classes), and it ends with
those words, most distinctive last, as zstandard finds later content cheapest.

Edge cases: null and empty texts have no windows and score as a text without
gains; without labels of both kinds every text scores 0; repeated rows are
scored each; an empty table gives an empty result; whole texts are scored, in
windows of bounded size; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample

SAMPLE = 8_000  # labelled documents that the dictionaries are trained on, at most
WORDS = re.compile(r"[^\W_]+")
WINDOW = 64  # characters of folded text in a window, about
DICT_BYTES = 1 << 15
ORDINARY_BYTES = 1 << 13
TOXIC_BYTES = 1 << 12
LEVELS = range(1, 8)  # gain thresholds in bytes
MARK = bytes(range(1, 25))


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    weights: np.ndarray | None  # of the logistic curve; None: no labels


def windows(text: str | None, size: int = WINDOW) -> list[bytes]:
    """Folded text in windows that end between words (a longer word is a window)."""
    words = WORDS.findall((text or "").lower())
    if not words:
        return []
    folded = " " + " ".join(words) + " "
    out, at, end = [], 0, len(folded) - 1
    while at < end:
        stop = folded.rfind(" ", at + 1, at + size + 1)
        if stop <= at:
            stop = folded.find(" ", at + size)
        out.append(folded[at : stop + 1].encode())
        at = stop
    return out


def compressor(content: bytes):
    """A function from a window to its compressed length under a dictionary."""
    import zstandard as z

    params = z.ZstdCompressionParameters(
        format=z.FORMAT_ZSTD1_MAGICLESS, window_log=16, chain_log=16, hash_log=16, search_log=4,
        min_match=6, target_length=16, strategy=z.STRATEGY_GREEDY, write_content_size=0,
        write_checksum=0, write_dict_id=0,
    )
    data = z.ZstdCompressionDict(content + MARK, dict_type=z.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(compression_params=params)
    return z.ZstdCompressor(dict_data=data, compression_params=params).compress


def trained(samples: list[bytes], size: int) -> bytes:
    """The last ``size`` bytes of a dictionary trained on the samples (a trained
    dictionary ends with its most useful content)."""
    import zstandard as z

    try:
        return z.train_dictionary(DICT_BYTES, samples, k=64, d=6).as_bytes()[-size:]
    except (z.ZstdError, ValueError):  # too few samples to train on: they are the content
        return b"".join(samples)[-size:]


def gains(ordinary, toxic, text: str | None) -> np.ndarray:
    """Bytes saved by the toxic dictionary, for each window of a text."""
    marked = [MARK + w for w in windows(text)]
    return np.array([len(ordinary(w)) - len(toxic(w)) for w in marked], dtype=float)


def features(gain: np.ndarray) -> np.ndarray:
    n = len(gain)
    reached = [float((gain >= t).sum()) for t in LEVELS]
    return np.array([
        1.0, *np.log1p(reached), np.log1p(n), reached[2] / max(n, 1), reached[4] / max(n, 1)
    ])


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps on the regularised log-likelihood."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def telling_words(texts: list[list[str]], y: np.ndarray) -> dict[str, float]:
    """Words that set toxic texts apart, with their log-likelihood ratio.

    Counts are of distinct contexts (the words before and after), so that the
    copies of one text do not make its words look telling.
    """
    toxic_in, ordinary_in = Counter(), Counter()
    for words, label in zip(texts, y):
        (toxic_in if label else ordinary_in).update(set(words))
    a, b = y.sum(), len(y) - y.sum()
    rare = {w for w, n in toxic_in.items() if n >= 3 and n / a > 4 * ordinary_in[w] / b}
    contexts: dict[str, set] = {w: set() for w in rare}
    for words, label in zip(texts, y):
        if label:
            for i, w in enumerate(words):
                if w in rare:
                    contexts[w].add((words[i - 1] if i else "", *words[i + 1 : i + 2]))
    out, needed = {}, 2 * np.log(max(len(toxic_in), 2)) + 6
    for w, found in contexts.items():
        n, m = min(len(found), toxic_in[w]), ordinary_in[w]
        expected = (n + m) * a / (a + b)
        ratio = 2 * (n * np.log(max(n, 1e-9) / expected)
                     + (m * np.log(m / ((n + m) * b / (a + b))) if m else 0.0))
        if n > expected and ratio > needed:
            out[w] = ratio
    return out


def train(texts: list[str | None], labels: list[int]) -> Model:
    """Dictionaries on one half of the texts, threshold and curve on the other."""
    y = np.array(labels, dtype=float)
    if not 0 < y.sum() < len(y):
        return Model(b"", b"", None)
    # every other text of each class
    half = np.where(y == 1, np.cumsum(y == 1), np.cumsum(y == 0)) % 2 == 1
    texts = np.array(texts, dtype=object)
    marked = telling_words([WORDS.findall((t or "").lower()) for t in texts[half]], y[half])
    listed = b""
    for w in sorted(marked, key=lambda w: (-marked[w], w)):
        if len(listed) + len(w.encode()) + 1 > DICT_BYTES // 2:
            break
        listed = b" " + w.encode() + listed
    toxic = [
        b" " + b" ".join(x for x in w.split() if x.decode() in marked) + b" "
        for text, label in zip(texts[half], y[half]) if label
        for w in windows(text) if any(x.decode() in marked for x in w.split())
    ]
    ordinary = [w for text, label in zip(texts[half], y[half]) if not label for w in windows(text)]
    # both dictionaries know ordinary text, so only what is toxic makes a gain
    plain = trained(ordinary, ORDINARY_BYTES)
    telling = trained(toxic, TOXIC_BYTES) + listed + b" "
    # bytes that no text holds keep the ordinary content as far from the window
    # in one dictionary as in the other, so that it costs the same in both
    filler = np.random.default_rng(1).integers(0xF8, 0x100, len(telling), dtype=np.uint8)
    model = Model(plain + telling, plain + filler.tobytes(), None)
    a, b = compressor(model.ordinary), compressor(model.toxic)
    x = np.array([features(gains(a, b, t)) for t in texts[~half]])
    model.weights = fit_logistic(x, y[~half])
    return model


def score_texts(model: Model, texts) -> np.ndarray:
    if model.weights is None or not len(texts):
        return np.zeros(len(texts))
    a, b = compressor(model.ordinary), compressor(model.toxic)
    x = np.array([features(gains(a, b, t)) for t in texts])
    return 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of at most ``sample`` labelled training documents."""
    rows = labelled_sample(docs, labels, "toxic", sample).orderBy("id_").toPandas()
    return train(rows["text"].tolist(), rows["y"].tolist())


def score_column(text: Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(score_texts(model, texts.tolist()))

    return score(text)
