"""Language model scores from a hidden Markov model.

Words are emitted through word classes: a short word (up to ``SHORT`` bytes) is
its own class, a longer one goes by its last ``SUFFIX`` bytes, both hashed into
a fixed number of classes, so a state's emission table has the same size for any
corpus. Within its class a word has the add-one-half share of its count over the
whole training corpus, with one share for the unknown words of the class:
P(word | state) = P(class | state) * P(word | class). The end of a text is a
class of its own.

Baum-Welch: starting values come from a bounded sample of training texts
(``START`` texts); each full pass then sums the expected counts of all training
texts per partition and by Spark over partitions, and only the summed tables (as
large as the model) reach the driver. Texts are trained on in windows of
``SPAN`` tokens.

Scoring is exact for whole texts: the scaled forward recursion runs over all
tokens. A text above ``SCORED_SPAN`` tokens is cut into spans that run side by side,
each from every state, and the spans' matrices are multiplied in order.

Word counts grow with the corpus and are never collected: the ``COMMON`` most
frequent words (a bounded table) are looked up in the tasks, all others are
joined by word.

Edge cases: null and empty texts are one end token; a null id belongs to the
training part; without training texts all tokens are unknown; repeated rows are
scored each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fold, stored

CLASSES = 8192
SHORT, SUFFIX = 4, 3
STATES = 8
START = 1_000
COMMON = 1 << 17
SPAN = 256  # tokens of a training window
SCORED_SPAN = 1024  # tokens of a span in scoring
SMOOTH = 0.02


@dataclass
class Model:
    first: np.ndarray  # (K,) state of a text's first token
    step: np.ndarray  # (K, K)
    emit: np.ndarray  # (CLASSES + 1, K): P(class | state); the last row is the end


def tokens(text: str | None) -> list[bytes]:
    """Words of the text with A-Z in lower case (ASCII white space separates)."""
    return (text or "").encode().lower().split()


def word_class(word: bytes) -> int:
    return crc32(word if len(word) <= SHORT else b"~" + word[-SUFFIX:]) % CLASSES


def word_class_column(word: Column) -> Column:
    """The same for a binary column."""
    key = F.when(F.length(word) <= SHORT, word).otherwise(
        F.concat(F.lit(b"~"), F.substring(word, -SUFFIX, SUFFIX))
    )
    return (F.crc32(key) % CLASSES).cast("int")


class Classes(dict):
    """Classes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        c = word_class(word)
        if len(self) < 1 << 18:
            self[word] = c
        return c


def spans_of(words: list[bytes], classes: Classes, size: int = SPAN) -> list[np.ndarray]:
    """Class numbers of a text's tokens and its end, in spans."""
    ids = np.fromiter(map(classes.__getitem__, words), dtype=np.int32, count=len(words))
    ids = np.append(ids, np.int32(CLASSES))
    return [ids[i : i + size] for i in range(0, len(ids), size)]


def _padded(spans: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Spans as columns of one array (time, row), longest first, and how many
    rows are still running at each time."""
    lengths = np.array([len(s) for s in spans])
    grid = np.full((len(spans), lengths.max()), CLASSES, dtype=np.int32)
    mask = np.arange(grid.shape[1])[None, :] < lengths[:, None]
    grid[mask] = np.concatenate(spans)
    running = mask.sum(axis=0)
    return grid.T.copy(), running


def forward(start: np.ndarray, spans: list[np.ndarray], model: Model, keep: bool = False):
    """Scaled forward recursion over rows at once; spans longest first.

    ``start`` (rows, K) is the state distribution at each span's first token.
    Returns the last scaled row vectors, their log scale and, if ``keep``, all
    row vectors by time with their running counts.
    """
    grid, running = _padded(spans)
    rows, k = start.shape
    last, scale = np.empty((rows, k)), np.zeros(rows)
    state, kept = start, []
    for t, n in enumerate(running):
        state = (state if t == 0 else state[:n] @ model.step) * model.emit[grid[t, :n]]
        total = state.sum(axis=1)
        state /= total[:, None]
        scale[:n] += np.log(total)
        after = running[t + 1] if t + 1 < len(running) else 0
        last[after:n] = state[after:]
        if keep:
            kept.append(state)
    return (last, scale, kept, grid, running) if keep else (last, scale)


def log10_likelihood(texts_spans: list[list[np.ndarray]], model: Model) -> np.ndarray:
    """Exact log10 P(classes of the text) for each text, from its spans."""
    k = len(model.first)
    spans, starts, owners = [], [], []
    for i, parts in enumerate(texts_spans):
        for p, part in enumerate(parts):
            # a first span starts from the first-state distribution, a later one
            # from each state in turn
            begin = model.first[None, :] if p == 0 else model.step
            for row in begin:
                spans.append(part)
                starts.append(row)
                owners.append(i)
    order = sorted(range(len(spans)), key=lambda r: -len(spans[r]))
    last, scale = np.empty((len(spans), k)), np.empty(len(spans))
    for at in range(0, len(order), 2048):
        chosen = order[at : at + 2048]
        last[chosen], scale[chosen] = forward(
            np.array([starts[r] for r in chosen]), [spans[r] for r in chosen], model
        )
    out, row = np.empty(len(texts_spans)), 0
    for i, parts in enumerate(texts_spans):
        state, log = last[row], scale[row]
        row += 1
        for _ in parts[1:]:
            lift = scale[row : row + k].max()
            state = (state * np.exp(scale[row : row + k] - lift)) @ last[row : row + k]
            total = state.sum()
            state, log = state / total, log + lift + np.log(total)
            row += k
        out[i] = log / np.log(10)  # a row's last vector sums to one
    return out


@dataclass
class Counts:
    """Expected counts of a Baum-Welch pass."""

    first: np.ndarray
    step: np.ndarray
    emit: np.ndarray

    @classmethod
    def zero(cls, k: int) -> Counts:
        return cls(np.zeros(k), np.zeros((k, k)), np.zeros((CLASSES + 1, k)))

    def add(self, spans: list[np.ndarray], firsts: np.ndarray, model: Model) -> None:
        """Forward and backward over windows; ``firsts`` marks texts' first windows."""
        order = sorted(range(len(spans)), key=lambda r: -len(spans[r]))
        k = len(model.first)
        usual = np.linalg.matrix_power(model.step, 64).mean(axis=0)  # inside a text
        for at in range(0, len(order), 2048):
            chosen = order[at : at + 2048]
            begins = firsts[chosen]
            start = np.where(begins[:, None], model.first, usual)
            _, _, alpha, grid, running = forward(start, [spans[r] for r in chosen], model, True)
            beta = np.ones((len(chosen), k))
            gammas = [None] * len(running)
            for t in range(len(running) - 1, -1, -1):
                n = running[t]
                gamma = alpha[t] * beta[:n]
                gamma /= gamma.sum(axis=1, keepdims=True)
                gammas[t] = gamma
                if t == 0:
                    self.first += gamma[begins].sum(axis=0)
                    break
                ahead = model.emit[grid[t, :n]] * beta[:n]
                back = ahead @ model.step.T
                # P(state before, state now) for each row, summed over rows
                weight = (alpha[t - 1][:n] * back).sum(axis=1)
                self.step += model.step * ((alpha[t - 1][:n] / weight[:, None]).T @ ahead)
                beta[:n] = back / weight[:, None]
            seen = np.concatenate([grid[t, :n] for t, n in enumerate(running)])
            gamma = np.concatenate(gammas)
            for s in range(k):
                self.emit[:, s] += np.bincount(seen, gamma[:, s], CLASSES + 1)

    def model(self) -> Model:
        smooth = lambda x, c: (x + c) / (x + c).sum(axis=-1, keepdims=True)
        emit = self.emit + SMOOTH
        return Model(smooth(self.first, 0.5), smooth(self.step, 0.5), emit / emit.sum(axis=0))


def starting_model(texts: list[str | None], states: int, passes: int = 12, seed: int = 7) -> Model:
    """Baum-Welch on a small sample, begun from texts dealt to states by the
    similarity of their classes."""
    classes = Classes()
    by_text = [spans_of(tokens(t), classes) for t in texts]
    spans = [s for parts in by_text for s in parts]
    firsts = np.array([p == 0 for parts in by_text for p in range(len(parts))], dtype=bool)
    rng = np.random.default_rng(seed)
    counts = Counts.zero(states)
    if not spans:
        return counts.model()
    # spherical k-means of class frequencies gives each window a state to start with
    bags = np.zeros((len(spans), CLASSES), dtype=np.float32)
    for i, s in enumerate(spans):
        np.add.at(bags[i], s[s < CLASSES], 1)
    bags = np.sqrt(bags)
    bags /= np.maximum(np.sqrt((bags * bags).sum(axis=1, keepdims=True)), 1e-9)
    middles = bags[rng.integers(len(bags))][None, :]
    while len(middles) < states:  # far from those chosen so far
        far = (bags @ middles.T).max(axis=1).argmin()
        middles = np.vstack([middles, bags[far]])
    for _ in range(8):
        dealt = (bags @ middles.T).argmax(axis=1)
        for s in range(states):
            if (dealt == s).any():
                m = bags[dealt == s].sum(axis=0)
                middles[s] = m / max(float(np.sqrt(m @ m)), 1e-9)
    for s, state in zip(spans, dealt):
        counts.emit[:, state] += 0.9 * np.bincount(s, minlength=CLASSES + 1)
        counts.emit += (0.1 / states) * np.bincount(s, minlength=CLASSES + 1)[:, None]
        counts.step[state, state] += 0.9 * len(s)
        counts.step[state] += 0.1 * len(s) / states
        counts.first[state] += 1
    model = counts.model()
    for _ in range(passes):
        counts = Counts.zero(states)
        counts.add(spans, firsts, model)
        model = counts.model()
    return model


def word_counts(training: DataFrame) -> DataFrame:
    """(word, n) of all training texts; batches are counted before the shuffle."""

    def table(total: Counter) -> pd.DataFrame:
        return pd.DataFrame({"word": list(total), "n": list(total.values())})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                total.update(tokens(text))
            if len(total) > 1 << 19:
                yield table(total)
                total.clear()
        yield table(total)

    return (
        training.select("text")
        .mapInPandas(count, "word binary, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )


def frequent_words(counts: DataFrame, most: int = COMMON) -> DataFrame:
    """(word, n) of the words above the count that at most ``most`` words reach.
    The count is found by running up how many words have each count, so no task
    sends the driver more than it keeps."""
    having = counts.groupBy("n").agg(F.count("*").alias("words"))
    above = having.select(
        "n", F.sum("words").over(Window.orderBy(F.desc("n"))).alias("reached")
    ).filter(F.col("reached") <= most)
    least = above.agg(F.min("n")).first()[0]
    return counts.select("word", "n").filter(
        F.col("n") >= least if least is not None else F.lit(False)
    )


def baum_welch_pass(training: DataFrame, model: Model) -> Model:
    """The model after one pass over all training texts."""
    k = len(model.first)
    columns = [f"v{s}" for s in range(k)]

    def expected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, classes = Counts.zero(k), Classes()
        held: list[np.ndarray] = []
        begins: list[bool] = []

        def flush():
            if held:
                counts.add(held, np.array(begins, dtype=bool), model)
                held.clear()
                begins.clear()

        for batch in batches:
            for text in batch["text"]:
                for p, span in enumerate(spans_of(tokens(text), classes)):
                    held.append(span)
                    begins.append(p == 0)
                    if len(held) >= 4096:
                        flush()
        flush()
        table = np.vstack([counts.first[None, :], counts.step, counts.emit])
        at = np.flatnonzero(table.any(axis=1))
        yield pd.DataFrame(table[at], columns=columns).assign(i=at)[["i", *columns]]

    rows = (
        training.select("text")
        .mapInPandas(expected, "i long, " + ", ".join(f"{c} double" for c in columns))
        .groupBy("i")
        .agg(*[F.sum(c).alias(c) for c in columns])
        .toPandas()  # the model's size
    )
    table = np.zeros((1 + k + CLASSES + 1, k))
    table[rows["i"].to_numpy(dtype=int)] = rows[columns].to_numpy(dtype=float)
    return Counts(table[0], table[1 : 1 + k], table[1 + k :]).model()


def score(docs: DataFrame, states: int = STATES, passes: int = 2) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", (fold(F.col("doc_id")) == 1).alias("held_out"))
    training = rows.filter(~F.col("held_out"))

    counts = stored(word_counts(training), "words").withColumn("c", word_class_column(F.col("word")))
    size = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n_texts = training.count()
    n_all, kinds = (size["n"] or 0) + n_texts, size["v"] + (n_texts > 0)
    # log10 of the shares' denominators, per class
    per_class = np.full(CLASSES + 1, 0.5)
    for r in counts.groupBy("c").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        per_class[r.c] = r.n + 0.5 * r.v + 0.5
    log_class = np.log10(per_class)
    log_class[CLASSES] = 0.0  # the end is alone in its class
    common = {
        bytes(r.word): float(np.log10(r.n + 0.5)) for r in frequent_words(counts).collect()
    }
    # first the hashes, then only the texts below the last of them
    h = F.xxhash64("doc_id")
    last = training.select(h.alias("h")).orderBy("h").limit(START).agg(F.max("h")).first()[0]
    chosen = training.filter(h <= (last if last is not None else 0)).select("text", h.alias("h"))
    start = [r.text for r in chosen.orderBy("h", "text").limit(START).collect()]
    model = starting_model(start, states)
    for _ in range(passes):
        model = baum_welch_pass(training, model)

    shared = spark.sparkContext.broadcast((model, common, log_class))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def evaluate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, common, log_class = shared.value
        classes = Classes()
        for batch in batches:
            for at in range(0, len(batch), 2048):
                part = batch.iloc[at : at + 2048]
                spans, rare, known, sums, of_class = [], [], [], [], []
                for text in part["text"]:
                    words = tokens(text)
                    logs = list(map(common.get, words))
                    found = [x for x in logs if x is not None]
                    rare.append([w for w, x in zip(words, logs) if x is None])
                    known.append(len(found))
                    sums.append(sum(found))
                    own = spans_of(words, classes, SCORED_SPAN)
                    of_class.append(sum(float(log_class[s].sum()) for s in own))
                    spans.append(own)
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].astype("Int64") if part["doc_id"].isna().any()
                    else part["doc_id"],
                    "row": part["row"], "held_out": part["held_out"],
                    "n_tokens": [sum(map(len, s)) for s in spans],
                    "known": known, "log_sum": sums,
                    "path": log10_likelihood(spans, model) - np.array(of_class), "rare": rare,
                })

    scored = stored(
        rows.withColumn("row", F.monotonically_increasing_id()).mapInPandas(
            evaluate,
            f"doc_id {id_type}, row long, held_out boolean, n_tokens long, known long, "
            "log_sum double, path double, rare array<binary>",
        ),
        "scored",
    )
    shared.unpersist()
    rare = (
        scored.select("row", F.explode("rare").alias("word"))
        .join(counts.select("word", "n"), "word", "left")
        .groupBy("row")
        .agg(
            F.count("n").alias("rare_known"),
            F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_sum"),
        )
    )
    words_sum = F.col("log_sum") + F.coalesce("rare_sum", F.lit(0.0))
    return scored.drop("rare").join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + int(n_texts > 0)).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (words_sum + float(np.log10(n_texts + 0.5))
         - F.col("n_tokens") * float(np.log10(n_all + 0.5 * (kinds + 1)))).alias("base_score"),
        (F.col("path") + words_sum).alias("score"),
    )
