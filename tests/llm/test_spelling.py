"""Spelling variants against plain loops."""

import zlib
from collections import Counter
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlake.llm import spelling
from txnlake.llm.queries import op13_spelling

SMALL = "/root/testdata/sf0.001"


def one_edit(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :]
    a, b = sorted((a, b), key=len)
    return a[i:] == b[i + 1 :]


def expected(docs: list[tuple], length=7, least=2, ratio=10) -> list[tuple]:
    counts: Counter = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= length and c >= least}
    # candidates share the word without one code point, or are it
    holes: dict = {}
    for w in n:
        for x in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            holes.setdefault(x, []).append(w)
    near = {w: set() for w in n}
    for group in holes.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_neighbourhood_hashes_match_strings():
    words = ["banana", "bandana"[:6], "ééàüöß"]
    hashed = {}
    for which, h in spelling.neighbour_hashes(words, 3):
        for w, x in zip(which, h):
            hashed.setdefault(w, set()).add(int(x))

    def value(symbols):
        out = 0
        for s in symbols:
            out = (out * spelling._BASE + int(s)) % (1 << 64)
        return out

    for i, w in enumerate(words):
        r = spelling._symbols([w], 3)[0].tolist()
        every = {tuple(r)}
        for at in range(len(r) + 1):
            every.update(tuple(r[:at] + [c] + r[at:]) for c in (1, 2, 3))
            if at < len(r):
                every.add(tuple(r[:at] + r[at + 1 :]))
                every.update(tuple(r[:at] + [c] + r[at + 1 :]) for c in (1, 2, 3))
        assert hashed[i] == {value(x) for x in every}
        assert int(spelling.reduced_hashes([w], 3)[0]) == value(r)


def test_parts_give_the_same_hashes(monkeypatch):
    words = ["abcdefgh", "hgfedcba"]
    whole = {(int(a), int(b)) for w, h in spelling.neighbour_hashes(words, 8) for a, b in zip(w, h)}
    monkeypatch.setattr(spelling, "CELLS", 40)
    parts = {(int(a), int(b)) for w, h in spelling.neighbour_hashes(words, 8) for a, b in zip(w, h)}
    assert parts == whole


def test_groups_match_brute_force(spark):
    rng = np.random.default_rng(3)
    base = ["".join(rng.choice(list("abcdeé"), size=rng.integers(6, 11))) for _ in range(60)]
    docs = []
    for i in range(600):
        words = [base[min(int(rng.exponential(9)), 59)] for _ in range(12)]
        words = [w[:3] + "x" + w[4:] if rng.random() < 0.05 else w for w in words]
        docs.append((i, " ".join(w.title() if rng.random() < 0.2 else w for w in words)))
    docs += [(None, "wordwithoutid wordwithoutid"), (7, None), (8, ""), (600, "1234567 !!"),
             (601, "k" * 5000 + " " + "k" * 5000), (602, "k" * 4999 + "m"), (603, "k" * 4999 + "m")]
    docs += docs[:40]  # repeated rows
    # a chain: each form has ten times the count of the word before
    docs += [(700, "chainedx " * 2), (701, "chainedxx " * 20), (702, "chainedxxx " * 200)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {"word": F.lit("clash"), "n": F.lit(1), "near": F.lit(None).cast("string")}
    )
    want = expected(docs)
    assert any(r[1] for r in want) and any(r[1] and r[2] != r[1] for r in want)
    assert rows(spelling.group_variants(df)) == want
    # a saturated bitmap and a small alphabet change the work, not the rows
    assert rows(spelling.group_variants(df, symbols=2, log2_bits=6)) == want


@pytest.mark.parametrize("docs", [[], [(1, None)], [(1, "short words only")], [(1, "elephant")]])
def test_no_words(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(spelling.group_variants(df)) == expected(docs) == []


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(op13_spelling(spark, SMALL)) == expected(docs)
