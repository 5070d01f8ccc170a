"""Packing against the tokenizers library and plain checks of every sequence."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlake.llm import bpe, packing
from txnlake.llm.queries import op11_packing, tokenizer_path

SMALL = "/root/testdata/sf0.001"


def check_pieces(pieces, ids_of_doc, window, most_padding):
    """``pieces``: (doc key, start, length, ids, doc_tokens, sequence, offset)."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for key, start, length, crc, total, sequence, offset in pieces:
        ids = ids_of_doc[key]
        assert total == len(ids) and length > 0
        part = np.array(ids[start : start + length], dtype="<u4").tobytes()
        assert zlib.crc32(part) == crc
        docs[key].append((start, length))
        sequences[sequence].append((offset, length))
    assert set(docs) == set(ids_of_doc)
    for key, found in docs.items():
        at = 0
        for start, length in sorted(found):
            assert start == at
            at += length
        assert at == len(ids_of_doc[key])
    padding = 0
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    assert padding <= most_padding * sum(len(x) for x in ids_of_doc.values())


def collected(df):
    return [
        (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, r.sequence_id, r.offset)
        for r in df.collect()
    ]


def library_ids(docs, end=1):
    tok = bpe.tokenizer(tokenizer_path())
    return {i: [*tok.encode(t or "", add_special_tokens=False).ids, end] for i, t in docs}


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    check_pieces(collected(op11_packing(spark, SMALL)), library_ids(docs), 2048, 0.01)


@pytest.mark.parametrize("window", [64, 8])
def test_small_windows(spark, tmp_path, window):
    texts = ["", None, "one", "one two three", "word " * 300, "é" * 40]
    docs = [(i, texts[i % 6] if i % 3 else f"t{i} " * (i % 90)) for i in range(300)]
    # one length holds most rows
    docs += [(1000 + i, "a b c d e f g") for i in range(700)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {"ids": F.lit("clash"), "n": F.lit(1), "part": F.lit(2), "row": F.lit(3)}
    ).repartition(5)
    path = str(tmp_path / "docs")
    df.write.parquet(path)
    out = packing.pack(spark.read.parquet(path), tokenizer_path(), window, slack=0)
    check_pieces(collected(out.withColumn("ids_crc32", F.crc32("ids"))), library_ids(docs), window, 0.0)


def test_repeated_and_empty_rows(spark, tmp_path):
    path = str(tmp_path / "docs")
    rows = [(1, "same text"), (1, "same text"), (None, "no id"), (2, None), (2, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    out = packing.pack(spark.read.parquet(path), tokenizer_path()).collect()
    assert {r.doc_id for r in out} == {None, 1, 2}
    assert sum(r.length for r in out) == sum(r.doc_tokens for r in out if r.start == 0)
    assert len({(r.sequence_id, r.offset) for r in out}) == len(out)
    empty = str(tmp_path / "none")
    spark.createDataFrame([], "doc_id long, text string").write.parquet(empty)
    assert packing.pack(spark.read.parquet(empty), tokenizer_path()).collect() == []


def planned(histogram, window, **more):
    """Every document of the histogram, placed."""
    plan = packing.plan_windows(histogram, window, **more)
    sequences = defaultdict(list)
    for length, n in enumerate(histogram):
        for rank in range(int(n)):
            at = 0
            for start, size, sequence, offset in plan.pieces(length, rank):
                assert start == at
                sequences[sequence].append((offset, size))
                at += size
            assert at == length
    for found in sequences.values():
        at = 0
        for offset, size in sorted(found):
            assert offset == at
            at += size
        assert at <= window
    return plan, {s: sum(n for _, n in found) for s, found in sequences.items()}


@pytest.mark.parametrize("seed", range(12))
def test_plans_place_every_document(seed):
    rng = np.random.default_rng(seed)
    window = int(rng.choice([8, 32, 128]))
    histogram = rng.integers(0, 60, window) * (rng.random(window) < rng.choice([0.1, 0.5, 1]))
    histogram[0] = 0
    if seed % 3 == 0:
        histogram[window - 3] = 2000  # a third of the rows and more
    plan, filled = planned(histogram, window, slack=0)
    assert all(n == window or n & (n - 1) == 0 for n in filled.values())
    assert len(filled) == plan.sequences


def test_repeat_counts_are_least_squares():
    """Perfect histograms are met; else no single column could lower the error."""
    window, rng = 32, np.random.default_rng(5)
    histogram = np.zeros(window)
    for column, n in {(16, 16, 0): 40, (20, 8, 4): 70, (11, 11, 10): 30, (31, 1, 0): 25}.items():
        for v in column:
            histogram[v] += n if v else 0
    solved = packing.solve_repeats(histogram, window, sweeps=200)
    used = np.zeros(window)
    for column, x in solved.items():
        assert sum(column) == window and x > 0
        for v in column:
            used[v] += x if v else 0
    assert np.abs(used - histogram).max() < 0.5
    histogram = rng.integers(1, 500, window).astype(float)
    histogram[0] = 0
    solved = packing.solve_repeats(histogram, window, sweeps=400)
    left = histogram.copy()
    for column, x in solved.items():
        for v in column:
            left[v] -= x if v else 0
    weight = (np.arange(window) / window) ** 2
    for a in range(1, window):
        for b in range(0, a + 1):
            c = window - a - b
            if 0 <= c <= b and (b or not c):
                gain = sum(weight[v] * left[v] for v in (a, b, c) if v)
                assert gain < 2.0 or (a, b, c) in solved and abs(gain) < 2.0
