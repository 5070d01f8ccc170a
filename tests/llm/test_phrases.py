"""Phrase mining against plain loops."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlake.llm import bitset, phrases

WORDS = ["the", "a", "red", "Red", "fox", "über", "of", "in"]


def expected(docs, least, top):
    counts, totals = Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und"
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 6):
                for i in range(len(words) - n + 1):
                    counts[lang, tuple(words[i : i + n])] += 1
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out = []
    for (lang, p), a in candidates.items():
        inside = any(
            lang == other and len(q) > len(p) and f >= a
            and any(q[i : i + len(p)] == p for i in range(len(q)))
            for (other, q), f in candidates.items()
        )
        if inside:
            continue
        n = totals[lang]
        cuts = []
        for k in range(1, len(p)):
            l, r = counts[lang, p[:k]], counts[lang, p[k:]]
            cuts.append((1000 * a * n // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        out.append((lang, " ".join(p), a, l, r, n, score))
    ranked = []
    for lang in totals:
        rows = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(rows[:top])]
    return sorted(ranked)


def rows(df):
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(2)
    weights = np.array([8, 6, 4, 1, 3, 2, 3, 2]) / 29
    docs = []
    for i in range(240):
        words = rng.choice(WORDS, size=rng.integers(0, 60), p=weights)
        marks = rng.choice([" ", "  ", "\t", ". ", ",", "\n", " ;; "], size=len(words), p=[0.7, 0.08, 0.05, 0.07, 0.04, 0.03, 0.03])
        docs.append(([None, "en", "de", "und"][i % 4], "".join(w + m for w, m in zip(words, marks))))
    docs += [("en", "the red fox in the red house of the red fox " * 40)] * 12  # copies
    docs += [("en", "same " * 500), ("fr", None), ("fr", ""), ("fr", "..."), ("fr", "a b\x1cc d")]
    return docs


@pytest.mark.parametrize("every, log2_bits, held", [(32, 20, 1_500_000), (2, 20, 50), (1, 3, 400), (7, 6, 1_500_000)])
def test_mine_matches_brute_force(spark, texts, monkeypatch, every, log2_bits, held):
    monkeypatch.setattr(phrases, "HELD_TOKENS", held)
    df = spark.createDataFrame(texts, "lang string, text string").withColumns(
        {"chunk": F.lit(1), "freq": F.lit("x"), "phrase": F.lit("clash"), "f": F.lit(None).cast("long")}
    ).repartition(3)
    got = rows(phrases.mine(df, min_count=15, top=40, every=every, log2_bits=log2_bits))
    want = expected(texts, 15, 40)
    assert len(want) > 60 and got == want


def test_chunks_cover_each_start_once(spark, texts):
    df = spark.createDataFrame(texts, "lang string, text string")
    for every in (1, 4, 64):
        chunks = phrases.parse(df, every).collect()
        starts = sum(r.freq * (len(r.chunk.split(" ")) - (0 if r.ends else 4)) for r in chunks)
        assert starts == sum(len(phrases.tokens_of(t or "")) for _, t in texts)

def test_repeated_passages_give_the_same_chunks(spark):
    passage = " ".join(f"w{i * 7919 % 1000}" for i in range(400))
    texts = [("en", " ".join(f"x{k}y{i}" for i in range(60)) + f" {passage} z{k}") for k in range(20)]
    found = phrases.parse(spark.createDataFrame(texts, "lang string, text string"), 16).collect()
    assert sum(len(r.chunk.split(" ")) for r in found if r.freq == 20) > 300


def test_large_products_are_exact(spark):
    a, l, r, n = 10**13 + 1, 10**13 + 7, 3 * 10**13 + 1, 10**15 + 3
    counted = spark.createDataFrame(
        [("en", "", n), ("en", "x", l), ("en", "y", r), ("en", "x y", a)], "lang string, phrase string, f long"
    )
    assert rows(phrases.collocations(counted)) == [("en", 1, "x y", a, l, r, n, 1000 * a * n // (l * r))]


@pytest.mark.parametrize("docs", [[], [(None, None)], [("en", "too few words")]])
def test_nothing_to_mine(spark, docs):
    assert rows(phrases.mine(spark.createDataFrame(docs, "lang string, text string"))) == []


def test_bitset(spark):
    spots = [0, 1, 32767, 32768, 99999, (1 << 18) - 1, 1]
    df = spark.createDataFrame([(s,) for s in spots], "spot long")
    bits = np.frombuffer(bitset.collect_bitset(df, "spot", 18), dtype=np.uint8)
    assert np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist() == sorted(set(spots))
    every = np.arange(1 << 18)
    assert np.flatnonzero(bitset.holds(bits, every)).tolist() == sorted(set(spots))


def test_levels_of_a_block_are_those_of_each_length(monkeypatch):
    import pandas as pd

    rng = np.random.default_rng(3)
    rows = pd.DataFrame({
        "lang": ["x", "y"], "chunk": ["", ""], "ends": [True, False], "freq": [1, 2], "id": [1, 2],
        "words": [rng.integers(0, 6, 500).astype("<u8").tobytes() for _ in range(2)],
    })
    block, bits = phrases._Block(rows), 12
    bitsets = [rng.integers(0, 256, 1 << (bits - 3)).astype(np.uint8) for _ in range(5)]
    steps, longer = [], phrases._longer
    monkeypatch.setattr(phrases, "_longer", lambda *a: steps.append(a[2]) or longer(*a))
    levels = [(at.copy(), h.copy(), block.checks(at, n))
              for n, (at, h) in enumerate(block.levels(bitsets, bits, 5), 1)]
    assert steps == [1, 2, 3, 4, 5]  # each length from the one before, once
    for n, found in enumerate(levels, 1):
        assert all((a == b).all() for a, b in zip(found, block.phrases(n, bitsets, bits)))


def test_phrases_are_read_at_their_places_only(spark, texts, tmp_path, monkeypatch):
    df = spark.createDataFrame(texts, "lang string, text string")
    phrases.coded(phrases.parse(df, 4)).write.parquet(str(tmp_path / "chunks"))
    chunks = spark.read.parquet(str(tmp_path / "chunks"))
    written = {}
    monkeypatch.setattr(phrases, "stored", lambda d, name: written.setdefault(name, d.localCheckpoint()))
    for log2_bits in (3, 20):  # a bitmap that is full leaves the rows as they are
        written.clear()
        got = phrases.count_phrases(chunks, 15, log2_bits).collect()
        frequent = sum(written[f"frequent-{n}"].count() for n in range(1, 6))
        assert written["phrase-texts"].count() == frequent > 100
        assert len({(r.lang, r.phrase) for r in got}) == len(got)
        counts = Counter()
        for lang, text in texts:
            for piece in re.split("[.,;:!?\x0a-\x0d]", text or ""):
                w = re.findall("[^\x20\x09]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in piece))
                counts.update((lang or "und", " ".join(w[i : i + n])) for n in range(1, 6) for i in range(len(w) - n + 1))
        assert {(r.lang, r.phrase): r.f for r in got if r.phrase} == {k: f for k, f in counts.items() if f >= 15}


def test_a_word_equal_to_its_lang_has_a_key_of_its_own():
    import pandas as pd
    import xxhash

    words = [np.array([xxhash.xxh64_intdigest(x)], dtype="<u8").tobytes() for x in ("es", "de")]
    block = phrases._Block(pd.DataFrame({
        "lang": ["es", "de"], "chunk": ["es", "de"], "ends": True, "freq": 1, "id": [1, 2], "words": words}))
    _, h, c = block.phrases(1, [], 12)
    assert h[0] != h[1] and c[0] != c[1]


def parts(texts, every):
    """Words that start in the chunks of each lang, and the chunks that end a text."""
    held, starts, ends = Counter(), Counter(), Counter()
    size = phrases.chunk_rows([t for _, t in texts], [x for x, _ in texts], every, held)
    for (lang, chunk, final), n in held.items():
        words = chunk.split(b" ")
        for w in words[: len(words) - (0 if final else 4)]:
            starts[lang, w] += n
        ends[lang] += n * final
    return size, starts, ends


@pytest.mark.parametrize("every", [1, 3, 32])
def test_words_are_hashed_by_arrays_not_one_by_one(texts, monkeypatch, every):
    import xxhash

    texts = [(lang or "und", text or "") for lang, text in texts]
    texts += [("en", " ".join(f"word{i}" for i in range(3000))), ("en", "\t a  \x00b " + "x" * 65 + "\t ")]
    called, digest = [], xxhash.xxh64_intdigest
    monkeypatch.setattr(phrases.xxhash, "xxh64_intdigest", lambda *a, **k: called.append(a[0]) or digest(*a, **k))
    size, starts, ends = parts(texts, every)
    assert called == [b"x" * 65]  # other words in steps of eight bytes, all at once
    words = [(lang, phrases.tokens_of(text)) for lang, text in texts]
    assert starts == Counter((lang, w) for lang, ws in words for w in ws) and size == sum(starts.values())
    assert ends == Counter(lang for lang, ws in words if ws)


def test_word_hashes_tell_words_apart():
    words = [b"a", b"a\x00", b"\x00a", b"\x00", b"\x00\x00", "ü".encode(), b".", b"\xff"]
    words += [b"w" * n for n in range(1, 200)] + [b"w" * n + b"\x00" for n in range(1, 200)]
    words += [b"%016d" % (i * 10007) for i in range(100_000)]  # and some that differ in a few bytes of each eight
    words += [b"abcdefg%cabc%cefg%c" % (i, j, k) for i in b"0123456789" for j in b"0123456789" for k in b"0123456789"]
    assert len(set(words)) == len(words)
    hashes, begins = phrases.word_hashes(b" ".join(words))
    sizes = np.array([len(w) for w in words])
    assert (begins == np.cumsum(sizes + 1) - sizes - 1).all()
    assert len(np.unique(hashes)) == len(words)
    assert [w for w, h in zip(words, hashes) if h < 2] == [b".", b"\xff"]
    alone = [phrases.word_hashes(w)[0][0] for w in words[:500]]  # whatever stands around
    assert (hashes[:500] == alone).all()


def test_equal_hashes_stand_together():
    rng = np.random.default_rng(5)
    hashes = rng.integers(-(1 << 63), 1 << 63, 300)[rng.integers(0, 300, 5000)]
    order = phrases._grouped(hashes)
    assert (np.sort(order) == np.arange(5000)).all()
    assert 1 + np.count_nonzero(np.diff(hashes[order])) == len(np.unique(hashes))
    near = rng.integers(0, 4, 5000)  # equal leading bits: not together, but all there
    assert (np.sort(phrases._grouped(near)) == np.arange(5000)).all()
    assert len(phrases._grouped(hashes[:0])) == 0
