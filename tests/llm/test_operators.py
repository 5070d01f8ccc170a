"""The operators on Spark: edge cases and brute-force versions."""

import base64
import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from txnlake.llm import (
    bpe, common, fuzzyhash, gbdt, graph, hmm, html_text, mixing, ngramjoin, pcadedup, queries, toxicity,
    warc,
)

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
DOC = "doc_id long, text string, lang string, source string, n_chars long, score string"
BASE = " ".join(f"word{i}" for i in range(60))
TEXTS = [
    BASE, BASE, BASE + " more", None, "", "  \n", "one two", "One TWO", "x" * 3000 + " tail",
    " ".join(f"other{i} é" for i in range(400)), "a<|endoftext|>b", BASE.upper(), "idiot fool",
]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, 0, "clash") for i, t in enumerate(TEXTS)]
    rows += [(3, None, "en", "s0", 0, "x"), (None, BASE, None, None, None, None), rows[0]]
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(rows, DOC).coalesce(2).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none"))
    spark.createDataFrame([], DOC).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def all_rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def test_bpe(docs, none):
    tok = bpe.tokenizer(PATH)
    for long_chars, leaf in ((1 << 16, 1 << 14), (50, 64)):
        out = bpe.encode(docs, PATH, long_chars, leaf).withColumn(
            "text", bpe.decode_column(F.col("ids"), PATH)
        )
        got = Counter((r.doc_id, tuple(np.frombuffer(bytes(r.ids), "<u4").tolist()), r.text)
                      for r in out.collect())
        expected = Counter(
            (i, tuple(tok.encode(t, add_special_tokens=False).ids),
             tok.decode(tok.encode(t, add_special_tokens=False).ids, skip_special_tokens=False))
            for i, t in all_rows(docs)
        )
        assert got == expected
    assert queries.encoded_digests(none, PATH).count() == 0


def python_nodes(df):
    """Nodes of the plan that run Python: for each of a stage every task has a worker."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum(len(re.findall(rf"\b{n}\b", plan)) for n in (
        "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas"))


def test_texts_are_encoded_and_decoded_in_one_pass(docs):
    out = queries.encoded_digests(docs, PATH)
    # short texts; pieces of long ones: cut, encoded, joined
    assert python_nodes(out) == 4
    for long_chars, leaf in ((1 << 16, 1 << 14), (50, 64)):
        both = bpe.encode(docs, PATH, long_chars, leaf, decoded=True)
        apart = bpe.encode(docs, PATH, long_chars, leaf).withColumn(
            "decoded", bpe.decode_column(F.col("ids"), PATH))
        assert both.schema == apart.schema
        got, expected = (Counter((r.doc_id, bytes(r.ids), r.decoded) for r in x.collect())
                         for x in (both, apart))
        assert got == expected and len(got) > 10


def test_near_copies_hash_each_text_once(docs):
    # one for the rows with words, one for those without
    assert python_nodes(ngramjoin.keep_one(docs)) == 2


def test_the_library_is_loaded_where_a_text_is_not_split_by_spaces(monkeypatch):
    loaded, library = [], bpe.tokenizer
    monkeypatch.setattr(bpe, "tokenizer", lambda path: loaded.append(path) or library(path))
    pieces = bpe.split_text(bpe.LoadedOnUse(PATH), "some words " * 50, 40, 16)
    ids_of = bpe.whole_encoder(PATH)
    assert bpe.assemble(bpe.LoadedOnUse(PATH), [(k, ids_of(b)) for k, b in pieces]) == ids_of("some words " * 50)
    assert not loaded
    assert {k for k, _ in bpe.split_text(bpe.LoadedOnUse(PATH), "x" * 200, 40, 16)} > {bpe.LEAF}
    assert loaded


def brute_components(docs):
    sets = []
    for i, text in all_rows(docs):
        w = text.encode().lower().split()
        k = min(5, len(w))
        sets.append((i, {tuple(w[p : p + k]) for p in range(len(w) - k + 1)} if w else set()))
    label = list(range(len(sets)))
    for p, (_, a) in enumerate(sets):
        for q, (_, b) in enumerate(sets[:p]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b) and label[p] != label[q]:
                old, new = label[p], label[q]
                label = [new if x == old else x for x in label]
    out = []
    for (i, s), x in zip(sets, label):
        ids = [j for (j, _), y in zip(sets, label) if y == x and j is not None]
        out.append((i, len(s), min(ids, default=None)))
    return Counter(out)


def test_shingle_join(docs, none, spark, tmp_path):
    got = ngramjoin.link(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == brute_components(docs)
    assert ngramjoin.link(none).count() == 0
    kept = ngramjoin.keep_one(docs)
    assert kept.columns == docs.columns
    texts = Counter(r.text for r in kept.collect())
    assert texts[BASE] == 1 and texts[BASE + " more"] == 0 and texts[BASE.upper()] == 0


def test_shingle_join_chains_and_hot_passage(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ngramjoin, "OFTEN", 4)
    monkeypatch.setattr(ngramjoin, "BLOCK", 8)
    rnd = np.random.default_rng(1)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for g in range(12):
        words = [f"g{g}w{i}" for i in range(40)] + passage
        for step in range(6):  # each copy is edited further
            rows.append((len(rows), " ".join(words)))
            words = words[: 2 * step] + [f"n{rnd.integers(1 << 30)}"] + words[2 * step + 1 :]
    path = str(tmp_path / "d")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    docs = spark.read.parquet(path)
    got = ngramjoin.link(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == brute_components(docs)


def test_tile_forest_joins_what_all_pairs_join(monkeypatch):
    rnd = np.random.default_rng(2)
    rows = []
    for h in range(3):
        base = rnd.integers(0, 1 << 62, 60).astype(np.uint64)
        for _ in range(40):
            s = np.unique(np.concatenate([base[rnd.random(60) < 0.95], rnd.integers(
                0, 1 << 62, rnd.integers(0, 8)).astype(np.uint64)]))
            key = ngramjoin.set_key(s)
            rows.append((h, 0, 0, 0, key, len(s), key if rnd.random() < 0.8 else 7, s.tobytes(),
                         ngramjoin.bitmap(s, ngramjoin.WIDE)))
    frame = pd.DataFrame(rows, columns="h p q side key n component set wide".split())
    frame = frame.sort_values(["h", "p", "q", "n", "key"]).reset_index(drop=True)
    expected, allowed = set(), set()
    for x, y in itertools.combinations(frame.itertuples(), 2):
        if x.h == y.h and x.component != y.component:
            a, b = (set(np.frombuffer(z.set, np.uint64).tolist()) for z in (x, y))
            if 100 * len(a & b) >= 80 * len(a | b):
                expected.add((x.key, y.key))
                allowed |= {x.key, y.key}
    assert len(expected) > 200
    partners = ngramjoin.with_partner(frame.drop(columns="set"))
    assert allowed <= set(partners["key"]) and "wide" not in partners.columns
    got = ngramjoin.tile_forest(frame.drop(columns="wide"))
    pairs = {frozenset(p) for p in got.itertuples(index=False, name=None)}
    assert len(got) < len(frame) and pairs <= {frozenset(p) for p in expected}

    def groups(links):
        label = {}
        for x in frame.itertuples():  # components known before count, in each tile
            label[x.h, x.key] = (x.h, x.component)
        for a, b in links:
            for h in range(3):
                if (h, a) in label and (h, b) in label:
                    old, new = label[h, a], label[h, b]
                    label = {k: new if v == old else v for k, v in label.items()}
        return {frozenset(k for k, v in label.items() if v == c) for c in label.values()}

    assert groups(map(tuple, pairs)) == groups(expected)
    empty = frame.iloc[:0]
    assert len(ngramjoin.tile_forest(empty)) == len(ngramjoin.with_partner(empty)) == 0


def test_shingle_join_keeps_clashing_columns(spark):
    rows = [(1, BASE, 5, "x"), (2, BASE + " more", 6, "y"), (3, None, 7, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank int, Set_Key string")
    assert sorted(map(tuple, ngramjoin.keep_one(docs).collect())) == [rows[0], rows[2]]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7), (None, 3), (200, 100)]
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == (
        {i: 1 for i in range(1, 41)} | {i: 100 for i in (100, 101, 200)}
    )
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_mixing(docs, none):
    out = mixing.mix(docs).collect()
    sizes = Counter((i, len(t.encode().split())) for i, t in all_rows(docs))
    assert Counter((r.doc_id, r.size) for r in out) == sizes
    assert all(0 <= r.copies <= 2 for r in out)
    total = sum(r.size for r in out)
    targets = {r.source: r.target for r in out}
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    assert mixing.mix(none).count() == 0
    whole = mixing.mixture(docs)
    assert whole.columns == docs.columns
    assert whole.count() == sum(r.copies for r in out)


def test_following_document(docs, none, spark, tmp_path):
    path = str(tmp_path / "d")
    rows = [(i * 7 % 101, f"text {i} " * (i % 9)) for i in range(101)] + [(500, None)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(path)
    ordered = sorted((i, t or "") for i, t in rows)
    expected = {}
    for (i, t), (_, f) in zip(ordered, ordered[1:] + ordered[:1]):
        e = fuzzyhash.edited_text(t, f)
        a, b, c = map(fuzzyhash.fingerprint, (t, e, f))
        expected[i] = (len(t), hashlib.sha256(e.encode()).hexdigest(), a, b,
                       fuzzyhash.likeness(a, b), fuzzyhash.likeness(a, c))
    for slices in (1, 4, 30):
        got = fuzzyhash.compare_following(spark.read.parquet(path), slices).collect()
        assert {r.doc_id: tuple(r)[1:] for r in got} == expected and len(got) == len(rows)
    assert fuzzyhash.compare_following(docs).count() == docs.count()
    assert fuzzyhash.compare_following(none).count() == 0


def test_warc_round_trip(spark, tmp_path):
    html = ["<p>a</p>", "<p>a</p>", None, "", "WARC/1.1\r\n\r\n" * 3, "é\n\n", "<p>a</p>"]
    rows = [(i, None if i == 3 else f"http://x/{i}\n", h) for i, h in enumerate(html)]
    rows.append((None, "u", "<p>a</p>"))
    pages = str(tmp_path / "p")
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(pages)
    table = spark.read.parquet(pages)
    out = str(tmp_path / "w")
    warc.write_archive(table, out)
    captures = warc.assemble(warc.read_archive(spark, out)).cache()
    assert captures.count() == len(rows)
    assert captures.filter("size(request) != 1 or size(metadata) != 1").count() == 0
    first = {}
    for i, _, h in rows:
        if i is not None:
            first.setdefault(h or "", i)
    expected = Counter()
    for i, _, h in rows:
        body = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        own = first[h or ""] == i
        expected[(i, len(body), digest, "response" if own else "revisit",
                  None if own else first[h or ""])] += 1
    assert Counter(map(tuple, queries.capture_digests(captures).collect())) == expected
    payloads = captures.filter("answer.type = 'response'").select("answer.payload").collect()
    assert {bytes(r[0]).decode() for r in payloads} == {h or "" for h in html}
    short = str(tmp_path / "short")
    warc.write_archive(table, short, least=100)
    assert warc.read_archive(spark, short).filter("type = 'revisit'").count() == 0
    empty = str(tmp_path / "none")
    warc.write_archive(table.limit(0), empty)
    assert warc.read_archive(spark, empty).count() == 0


def test_embeddings(spark, tmp_path):
    rnd = np.random.default_rng(3)
    base = rnd.normal(size=(200, 8))
    near = base[:80] + 0.08 * rnd.normal(size=(80, 8))
    vectors = [*base.tolist(), *near.tolist(), *base[:5].tolist(), [0.0] * 8, None,
               [float("nan")] * 8, [None] + [1.0] * 7, [1.0, 2.0]]
    rows = [(i + 10, v, 0) for i, v in enumerate(vectors)]
    path = str(tmp_path / "e")
    schema = "vec_id long, embedding array<double>, label int"
    spark.createDataFrame(rows, schema).write.parquet(path)
    good = np.array(vectors[:285])
    u = good / np.linalg.norm(good, axis=1, keepdims=True)
    link = u @ u.T >= 0.95
    np.fill_diagonal(link, False)
    label = np.arange(285)
    for _ in range(285):
        label = np.array([min(label[i], *label[link[i]]) if link[i].any() else label[i]
                          for i in range(285)])
    expected = {i + 10: (int(link[i].sum()), int(label[i]) + 10) for i in range(285)}
    expected |= {i + 10: (0, i + 10) for i in range(285, len(rows))}
    table = spark.read.parquet(path)
    for tile in (16, 2048):
        got = pcadedup.near_duplicates(table, tile=tile).collect()
        assert {r.vec_id: (r.n_links, r.component_id) for r in got} == expected
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert pcadedup.near_duplicates(table.limit(0)).count() == 0


def test_hmm_base_and_counts(docs, none):
    rows = all_rows(docs)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    counts = Counter()
    for i, t in rows:
        if not held(i):
            counts.update([*t.encode().lower().split(), "end"])
    n, v = sum(counts.values()), len(counts)
    expected = Counter()
    for i, t in rows:
        words = [*t.encode().lower().split(), "end"]
        base = sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        expected[(i, held(i), len(words), sum(w in counts for w in words), n, round(base, 6))] += 1
    got = hmm.score(docs).collect()
    assert Counter((*tuple(r)[:5], round(r.base_score, 6)) for r in got) == expected
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert hmm.score(none).count() == 0


def test_classifiers_and_pages(docs, none, spark):
    labels = spark.createDataFrame(
        [(i, i % 2, i % 2) for i in range(13)] + [(None, 1, 1), (3, None, None)],
        "doc_id long, quality int, toxic int",
    )
    for table in (labels, labels.limit(0)):
        trees = gbdt.fit(docs, table)
        model = toxicity.fit(docs, table)
        for frame in (docs, none):
            out = frame.select(
                gbdt.score_column(F.col("text"), trees).alias("a"),
                toxicity.score_column(F.col("text"), model).alias("b"),
            ).collect()
            assert len(out) == frame.count()
            assert all(0 <= r.a <= 1 and 0 <= r.b <= 1 for r in out)
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"),
                        F.col("text").alias("html"))
    assert html_text.extract(pages).filter("text is null").count() == 0
    assert html_text.extract(pages.limit(0)).count() == 0


def test_labelled_sample_is_bounded_by_rows(spark):
    rows = [(i, f"text {i}") for i in range(20, 60)] + [(25, "again")] * 300 + [(26, None)] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(60)] + [(25, 0), (None, 1)], "doc_id long, quality int"
    )
    present = [i for i in range(20, 60) if zlib.crc32(str(i).encode()) % 5]
    text = {i: "again" if i == 25 else f"text {i}" for i in present}
    for limit in (10, 1000):  # ids that docs does not hold take no place
        got = common.labelled_sample(docs, labels, "quality", limit).collect()
        assert len(got) == min(limit, len(present)) == len({r.id_ for r in got})
        assert all((r.text, r.y) == (text[r.id_], r.id_ % 2) for r in got)
    assert 25 in text and 26 in text


def test_pipeline_stages(spark, docs, tmp_path):
    folder = str(tmp_path)
    docs.write.parquet(folder + "/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(13)], "doc_id long, quality int, toxic int"
                          ).write.parquet(folder + "/labels.parquet")
    # with labels of one kind nothing is rejected: what is left is one of each
    # group, as often as the mixture draws it
    kept = ngramjoin.keep_one(docs)
    path = str(tmp_path / "kept")
    kept.write.parquet(path)
    mixed = [r.text or "" for r in mixing.mixture(spark.read.parquet(path)).collect()]
    expected = Counter(hashlib.sha256(t.encode()).hexdigest() for t in mixed)
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter(r.decoded_sha256 for r in got) == expected
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns


def python_mixture(rows):
    """Copies of each (doc_id, text, source), weights 5, 2, 1 by source."""
    digest = lambda x: int(hashlib.md5(x.encode()).hexdigest()[:8], 16)
    size = lambda r: len(r[1].encode().split())
    sources = sorted({r[2] for r in rows})
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    held = {s: sum(size(r) for r in rows if r[2] == s) for s in sources}
    left, weights, level = 1.5 * sum(held.values()), sum(weight.values()), None
    for s in sorted(sources, key=lambda s: (held[s] / weight[s], s)):
        if left / weights * weight[s] < 2 * held[s]:
            level = left / weights
            break
        left, weights = left - 2 * held[s], weights - weight[s]
    out = []
    for s in sources:
        most = 2.0 * held[s]
        rate = (most if level is None else min(level * weight[s], most)) / held[s]
        start, order = digest("mix#" + s) / 2**32, lambda r: (
            size(r), digest(f"mix|{r[0]}") % 256, digest(f"mix|{r[0]}"), r[0])
        for k, r in enumerate(sorted((r for r in rows if r[2] == s), key=order), 1):
            out += [r] * int(np.floor(start + rate * k) - np.floor(start + rate * (k - 1.0)))
    return out


def test_pipeline_against_plain_loops(spark, tmp_path):
    rnd = np.random.default_rng(5)
    word = lambda: "".join(rnd.choice(list("aeioulnrst"), rnd.integers(2, 8)))
    rows, labels = [], []
    for i in range(300):
        words = [word() for _ in range(50)]
        if i % 4 == 0:  # toxic
            for at in rnd.integers(0, 50, 5):
                words[at] = str(rnd.choice(["blockhead", "nitwits", "dimwitted"]))
        if i % 4 == 1:  # poor
            words = [str(rnd.choice(["$$$", "!!!", "A1", "#"])) + str(k) for k in range(50)]
        text = " ".join(words)
        if i % 4 == 3 and i % 3 == 0:  # a near copy of the clean text before
            text = rows[-1][1] + " more"
        rows.append((i, text, f"s{i % 5 % 3}"))
        labels.append((i, int(i % 4 != 1), int(i % 4 == 0)))
    folder = str(tmp_path)
    spark.createDataFrame(
        [(i, t, "en", s, len(t), "x") for i, t, s in rows], DOC
    ).write.parquet(folder + "/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        folder + "/labels.parquet")
    table = spark.read.parquet(folder + "/documents.parquet")
    marks = spark.read.parquet(folder + "/labels.parquet")

    model = toxicity.fit(table, marks)
    mild = [r for r in rows if toxicity.score_texts(model, [r[1]])[0] < queries.TOXIC_CUT]
    trees = gbdt.fit(table.filter(F.col("doc_id").isin([r[0] for r in mild])), marks)
    good = [r for r in mild if trees.probability(
        np.array([gbdt.statistics(r[1])], dtype=float))[0] >= queries.QUALITY_CUT]
    sets, label = [], list(range(len(good)))
    for _, text, _ in good:
        w = text.lower().split()
        sets.append({tuple(w[p : p + 5]) for p in range(len(w) - 4)})
    for p, a in enumerate(sets):
        for q, b in enumerate(sets[:p]):
            if 100 * len(a & b) >= 80 * len(a | b) and label[p] != label[q]:
                old, new = max(label[p], label[q]), min(label[p], label[q])
                label = [new if x == old else x for x in label]
    single = [r for p, r in enumerate(good) if label[p] == p]  # ids ascend
    # every stage has rows to refuse and to keep
    assert len(rows) > len(mild) > len(good) > len(single) > 50
    tok, expected = bpe.tokenizer(PATH), Counter()
    for i, text, _ in python_mixture(single):
        ids = tok.encode(text, add_special_tokens=False).ids
        expected[(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                  hashlib.sha256(text.encode()).hexdigest())] += 1
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == expected


def test_embeddings_of_several_lengths_and_sizes(spark, tmp_path):
    vectors = [[1.0, 0.0, 0.0], [1.0, 0.01, 0.0], [0.0, 1.0], [0.0, 1.0], [1e200, 0.0, 1e200], [1e200, 0.0, 1e200],
               [1e-200, 0.0, 1e-200], [1.0], [-1.0], [5.0], [], [1e308, 1e308, 1e308, 1e308], [1.0, 1.0, 1.0, 1.0]]
    path = str(tmp_path / "e")
    spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").write.parquet(path)
    got = {r.vec_id: (r.n_links, r.component_id) for r in pcadedup.near_duplicates(spark.read.parquet(path)).collect()}
    expected = {}
    links = {i: [] for i in range(len(vectors))}
    for i, a in enumerate(vectors):
        for j, b in enumerate(vectors):
            if i != j and len(a) == len(b) > 0:
                p, q = np.array(a) / max(map(abs, a)), np.array(b) / max(map(abs, b))
                if p @ q / np.sqrt((p @ p) * (q @ q)) >= 0.95:
                    links[i].append(j)
    for i in links:
        expected[i] = (len(links[i]), min([i, *links[i]]))  # these groups are complete
    assert got == expected


def test_tiles_of_embeddings_meet_without_a_shuffle(spark, tmp_path, monkeypatch):
    """Each pair of tiles was shuffled with both tiles' vectors: disk grew with the
    square of the rows."""
    rnd = np.random.default_rng(8)
    x = rnd.normal(size=(400, 12)).astype(np.float32)
    x[200:300] = x[:100] + 0.05 * rnd.normal(size=(100, 12))
    x[300:320] = x[0]
    rows = [(i, v, 0) for i, v in enumerate(x.tolist())]
    path = str(tmp_path / "e")
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(path)
    plans, size = {}, {}

    def stored(df, name, **options):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        found = common.stored(df, name, **options)
        size[name] = found.count()
        return found

    monkeypatch.setattr(pcadedup, "stored", stored)
    got = {r.vec_id: (r.n_links, r.component_id) for r in
           pcadedup.near_duplicates(spark.read.parquet(path), tile=32).collect()}
    assert size["tiles"] > 8
    assert not re.search(r"\bExchange\b", plans["links"])
    u = pcadedup.unit_rows(x)
    link = u @ u.T >= 0.95
    np.fill_diagonal(link, False)
    label = np.arange(400)
    for _ in range(400):
        label = np.array([min(label[i], *label[link[i]]) if link[i].any() else label[i]
                          for i in range(400)])
    assert got == {i: (int(link[i].sum()), int(label[i])) for i in range(400)}
