"""The operators' Python parts against brute force."""

import random

import numpy as np
import pytest

from txnlake.llm import bpe, fuzzyhash, gbdt, hmm, html_text, ngramjoin, pcadedup, toxicity, warc

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_pieces_and_joins_give_the_librarys_ids():
    tok, ids_of, rnd = bpe.tokenizer(PATH), bpe.whole_encoder(PATH), random.Random(1)
    parts = ["a", "ab", "abc \n", "  \n\t", "é日本a", "'!?s-", "<|endoftext|>", "<|", "endof"]
    for _ in range(1500):
        some = rnd.sample(parts, rnd.randrange(1, 4))
        text = "".join(rnd.choice("".join(some)) if rnd.random() < 0.7 else rnd.choice(some)
                       for _ in range(rnd.randrange(200)))
        expected = tok.encode(text, add_special_tokens=False).ids
        pieces = bpe.split_text(tok, text, rnd.choice([5, 17, 60]), rnd.choice([4, 16, 40]))
        encoded = [(k, ids_of(b) if k == bpe.TEXT else bpe.encode_leaf(tok, b))
                   for k, b in pieces]
        assert bpe.assemble(tok, encoded) == expected == ids_of(text)


def test_edit_distance():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a):
            new = [i + 1]
            for j, d in enumerate(b):
                new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (c != d)))
            row = new
        return row[-1]

    rnd = random.Random(2)
    for _ in range(1000):
        a, b = ("".join(rnd.choice("abc") for _ in range(rnd.randrange(12))) for _ in range(2))
        assert fuzzyhash.edit_distance(a, b) == plain(a, b)


def test_fingerprints(monkeypatch):
    rnd = random.Random(3)
    text = " ".join("".join(rnd.choices("abcdefgh", k=rnd.randrange(2, 9))) for _ in range(500))
    other = " ".join("".join(rnd.choices("ijklmnop", k=rnd.randrange(2, 9))) for _ in range(500))
    own = fuzzyhash.fingerprint(text)
    edited = fuzzyhash.fingerprint(fuzzyhash.edited_text(text, other))
    assert 0.2 < fuzzyhash.likeness(own, edited) < 0.9
    assert fuzzyhash.likeness(own, fuzzyhash.fingerprint(other)) < 0.2
    assert fuzzyhash.likeness(own, fuzzyhash.fingerprint(text[:700] + "x" + text[700:])) > 0.8
    assert fuzzyhash.fingerprint("") == fuzzyhash.fingerprint(None) == "1::"
    assert fuzzyhash.fingerprint("a").startswith("1:")
    monkeypatch.setattr(fuzzyhash, "STEP", 101)  # blocks do not change the result
    assert fuzzyhash.fingerprint(text) == own


def test_forward_is_exact_and_counts_sum():
    rnd = np.random.default_rng(4)
    k = 3
    norm = lambda x: x / x.sum(axis=-1, keepdims=True)
    emit = rnd.random((hmm.CLASSES + 1, k)) + 0.01
    model = hmm.Model(norm(rnd.random(k)), norm(rnd.random((k, k))), emit / emit.sum(axis=0))
    for n in (0, 1, 5, 33):
        words = [bytes([97 + int(c)]) for c in rnd.integers(0, 5, n)]
        spans = hmm.spans_of(words, hmm.Classes(), 7)
        ids = np.concatenate(spans)
        state, log = model.first * model.emit[ids[0]], 0.0
        for c in ids[1:]:
            log += np.log10(state.sum())
            state = (state / state.sum()) @ model.step * model.emit[c]
        expected = log + np.log10(state.sum())
        assert hmm.log10_likelihood([spans], model)[0] == pytest.approx(expected, rel=1e-10)
        counts = hmm.Counts.zero(k)
        counts.add([ids], np.array([True]), model)
        assert counts.emit.sum() == pytest.approx(len(ids))
        assert counts.step.sum() == pytest.approx(len(ids) - 1)


def test_expectation_step_raises_likelihood():
    rnd = random.Random(5)
    texts = [" ".join(rnd.choices(["aa", "bb", "cc"] if i % 2 else ["xx", "yy", "zz"], k=40))
             for i in range(30)]
    few = hmm.starting_model(texts, 2, passes=0)
    more = hmm.starting_model(texts, 2, passes=3)
    spans = [hmm.spans_of(hmm.tokens(t), hmm.Classes()) for t in texts]
    assert hmm.log10_likelihood(spans, more).sum() >= hmm.log10_likelihood(spans, few).sum()


def test_trees_learn_and_handle_one_class():
    rnd = np.random.default_rng(6)
    x = rnd.random((600, gbdt.N_STATISTICS))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.5)).astype(float)
    trees = gbdt.train(x[:400], y[:400])
    assert ((trees.probability(x[400:]) >= 0.5) == y[400:]).mean() > 0.9
    assert gbdt.train(x[:0], y[:0]).probability(x[:2]).tolist() == [0.5, 0.5]
    assert (gbdt.train(x, np.ones(600)).probability(x[:3]) > 0.9).all()
    assert gbdt.statistics(None) == gbdt.statistics("") == [0.0] * gbdt.N_STATISTICS
    assert len(gbdt.statistics("one line")) == gbdt.N_STATISTICS


def test_toxic_windows():
    long = "x" * 500
    text = f"The cat, {long} sat\non 3 mats."
    joined = b"".join(w.rstrip(b" ") if i else w for i, w in enumerate(toxicity.windows(text)))
    assert joined.decode().split() == ["the", "cat", long, "sat", "on", "3", "mats"]
    assert toxicity.windows(None) == toxicity.windows(" .,") == []
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choices("aeioulnrst", k=rnd.randrange(2, 8)))
    texts, labels = [], []
    for i in range(600):
        words = [word() for _ in range(60)]
        if i % 4 == 0:
            for at in rnd.sample(range(60), 4):
                words[at] = rnd.choice(["blockhead", "nitwits", "dimwitted"])
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    model = toxicity.train(texts[:400], labels[:400])
    hit = (toxicity.score_texts(model, texts[400:]) >= 0.5) == np.array(labels[400:])
    assert hit.mean() > 0.95
    assert toxicity.score_texts(toxicity.train(["a"], [0]), ["a", None]).tolist() == [0.0, 0.0]


PAGE = """<html><head><title>t</title><style>p{}</style><script>var a="</p><p>no";</script></head>
<body><header>Site</header><nav><ul><li><a href=/>Menu</a></ul></nav>
<div class="cookie-notice">We use cookies</div>
<article><h1>Head &amp;  line</h1><p>One <b>two</b>
 three<p>Four<div class="ad">Buy</div><p>Five</article>
<div class="sidebar">Side</div><section id="comments"><p>First!</p></section>
<form><p>Mail</p></form><footer>&copy; x</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE) == "Head & line\nOne two three\nFour\nFive"
    assert html_text.main_text(None) == html_text.main_text("") == ""
    assert html_text.main_text("<nav>a</nav>") == ""
    assert html_text.main_text("just text") == "just text"
    assert html_text.main_text("<div><p>a b</p><p>c</div><footer>f") == "a b\nc"


def passage(start, stop):
    lines = [f"Words of the body that go on for some length, one after the other, part {i}."
             for i in range(start, stop)]
    return "".join(f"<p>{x}</p>" for x in lines), "\n".join(lines)


@pytest.mark.parametrize("page, whole", [
    ("<div class=content>{body}</div>{card}", False),
    ("<div>{body}</div>{card}", False),
    ("{card}<div>{body}</div>", False),
    ("{body}{card}", False),
    ("<div><div>{body}</div><div>{card}</div></div>", False),
    ("<article>{body}</article><article>{rest}</article>", True),
    ("<article>{body}</article>{rest}", True),
    ("<div><div>{body}</div><div>{rest}</div></div>", True),
    ("{links}<article>{body}</article>", False),
])
def test_content_region_goes_by_text(page, whole):
    (body, expected), (rest, more) = passage(0, 6), passage(6, 10)
    card = f"<article><h3>Card</h3>{passage(10, 11)[0]}</article>"
    links = "<div>" + "".join(f"<p><a href=/{i}>Link {i}</a></p>" for i in range(60)) + "</div>"
    html = page.format(body=body, rest=rest, card=card, links=links)
    got = html_text.main_text(f"<html><body><nav>Menu</nav>{html}</body></html>")
    assert got == (f"{expected}\n{more}" if whole else expected)


@pytest.mark.parametrize("page", [
    "<div id=wrapper class='has-sidebar'><article>{body}</article>{side}{comments}</div>",
    "<div class='page with-menu'><div class=menu>Home</div><div>{body}</div>{comments}</div>",
    "<div class='layout sidebar-right'><main>{body}</main></div>",
    "<form><div>{body}</div><input name=a><button>Go</button></form>",
    "<div class='page with-comments'><article>{body}</article>{comments}</div>",
    # names that do count
    "<article>{body}</article><div class=comments>{long}</div>",
    "<div>{body}</div><div class=comments><article>{long}</article></div>",
    "<div>{body}</div><div class=sidebar>{long}</div>",
    "<article>{body}</article><form class=newsletter>{side}</form>",
])
def test_names_and_forms_around_the_content_do_not_count(page):
    body, expected = passage(0, 6)
    html = page.format(body=body, long=passage(6, 13)[0], side="<div class=sidebar>Side</div>",
                       comments=f"<section id=comments>{passage(13, 15)[0]}</section>")
    assert html_text.main_text(f"<html><body><nav>Menu</nav>{html}</body></html>") == expected


def test_warc_parser_goes_by_length():
    import io

    body = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    record = (b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: %d\r\n\r\n" % len(body)
              + body + b"\r\n\r\n")
    found = list(warc.parse_records(io.BytesIO(record * 2)))
    assert [r["block"] for r in found] == [body, body]
    with pytest.raises(ValueError):
        list(warc.parse_records(io.BytesIO(record[:-20])))


def test_bitmap_never_rejects_a_similar_pair():
    rnd = np.random.default_rng(8)
    for _ in range(200):
        base = rnd.integers(0, 1 << 63, int(rnd.integers(2, 200)), dtype=np.uint64)
        a = np.unique(base)
        b = np.unique(np.concatenate([base[rnd.random(len(base)) > 0.1],
                                      rnd.integers(0, 1 << 63, 3, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        similar = 100 * both >= 80 * (len(a) + len(b) - both)
        maps = np.array([ngramjoin.bitmap(a), ngramjoin.bitmap(b)], dtype=object)
        sizes, widths = np.array([len(a), len(b)]), np.array([len(m) for m in maps])
        allowed = ngramjoin.overlap_allowed(maps, widths, sizes, np.array([0]), np.array([1]))[0]
        assert allowed or not similar
        if similar:
            none = np.zeros(0, dtype=np.uint64)
            assert set(ngramjoin.prefix(a, none).tolist()) & set(ngramjoin.prefix(b, none).tolist())
            last = np.sort(rnd.choice(a, len(a) // 2, replace=False))
            assert (set(ngramjoin.prefix(a, last).tolist())
                    & set(ngramjoin.prefix(b, last).tolist()))


def test_tile_links_against_all_pairs():
    rnd = np.random.default_rng(9)
    a = rnd.normal(size=(300, 16))
    b = np.concatenate([a[:100] + 0.05 * rnd.normal(size=(100, 16)), rnd.normal(size=(50, 16))])
    axes = np.linalg.qr(rnd.normal(size=(16, 16)))[0]
    ua, ub = pcadedup.unit_rows(a), pcadedup.unit_rows(b)
    i, j = pcadedup.tile_links(a, b, axes, 0.95, False)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(
        ua @ ub.T >= 0.95))))
    both = np.concatenate([a, b])
    u = pcadedup.unit_rows(both)
    i, j = pcadedup.tile_links(both, both, axes, 0.95, True)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(
        np.triu(u @ u.T >= 0.95, 1)))))


def test_cells_and_their_margins_lose_no_link():
    rnd = np.random.default_rng(4)
    for dim, dtype in ((5, float), (40, np.float32), (40, float)):
        centres = rnd.normal(size=(12, dim))
        x = (centres[rnd.integers(0, 12, 900)] + 0.15 * rnd.normal(size=(900, dim))) * 10.0 ** rnd.integers(
            -9, 9, (900, 1))
        x = np.concatenate([x, rnd.normal(size=(300, dim)), x[:40] * 3]).astype(dtype)
        x = x[rnd.permutation(len(x))]
        axes = np.linalg.qr(rnd.normal(size=(dim, dim)))[0]
        tiles, starts = [], np.array([0, 1, 200, 450])
        for part in (x[:640], x[640:]):
            # any points will do as pivots: near ones, the same one twice, far ones, none
            pivots = np.stack([pcadedup.unit_rows(part[:1])[0] @ axes] * 2 + [
                pcadedup.unit_rows(part[300:301])[0] @ axes, np.zeros(dim)])
            tiles.append(pcadedup.Tile(part, axes, starts, pivots))
        u = pcadedup.unit_rows(x)
        link = u @ u.T >= 0.95
        got = set()
        for a, b, more, less in ((0, 0, 0, 0), (1, 1, 640, 640), (0, 1, 0, 640)):
            for i, j in pcadedup.links_between(tiles[a], tiles[b], 0.95):
                some = set(zip((i + more).tolist(), (j + less).tolist()))
                assert len(some) == len(i) and not some & got  # each pair once
                got |= some
        assert got == set(zip(*map(np.ndarray.tolist, np.nonzero(np.triu(link, 1)))))
        assert len(got) > 1000


def test_ids_in_any_order_decode_as_by_the_library():
    tok, text_of, rnd = bpe.tokenizer(PATH), bpe.whole_decoder(PATH), random.Random(2)
    size = tok.get_vocab_size()
    for n in (0, 1, 2, 5, 50, 500):
        for _ in range(40):  # cut code points and invalid bytes come up as well
            ids = [rnd.randrange(size) for _ in range(n)]
            assert text_of(ids) == tok.decode(ids, skip_special_tokens=False)
    for i in range(size):
        assert text_of([i]) == tok.decode([i], skip_special_tokens=False)
    for a in range(188, 256):  # pairs of single bytes
        for b in range(256):
            assert text_of([a, b, a]) == tok.decode([a, b, a], skip_special_tokens=False)


def test_repeated_passages_take_larger_blocks():
    rnd = random.Random(3)
    for unit in ("abcdefgh ", "x", "one two three four five six seven ", "é"):
        for n in (500, 2_000, 20_000):
            text = unit * n
            cut = 3 * len(text) // 4
            other = text[:cut] + "".join(rnd.choices("abcdefghij ", k=len(text) - cut))
            for t in (text, other):
                signs = fuzzyhash.fingerprint(t).split(":")[1:]
                assert all(len(x) <= fuzzyhash.LIMIT for x in signs)
            assert fuzzyhash.likeness(fuzzyhash.fingerprint(text), fuzzyhash.fingerprint(other)) < 1
    # each end after the block's: any text, whole or in steps, within the limit
    for _ in range(50):
        base = "".join(rnd.choices("ab ", k=rnd.randrange(1, 40)))
        text = base * rnd.randrange(1, 400)
        size, one, two = fuzzyhash.fingerprint(text).split(":")
        data = text.encode()
        ends, double = fuzzyhash.chunk_ends(data, int(size).bit_length() - 1)
        if len(ends) < fuzzyhash.LIMIT:
            assert one == fuzzyhash.signature(data, ends.tolist())
            assert two == fuzzyhash.signature(data, ends[double].tolist())
        else:
            assert len(one) == len(two) == 1


def test_shingle_sets_count_distinct_windows_whatever_the_slice():
    texts = ["", None, " \n", "one two", "a b c d e", "a a a a a a a", "A b\x0bC  d e f é", "x" * 500 + " y",
             " ".join(f"w{i % 50}" for i in range(400))] * 3
    sets = list(ngramjoin.shingle_sets(texts))
    assert len(sets) == len(texts)
    for text, got in zip(texts, sets):
        words = (text or "").encode().lower().split()
        k = min(5, len(words))
        want = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()
        assert len(got) == len(want)
        assert (ngramjoin.shingle_set(text) == got).all()
    long = " ".join(texts[-1:] * 3).encode()
    for size in (1, 7, 64):
        at, hashes = ngramjoin.word_hashes(long, size)
        whole = ngramjoin.word_hashes(long)
        assert (at == whole[0]).all() and (hashes == whole[1]).all()
