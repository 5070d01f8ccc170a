"""Byte-level BPE encoding and decoding with a given public vocabulary.

Ordinary texts are encoded whole inside Arrow batches, by ``tiktoken`` where the
vocabulary file allows it (its ids are in merge order; several times faster)
and else by the ``tokenizers`` library; both give the same ids. A text above ``long_chars`` is cut into pieces that are encoded in
parallel, as rows of their own:

* where an ASCII space follows an ASCII letter or digit the pre-tokenizer
  always starts a new token, so pieces cut there are exact as they stand;
* a longer stretch without such a place is pre-tokenized, and a pre-token above
  ``leaf_bytes`` (text that the vocabulary's pattern does not split at all) is
  halved into leaves. The encoded leaves are concatenated as a tree: around
  each join a window of tokens is encoded anew and grown until its first and
  its last token are those that the left and the right side already had there
  (or the window has reached the side's end). A token sequence whose
  neighbours all encode to themselves is the encoding of its text, so agreement
  at both window ends makes the joined sequence exact.

Edge cases: a null text counts as empty; an empty text has no tokens and
decodes to an empty text; repeated rows are encoded each; an empty table gives
an empty result; special-token strings in a text become their special token,
as the library does without added tokens; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONG_CHARS = 1 << 16
LEAF_BYTES = 1 << 14
PASSED_ON = 500  # texts whose ids a worker holds at once
SAFE_CUT = re.compile(r"(?<=[A-Za-z0-9]) ")
TEXT, LEAF, LEAF_NEXT = 0, 1, 2  # LEAF_NEXT continues the pre-token of the leaf before


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    """The vocabulary file's tokenizer, one for each worker process."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


class LoadedOnUse:
    """The tokenizer of a vocabulary file, loaded when it is first asked for something:
    most texts are split and joined without it."""

    def __init__(self, path: str):
        self.path = path

    def __getattr__(self, name: str):
        return getattr(tokenizer(self.path), name)


# Fixed value: the published pattern of byte-level pre-tokenization.
PATTERN = (
    r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
)


def _spec(path: str) -> dict:
    import json

    with open(path, encoding="utf-8") as f:
        return json.load(f)


@functools.lru_cache(maxsize=4)
def whole_encoder(path: str):
    """A function from a text to its ids. The library is loaded only where it is used,
    as each worker holds what it loads."""

    def by_library(text: str) -> list[int]:
        return tokenizer(path).encode(text, add_special_tokens=False).ids

    spec = _spec(path)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    plain_added = not any(
        t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", [])
    )
    if (model.get("type") != "BPE" or not byte_level or pre.get("add_prefix_space")
            or spec.get("normalizer") or not plain_added):
        return by_library
    signs = byte_signs()
    vocab = {t: i for t, i in model["vocab"].items() if t not in added}
    merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    first = len(vocab) - len(merges)
    if any(vocab.get(m.replace(" ", "")) != first + k for k, m in enumerate(merges)):
        return by_library
    import tiktoken

    ranks = {bytes(signs[c] for c in t): i for t, i in vocab.items()}
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return functools.partial(enc.encode, allowed_special="all")


@functools.lru_cache(maxsize=4)
def whole_decoder(path: str):
    """A function from ids to their text, by a table of each token's bytes where the
    vocabulary is byte-level, else by the library. Ids without a token give nothing."""
    spec = _spec(path)
    if (spec.get("decoder") or {}).get("type") != "ByteLevel":
        return lambda ids: tokenizer(path).decode(ids, skip_special_tokens=False)
    signs = byte_signs()
    tokens = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    table = [b""] * (max(tokens.values(), default=-1) + 1)
    for token, i in tokens.items():
        table[i] = bytes(signs[c] for c in token) if set(token) <= signs.keys() else token.encode()

    def decode(ids: list[int]) -> str:
        known = (table[i] for i in ids if i < len(table))
        return b"".join(known).decode("utf-8", "replace")

    return decode


def byte_signs() -> dict[str, int]:
    """The printable sign of each byte in byte-level vocabularies: itself where
    Latin-1 prints it, else the next free sign from U+0100 on."""
    out, spare = {}, 0x100
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b:
            out[chr(b)] = b
        else:
            out[chr(spare)] = b
            spare += 1
    return out


def _packed(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def _unpacked(data: bytes) -> list[int]:
    return np.frombuffer(data, dtype="<u4").tolist()


def split_text(tok, text: str, long_chars: int, leaf_bytes: int) -> list[tuple[int, str]]:
    """Pieces of a text, in order, whose encodings concatenate to the text's."""
    cuts = [0, *(m.start() for m in SAFE_CUT.finditer(text)), len(text)]
    out, start = [], 0
    for at, after in zip(cuts[1:], [*cuts[2:], None]):
        if after is not None and after - start <= long_chars:
            continue  # the next place still fits
        if at > start:
            if at - start <= long_chars:
                out.append((TEXT, text[start:at]))
            else:
                out.extend(_split_stretch(tok, text[start:at], long_chars, leaf_bytes))
            start = at
    return out


def _split_stretch(tok, stretch: str, long_chars: int, leaf_bytes: int) -> Iterator[tuple[int, str]]:
    special = [t.content for t in tok.get_added_tokens_decoder().values()]
    parts = re.split("(" + "|".join(map(re.escape, special)) + ")", stretch) if special else [stretch]
    for part in parts:
        if not part:
            continue
        if part in special:
            yield TEXT, part
            continue
        # Ordinary pre-tokens are gathered. A piece that ends in white space could be
        # pre-tokenized otherwise when it stands alone, so white space at its end
        # goes into pieces of its own.
        gathered: list[tuple[int, int]] = []
        for body, (a, b) in tok.pre_tokenizer.pre_tokenize_str(part):
            if len(body) > leaf_bytes:
                yield from _gathered(part, gathered)
                n = 1
                while len(body) > leaf_bytes * n:
                    n *= 2
                edges = [len(body) * i // n for i in range(n + 1)]
                for i in range(n):
                    yield (LEAF if i == 0 else LEAF_NEXT), body[edges[i] : edges[i + 1]]
                gathered = []
                continue
            if gathered and b - gathered[0][0] > long_chars:
                yield from _gathered(part, gathered)
                gathered = []
            gathered.append((a, b))
        yield from _gathered(part, gathered)


def _gathered(part: str, spans: list[tuple[int, int]]) -> Iterator[tuple[int, str]]:
    n = len(spans)
    while n and part[spans[n - 1][1] - 1].isspace():
        n -= 1
    if n:
        yield TEXT, part[spans[0][0] : spans[n - 1][1]]
    for a, b in spans[n:]:
        yield TEXT, part[a:b]


def encode_leaf(tok, body: str) -> list[int]:
    """Token ids of text already mapped byte by byte to the vocabulary's signs."""
    return [t.id for t in tok.model.tokenize(body)]


def join_sides(tok, left: list[int], right: list[int]) -> list[int]:
    """The exact encoding of two neighbours' text from their own encodings."""
    w = 2
    while left and right:
        a, b = left[-w:], right[:w]
        window = encode_leaf(tok, "".join(map(tok.id_to_token, a + b)))
        if (len(a) == len(left) or window[0] == a[0]) and (
            len(b) == len(right) or window[-1] == b[-1]
        ):
            return left[: len(left) - len(a)] + window + right[len(b) :]
        w *= 2
    return left or right


def join_tree(tok, leaves: list[list[int]]) -> list[int]:
    while len(leaves) > 1:
        leaves = [
            join_sides(tok, leaves[i], leaves[i + 1]) if i + 1 < len(leaves) else leaves[i]
            for i in range(0, len(leaves), 2)
        ]
    return leaves[0] if leaves else []


def assemble(tok, pieces: list[tuple[int, list[int]]]) -> list[int]:
    """Ids of a text from its encoded pieces in order."""
    out, run = [], []
    for kind, ids in pieces:
        if kind != LEAF_NEXT and run:
            out += join_tree(tok, run)
            run = []
        if kind == TEXT:
            out += ids
        else:
            run.append(ids)
    return out + join_tree(tok, run)


def decode_column(ids: Column, path: str) -> Column:
    """Texts of packed ids; special tokens are kept."""

    @F.pandas_udf("string")
    def decode(packed: pd.Series) -> pd.Series:
        text_of = whole_decoder(path)
        return pd.Series([text_of(_unpacked(p)) for p in packed], dtype=object)

    return decode(ids)


def encode(docs: DataFrame, path: str, long_chars: int = LONG_CHARS,
           leaf_bytes: int = LEAF_BYTES, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) of every row, ids as little-endian unsigned 32-bit integers; with
    ``decoded`` also the text that they decode to, special tokens kept, from the same
    pass: one worker for each task and not two. ``docs`` must be a table or a
    checkpoint, as rows of long texts are numbered while they are read."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    is_long = F.length("text") > long_chars
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, ids binary" + ", decoded string" * decoded

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = whole_encoder(path)
        text_of = whole_decoder(path) if decoded else None
        for batch in batches:
            for at in range(0, batch.num_rows, PASSED_ON):
                part = batch.slice(at, PASSED_ON)
                ids = [_packed(ids_of(t)) for t in part.column("text").to_pylist()]
                out = {"doc_id": part.column("doc_id"), "ids": pa.array(ids, pa.binary())}
                if decoded:
                    texts = [text_of(_unpacked(p)) for p in ids]
                    out["decoded"] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_pydict(out)

    short = rows.filter(~is_long).mapInArrow(code, schema)

    @F.pandas_udf("array<struct<kind:int,body:string>>")
    def split(texts: pd.Series) -> pd.Series:
        tok = LoadedOnUse(path)
        return pd.Series(
            [[{"kind": k, "body": b} for k, b in split_text(tok, t, long_chars, leaf_bytes)]
             for t in texts], dtype=object
        )

    @F.pandas_udf("binary")
    def encode_pieces(kinds: pd.Series, bodies: pd.Series) -> pd.Series:
        ids_of = whole_encoder(path)
        return pd.Series(
            [_packed(ids_of(b) if k == TEXT else encode_leaf(tokenizer(path), b))
             for k, b in zip(kinds, bodies)], dtype=object
        )

    def whole(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pos")
        ids = assemble(
            LoadedOnUse(path), [(k, _unpacked(p)) for k, p in zip(group["kind"], group["ids"])]
        )
        out = {"doc_id": group["doc_id"].iloc[:1].astype("Int64"), "ids": [_packed(ids)]}
        if decoded:
            out["decoded"] = [whole_decoder(path)(ids)]
        return pd.DataFrame(out)

    pieces = (
        rows.filter(is_long)
        .select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
        .select("doc_id", "row", F.posexplode(split("text")).alias("pos", "piece"))
        .select("doc_id", "row", "pos", "piece.kind", "piece.body")
        .repartition("row", "pos")
    )
    long = (
        pieces.select("doc_id", "row", "pos", "kind",
                      encode_pieces("kind", "body").alias("ids"))
        .groupBy("row")
        .applyInPandas(whole, schema)
    )
    return short.unionByName(long)
