"""Encoding, decoding and prefix counts against the public libraries."""

import base64
import random

import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from grantflow.llm import bpe, token_counts

RANKS, MERGES = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  ", "\n\n  x", "a  b   c", "it's we'll they've I'd 'tis 're x'll'", "don''t 'lll", "naïve café ß ñ ÿ÷×",
    "日本語 текст 😀👍🏽 é", "x  y  z", "１２３ ½ ² Ⅷ 12 3", "\x1c\x1f\x85 a", "a" * 3000, " " * 300 + "x", "ab" * 700,
    "<|endoftext|>", "x <|endoftext|> y", "!!<|endoftext|><|endoftext|>", "a\t\n b\r\n\r\nc  ", "_ __ a_b", "Thing.\nOf ththndor!! ### $$$",
]


def texts() -> list[str]:
    chance = random.Random(5)
    letters = "aeiou thsrnd  \n'.,!çéñßü日<|>0123456789 ĐλЖ"
    return ODD + ["".join(chance.choice(letters) for _ in range(chance.randrange(200))) for _ in range(150)]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_library(library):
    own = bpe.codec(bpe.read_ranks(RANKS), P.PATTERN)
    for text, ids in zip(texts(), own.encode(texts()), strict=True):
        assert list(memoryview(ids).cast("I")) == library.encode_ordinary(text), repr(text[:50])
        assert own.decode(ids) == text.encode()


def test_long_pieces_merge_alike_in_rows_and_heap(library):
    own = bpe.codec(bpe.read_ranks(RANKS), P.PATTERN)
    out = [b""]
    for piece in (b"thereation" * 50, b"a" * 500, bytes(range(65, 91)) * 15):
        own._merge_rows([piece], [0], 512, out)
        assert out[0] == own._merge_long(piece)


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(MERGES)


def test_counts_are_those_of_the_library(reference):
    own = token_counts.counter(open(MERGES, "rb").read(), P.PATTERN)
    for text, steps in zip(texts(), own.prefix_steps(texts()), strict=True):
        assert len(steps) == len(text.encode())
        assert token_counts.tokens_at(steps, len(steps)) == len(reference.encode(text, add_special_tokens=False).ids)


def test_counts_at_every_prefix(reference):
    own = token_counts.counter(open(MERGES, "rb").read(), P.PATTERN)
    for text in [t for t in texts() if len(t) < 120]:
        (steps,) = own.prefix_steps([text])
        for i in range(len(text) + 1):
            whole = reference.encode(text[:i], add_special_tokens=False).ids
            assert token_counts.tokens_at(steps, len(text[:i].encode())) == len(whole), repr(text[:i])


def test_frames(spark, library, reference):
    data = [(i, t, i) for i, t in enumerate(texts())] + [(None, None, 1), (3, "twice", 1), (3, "twice", 1)]
    df = spark.createDataFrame(data, "doc_id long, text string, n_tokens int").repartition(3)
    encoded = bpe.decode(bpe.encode(df, RANKS, P.PATTERN), RANKS, P.PATTERN)
    assert encoded.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    for r in encoded.collect():
        assert r.n_tokens == len(library.encode_ordinary(r.text or "")) == len(r.ids) // 4
        assert bytes(r.decoded) == (r.text or "").encode()
    cut = token_counts.truncate(token_counts.prefix_counts(df, MERGES, P.PATTERN), 7).collect()
    assert len(cut) == len(data)
    for r in cut:
        prefixes = [(r.text or "")[:i] for i in range(len(r.text or "") + 1)]
        assert r.truncated in prefixes
        assert len(reference.encode(r.truncated, add_special_tokens=False).ids) <= 7
        if len(prefixes) < 300:
            assert all(len(reference.encode(p, add_special_tokens=False).ids) > 7 for p in prefixes[len(r.truncated) + 1 :])
    for made in (bpe.round_trip(df.limit(0), RANKS, P.PATTERN), token_counts.prefix_counts(df.limit(0), MERGES, P.PATTERN)):
        assert made.count() == 0
