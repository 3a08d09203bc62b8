import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from murmur.llm import bpe
from tests.llm.cases import empty, odd

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
PARTS = ["a", "b", "th", "the", " ", "  ", "\n", "\t", "'", "'s", "'ll", "'l", "é", "ß", "日本", "1", "23", "!", "--", "　", "ing", "\r\n", "😀", "xxxxx"]


@pytest.fixture(scope="module")
def both():
    ours = bpe.load(bpe.read_ranks(PATH), PATTERN)
    return ours, tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ours.ranks, special_tokens={})


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


@pytest.mark.parametrize("leaf", [3, 8, 1 << 16])
def test_tree_equals_the_library(both, monkeypatch, leaf):
    monkeypatch.setattr(bpe, "LEAF_CHARS", leaf)
    ours, library = both
    rng = random.Random(leaf)
    for _ in range(1500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40)))
        assert ids(ours.encode(text)) == library.encode_ordinary(text)


@pytest.mark.parametrize("leaf", [1, 2, 5])
def test_byte_tree_equals_the_library(both, monkeypatch, leaf):
    monkeypatch.setattr(bpe, "LEAF_BYTES", leaf)
    ours, library = both
    rng = random.Random(leaf)
    for _ in range(500):
        text = "".join(rng.choice("abethingsou") for _ in range(rng.randint(1, 200)))
        assert ours.encode_bytes(text.encode()) == library.encode_ordinary(text)


def test_long_pieces_and_every_token(both):
    ours, library = both
    for text in ("ab" * 20_000, "é" * 9_000, " " * 30_000 + "x", "a" * 10_001):
        assert ids(ours.encode(text)) == library.encode_ordinary(text)
    assert all(ours.merge(t) == [i] for t, i in list(ours.ranks.items())[::7])


def test_decoding_is_the_inverse(both, monkeypatch):
    monkeypatch.setattr(bpe, "LEAF_IDS", 4)
    ours, _ = both
    for text in ("", "Höher, schneller!", "日本" * 50):
        assert bpe.decode_ids(ours.tokens, ids(ours.encode(text))).decode() == text


def test_rows(spark):
    out = bpe.decode(bpe.encode(odd(spark), PATH, PATTERN), PATH)
    assert out.exceptAll(bpe.encode(odd(spark), PATH, PATTERN, decoded=True)).count() == 0
    got = sorted((str(r["doc_id"]), r["n_tokens"], bytes(r["decoded"]).decode()) for r in out.collect())
    assert [(i, t) for i, _, t in got] == sorted((str(r["doc_id"]), r["text"] or "") for r in odd(spark).collect())
    assert all((n == 0) == (t == "") for _, n, t in got)
    assert bpe.encode(empty(spark), PATH, PATTERN).count() == 0


def test_vocabulary_file_is_text():
    line = bpe.read_ranks(PATH).splitlines()[0].split()
    assert base64.b64decode(line[0]) and int(line[1]) >= 0
