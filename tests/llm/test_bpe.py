"""Joined halves, whole queries and decoding against the library itself."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from layerworks.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", "b", "the", " the", "ing", "'", "'s", "'re", "'l", " ", "  ", "\n", "\n\n", "\t", "1", "234", "!!", "...", "é", "日本", "😀",
    "<|endoftext|>", " ", "\x1c", "don't", "xyzzy" * 5, "lo" * 9, "aaaaaaaa", "=====", "́", "Ab", "ÖÄ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def made(rng, size):
    if rng.random() < 0.3:  # one unbroken run
        letters = rng.choice(["ab", "abcdefgh ", "e", "=-", "12", "日本語", "thein"])
        return "".join(rng.choice(letters.strip() or "x") for _ in range(size * 6))
    return "".join(rng.choice(PARTS) for _ in range(size))


@pytest.mark.parametrize("seed", range(6))
def test_joined_leaves_are_the_encoding(library, seed):
    rng = random.Random(seed)
    tool = bpe.encoder(PATH)
    for _ in range(120):
        text = made(rng, rng.choice([3, 20, 200, 900]))
        leaves = bpe.leaf_texts(text, rng.choice([1, 2, 7, 64, 500]), tool.special)
        assert "".join(leaves) == text
        whole = bpe.join_tree([tool.piece(t) for t in leaves]) if text else None
        if whole is not None:
            assert whole.ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_whole_frame(spark, library):
    rng = random.Random(7)
    texts = [None, "", " ", "plain words here", "plain words here", made(rng, 3000), "unbroken" * 4000, "<|endoftext|>" * 3]
    rows = [(i if i else None, t, "x") for i, t in enumerate(texts)] + [(3, "plain words here", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.decode(bpe.encode(docs, PATH, leaf_chars=500), PATH).collect()
    expected = sorted((i or -1, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t, _ in rows)
    assert sorted((r.doc_id or -1, list(r.ids), r.decoded) for r in out) == expected


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, PATH), PATH).collect() == []
