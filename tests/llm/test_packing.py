"""Pieces against the library; packing against its rules and the lower bound."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from layerworks.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_equal_the_library(spark):
    library = Tokenizer.from_file(PATH)
    rng = random.Random(3)
    parts = ["a", "The", " ", "\n", "\t", " ", "é", "é", "İ", "ΑΣ", "12", "don't", "!!", "日本", "<|endoftext|>", "don't'll", "ÀÉß", "e\u0301", "½²", "I'M", "\xa0", "word " * 30, "\x1c"]
    texts = [None, "", "   ", "x" * 9000] + ["".join(rng.choice(parts) for _ in range(rng.choice([5, 60, 400]))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = defaultdict(list)
    for row in packing.token_pieces(docs, PATH, capacity=50, with_ids=True).collect():
        got[row.doc_id].append(row)
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        rows = sorted(got[i], key=lambda r: r.piece)
        assert [list(r.ids) for r in rows] == [ids[j : j + 50] for j in range(0, len(ids), 50)]
        assert [r.start for r in rows] == list(range(0, len(ids), 50))
        assert [r.ids_crc32 for r in rows] == [zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows]


def test_words_encoded_together_equal_the_library():
    library = Tokenizer.from_file(PATH)
    rng = random.Random(7)
    signs = [chr(c) for c in range(0x250)] + ["\u0301", "\u03a3", "'s", "'LL", "<|endoftext|>", "<|", "the", "ing"]
    texts = signs + ["".join(rng.choices(signs, k=rng.choice([2, 3, 9, 40]))) for _ in range(3000)] + ["x" * 5000, "\n", "\0", "a\0\n\0b"]
    got = packing.WordEncoder(PATH).encode_all(texts)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == [code.ids for code in library.encode_batch(texts, add_special_tokens=False)]


def test_new_words_are_not_encoded_one_by_one():
    class Counted:
        def __init__(self, ranked):
            self.ranked, self.calls = ranked, 0

        def __getattr__(self, name):
            self.calls += 1
            return getattr(self.ranked, name)

    tool = packing.WordEncoder(PATH)
    tool.ranked = Counted(tool.ranked)
    tool.encode_all([" ".join(f"word{i}," for i in range(2000))])
    assert 1 <= tool.ranked.calls < 10


def check(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_is_whole_gapless_and_tight(spark):
    rng = random.Random(5)
    sizes = [rng.choice([rng.randint(1, 40), rng.randint(30, 70), 100, 7]) for _ in range(3000)]
    items = spark.createDataFrame([(i % 900 if i % 50 else None, 0, 0, s, i) for i, s in enumerate(sizes)], packing.ITEM)
    rows = packing.pack(items, capacity=100, block=500).collect()
    assert sorted(r.ids_crc32 for r in rows) == list(range(3000))
    assert {r.ids_crc32: r.length for r in rows} == dict(enumerate(sizes))
    assert check(rows, 100) <= -(-sum(sizes) // 100) * 1.02 + 2


def test_no_rows(spark):
    assert packing.pack(spark.createDataFrame([], packing.ITEM)).collect() == []


def test_generations_improve_a_hard_block():
    rng = np.random.default_rng(1)
    cuts = [np.diff(np.r_[0, np.sort(rng.choice(np.arange(1, 1000), 2, replace=False)), 1000]) for _ in range(60)]
    sizes = np.concatenate(cuts)  # sixty bins can be filled without a gap
    start = packing.best_fit(sizes, np.argsort(-sizes, kind="stable"), np.full(len(sizes), -1), 1000)
    people = packing.evolve(sizes, [], 1000, seed=2, generations=60)
    again = packing.evolve(sizes, [], 1000, seed=2, generations=60)
    assert (people[0] == again[0]).all()
    assert packing._fitness(sizes, people[0], 1000) > packing._fitness(sizes, start, 1000)
    assert np.bincount(people[0], weights=sizes).max() <= 1000


def test_large_ids_beside_missing_ones(spark):
    ids = [1152921504606846977, None, 2**62 + 1, -(2**62) - 1, None]
    items = spark.createDataFrame([(i, 0, 0, 40, n) for n, i in enumerate(ids)], packing.ITEM)
    rows = packing.pack(items, capacity=100).collect()
    assert {r.ids_crc32: r.doc_id for r in rows} == dict(enumerate(ids))
    assert check(rows, 100) == 3
