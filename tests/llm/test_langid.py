"""Sums against listed segmentations; held-out accuracy; odd texts."""

import math

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from layerworks.llm import langid

PATH = public_tokenizers.path("piece_bpe_32k.model")


def listed(text, known, weights, count):
    """Sum over all segmentations, by recursion, and the expected counts."""
    if not text:
        return [([], 1.0)]
    out = []
    for end in range(1, len(text) + 1):
        piece = known.get(text[:end], -1)
        if piece < 0 and end == 1:
            piece = count
        if piece >= 0:
            out += [([piece, *rest], weights[piece] * p) for rest, p in listed(text[end:], known, weights, count)]
    return out


def test_sums_and_counts_equal_listed_segmentations():
    known, count = langid.pieces(PATH)
    rng = np.random.default_rng(0)
    table = rng.dirichlet(np.ones(count + 1), 2).T
    words = ["a", "the", "über", "señor", "日x", "thing"]
    got = langid.forward(words, table, known, count)
    for column in range(2):
        for i, word in enumerate(words):
            ways = listed("▁" + word, known, table[:, column], count)
            assert got[i, column] == pytest.approx(math.log(sum(p for _, p in ways)))
    counts = langid.expected_counts(words, np.ones(6), table[:, 0], known, count)
    expected = np.zeros(count + 1)
    for word in words:
        ways = listed("▁" + word, known, table[:, 0], count)
        for parts, p in ways:
            np.add.at(expected, parts, p / sum(q for _, q in ways))
    assert np.allclose(counts, expected)
    long = "thingandüber" * 4
    assert np.allclose(langid.forward([long], table, known, count)[0], langid._long_word(long, table, known, count))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    away = langid.held_out(F.col("doc_id"), 4, 2)
    model = langid.train(docs.where(~away), PATH, sample_per_language=100)
    rows = langid.identify(docs.where(away).withColumn("score", F.lit("x")), model).collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_texts(spark):
    docs = spark.createDataFrame(
        [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (None, "the dog", "en"), (4, None, "de"), (5, "x", None)],
        "doc_id long, text string, lang string",
    )
    model = langid.train(docs, PATH, iterations=1)
    odd = [(1, None), (2, ""), (3, "12 ²!"), (4, "the the"), (4, "the the"), (5, "und" * 30000), (None, "Katze 日本")]
    rows = langid.identify(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()
    assert len(rows) == 7
    assert [r.lang_pred for r in rows if r.doc_id in (1, 2, 3)] == ["und"] * 3
    assert {r.lang_pred for r in rows if r.doc_id == 4} == {"en"}
    empty = langid.train(docs.limit(0), PATH)
    assert {r.lang_pred for r in langid.identify(docs, empty).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).collect() == []


@pytest.mark.parametrize("letter", ["ж", "ᚠ", "a", "é", "日"])
def test_long_runs_stay_inside_the_range_of_doubles(letter):
    known, count = langid.pieces(PATH)
    table = np.full((count + 1, 3), 1e-12)
    table[:, 1] = 1 / (count + 1)
    table[known.get("a", 0)] = 0.9
    words = [letter * size for size in range(40, 61)]
    got = langid.forward(words, table, known, count)
    assert np.isfinite(got).all()
    for row, word in zip(got, words):
        assert np.allclose(row, langid._long_word(word, table, known, count))
    counts = langid.expected_counts(words[:9], np.ones(9), table[:, 0], known, count)
    assert np.isfinite(counts).all() and counts.sum() > 0


def test_texts_with_runs_of_an_unknown_script(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs, PATH)
    odd = [(n, f"the cat and the dog were in the house {letter * n}") for letter in ("ᚠ", "ж") for n in (30, 46, 47, 48, 49, 60, 200)]
    rows = langid.identify(spark.createDataFrame(odd, "doc_id long, text string").coalesce(1), model).collect()
    assert all(0 <= r.score <= 1 for r in rows)
