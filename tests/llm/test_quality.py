"""Counts against plain Python; bounds against summed binomials; the guarantee on labels."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from layerworks.llm import quality


def model(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = set()
    for i, window in enumerate(windows):
        if windows.count(window) > 1:
            covered.update(range(i, i + 5))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_counts(spark):
    rng = random.Random(1)
    parts = ["a ", "b ", "the\n", "x\n", "\n", "#", "|<", "é ", "日本 ", "\x0b", "\x1c", " ", "one two three four five "]
    texts = [None, "", " \n ", "a b c d e", "a b c d e a b c d e", "w " * 4000]
    texts += ["".join(rng.choice(parts) for _ in range(rng.choice([4, 40, 150]))) for _ in range(80)]
    docs = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    for row in quality.measures(docs).collect():
        if texts[row.doc_id] != "w " * 4000:
            assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == model(texts[row.doc_id]), row
        else:
            assert row.n_repeat_words == 4000


@pytest.mark.parametrize("n,risk,error", [(0, 0.01, 0.05), (50, 0.1, 0.05), (400, 0.01, 0.05), (1000, 0.02, 0.001), (30000, 0.005, 1e-5), (300000, 0.01, 1e-4)])
def test_allowed_failures(spark, n, risk, error):
    found = spark.range(1).select(quality.allowed_failures(F.lit(n), risk, F.lit(error))).first()[0]
    log_of = lambda k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(risk) + (n - k) * math.log1p(-risk)
    total, best = 0.0, -1
    for k in range(n + 1):
        total += math.exp(log_of(k))
        if total > error:
            break
        best = k
    assert found == best


def corpus(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(3000):
        bad = i % 5 == 0
        words = [f"w{rng.randrange(10**6)}" + ("$$$$" if bad else "") for _ in range(30)]
        rows.append((i, " ".join(words), "en" if i % 2 else "fr"))
        if i % 3:
            labels.append((i, 0 if bad else 1))
    rows += [(9000, "few words", "en"), (9001, None, None), (9002, " ".join(f"q{i}" for i in range(20)), None), (9003, " ".join(f"z{i}####" for i in range(20)), "xx")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_rejects_bad_and_keeps_good(spark):
    docs, labels = corpus(spark)
    kept = {r.doc_id: r for r in quality.judged(docs, labels, alpha=0.05).collect()}
    assert len(kept) == 3004
    good = [kept[i].kept for i in range(3000) if i % 5]
    assert sum(good) / len(good) >= 0.98
    assert not any(kept[i].kept for i in range(0, 3000, 5))
    assert not kept[9000].kept and kept[9000].base_failed and not kept[9001].kept
    assert kept[9002].kept and kept[9003].kept  # no labels there: nothing is certified


def test_no_rows_and_no_labels(spark):
    docs, labels = corpus(spark)
    assert quality.judged(docs.limit(0), labels).collect() == []
    assert all(r.kept != r.base_failed for r in quality.judged(docs, labels.limit(0)).collect())


def test_no_python_in_the_plan(spark, plan):
    docs, labels = corpus(spark)
    assert "Python" not in plan(quality.measures(docs)) and "Arrow" not in plan(quality.judged(docs, labels))
