"""Marginals against all tag sequences; held-out scores; spans."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerworks.llm import toxicity
from layerworks.llm.common import remainder


def listed(emission, pairs, first):
    weights = {}
    for tags in itertools.product((0, 1), repeat=len(emission)):
        value = first[tags[0]] + sum(e for e, t in zip(emission, tags) if t)
        weights[tags] = np.exp(value + sum(pairs[a, b] for a, b in zip(tags, tags[1:])))
    total = sum(weights.values())
    return [sum(w for t, w in weights.items() if t[i]) / total for i in range(len(emission))]


def test_marginals_equal_listed_tags():
    rng = np.random.default_rng(0)
    pairs, first = rng.normal(size=(2, 2)), rng.normal(size=2)
    sizes = np.array([1, 3, 9, 2])
    emission = rng.normal(size=15) * 2
    got, joint = toxicity.chain(emission, sizes, pairs, first, with_pairs=True)
    expected, at = [], 0
    for size in sizes:
        expected += listed(emission[at : at + size], pairs, first)
        at += size
    assert np.allclose(got, expected)
    assert joint.sum() == pytest.approx(11)


def test_blocks_do_not_matter(monkeypatch):
    rng = np.random.default_rng(1)
    pairs, first = rng.normal(size=(2, 2)), rng.normal(size=2)
    sizes = np.array([1, 500, 32, 33, 64, 7, 1000])
    emission = rng.normal(size=sizes.sum()) * 5
    one = toxicity.chain(emission, sizes, pairs, first)[0]
    monkeypatch.setattr(toxicity, "BLOCK", 1)
    assert np.allclose(one, toxicity.chain(emission, sizes, pairs, first)[0])


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    return docs, labels, toxicity.train(docs, labels.where(remainder(F.col("doc_id"), 3) != 1))


def test_held_out_documents(trained):
    docs, labels, model = trained
    held = labels.where(remainder(F.col("doc_id"), 3) == 1).select("doc_id", "toxic")
    rows = toxicity.tag(docs.join(held, "doc_id"), model).select("toxic", "score", "text", "spans").collect()
    toxic = [r.score >= 0.7 for r in rows if r.toxic]
    clean = [r.score >= 0.7 for r in rows if not r.toxic]
    assert sum(toxic) / len(toxic) > 0.7 and sum(clean) / len(clean) < 0.01
    some = [r for r in rows if r.spans]
    assert any("idiot" in r.text[s.start : s.end].lower() for r in some for s in r.spans)


def test_odd_texts(spark, trained):
    model = trained[2]
    rows = [(1, None), (2, ""), (3, " \n"), (4, "idiot " * 20000), (None, "x"), (5, "what an idiot"), (5, "what an idiot")]
    out = toxicity.tag(spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("a")), model).collect()
    assert len(out) == 7 and all(0 <= r.score <= 1 for r in out)
    assert all(r.score < 0.7 and not r.spans for r in out if r.doc_id in (1, 2, 3))
    assert [(s.start, s.end) for r in out if r.doc_id == 5 for s in r.spans] == [(8, 13)] * 2
    assert toxicity.tag(spark.createDataFrame([], "doc_id long, text string"), model).collect() == []


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert all(r.score < 0.7 for r in toxicity.tag(docs, model).collect())
