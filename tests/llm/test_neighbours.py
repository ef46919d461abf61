"""Recall and order against brute force; copies, ties and vectors that take no part."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerworks.llm import neighbours


def brute(rows, is_query, k):
    good = {}
    for i, v in rows:
        if v is not None and all(x is not None for x in v):
            a = np.array(v, float)
            if np.isfinite(a).all() and a.any():
                good[i] = a
    ids = np.array(sorted(good))
    matrix = np.array([good[i] for i in ids])
    out = {}
    for i in ids:
        if is_query(i):
            scores = matrix @ good[i]
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), scores[j]) for j in order]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, expected):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in e}) for q, e in expected.items())
    return hits / sum(map(len, expected.values()))


def test_recall_on_the_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    got = answers(neighbours.nearest(vectors, F.col("vec_id") % 20 == 0))
    expected = brute(rows, lambda i: i % 20 == 0, 20)
    assert got.keys() == expected.keys() and all(len(x) == 20 for x in got.values())
    assert recall(got, expected) >= 0.95
    by_id = {i: np.array(v, float) for i, v in rows}
    for q, found in got.items():
        assert all(score == pytest.approx(by_id[q] @ by_id[i], rel=1e-12, abs=1e-12) for i, score in found)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_copies_lengths_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) * rng.uniform(0.2, 3)).round(3).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)]
    rows += [(2000, None), (2001, [0.0] * 6), (2002, [None, 1.0, 1.0, 1.0, 1.0, 1.0]), (2003, [float("nan")] + [1.0] * 5), (2004, [float("inf")] + [1.0] * 5), (1001, rows[3][1])]
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, node int")
    got = answers(neighbours.nearest(vectors, F.col("vec_id") % 10 == 0))
    expected = brute(rows, lambda i: i % 10 == 0, 20)
    assert got.keys() == expected.keys()
    assert recall(got, expected) >= 0.95
    assert [i for i, _ in got[1010]] == [i for i, _ in expected[1010]]  # copies by their smallest ids


@pytest.mark.parametrize("count", [0, 1, 2, 5])
def test_few_rows(spark, count):
    rows = [(i * 20, [1.0, float(i + 1)]) for i in range(count)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = answers(neighbours.nearest(vectors, F.col("vec_id") % 20 == 0))
    expected = brute(rows, lambda i: True, 20) if count else {}
    assert got == {q: e for q, e in expected.items() if e}


def long_one(rng, base):
    """The table with one vector a hundred times as long as the others."""
    far = rng.normal(size=base.shape[1])
    return np.vstack([base, far / np.linalg.norm(far) * 100])


def near_copies(rng, base):
    """The table with 3000 near copies of one vector, all of length one."""
    group = base[0] + rng.uniform(1e-4, 3e-3, size=(3000, 1)) * rng.normal(size=(3000, base.shape[1]))
    return np.vstack([base, group / np.linalg.norm(group, axis=1, keepdims=True)])


@pytest.mark.parametrize("table, least", [(long_one, 0.95), (near_copies, 0.9)])
def test_recall_of_uneven_tables(spark, table, least):
    base = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id")
    base = np.array([r.embedding for r in base.collect()], float)
    rows = [(i, v.tolist()) for i, v in enumerate(table(np.random.default_rng(3), base))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = answers(neighbours.nearest(vectors, F.col("vec_id") % 20 == 0))
    expected = brute(rows, lambda i: i % 20 == 0, 20)
    assert got.keys() == expected.keys()
    assert recall(got, expected) >= least


def hub_heavy(rng):
    """Ten vectors in the middle of a wide cloud around one direction, near all others; lengths are one."""
    middle = np.eye(64)[0]
    cloud = rng.normal(size=(3000, 64)) / 8
    table = np.vstack([middle + cloud, middle + rng.normal(size=(10, 64)) * 0.01])
    return table / np.linalg.norm(table, axis=1, keepdims=True)


def test_recall_with_hubs(spark):
    table = hub_heavy(np.random.default_rng(9))
    rows = [(i, v.tolist()) for i, v in enumerate(table)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = neighbours.build(neighbours.usable(vectors))
    named = index.graph.select(F.explode("ids").alias("id")).groupBy("id").count().agg(F.max("count")).first()[0]
    assert named > 1500
    got = answers(neighbours.nearest(vectors, F.col("vec_id") % 20 == 0))
    expected = brute(rows, lambda i: i % 20 == 0, 20)
    assert got.keys() == expected.keys()
    assert recall(got, expected) >= 0.9


def test_each_link_is_used_in_each_round(spark):
    graph = spark.createDataFrame([(i, [0], [1.0], [True]) for i in range(1, 2001)], neighbours.GRAPH)
    one, two = (neighbours._around(graph, n).collect() for n in (1, 2))
    for rows in (one, two):
        assert {r.other for r in rows if r.node == 0} == set(range(1, 2001))
        assert {r.node for r in rows if r.other == 0} == set(range(1, 2001))
    assert {(r.part, r.other) for r in one if r.node == 0} != {(r.part, r.other) for r in two if r.node == 0}


def test_rounds_in_slices(spark, monkeypatch):
    """Neighbourhoods are compared part by part; no part has the vectors of all."""
    monkeypatch.setattr(neighbours, "SLICE_NODES", 250)
    sizes, plain = [], neighbours.stored

    def stored(df, label):
        kept = plain(df, label)
        sizes.extend([(label, kept.count())] * (label in ("ann-around", "ann-compared")))
        return kept

    monkeypatch.setattr(neighbours, "stored", stored)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(700)]
    got = answers(neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0))
    rounds = sum(label == "ann-around" for label, _ in sizes)
    assert sum(label == "ann-compared" for label, _ in sizes) == 3 * rounds > 0
    assert recall(got, brute(rows, lambda i: i % 20 == 0, 20)) >= 0.95
