import numpy as np
import pytest
from pyspark.sql import functions as F

from layerworks.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, anchors, scale=256.0, positives=5, count=10):
    """By plain loops over whole-number vectors of any size."""
    whole = {i: (label, [int(np.floor(scale * x)) for x in vec]) for i, vec, label in rows}
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a in sorted(set(anchors) & whole.keys()):
        label, vec = whole[a]
        scored = sorted(((-score(vec, v), i, m == label) for i, (m, v) in whole.items() if i != a))
        for s, p, _ in [x for x in scored if x[2]][:positives]:
            window = [(i, -t) for t, i, same in scored if not same and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(a, p, rank, i, -s, t) for rank, (i, t) in enumerate(window[:count], 1)]
    return sorted(out)


def mined(spark, rows, every=10, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    whole = negatives.whole_vectors(df, F.col("vec_id") % every == 0, F.col("label"))
    return sorted(tuple(r) for r in negatives.mine(whole, **options).collect())


def clustered(n, size, seed, spread=0.2, labels=4):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(6, size))
    own = random.integers(0, 6, n)
    vectors = centres[own] + spread * random.normal(size=(n, size))
    return [(i, v.tolist(), int(label)) for i, (v, label) in enumerate(zip(vectors, random.integers(0, labels, n)))]


@pytest.fixture
def small_tree(monkeypatch):
    """Several levels and several blocks of a leaf on a small table."""
    monkeypatch.setattr(negatives, "LEAF", 8)
    monkeypatch.setattr(negatives, "BLOCK", 16)
    monkeypatch.setattr(negatives, "SAMPLE", 150)


def test_equals_brute_force_in_a_deep_tree(spark, small_tree):
    rows = clustered(600, 6, 1)
    assert mined(spark, rows) == brute(rows, range(0, 600, 10))


def test_equals_brute_force_without_clusters_and_with_ties(spark, small_tree):
    random = np.random.default_rng(2)
    rows = [(i, (random.integers(-1, 2, 4) / 256).tolist(), int(random.integers(0, 3))) for i in range(400)]
    assert mined(spark, rows, every=20) == brute(rows, range(0, 400, 20))


def test_a_hot_group_of_equal_vectors(spark, small_tree):
    rows = clustered(300, 5, 3)
    rows += [(300 + i, [0.5, 0.1, -0.2, 0.3, 0.9], i % 3) for i in range(200)]
    assert mined(spark, rows, every=50) == brute(rows, range(0, 500, 50))


def test_components_too_large_for_single_and_double_precision(spark, small_tree):
    for factor in (2.0**12, 2.0**17):
        rows = [(i, [x * factor for x in v], label) for i, v, label in clustered(120, 3, 4)]
        assert mined(spark, rows) == brute(rows, range(0, 120, 10))


def test_rows_that_take_no_part(spark):
    good = clustered(60, 3, 5)
    bad = [
        (100, None, 1), (110, [1.0, None, 1.0], 1), (120, [1.0, float("nan"), 1.0], 1), (130, [1.0, float("inf"), 0.0], 1),
        (140, [1.0, 2.0, 3.0], None), (None, [1.0, 2.0, 3.0], 1), (150, [1.0, 2.0], 1), (160, [], 1), (170, [1e300, 0.0, 0.0], 1),
    ]
    assert mined(spark, good + bad) == brute(good, range(0, 60, 10))


def test_repeated_rows_count_once(spark):
    rows = clustered(80, 3, 6)
    assert mined(spark, rows + rows[:40]) == brute(rows, range(0, 80, 10))


def test_no_rows_no_anchors_no_other_label(spark):
    assert mined(spark, []) == []
    rows = clustered(40, 3, 7)
    assert mined(spark, rows[1:9]) == []
    alone = [(i, v, 1) for i, v, _ in rows]
    assert mined(spark, alone) == []
    single = [(i, v, i) for i, v, _ in rows]
    assert mined(spark, single) == []


def test_clashing_columns_are_ignored(spark):
    rows = clustered(50, 3, 8)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "vec", "anchor", "leaf", "part", "lows", "score", "raw", "finite", "square"):
        df = df.withColumn(name, F.lit("x"))
    whole = negatives.whole_vectors(df, F.col("vec_id") % 10 == 0, F.col("label"))
    assert sorted(tuple(r) for r in negatives.mine(whole).collect()) == brute(rows, range(0, 50, 10))


def test_ranges_rule_out_leaves_and_never_one_with_a_row_in_the_window():
    random = np.random.default_rng(9)
    vectors = np.floor(256 * np.array([v for _, v, _ in clustered(3000, 8, 9, spread=0.1)]))
    tree = negatives.fitted(vectors[::7], 3)
    negatives.count_in(tree, vectors)
    assert tree.rows[0].sum() == len(vectors)
    leaf = negatives.leaves(tree, vectors)
    anchors = vectors[random.integers(0, len(vectors), 40)]
    scores = anchors @ vectors.T
    top = np.sort(scores, axis=1)[:, -20]
    lows, highs = np.stack([0.85 * top, top], axis=1).astype(np.int64), np.stack([0.9 * top, top + 9], axis=1).astype(np.int64)
    who, found = negatives.open_leaves(tree, anchors, lows, highs)
    opened = np.zeros((40, 8**3), bool)
    opened[who, found] = True
    inside = ((scores[:, None, :] >= lows[:, :, None]) & (scores[:, None, :] <= highs[:, :, None])).any(axis=1)
    for a, row in zip(*np.nonzero(inside)):
        assert opened[a, leaf[row]]
    used = tree.rows[(8**2 - 1) // 7 :].ravel() > 0
    assert opened[:, used].mean() < 0.6
