"""The join against all pairs of whole shingle sets."""

import random
import re

import numpy as np
import pytest

from layerworks.llm import jaccard
from layerworks.llm.components import components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def model(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    names = list(range(len(rows)))
    links = [0] * len(rows)

    def top(i):
        while names[i] != i:
            i = names[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                x, y = top(i), top(j)
                names[max(x, y)] = min(x, y)
    out = []
    for i, (doc, _) in enumerate(rows):
        mates = [rows[j][0] for j in range(len(rows)) if top(j) == top(i)]
        same = [rows[j][0] for j in range(len(rows)) if sets[j] == sets[i] and sets[i]] or [doc]
        least = lambda ids: min((x for x in ids if x is not None), default=None)
        out.append((doc, least(mates) if sets[i] else doc, least(same), links[i]))
    return sorted(out, key=str)


def corpus(seed, groups=25):
    rng = random.Random(seed)
    rows = [(5000, None), (5001, ""), (5002, " \n"), (5003, "a b"), (5004, "a b"), (5005, "b a"), (None, "a b c"), (5006, "x " * 3000), (5007, "x y " * 500)]
    doc = 0
    for _ in range(groups):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.choice([5, 12, 40, 120]))]
        for _ in range(rng.choice([1, 2, 5, 9])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(50)}"
            rows.append((doc, " ".join(copy)))
            doc += 1
    return rows


@pytest.mark.parametrize("block", [400, 3])
def test_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = corpus(block)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, node int")
    got = sorted(((r.doc_id, r.class_id, r.set_id, r.n_links) for r in jaccard.near_duplicates(docs).collect()), key=str)
    assert got == model(rows)


def test_no_rows(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_bands_meet_the_recall():
    for recall in (0.9, 0.999, 0.9999):
        bands, rows = jaccard.bands_and_rows(0.8, recall)
        assert 1 - (1 - 0.8**rows) ** bands >= recall and rows >= 4


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7), (2000, 2000)]
    labels = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    names = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            least = min(names[a], names[b])
            changed |= names[a] != least or names[b] != least
            names[a] = names[b] = least
    assert labels == names
