"""Removed words against windows compared directly."""

import random
import re

import pytest

from layerworks.llm import passages


def model(rows):
    split = [(-1 if i is None else i, i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for key, _, words in split:
        for at in range(len(words) - 12):
            window = tuple(words[at : at + 13])
            first[window] = min(first.get(window, key), key)
    out = []
    for key, doc, words in split:
        gone = set()
        for at in range(len(words) - 12):
            if first[tuple(words[at : at + 13])] < key:
                gone.update(range(at, at + 13))
        out.append((doc, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "a", "é", "日本", "x\x1cy", " "]) if rng.random() < 0.4 else f"w{rng.randrange(3000)}"
    shared = [[word() for _ in range(rng.choice([12, 13, 14, 19, 20, 26, 40, 90]))] for _ in range(12)]
    rows = []
    for doc in range(120):
        words = []
        for _ in range(rng.randrange(5)):
            words += [word() for _ in range(rng.randrange(30))]
            passage = rng.choice(shared)
            a, b = sorted(rng.choices(range(len(passage) + 1), k=2)) if rng.random() < 0.4 else (0, len(passage))
            words += passage[a:b]
        rows.append((doc * 3, rng.choice([" ", "\n", "  \t"]).join(words)))
    copies = rows[5][1]
    rows += [(1000 + i, copies) for i in range(10)] + [(2000, "a " * 400), (2001, "a " * 300), (2002, "a b " * 100), (2003, "b a " * 50), (1999, "a b " * 9)]
    rows += [(None, rows[7][1]), (3000, None), (3001, ""), (3002, " \n"), (2000, "a " * 400), (9, rows[9][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_direct_comparison(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, anchors int")
    got = passages.remove_repeats(docs).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == model(rows)
    assert all(sum(s.end - s.start for s in r.removed) == r.n_removed for r in got)


def test_no_rows(spark):
    assert passages.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_passages_longer_than_a_cut_and_long_sources(spark, monkeypatch):
    rng = random.Random(6)
    long = " ".join(f"w{rng.randrange(500)}" for _ in range(1500))
    words = long.split(" ")
    rows = [(1, long), (2, " ".join(words[100:900])), (3, " ".join(words[254:280])), (4, "x y z " + " ".join(words[1300:])), (5, long + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = passages.remove_repeats(docs).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == model(rows)


def test_texts_keep_their_lines_and_rows_their_columns(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(1, passage, "first"), (7, f"above\n\n  {passage}\nbelow\t x", "a"), (7, "quite another\ntext", "b"), (None, None, "c"), (8, passage, "d"), (9, f"{passage}\n", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found string")
    out = passages.remove_repeats(docs, carry=["found"], in_place=True).collect()
    assert {r.found: r.kept for r in out} == {"first": passage, "a": "above\n\n  below\t x", "b": "quite another\ntext", "c": None, "d": "", "e": ""}
    assert {r.found: r.doc_id for r in out}["b"] == 7


@pytest.mark.parametrize("seed", [3, 4])
def test_windows_shared_across_the_groups_of_their_anchors(spark, seed):
    """Passages that begin and end anywhere, of few words, in chains of documents."""
    rng = random.Random(seed)
    stem = [f"w{rng.randrange(40)}" for _ in range(300)]
    rows = []
    for doc in range(150):
        words = []
        for _ in range(rng.randrange(1, 6)):
            a = rng.randrange(285)
            words += stem[a : a + rng.choice([12, 13, 14, 15, 18, 23, 40, 300])] + [rng.choice(["a", "b"])] * rng.choice([0, 1, 1, 30])
        rows.append((doc // 2 if doc % 10 == 0 else doc, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = passages.remove_repeats(docs).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == model(rows)


def test_copies_are_counted_by_groups_of_windows(spark, monkeypatch):
    """The disk of a row for every window was more than four times the input."""
    rows_of, stored = {}, passages.stored

    def counted(df, label):
        step = stored(df, label)
        rows_of[label] = step.count()
        return step

    monkeypatch.setattr(passages, "stored", counted)
    rng = random.Random(7)
    copy = " ".join(f"w{rng.randrange(5000)}" for _ in range(3000))
    got = passages.remove_repeats(spark.createDataFrame([(i, copy) for i in range(8)], "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in got} == {0: 0, **dict.fromkeys(range(1, 8), 3000)}
    assert sum(rows_of.values()) < 2988
