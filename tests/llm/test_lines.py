"""Line dedup against edit distances of all pairs."""

import random

from layerworks.llm import lines


def near(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1 :] or (len(a) == len(b) and a[i + 1 :] == b[i + 1 :])


def model(rows, least):
    seen, out = [], {}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for doc, text in order:
        if text is None:
            out[doc] = (None, 0, 0)
            continue
        kept, all_lines = [], text.split("\n")
        for pos, line in enumerate(all_lines):
            gone = len(line) >= least and any(near(line, s) for s in seen)
            if len(line) >= least:
                seen.append(line)
            if not gone:
                kept.append(line)
        out[doc] = ("\n".join(kept), len(all_lines), len(all_lines) - len(kept))
    return out


def edited(rng, line, alphabet):
    i = rng.randrange(len(line) + 1)
    kind = rng.randrange(4)
    if kind == 0:
        return line[:i] + rng.choice(alphabet) + line[i:]
    if kind == 1:
        return line[:i] + line[i + 1 :]
    if kind == 2:
        return line[:i] + rng.choice(alphabet) + line[i + 1 :]
    return line


def run(spark, rows, least):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, n_lines string, t int")
    return {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in lines.dedup_lines(docs, min_chars=least).collect()}


def test_equals_all_pairs(spark):
    rng = random.Random(4)
    alphabet = "abé日 "
    base = ["".join(rng.choice(alphabet) for _ in range(rng.choice([5, 8, 20, 47, 48, 94, 95, 96, 97, 98, 99, 100, 150, 300]))) for _ in range(25)]
    rows = [(None, None), (100, ""), (101, base[0] + "\n" + base[0])]
    for doc in range(60):
        picked = []
        for _ in range(rng.randrange(1, 6)):
            line = rng.choice(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                line = edited(rng, line, alphabet) if line else "abcde"
            picked.append(line.replace("\n", ""))
        rows.append((doc, "\n".join(picked)))
    assert run(spark, rows, 5) == model(rows, 5)


def test_short_alphabet(spark):
    rng = random.Random(5)
    rows = [(doc, "\n".join("".join(rng.choice("01") for _ in range(rng.choice([5, 6, 7]))) for _ in range(3))) for doc in range(40)]
    assert run(spark, rows, 5) == model(rows, 5)


def test_none_and_repeated_rows(spark):
    assert run(spark, [], 5) == {}
    docs = spark.createDataFrame([(1, "a long line of text"), (1, "a long line of text"), (2, "a long line of tex!")], "doc_id long, text string")
    got = sorted((r.doc_id, r.text, r.n_removed) for r in lines.dedup_lines(docs, min_chars=5).collect())
    assert got == [(1, "a long line of text", 0), (1, "a long line of text", 0), (2, "", 1)]


def test_long_line_and_no_python(spark, plan):
    docs = spark.createDataFrame([(1, "ab" * 60000), (2, "ab" * 59999 + "aab"), (3, "x" * 30000)], "doc_id long, text string")
    out = lines.dedup_lines(docs)
    assert "Python" not in plan(out) and "Arrow" not in plan(out)
    assert {r.doc_id: r.n_removed for r in out.collect()} == {1: 0, 2: 1, 3: 0}


def test_short_lines_go_if_equal(spark):
    rng = random.Random(6)
    words = ["a", "b", "end", "}"]
    rows = [(doc, "\n".join([" ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 12]))) for _ in range(4)] + ["", " \t"])) for doc in range(30)]
    seen, expected = [], {}
    for doc, text in rows:
        kept, all_lines = [], text.split("\n")
        for line in all_lines:
            gone = line.strip() and any(line == s or (min(len(line), len(s)) >= lines.MIN_CHARS and near(line, s)) for s in seen)
            seen.append(line)
            if not gone:
                kept.append(line)
        expected[doc] = ("\n".join(kept), len(all_lines), len(all_lines) - len(kept))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in lines.dedup_lines(docs).collect()} == expected
