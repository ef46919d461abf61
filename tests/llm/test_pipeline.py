"""Stages of the corpus pipeline against plain code."""

import gc
import random
import weakref

import corpus_pipeline
import public_tokenizers
import pytest
from layerworks.llm import common, langid, packing
from pyspark.sql import functions as F
from tests.llm.test_packing import check
from tests.llm.test_jaccard import shingles


def kept_model(rows):
    """Of each connected group of near copies the least row by (null id last, id), if ids differ."""
    sets = [shingles(text) for _, text in rows]
    names = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9 and names[i] != names[j]:
                old, new = names[i], names[j]
                names = [new if n == old else n for n in names]
    groups = {}
    for row, name, shingled in zip(rows, names, sets):
        groups.setdefault(name if shingled else object(), []).append(row)
    return [{(i, t) for i, t in g if (i is None, i or 0) == min((j is None, j or 0) for j, _ in g)} for g in groups.values()]


def test_one_row_of_each_near_copy_class(spark):
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(10_000)}" for _ in range(n)]
    rows = [(None, " ".join(words(30))) for _ in range(6)] + [(7, " ".join(words(30))) for _ in range(4)]
    base = words(60)
    near = " ".join([*base[:-1], "other"])
    rows += [(3, " ".join(base)), (9, near), (9, " ".join(words(25))), (None, near), (None, " ".join(base)), (9, near)]
    alone = " ".join(words(40))
    rows += [(None, alone), (None, alone), (None, ""), (None, ""), (None, None), (11, " "), (11, " ")]
    docs = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert out.columns == corpus_pipeline.COLUMNS
    got = [(r.doc_id, r.text) for r in out.collect()]
    groups = kept_model(rows)
    assert len(got) == len(groups)
    for row in got:
        groups.remove(next(g for g in groups if row in g))
    assert not groups


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    """Documents with columns of clashing names besides."""
    docs = spark.createDataFrame([(i, t, "en", f"s{n}", len(t or "")) for n, (i, t) in enumerate(rows)], DOCS)
    for name in ("kept", "removed", "found", "t", "n_lines", "n_removed", "score", "block", "piece"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs


def texts(df):
    assert df.columns == corpus_pipeline.COLUMNS
    return sorted([(r.doc_id, r.text, r.source) for r in df.collect()], key=str)


def test_rows_that_repeat_an_id_keep_their_own_text(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    clean = " ".join(f"c{i}" for i in range(30))
    rows = [(1, passage), (7, f"one\n{passage}\ntwo"), (7, clean), (7, clean), (None, "no id\nat all"), (None, None), (8, passage), (9, ""), (9, f"{passage} tail")]
    out = corpus_pipeline.drop_repeated_passages(spark, frame(spark, rows), "")
    expected = [(1, passage, "s0"), (7, "one\ntwo", "s1"), (7, clean, "s2"), (7, clean, "s3"), (None, "no id\nat all", "s4"), (None, None, "s5"), (9, "", "s7"), (9, "tail", "s8")]
    assert texts(out) == sorted(expected, key=str)
    assert {r.source: r.n_chars for r in out.collect()}["s1"] == len("one\ntwo")


def test_lines_go_and_documents_of_such_lines_only(spark):
    line, other = "a line of more than twenty characters", "yet another line of many characters"
    rows = [(1, f"{line}\nshort"), (2, f"{line}\n\n{other}"), (3, line + "s"), (4, f"short\n{other}"), (5, ""), (6, None), (7, "own words"), (7, "own words")]
    out = corpus_pipeline.drop_repeated_lines(spark, frame(spark, rows), "")
    expected = [(1, f"{line}\nshort", "s0"), (2, f"\n{other}", "s1"), (5, "", "s4"), (6, None, "s5"), (7, "own words", "s6"), (7, "own words", "s7")]
    assert texts(out) == sorted(expected, key=str)


def test_languages_that_are_not_determined_go(spark):
    english = "the house and the garden of the old man were in the north of the country"
    german = "das Haus und der Garten des alten Mannes waren im Norden des Landes"
    rows = [(i, english) for i in range(4)] + [(None, german), (None, german), (9, "123 !?"), (10, ""), (11, None)]
    docs = frame(spark, rows).withColumn("lang", F.when(F.col("text") == english, "en").when(F.col("text") == german, "de"))
    out = corpus_pipeline.identify_language(spark, docs, "")
    assert texts(out) == sorted([(i, t, f"s{n}") for n, (i, t) in enumerate(rows[:6])], key=str)


def test_packing_takes_every_row(spark):
    rows = [(1, "some words here"), (1, "some words here"), (None, None), (2**60 + 1, "long " * 6000), (3, "")]
    out = corpus_pipeline.pack_sequences(spark, frame(spark, rows), "").collect()
    check(out, 4096)
    pieces = sorted((str(r.doc_id), r.piece, r.start) for r in out)
    assert [p[0] for p in pieces] == sorted(["1", "1", "None", str(2**60 + 1), str(2**60 + 1), "3"])
    assert sum(r.length for r in out if r.doc_id == 2**60 + 1) == 6001


@pytest.mark.parametrize("number", range(5))
def test_every_stage_takes_an_empty_table(spark, number):
    name, stage = corpus_pipeline.STAGES[number]
    out = stage(spark, spark.createDataFrame([], DOCS), "")
    assert out.collect() == []
    if number < 4:
        assert out.columns == corpus_pipeline.COLUMNS


def test_the_whole_run_equals_its_stages_in_plain_code(spark, tmp_path):
    """Clean documents reach the end whole; what each stage is to remove is gone."""
    rng = random.Random(3)
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang = 'en'").orderBy("doc_id")
    base = [r.text for r in source.limit(60).collect()]
    # Words of our own around a few, so that nothing but what is planted repeats.
    clean = [" ".join(rng.sample(t.split(), min(40, len(t.split())))) for t in base if len(t.split()) >= 40][:25]
    passage = " ".join(rng.sample(base[0].split(), 60) if len(base[0].split()) >= 60 else [f"word{i}" for i in range(60)])
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(100, passage), (101, f"{clean[0]} {passage} {clean[1]} the end of it"), (102, clean[2]), (103, "1 2 3"), (104, None)]
    docs = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in rows], DOCS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    check(out, 4096)
    left = {r.doc_id for r in out}
    assert set(range(len(clean))) | {100, 101} == left
    tokens = {r.doc_id: r.length for r in out}
    whole = {r.doc_id: r.length for r in packing.token_pieces(docs.where("text is not null"), public_tokenizers.path("word_bpe_49k.json")).collect()}
    assert all(tokens[i] == whole[i] for i in range(len(clean)))
    assert tokens[101] < whole[101] - 60


def test_a_process_keeps_what_one_operator_remembers():
    encoder = weakref.ref(packing.word_encoder(public_tokenizers.path("word_bpe_49k.json")))
    assert encoder() is packing.word_encoder(public_tokenizers.path("word_bpe_49k.json"))
    langid.pieces(public_tokenizers.path("piece_bpe_32k.model"))
    gc.collect()
    assert encoder() is None


def test_steps_are_emptied_without_rows_of_python(spark, monkeypatch):
    step = common.stored(spark.sql("SELECT 1L AS a, array(struct('x' AS b, binary('y') AS c)) AS d, map('k', 1.5D) AS e"), "emptied")
    monkeypatch.setattr(type(spark), "createDataFrame", None)
    common.release(step)
    left = spark.read.schema(step.schema).parquet(step._stored_at)
    assert left.count() == 0 and left.schema == step.schema
