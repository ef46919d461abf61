import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerworks.llm import exact
from layerworks.llm.queries import op13_exact_dedup

SCHEMA = "doc_id long, text string"
FOLD = str.maketrans(exact.UPPER, exact.LOWER)


def digest(text):
    return hashlib.sha256((text or "").translate(FOLD).encode()).hexdigest()


def expected(rows):
    """Per row: (id, keep_id, group_size, sha) by a plain dictionary."""
    groups = {}
    for number, text in rows:
        groups.setdefault(digest(text), []).append(number)
    best = {k: max((i for i in v if i is not None), default=None) for k, v in groups.items()}
    return sorted([(i, best[k], len(v), k) for k, v in groups.items() for i in v], key=str)


def got(df):
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()], key=str)


def kept_once(df):
    """Of each text exactly one row stays, and it has the id that stays."""
    kept = [r for r in df.collect() if r.kept]
    assert all(r.doc_id == r.keep_id for r in kept)
    assert len({r.text_sha256 for r in kept}) == len(kept) == df.select("text_sha256").distinct().count()


ROWS = [(1, "Abc"), (2, "aBC"), (3, "Äbc"), (4, "äbc"), (5, None), (6, ""), (7, "É\n X"), (8, "É\n x"), (9, "ſ"), (10, "S"), (11, "K"), (12, "K"), (13, "x" * 200_000), (14, "X" * 200_000)]


@pytest.mark.parametrize("historical", ["true", "false", "doc_id % 2 = 0", "doc_id > 6", "cast(null as boolean)"])
def test_every_split_into_history_and_arrivals_gives_the_same_rows(spark, historical):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    out = exact.dedup_arrivals(docs, F.expr(historical), keys=3)
    assert got(out) == expected(ROWS)
    kept_once(out)


def test_seen_tells_what_the_history_has(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "A"), (3, "b"), (4, "B")], SCHEMA)
    out = exact.dedup_arrivals(docs, F.col("doc_id") == 1)
    assert {r.doc_id: r.seen for r in out.collect()} == {1: True, 2: True, 3: False, 4: False}


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(1, "a"), (1, "a"), (None, "A"), (None, "b"), (None, "b"), (2, "c"), (2, "d")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("shard", "copy", "asks", "digest", "id", "uid", "n", "generation", "kept", "keep_id"):
        docs = docs.withColumn(name, F.lit("x"))
    out = exact.dedup_arrivals(docs, F.col("text") == "a")
    assert got(out) == expected(rows)
    kept_once(out)


def test_no_rows(spark):
    out = exact.dedup_arrivals(spark.createDataFrame([], SCHEMA), F.lit(True))
    assert out.collect() == []
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "seen"]


def test_a_hot_text_is_dealt_among_copies(spark):
    rows = [(i, "same" if i % 3 else f"t{i % 400}") for i in range(3000)]
    out = exact.dedup_arrivals(spark.createDataFrame(rows, SCHEMA), F.col("doc_id") % 5 == 0, keys=40)
    assert got(out) == expected(rows)
    kept_once(out)


def test_generations_and_growing_shards(spark):
    """Texts that arrive in four steps, the index growing beyond its first shards."""
    rows = [(i, f"text {i * i % 701}") for i in range(2400)]
    index = None
    digests = exact.digest_rows(spark.createDataFrame(rows, SCHEMA))
    for step in range(4):
        index = exact.add(index, digests.where(F.col("id") % 4 == step), keys=4)
    assert index.generations == 4
    distinct = len({t for _, t in rows})
    assert index.size == distinct
    found = exact.look_up(index, digests)
    result = [(r.id, r.keep_id, r.group_size, bytes(r.digest).hex()) for r in found.collect()]
    assert sorted(result, key=str) == expected(rows)
    held = exact.entries(index).collect()
    assert sum(r.n for r in held) == len(rows) and len(held) == distinct
    unknown = exact.digest_rows(spark.createDataFrame([(1, "never seen")], SCHEMA))
    assert [r.keep_id for r in exact.look_up(index, unknown).collect()] == [None]


def test_the_hash_is_minimal_and_perfect():
    digests = np.random.default_rng(5).integers(0, 256, (20_000, 32)).astype(np.uint8)
    digests[1:4, :24] = digests[0, :24]  # equal but for one word
    hashing = exact.PerfectHash.of(digests)
    assert sorted(hashing.slots(digests).tolist()) == list(range(len(digests)))
    part = exact.Part.made(0, 0, digests, [None] * len(digests), np.arange(len(digests)), np.ones(len(digests), np.int64))
    again = exact.Part.read(part.row())
    sure, slots = again.members(digests)
    assert sure.all() and (again.digests[slots] == digests).all()
    others = digests ^ np.uint8(1)
    assert not again.members(others)[0].any()


def test_the_query_keeps_the_largest_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    out = op13_exact_dedup(spark, "/root/testdata/sf0.001")
    assert got(out) == expected([tuple(r) for r in docs])
    kept_once(out)
