"""Texts kept in pieces against the same texts as rows."""

import os
import random

import pytest
from pyspark.sql import functions as F

from layerworks.operators import long_texts
from layerworks.operators.chunk import to_gold_chunks
from layerworks.plans.arrivals import DocumentCollection
from layerworks.plans.documents import silver_documents
from layerworks.queries.documents import CONFIG
from layerworks.sources.files import list_files, read_binary_batch, read_listed, to_bronze

SNIPPETS = [
    b"word", b"some text 7", b" ", b"\t", b"\n", b"\n", b"\n\n", b"\r\n", b"\r", b"\x0b", b"\x00", b"\xff", b"\xe2\x82",
    b"\n# ", b"\n## ", b"\n### title", b"\n###### ", b"\n#", b"\n####### x", b"\r# ", b"\r\n## ", b"\n#\xc2\xa0", b"\xc2\xa0",
    b"\xe2\x80\xa8", b"a.b@c.de", b"012-345-6789", "é".encode(), b" \n", b"\n \n", b"#", b"\xef\xbb\xbf",
]


@pytest.fixture
def place(tmp_path, monkeypatch):
    """Folders; files of more than 20 bytes are long, and pieces short."""
    monkeypatch.setattr(long_texts, "LONG_BYTES", 20)
    monkeypatch.setattr(long_texts, "PIECE_BYTES", 12)
    monkeypatch.setattr(long_texts, "JOINED_BYTES", 30)
    (tmp_path / "in").mkdir()
    return tmp_path


def collection(place, **options):
    config = {**CONFIG, "source": {"path": str(place / "in"), "path_glob_filter": "*"}}
    return DocumentCollection(str(place / "out"), config, **options)


def write(place, at=None, **contents):
    for name, content in contents.items():
        path = place / "in" / f"{name}.md"
        path.write_bytes(content)
        if at is not None:
            os.utime(path, (at, at))


def silver(rows):
    return sorted((r.document_id, r.extracted_text, r.source_type, r.metadata["file_path"]) for r in rows.collect())


def assert_as_rebuilt(spark, place, docs):
    whole = silver_documents(to_bronze(read_binary_batch(spark, str(place / "in"))))
    assert silver(docs.silver(spark)) == silver(whole)
    names = to_gold_chunks(whole, CONFIG).columns
    gold = docs.gold(spark)
    assert gold.columns == names
    assert sorted(map(tuple, gold.collect())) == sorted(map(tuple, to_gold_chunks(whole, CONFIG).collect()))


def test_texts_in_pieces_equal_texts_in_rows(spark, place):
    made = random.Random(4)
    contents = {f"f{i}": b"".join(made.choices(SNIPPETS, k=made.randint(1, 60))) for i in range(150)}
    contents |= {
        "blank": b" \n\t\r\n" * 9,
        "marked": b"\xef\xbb\xbf\n\n# one\n\ntext of the first",
        "mark_only": b"\xef\xbb\xbf\n\n\n\n" + b"x\n" * 12,
        "unbroken": b"abc " * 40,
        "returns": b"# one\rbody\r\r## two\r" * 5,
        "ends": b"\n\n\n# A\n\nbody\n\n# B\n \n\n### C\n\nmore  \n\n\n",
    }
    contents |= {f"copy_{name}": contents[name] for name in ("blank", "ends", "f3")}
    write(place, **contents)
    docs = collection(place)
    docs.refresh(spark)
    assert spark.read.parquet(f"{place}/out/pieces").groupBy("document_id").count().where("count > 2").count() > 50
    assert_as_rebuilt(spark, place, docs)


def test_long_and_short_texts_follow_changes(spark, place):
    docs = collection(place)
    long, other = b"# one\n\n" + b"some text\n" * 20, b"# two\n\n" + b"other text\n" * 20
    # Blanks make a file long, its text is that of a short one.
    write(place, at=1_000_000_000, a=long, b=other, c=long, short=b"# one\n\ntext", padded=b"# one\n\n\n\n" + b" \n" * 30 + b"text \n")
    assert docs.refresh(spark) == {"added": 5, "changed": 0, "removed": 0}
    assert docs.silver(spark).count() == 3
    assert_as_rebuilt(spark, place, docs)
    write(place, at=1_000_000_500, a=b"now short")
    docs.refresh(spark)
    assert_as_rebuilt(spark, place, docs)
    (place / "in" / "short.md").unlink()
    (place / "in" / "padded.md").unlink()
    docs.refresh(spark)
    assert_as_rebuilt(spark, place, docs)
    write(place, at=1_000_000_900, a=long, c=b"again " + long)
    docs.refresh(spark)
    assert_as_rebuilt(spark, place, docs)


def test_masked_and_cleaned_copies_of_any_length_are_one(spark, place):
    text = b"x@y.z 012345 " * 3
    write(place, a=text, b=text + b"\n" * 90, c=b"\n" * 200 + text)
    write(place, d=text * 20, e=text * 20 + b"\n" * 9)
    docs = collection(place)
    docs.refresh(spark)
    assert docs.silver(spark).count() == 2
    assert_as_rebuilt(spark, place, docs)


def opened(df):
    """How many files the scan of a DataFrame opens."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    node = execution.executedPlan()
    while not node.metrics().contains("numFiles"):
        node = node.children().head()
    return node.metrics().apply("numFiles").value()


def test_long_files_are_not_opened_whole(spark, place, plan):
    write(place, a=b"x" * 21, b=b"y" * 20)
    (place / "in" / "c.bin").write_bytes(b"z" * 99)
    long, source = long_texts.is_long(), str(place / "in")
    short = read_listed(spark, source, list_files(spark, source), only=~long)
    assert sorted(bytes(r.content[:1]) for r in short.collect()) == [b"y", b"z"]
    assert opened(short) == 2
    assert [r.length for r in read_listed(spark, source, list_files(spark, source), only=long).collect()] == [21]
    docs = collection(place)
    docs.refresh(spark)
    assert spark.read.parquet(f"{place}/out/extracted").where("extracted_text like 'x%'").count() == 0
    # A text is joined only where it is read.
    assert "pieces" not in plan(docs.silver(spark).select("document_id"))
    assert {r._corrupt for r in docs.quarantine(spark).collect()} == {"unsupported_type"}


def test_a_change_that_failed_leaves_no_pieces(spark, place, monkeypatch):
    docs = collection(place)
    write(place, at=1_000_000_000, a=b"one text that is long enough")
    docs.refresh(spark)
    write(place, at=1_000_000_500, b=b"two texts that are long enough")
    with monkeypatch.context() as patch:
        patch.setattr("layerworks.plans.arrivals.COMMITS", "broken")
        with pytest.raises(Exception):
            docs.refresh(spark)
    write(place, at=1_000_000_900, b=b"two")
    docs.refresh(spark)
    assert_as_rebuilt(spark, place, docs)


def test_a_parser_for_text_gets_whole_files(spark, place):
    write(place, a=b"some text that is longer than twenty bytes")
    docs = collection(place, parsers={"md": lambda content: content.decode().upper()})
    docs.refresh(spark)
    assert [r.extracted_text for r in docs.silver(spark).collect()] == ["SOME TEXT THAT IS LONGER THAN TWENTY BYTES"]
    assert docs.gold(spark).select(F.length("chunk_text")).first()[0] == 42
