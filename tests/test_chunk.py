import models
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerworks.operators import chunk
from layerworks.operators.chunk import heading_chunks, paragraph_chunks, to_gold_chunks

PIECES = [
    *"abc \t\n\n\n\n#あ\r", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "\U0001d400",
    "\n\n", "\n# ", "\n## ", "\n### ", "\n###### ", "\n####### ", "\n#　", "\r\n", "long word ",
]
TEXTS = st.lists(st.lists(st.sampled_from(PIECES), max_size=40).map("".join), min_size=100, max_size=200)
FUZZ = settings(
    max_examples=6, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True
)
SIZES = [(1000, 100), (20, 5), (10, 0), (8, 100), (10, 9), (12, 3), (0, 0), (0, 4), (3, 1)]


def chunks_of(spark, values, *columns):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [tuple(row)[1:] for row in sorted(df.select("i", *columns).collect())]


@FUZZ
@given(TEXTS)
def test_chunkers_equal_the_models(spark, values):
    columns = [paragraph_chunks(F.col("t"), *sizes) for sizes in SIZES]
    for value, (headed, *packed) in zip(
        values, chunks_of(spark, values, heading_chunks(F.col("t")), *columns), strict=True
    ):
        assert headed == models.by_heading(value)
        for sizes, got in zip(SIZES, packed, strict=True):
            assert got == models.by_paragraph(value, *sizes), sizes


def test_folding_in_blocks_changes_nothing(spark, monkeypatch):
    text = "".join(f"{'#' * (i % 6 + 1)} t{i}\n\nbody {i}\n\n" for i in range(40))
    for size in (1, 3, 128):
        monkeypatch.setattr(chunk, "_BLOCK", size)
        columns = heading_chunks(F.col("t")), paragraph_chunks(F.col("t"), 30, 7)
        ((headed, packed),) = chunks_of(spark, [text], *columns)
        assert headed == models.by_heading(text)
        assert packed == models.by_paragraph(text, 30, 7)


def test_skipped_levels_nest_under_the_heading_above(spark):
    ((got,),) = chunks_of(spark, ["# A\n### B\nx\n### C\ny\n## D\nz"], heading_chunks(F.col("t")))
    assert got == ["A > B\nx", "A > B > C\ny", "A > D\nz"]


def test_texts_without_chunks(spark):
    values = [None, "", " \n\t\n", "# only\n## headings\n"]
    got = chunks_of(spark, values, heading_chunks(F.col("t")), paragraph_chunks(F.col("t")))
    assert got == [([], []), ([], []), ([], []), ([], ["# only\n## headings"])]


def test_a_long_paragraph_stays_whole(spark):
    long = "x" * 3000
    ((got,),) = chunks_of(spark, [f"a\n\n{long}\n\nb"], paragraph_chunks(F.col("t"), 1000, 100))
    assert got == models.by_paragraph(f"a\n\n{long}\n\nb", 1000, 100)
    assert [len(c) for c in got] == [1, 3 + 3000, 100 + 3]


def test_documents_of_megabytes(spark):
    """State carried from step to step must not grow with the document."""
    paragraphs = "a few words, twice over\n\n" * 60_000
    sections = "a few words\n# title\n" * 8_000
    (packed, headed), = chunks_of(
        spark, [paragraphs], F.size(paragraph_chunks(F.col("t"))), F.lit(0)
    )
    assert packed == len(models.by_paragraph(paragraphs, 1000, 100))
    ((headed,),) = chunks_of(spark, [sections], F.size(heading_chunks(F.col("t"))))
    assert headed == len(models.by_heading(sections))


def test_sizes_must_not_be_negative():
    with pytest.raises(ValueError, match="negative chunk size"):
        paragraph_chunks(F.lit("x"), 10, -1)


CONFIG = {
    "chunking": {
        "md": {"strategy": "paragraph"},
        "pdf": {"strategy": "paragraph", "max_chars": 12, "overlap": 2},
        "pptx": None,
        "html": {"strategy": "markdown_header"},
        "default": {"strategy": "paragraph", "max_chars": 20, "overlap": 0},
    },
    "permission_metadata": {"allowed_roles": ["analyst", "manager"], "department": "engineering"},
}


def test_strategy_by_type(spark):
    text = "# T\nbody one\n\nbody two\n\nbody three"
    documents = spark.createDataFrame(
        [(str(i), text, kind) for i, kind in enumerate(["md", "pdf", "pptx", "html", "csv", None])]
        + [("x", None, "md")],
        "document_id string, extracted_text string, source_type string",
    )
    rows = to_gold_chunks(documents, CONFIG).orderBy("document_id", "chunk_index").collect()
    got = {}
    for row in rows:
        got.setdefault(row.document_id, []).append(row.chunk_text)
        assert (row.allowed_roles, row.department) == ("analyst,manager", "engineering")
    headed, default = models.by_heading(text), models.by_paragraph(text, 20, 0)
    assert got == {
        "0": headed, "1": models.by_paragraph(text, 12, 2), "2": default, "3": headed,
        "4": default, "5": default,
    }


def test_gold_without_configuration(spark):
    documents = spark.createDataFrame(
        [("d", "text", "pdf")], "document_id string, extracted_text string, source_type string"
    )
    (row,) = to_gold_chunks(documents, {}).collect()
    assert row.asDict() | {"chunk_id": ""} == {
        "chunk_id": "", "document_id": "d", "chunk_text": "text", "allowed_roles": "",
        "department": "", "chunk_index": 0,
    }
    assert to_gold_chunks(documents, {}).columns == list(chunk.GOLD_COLUMNS)
