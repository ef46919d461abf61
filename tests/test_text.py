import hashlib
import os.path

import models
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerworks.functions import ids, text

PIECES = [
    *"abz019-@.+_ \t\n\r\0あ漢é#",
    "\x0b", "\x1c", "\x1f", "\x85", "\xa0", " ", "　", "\U0001d400",
    "\n\n\n", " \t\n", "a@b.co", "x+y@ü-1.jp.", "03-1234-5678", " 0901234567 ", "０１２", "́",
]
TEXTS = st.lists(st.lists(st.sampled_from(PIECES), max_size=30).map("".join), min_size=150, max_size=300)
FUZZ = settings(
    max_examples=6, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True
)


def evaluate(spark, values, *columns, schema="i int, t string"):
    rows = spark.createDataFrame(list(enumerate(values)), schema).select("i", *columns).collect()
    return [tuple(row)[1:] for row in sorted(rows)] if rows else []


def test_whitespace_is_that_of_strip():
    assert set(text.WHITESPACE) == {c for c in map(chr, range(0x110000)) if c.isspace()}


def test_line_breaks_are_those_of_splitlines():
    assert set(text.LINE_BREAKS) == {
        c for c in map(chr, range(0x110000)) if len(f"a{c}b".splitlines()) == 2
    }


@FUZZ
@given(TEXTS)
def test_text_functions_equal_the_models(spark, values):
    got = evaluate(
        spark, values, text.strip("t"), text.clean_text("t"), text.redact_pii("t"),
        text.normalize_line_breaks("t"),
    )
    for value, (stripped, cleaned, masked, lines) in zip(values, got, strict=True):
        assert stripped == value.strip()
        assert cleaned == models.cleaned(value)
        assert masked == models.masked(value)
        assert lines.split("\n")[: len(value.splitlines())] == value.splitlines()


@FUZZ
@given(st.lists(st.binary(max_size=12), min_size=100, max_size=200))
def test_decoding_replaces_what_is_not_utf8(spark, values):
    got = evaluate(spark, values, text.decode_utf8("t"), schema="i int, t binary")
    assert [row[0] for row in got] == [value.decode("utf-8", "replace") for value in values]


def test_null_texts(spark):
    (row,) = evaluate(spark, [None], text.clean_text("t"), text.redact_pii("t"), text.decode_utf8("t"))
    assert row == ("", None, None)


def test_masking_examples(spark):
    values = [
        "不明点は support@example.com または 03-1234-5678 まで",
        "連絡先user.name+tag@example.co.jp。",
        "090-1234-5678 0312345678 103-1234-5678 03-1234-56789",
        "call x03-1234-5678",
        "no contacts here",
        "",
    ]
    got = [row[0] for row in evaluate(spark, values, text.redact_pii("t"))]
    assert got[0] == "不明点は [REDACTED_EMAIL] または [REDACTED_PHONE] まで"
    assert got == [models.masked(value) for value in values]


def test_long_unbroken_lines_stay_linear(spark):
    """Quadratic patterns would take minutes on these."""
    letter, blank = (F.when(F.col("id") >= 0, F.lit(c)) for c in "a ")
    long = spark.range(1).select(
        F.concat(F.repeat(letter, 1_000_000), F.lit("@")).alias("run"),
        F.concat(F.repeat(blank, 1_000_000), F.lit("x \n")).alias("blanks"),
    )
    row = long.select(F.length(text.redact_pii("run")), F.length(text.clean_text("blanks"))).first()
    assert tuple(row) == (1_000_001, 1)  # all blanks are at an end


PATHS = [
    "/a/b.md", "/a/b.MarkDown", "/a/b.PDF", "s3://x/deck.ppt", "deck.pptx", "/a.b/c", "/a/.md",
    "/a/..md", "/a/b.md.txt", "/a/b.", "", "/a/...", "/a/x.tar.md", "/docs.md/readme",
]


def test_source_type(spark):
    got = [row[0] for row in evaluate(spark, PATHS, ids.source_type("t"))]
    assert got == [ids.SOURCE_TYPES.get(os.path.splitext(p)[1].lower()) for p in PATHS]


def test_ids(spark):
    values = ["file:/a/b.md", "文書.md", ""]
    got = evaluate(spark, values, ids.document_id("t"), ids.chunk_id("t", F.lit(12)))
    for value, (document, chunk) in zip(values, got, strict=True):
        assert document == hashlib.sha256(value.encode()).hexdigest()[:32]
        assert chunk == hashlib.sha256(f"{value}:12".encode()).hexdigest()[:32]
