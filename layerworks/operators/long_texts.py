"""Texts too long for one row: cleaned, masked and chunked line by line, kept in pieces.

The steps are those of ``clean_text``, ``redact_pii`` and ``heading_chunks``.  What they need to know
of other lines (blank ones before, the first and last ones of a text or section, the titles above)
comes from windows over a document's lines, which Spark sorts and keeps on disk where memory ends.
A piece is some lines of a text; pieces joined by line feeds are the text.  Where a piece ends
follows from the text alone, not from how its file was read.
"""

from __future__ import annotations

from collections.abc import Container, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerworks.config import access_attributes
from layerworks.functions.ids import SOURCE_TYPES, chunk_id, source_type
from layerworks.functions.text import (
    INLINE_SPACE,
    WHITESPACE,
    decode_utf8,
    normalize_line_breaks,
    redact_pii,
    strip,
)
from layerworks.operators.chunk import GOLD_COLUMNS
from layerworks.operators.extract import TEXT_TYPE

# Bytes of a file above which its text is kept in pieces.
LONG_BYTES = 16 << 20

# Masks and replaced bytes make a text at most so many times as long as its file.
GROWTH = 4

# Bytes of a piece, and one line more.  A Parquet reader holds 4,096 of them at a time.
PIECE_BYTES = 1 << 14

# Bytes of the pieces that a task joins before they are dealt to their text.
JOINED_BYTES = 16 << 20

# Files that Spark's text reader would unpack.
_PACKED = "(?i)\\.(gz|gzip|bz2|deflate|snappy|lz4|zst|zstd)\\z"

# Hadoop's line reader drops this mark from the start of a file.
_BYTE_ORDER_MARK = "\ufeff"

PIECES = "document_id string, piece long, text string"


def is_long(parsers: Container[str] = (), types: Mapping[str, str] = SOURCE_TYPES) -> Column:
    """Whether a file's text is kept in pieces: by its listing, so that it need not be opened."""
    if TEXT_TYPE in parsers:
        return F.lit(False)
    name = F.col("_metadata.file_name")
    is_text = F.coalesce(source_type(name, types) == TEXT_TYPE, F.lit(False))
    return (F.col("_metadata.file_size") > LONG_BYTES) & is_text & ~name.rlike(_PACKED)


def _has_ink(line: str) -> Column:
    return F.col(line).rlike(f"[^{WHITESPACE}]")


def _stripped(line: Column, first: Column, last: Column) -> Column:
    """The first line without whitespace before it, the last one without any after it."""
    spaces = F.lit(WHITESPACE)
    return F.when(first & last, strip(line)).when(first, F.ltrim(line, spaces)).when(last, F.rtrim(line, spaces)).otherwise(line)


def _in_pieces(lines: DataFrame, order: Sequence[str], keys: Sequence[str], name: str) -> DataFrame:
    """Lines (``n``, ``line``) joined to pieces that begin where whole multiples of a piece's size lie."""
    size = F.octet_length("line").cast("long") + 1
    before = F.sum(size).over(Window.partitionBy("document_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - size
    dealt = lines.withColumn("piece", F.floor(before / PIECE_BYTES))
    held = F.sort_array(F.collect_list(F.struct("n", "line")))
    return dealt.groupBy(*keys, "piece").agg(F.concat_ws("\n", held["line"]).alias(name))


def clean_pieces(lines: DataFrame) -> DataFrame:
    """Pieces of cleaned and masked text, from the lines of ``read_listed_lines``."""
    order = Window.partitionBy("document_id").orderBy("start", "number")
    whole = Window.partitionBy("document_id")
    line = F.replace(decode_utf8("value"), F.lit("\x00"), F.lit(""))
    size = F.octet_length("value").cast("long") + 1
    rows = lines.select("document_id", "start", "number", "length", line.alias("line"), size.alias("size")).withColumns(
        {"n": F.row_number().over(order), "total": F.sum("size").over(whole)}
    )
    marked = (F.col("n") == 1) & (F.col("total") < F.col("length") - 1)
    line = F.when(marked, F.concat(F.lit(_BYTE_ORDER_MARK), "line")).otherwise(F.col("line"))
    rows = rows.withColumn("line", line)
    ends_blank = F.endswith("line", F.lit(" ")) | F.endswith("line", F.lit("\t"))
    rows = rows.withColumn("line", F.when(ends_blank, F.rtrim("line", F.lit(" \t"))).otherwise(F.col("line")))
    inked = F.when(_has_ink("line"), F.col("n"))
    rows = rows.withColumns(
        {
            "again": F.lag(F.col("line") == "", 1, False).over(order),
            "first": F.coalesce(F.min(inked).over(whole), F.lit(1)),
            "last": F.coalesce(F.max(inked).over(whole), F.lit(1)),
        }
    )
    kept = rows.where(F.col("n").between(F.col("first"), F.col("last")) & ~((F.col("line") == "") & F.col("again")))
    line = _stripped(F.col("line"), F.col("n") == F.col("first"), F.col("n") == F.col("last"))
    kept = kept.withColumn("line", redact_pii(line))
    return _in_pieces(kept, ["start", "number"], ["document_id"], "text")


def piece_digests(pieces: DataFrame) -> DataFrame:
    """A digest of each document's text: that of the text itself if a short file can have it."""
    lengths = pieces.groupBy("document_id").agg(F.sum(F.octet_length("text").cast("long") + 1).alias("length"))
    is_short = F.col("length") <= GROWTH * LONG_BYTES
    held = pieces.join(lengths, "document_id").groupBy("document_id").agg(
        F.collect_list(F.when(is_short, F.struct("piece", "text"))).alias("texts"),
        F.collect_list(F.when(~is_short, F.struct("piece", F.sha2(F.col("text").cast("binary"), 256).alias("digest")))).alias("digests"),
    )
    text = F.concat_ws("\n", F.sort_array("texts")["text"])
    digests = F.concat_ws("\n", F.lit("pieces"), F.sort_array("digests")["digest"])
    either = F.when(F.size("digests") > 0, digests).otherwise(text)
    return held.select("document_id", F.unhex(F.sha2(either.cast("binary"), 256)).alias("digest"))


def heading_chunk_pieces(pieces: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    """``to_gold_chunks`` of texts in pieces: the chunks, in pieces as well, with their size."""
    order = Window.partitionBy("document_id").orderBy("piece", "position")
    # With the line feed after it, a piece's last line can end in a carriage return.
    lines = F.split(normalize_line_breaks(F.concat("text", F.lit("\n"))), "\n")
    rows = pieces.select("document_id", "piece", lines.alias("lines")).select(
        "document_id", "piece", F.posexplode(F.slice("lines", F.lit(1), F.size("lines") - 1)).alias("position", "line")
    )
    heads = F.col("line").rlike(f"\\A#{{1,6}}[{INLINE_SPACE}]")
    rows = rows.withColumn("level", F.when(heads, F.length(F.regexp_extract("line", "\\A#*", 0))))
    heads = F.col("level").isNotNull()
    rows = rows.withColumns({"n": F.row_number().over(order), "section": F.count("level").over(order)})
    # A heading is one deeper than the one before, or as deep as its level if that is less.
    rows = rows.withColumn("depth", F.col("section") + F.least(F.lit(0), F.min(F.col("level") - F.col("section")).over(order)))
    title = strip(F.substr("line", F.col("level") + 1))
    depth = F.coalesce("depth", F.lit(0))
    titles = [F.last(F.when(heads & (depth == k), title), ignorenulls=True).over(order) for k in range(1, 7)]
    section = Window.partitionBy("document_id", "section")
    inked = F.when(~heads & _has_ink("line"), F.col("n"))
    rows = rows.withColumn("titles", F.slice(F.array(*titles), F.lit(1), depth.cast("int"))).withColumns(
        {"first": F.min(inked).over(section), "last": F.max(inked).over(section)}
    )
    is_first, is_last = F.col("n") == F.col("first"), F.col("n") == F.col("last")
    prefix = F.array_join("titles", " > ")
    line = _stripped(F.col("line"), is_first, is_last)
    line = F.when(is_first & (prefix != ""), F.concat(prefix, F.lit("\n"), line)).otherwise(line)
    kept = rows.where(~heads & F.col("n").between(F.col("first"), F.col("last")))
    kept = kept.withColumns({"chunk_index": (F.sum(is_first.cast("int")).over(order) - 1).cast("int"), "line": line})
    kept = kept.withColumnRenamed("piece", "part")
    chunks = _in_pieces(kept, ["part", "position"], ["document_id", "chunk_index"], "chunk_text")
    return chunks.withColumns(
        {
            "chunk_id": chunk_id("document_id", "chunk_index"),
            **{name: F.lit(value) for name, value in access_attributes(config).items()},
            "n_bytes": F.octet_length("chunk_text").cast("long"),
        }
    ).select(*GOLD_COLUMNS, "piece", "n_bytes")


def joined(pieces: DataFrame, keys: Sequence[str], name: str, n_bytes: int) -> DataFrame:
    """Whole texts, a row for each of ``keys``, from pieces of about ``n_bytes`` in all.

    Pieces are first dealt to tasks of some neighbours each: a task that had much of a text would
    hold it several times over before it is sent to the others.
    """
    run = F.floor(F.col("piece") * PIECE_BYTES / JOINED_BYTES)
    dealt = pieces.repartition(n_bytes // JOINED_BYTES + 1, *keys, run)
    held = F.sort_array(F.collect_list(F.struct("piece", name)))
    return dealt.groupBy(*keys).agg(F.concat_ws("\n", held[name]).alias(name))
