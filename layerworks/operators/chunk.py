"""Splitting document text into chunks, and the chunk table.

Both splitters are sequential, so each is a fold inside its row: Column expressions,
no shuffle, no Python, and usable on documents of many megabytes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerworks.config import access_attributes, strategy_table
from layerworks.functions.columns import bind
from layerworks.functions.ids import chunk_id
from layerworks.functions.text import INLINE_SPACE, WHITESPACE, normalize_line_breaks, strip

GOLD_COLUMNS = (
    "chunk_id",
    "document_id",
    "chunk_text",
    "allowed_roles",
    "department",
    "chunk_index",
)

_HEADING_AHEAD = f"\\n(?=#{{1,6}}[{INLINE_SPACE}])"
_BLANK_LINES = f"\\n[{WHITESPACE}]*\\n"
_GAP = "\n\n"
_BLOCK = 64
_LEVELS = 2


def _strings() -> Column:
    return F.array().cast("array<string>")


def _fold_chunks(
    items: Column,
    carried: Mapping[str, Column],
    extend: Callable[[Column, Column], Column],
    finish: Callable[[Column], Column],
) -> Column:
    """Fold items into ``chunks`` and what is carried from item to item.

    A fold copies its list of chunks at each step.  So that a long document does not
    copy all its chunks with every item, items are folded in runs of ``_BLOCK``, and
    these in runs of runs: at each level a chunk is only copied with the runs beside it.
    """

    def state(chunks: Column, source: Column | None = None) -> Column:
        values = [source[name] if source is not None else carried[name] for name in carried]
        named = [value.alias(name) for name, value in zip(carried, values, strict=True)]
        return F.struct(chunks.alias("chunks"), *named)

    def runs(items: Column, length: int) -> Column:
        last = F.greatest(F.size(items) - 1, F.lit(0))
        starts = F.sequence(F.lit(0), last, F.lit(length))
        return F.transform(starts, lambda start: F.slice(items, start + 1, F.lit(length)))

    def fold(items: Column, start: Column, level: int, last: Callable[[Column], Column]) -> Column:
        if level == 0:
            return F.aggregate(items, start, extend, last)

        def add(before: Column, run: Column) -> Column:
            # Joined by the fold's own last step: a bound value is copied, all its texts too.
            return fold(
                run,
                state(_strings(), before),
                level - 1,
                lambda after: state(F.concat(before.chunks, after.chunks), after),
            )

        return F.aggregate(bind(items, lambda items: runs(items, _BLOCK**level)), start, add, last)

    return fold(items, state(_strings()), _LEVELS, finish)


def _section(text: Column) -> Column:
    """Level, title and body of a section; level 0 is text before any heading."""

    def parts(head: Column) -> Column:
        marks = F.length(F.regexp_extract(head, "\\A#*", 0))
        return F.struct(
            marks.alias("level"),
            strip(F.substr(head, marks + 1)).alias("title"),
            strip(F.substr(text, F.length(head) + 1)).alias("body"),
        )

    return bind(F.substring_index(text, "\n", 1), parts)


def heading_chunks(text: Column) -> Column:
    """One chunk per heading with a body, prefixed by the path of titles above it."""
    # The added line break makes a heading in the first line like any other, and
    # leaves the text before the first heading as the first section.
    lines = F.concat(F.lit("\n"), normalize_line_breaks(F.coalesce(text, F.lit(""))))
    sections = bind(
        lines,
        lambda lines: F.when(
            F.contains(lines, F.lit("\n#")), F.split(lines, _HEADING_AHEAD)
        ).otherwise(F.array(lines)),
    )

    def extend(state: Column, section: Column) -> Column:
        path = F.when(
            section.level > 0,
            F.concat(F.slice(state.path, 1, section.level - 1), F.array(section.title)),
        ).otherwise(state.path)
        prefix = F.array_join(path, " > ")
        chunk = F.when(
            prefix != "", F.concat(prefix, F.lit("\n"), section.body)
        ).otherwise(section.body)
        chunks = F.when(
            section.body != "", F.concat(state.chunks, F.array(chunk))
        ).otherwise(state.chunks)
        return F.struct(chunks.alias("chunks"), path.alias("path"))

    return _fold_chunks(
        F.transform(sections, _section),
        {"path": _strings()},
        extend,
        lambda state: state.chunks,
    )


def paragraph_chunks(text: Column, max_chars: int = 1000, overlap: int = 100) -> Column:
    """Pack paragraphs greedily; each chunk but the first opens with the end of the last.

    ``max_chars`` bounds what is packed together; a longer paragraph stays whole.
    """
    if max_chars < 0 or overlap < 0:
        raise ValueError(f"negative chunk size: max_chars={max_chars}, overlap={overlap}")

    def state(chunks: Column, current: Column, size: Column) -> Column:
        return F.struct(chunks.alias("chunks"), current.alias("current"), size.alias("size"))

    def closed(state: Column) -> Column:
        return F.concat(state.chunks, F.array(strip(state.current)))

    def extend(open_: Column, paragraph: Column) -> Column:
        # The size is carried along, as counting characters means reading them.
        length = F.length(paragraph)
        grown = open_.size + len(_GAP) + length
        overlapped = F.concat(F.right(open_.current, F.lit(overlap)), F.lit(_GAP), paragraph)
        return (
            F.when(open_.current == "", state(open_.chunks, paragraph, length))
            .when(
                grown > max_chars,
                state(
                    closed(open_),
                    overlapped,
                    F.least(open_.size, F.lit(overlap)) + len(_GAP) + length,
                ),
            )
            .otherwise(
                state(open_.chunks, F.concat(open_.current, F.lit(_GAP), paragraph), grown)
            )
        )

    def pack(text: Column, paragraphs: Column) -> Column:
        folded = _fold_chunks(
            paragraphs,
            {"current": F.lit(""), "size": F.lit(0)},
            extend,
            lambda state: F.when(state.current != "", closed(state)).otherwise(state.chunks),
        )
        # What fits one chunk as it is fits it with its gaps narrowed.
        return (
            F.when(F.size(paragraphs) == 0, _strings())
            .when(F.length(text) <= max_chars, F.array(F.array_join(paragraphs, _GAP)))
            .otherwise(folded)
        )

    def split(text: Column) -> Column:
        parts = F.transform(F.split(text, _BLANK_LINES), strip)
        paragraphs = F.filter(parts, lambda paragraph: paragraph != "")
        return bind(paragraphs, lambda paragraphs: pack(text, paragraphs))

    return bind(F.coalesce(text, F.lit("")), split)


def chunk_text(text: Column, source_type: Column, config: Mapping[str, Any]) -> Column:
    """The chunks of a text, by the strategy configured for its type.

    Types with the same strategy share a branch; only the branch of a row's own
    type is evaluated for it.
    """
    table = strategy_table(config)
    fallback = _strategy_key(None, table.pop(None))
    branches: dict[tuple, list[str]] = {}
    for name, strategy in {"md": {}, **table}.items():
        branches.setdefault(_strategy_key(name, strategy), []).append(name)
    chunks = None
    for strategy, types in branches.items():
        if strategy == fallback:
            continue
        condition = source_type.isin(types)
        value = _chunks_by(text, strategy)
        chunks = F.when(condition, value) if chunks is None else chunks.when(condition, value)
    rest = _chunks_by(text, fallback)
    return rest if chunks is None else chunks.otherwise(rest)


def _strategy_key(source_type: str | None, strategy: Mapping[str, Any]) -> tuple:
    if source_type == "md" or strategy.get("strategy", "paragraph") == "markdown_header":
        return ("heading",)
    return ("paragraph", strategy.get("max_chars", 1000), strategy.get("overlap", 100))


def _chunks_by(text: Column, strategy: tuple) -> Column:
    return heading_chunks(text) if strategy[0] == "heading" else paragraph_chunks(text, *strategy[1:])


def to_gold_chunks(documents: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    """Silver documents to chunk rows with ids and access attributes.

    Documents without a chunk (empty, or headings only) give no row;
    ``chunkless_documents`` finds them.
    """
    chunks = chunk_text(F.col("extracted_text"), F.col("source_type"), config)
    return (
        documents.where(F.col("extracted_text").isNotNull())
        .select("document_id", F.posexplode(chunks).alias("chunk_index", "chunk_text"))
        .withColumns(
            {
                "chunk_id": chunk_id("document_id", "chunk_index"),
                **{name: F.lit(value) for name, value in access_attributes(config).items()},
            }
        )
        .select(*GOLD_COLUMNS)
    )


def chunkless_documents(documents: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    """The documents that have a text but give no chunk."""
    chunks = chunk_text(F.col("extracted_text"), F.col("source_type"), config)
    return documents.where(F.col("extracted_text").isNotNull() & (F.size(chunks) == 0))
