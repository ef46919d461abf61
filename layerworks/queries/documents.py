"""Document text: identifiers, cleaning, masking, deduplication, chunks, the layers."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerworks.functions import ids, text
from layerworks.operators import chunk
from layerworks.operators.dedup import dedup_documents
from layerworks.operators.extract import (
    add_extracted_text,
    join_parts,
    quarantined_documents,
    to_silver,
)
from layerworks.queries import sql
from layerworks.queries.inputs import table

# Chunking strategies by type, and access attributes.
CONFIG: dict[str, Any] = {
    "chunking": {
        "md": {"strategy": "markdown_header"},
        "pdf": {"strategy": "paragraph", "max_chars": 1000, "overlap": 100},
        "pptx": {"strategy": "paragraph", "max_chars": 800, "overlap": 80},
        "default": {"strategy": "paragraph", "max_chars": 1000, "overlap": 100},
    },
    "permission_metadata": {
        "allowed_roles": ["analyst", "manager"],
        "department": "engineering",
    },
}


def _choose(key: str, values: list[str]) -> Column:
    """One of the values, by the key."""
    position = (F.col(key) % len(values) + 1).cast("int")
    return F.element_at(F.array(*map(F.lit, values)), position)


def _spaced(body: str = "text") -> Column:
    """Text with every line a paragraph."""
    return F.replace(F.col(body), F.lit("\n"), F.lit("\n\n"))


def document_id(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return pages.select("page_id", ids.document_id("url").alias("document_id"))


ENDINGS = ["/guide.md", "/Guide.MARKDOWN", "/a.b.pdf", "/deck.Pptx", "/old.ppt", "/x.txt", "/.md", ""]


def source_type(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select(
        "page_id", F.concat("url", _choose("page_id", ENDINGS)).alias("path")
    )
    return pages.withColumn("source_type", ids.source_type("path"))


def decode_bytes(spark: SparkSession, folder: str) -> DataFrame:
    content = F.concat(F.encode("text", "UTF-8"), F.lit(bytes([0xFF, 0x41, 0xC3])))
    documents = table(spark, folder, "documents").select("doc_id", content.alias("content"))
    return documents.select("doc_id", text.decode_utf8("content").alias("decoded"))


def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    noisy = F.concat(
        F.lit(" \t　\n"),
        F.replace("text", F.lit("\n"), F.lit(" \t \n\n\n\n")),
        F.lit("\x00 \n\n"),
        F.lit("end\t\n\n\n \xa0"),
    )
    documents = table(spark, folder, "documents")
    return documents.select("doc_id", text.clean_text(noisy).alias("cleaned"))


def _with_contacts() -> Column:
    """The text with an address and numbers made from the key."""
    key = F.col("doc_id").cast("string")
    four = F.lpad((F.col("doc_id") % 10000).cast("string"), 4, "0")
    return F.concat(
        F.col("text"),
        F.lit("\n連絡先は"), key, F.lit(".user+x@mail-"), key, F.lit(".example.co.jp または 03-"),
        four, F.lit("-"), four, F.lit(" 090"), four, four, F.lit(" 電話03-1234-5678 1"), four,
    )


def redact_pii(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return documents.select("doc_id", text.redact_pii(_with_contacts()).alias("redacted"))


def doc_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_documents(table(spark, folder, "documents"), "text", ["doc_id"])


def chunk_paragraph(spark: SparkSession, folder: str) -> DataFrame:
    chunks = chunk.paragraph_chunks(_spaced(), 1000, 100)
    return table(spark, folder, "documents").select(
        "doc_id", F.posexplode(chunks).alias("chunk_index", "chunk_text")
    )


def chunk_ids(spark: SparkSession, folder: str) -> DataFrame:
    document = ids.document_id(F.col("doc_id").cast("string"))
    return chunk_paragraph(spark, folder).select(
        "doc_id", "chunk_index", ids.chunk_id(document, "chunk_index").alias("chunk_id")
    )


def _markdown() -> Column:
    """A Markdown document from a turn of a conversation, levels skipped and repeated."""
    number = F.col("conv_id").cast("string")
    return F.concat(
        F.when(F.col("turn") % 2 == 0, F.lit("opening words\r\n")).otherwise(F.lit("")),
        F.lit("# Conversation "), number, F.lit("\n\n### "), F.col("role"), F.lit(" \n"),
        F.col("text"), F.lit("\n### \n\n\n###### last\n- a\n\n- b\n####### no heading\n#no heading\n"),
        F.lit("## Notes\t\n　\n#　End\n"), F.col("role"), F.lit("\x0b# not part of it\n"),
    )


def chunk_heading(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations").select(
        "conv_id", "turn",
        F.posexplode(chunk.heading_chunks(_markdown())).alias("chunk_index", "chunk_text"),
    )


def chunkless_documents(spark: SparkSession, folder: str) -> DataFrame:
    only_headings = F.concat(F.lit("# "), F.col("role"), F.lit("\n\n## Nothing\n \t\n"))
    body = F.when(F.col("turn") % 2 == 0, only_headings).otherwise(F.col("text"))
    documents = table(spark, folder, "conversations").select(
        F.concat_ws("/", "conv_id", "turn").alias("document_id"),
        body.alias("extracted_text"),
        F.lit("md").alias("source_type"),
    )
    return chunk.chunkless_documents(documents, CONFIG).select("document_id")


def _bronze(spark: SparkSession, folder: str, ending: Column, content: Column) -> DataFrame:
    """The documents as Bronze rows of files."""
    return table(spark, folder, "documents").select(
        F.concat(F.lit("/docs/"), "source", F.lit("/"), "doc_id", ending).alias("file_path"),
        content.alias("binary_content"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ingest_timestamp"),
        F.lit(None).cast("string").alias("_corrupt"),
    )


def doc_silver(spark: SparkSession, folder: str) -> DataFrame:
    bronze = _bronze(spark, folder, F.lit(".md"), F.encode("text", "UTF-8"))
    return to_silver(add_extracted_text(bronze)).select(
        "document_id", "extracted_text", "source_type",
        F.col("metadata")["file_path"].alias("file_path"),
        F.col("metadata")["ingest_timestamp"].alias("ingested_at"),
    )


def doc_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    endings = [".md", ".pdf", ".txt", "", ".Markdown"]
    content = F.when(F.col("doc_id") % 7 != 0, F.encode("text", "UTF-8"))
    bronze = _bronze(spark, folder, _choose("doc_id", endings), content)
    return quarantined_documents(add_extracted_text(bronze))


def _slides(content: bytes) -> str:
    """Stand-in for a slide parser: lines are shapes; some files are refused."""
    lines = content.decode("utf-8").split("\n")
    if lines[0] == "broken":
        raise ValueError("not a slide deck")
    return join_parts(lines)


def doc_parsers(spark: SparkSession, folder: str) -> DataFrame:
    opening = F.when(F.col("doc_id") % 10 == 4, F.lit("broken\n")).otherwise(F.lit("\n"))
    bronze = _bronze(
        spark, folder, _choose("doc_id", [".pptx", ".md"]),
        F.encode(F.concat(opening, "text"), "UTF-8"),
    )
    return add_extracted_text(bronze, {"pptx": _slides}).select(
        "file_path", "source_type", "extracted_text", "_corrupt"
    )


def _typed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of every type with their text cleaned and masked, one row per text."""
    first_line = F.substring_index("text", "\n", 1)
    rest = F.substr("text", F.length(first_line) + F.lit(1))
    markdown = F.concat(F.lit("# Part\n"), first_line, F.lit("\n## More"), rest)
    kind = _choose("doc_id", ["md", "pdf", "pptx", "other"])
    documents = table(spark, folder, "documents").select(
        ids.document_id(F.col("doc_id").cast("string")).alias("document_id"),
        F.when(kind == "md", markdown).otherwise(_spaced()).alias("raw"),
        kind.alias("source_type"),
    )
    prepared = documents.select(
        "document_id",
        text.redact_pii(text.clean_text("raw")).alias("extracted_text"),
        "source_type",
    )
    return dedup_documents(prepared)


def doc_gold(spark: SparkSession, folder: str) -> DataFrame:
    return chunk.to_gold_chunks(_typed_documents(spark, folder), CONFIG)


QUERIES = {
    "document_id": document_id,
    "source_type": source_type,
    "decode_bytes": decode_bytes,
    "clean_text": clean_text,
    "redact_pii": redact_pii,
    "doc_dedup": doc_dedup,
    "chunk_paragraph": chunk_paragraph,
    "chunk_ids": chunk_ids,
    "chunk_heading": chunk_heading,
    "chunkless_documents": chunkless_documents,
    "doc_silver": doc_silver,
    "doc_quarantine": doc_quarantine,
    "doc_parsers": doc_parsers,
    "doc_gold": doc_gold,
}


def _pick(key: str, values: list[str]) -> str:
    items = ", ".join(f"'{value}'" for value in values)
    return f"list_extract([{items}], {key} % {len(values)} + 1)"


_SPACED = "replace(text, chr(10), chr(10) || chr(10))"
_KEY = "CAST(doc_id AS VARCHAR)"
_FOUR = "lpad(CAST(doc_id % 10000 AS VARCHAR), 4, '0')"
_CONTACTS = f"""concat(text, chr(10), '連絡先は', {_KEY}, '.user+x@mail-', {_KEY},
    '.example.co.jp または 03-', {_FOUR}, '-', {_FOUR}, ' 090', {_FOUR}, {_FOUR},
    ' 電話03-1234-5678 1', {_FOUR})"""

_PARAGRAPHS = f"""
    WITH RECURSIVE spaced AS (
        SELECT doc_id AS id, {_SPACED} AS text, 1000 AS max_chars, 100 AS overlap FROM documents
    ), {sql.paragraph_chunks("spaced")}
"""

_MARKDOWN = """concat(
    CASE WHEN turn % 2 = 0 THEN 'opening words' || chr(13) || chr(10) ELSE '' END,
    '# Conversation ', conv_id, '\n\n### ', role, ' \n', text,
    '\n### \n\n\n###### last\n- a\n\n- b\n####### no heading\n#no heading\n',
    '## Notes\t\n　\n#　End\n', role, '\x0b# not part of it\n')"""

_SILVER = f"""
    WITH prepared AS (
        SELECT concat('/docs/', source, '/', doc_id, '.md') AS file_path,
               {sql.redact(sql.clean("text"))} AS extracted_text
        FROM documents
    ), identified AS (
        SELECT {sql.short_hash("file_path")} AS document_id, extracted_text, file_path FROM prepared
    )
"""

_TYPED = f"""
    typed AS (
        SELECT {sql.short_hash(_KEY)} AS document_id, doc_id,
               {_pick("doc_id", ["md", "pdf", "pptx", "other"])} AS kind,
               CASE WHEN doc_id % 4 = 0 THEN
                   concat('# Part\n', split_part(text, chr(10), 1), '\n## More',
                          substr(text, length(split_part(text, chr(10), 1)) + 1))
               ELSE {_SPACED} END AS raw
        FROM documents
    ), prepared AS (
        SELECT document_id, kind, {sql.redact(sql.clean("raw"))} AS text FROM typed
    ), distinct_texts AS (
        SELECT document_id AS id, kind, text,
               CASE WHEN kind = 'pptx' THEN 800 ELSE 1000 END AS max_chars,
               CASE WHEN kind = 'pptx' THEN 80 ELSE 100 END AS overlap
        FROM prepared
        QUALIFY row_number() OVER (PARTITION BY text ORDER BY document_id) = 1
    ), markdown AS (
        SELECT id, text FROM distinct_texts WHERE kind = 'md'
    ), paragraphed AS (
        SELECT id, text, max_chars, overlap FROM distinct_texts WHERE kind <> 'md'
    )
"""

ORACLES = {
    "document_id": f"SELECT page_id, {sql.short_hash('url')} AS document_id FROM pages",
    "source_type": f"""
        WITH paths AS (
            SELECT page_id, url || {_pick("page_id", ENDINGS)} AS path FROM pages
        ), names AS (
            SELECT *, ltrim(list_extract(string_split(path, '/'), -1), '.') AS name FROM paths
        ), endings AS (
            SELECT *, CASE WHEN contains(name, '.')
                           THEN lower(list_extract(string_split(name, '.'), -1)) END AS ending
            FROM names
        )
        SELECT page_id, path, CASE WHEN ending IN ('md', 'markdown') THEN 'md'
               WHEN ending IN ('ppt', 'pptx') THEN 'pptx' WHEN ending = 'pdf' THEN 'pdf' END AS source_type
        FROM endings
    """,
    "decode_bytes": "SELECT doc_id, concat(text, '�A�') AS decoded FROM documents",
    "clean_text": f"""
        WITH noisy AS (
            SELECT doc_id, concat(' \t　\n', replace(text, chr(10), ' \t \n\n\n\n'), chr(0),
                                  ' \n\n', 'end\t\n\n\n \xa0') AS text
            FROM documents
        )
        SELECT doc_id, {sql.clean("text")} AS cleaned FROM noisy
    """,
    "redact_pii": f"""
        WITH contacts AS (SELECT doc_id, {_CONTACTS} AS text FROM documents)
        SELECT doc_id, {sql.redact("text")} AS redacted FROM contacts
    """,
    "doc_dedup": """
        SELECT * FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)
    """,
    "chunk_paragraph": f"""{_PARAGRAPHS}
        SELECT id AS doc_id, chunk_index, chunk_text FROM paragraph_chunks
    """,
    "chunk_ids": f"""{_PARAGRAPHS}
        SELECT id AS doc_id, chunk_index,
               {sql.short_hash(f"{sql.short_hash('CAST(id AS VARCHAR)')} || ':' || chunk_index")} AS chunk_id
        FROM paragraph_chunks
    """,
    "chunk_heading": f"""
        WITH markdown AS (
            SELECT [conv_id, turn] AS id, {_MARKDOWN} AS text FROM conversations
        ), {sql.heading_chunks("markdown")}
        SELECT id[1] AS conv_id, id[2] AS turn, chunk_index, chunk_text FROM heading_chunks
    """,
    "chunkless_documents": """
        SELECT concat_ws('/', conv_id, turn) AS document_id FROM conversations WHERE turn % 2 = 0
    """,
    "doc_silver": f"""{_SILVER}
        SELECT document_id, extracted_text, 'md' AS source_type, file_path,
               '2024-01-01 00:00:00' AS ingested_at
        FROM identified
        QUALIFY row_number() OVER (PARTITION BY extracted_text ORDER BY document_id) = 1
    """,
    "doc_quarantine": f"""
        WITH files AS (
            SELECT doc_id, concat('/docs/', source, '/', doc_id,
                   {_pick("doc_id", [".md", ".pdf", ".txt", "", ".Markdown"])}) AS file_path
            FROM documents
        ), typed AS (
            SELECT *, CASE doc_id % 5 WHEN 0 THEN 'md' WHEN 4 THEN 'md' WHEN 1 THEN 'pdf' END AS source_type
            FROM files
        )
        SELECT file_path, source_type, CASE WHEN source_type IS NULL THEN 'unsupported_type'
               WHEN doc_id % 7 = 0 THEN 'null_content' ELSE 'no_parser:pdf' END AS _corrupt
        FROM typed WHERE source_type IS NULL OR source_type = 'pdf' OR doc_id % 7 = 0
    """,
    "doc_parsers": f"""
        WITH files AS (
            SELECT concat('/docs/', source, '/', doc_id, {_pick("doc_id", [".pptx", ".md"])}) AS file_path,
                   doc_id % 2 = 0 AS is_deck, doc_id % 10 = 4 AS is_broken,
                   concat(CASE WHEN doc_id % 10 = 4 THEN 'broken' ELSE '' END, chr(10), text) AS text
            FROM documents
        ), raw AS (
            SELECT *, CASE WHEN NOT is_deck THEN text ELSE array_to_string(list_filter(
                   string_split(text, chr(10)), lambda part: part <> ''), chr(10) || chr(10)) END AS raw
            FROM files
        )
        SELECT file_path, CASE WHEN is_deck THEN 'pptx' ELSE 'md' END AS source_type,
               CASE WHEN NOT (is_deck AND is_broken) THEN {sql.redact(sql.clean("raw"))} END AS extracted_text,
               CASE WHEN is_deck AND is_broken THEN 'parse_error:ValueError: not a slide deck' END AS _corrupt
        FROM raw
    """,
    "doc_gold": f"""
        WITH RECURSIVE {_TYPED}, {sql.heading_chunks("markdown")},
        {sql.paragraph_chunks("paragraphed")}, chunks AS (
            SELECT * FROM heading_chunks UNION ALL SELECT * FROM paragraph_chunks
        )
        SELECT {sql.short_hash("id || ':' || chunk_index")} AS chunk_id, id AS document_id, chunk_text,
               'analyst,manager' AS allowed_roles, 'engineering' AS department, chunk_index
        FROM chunks
    """,
}
