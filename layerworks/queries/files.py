"""Documents written as files and ingested from them, in one batch or as they arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerworks.operators.extract import add_extracted_text
from layerworks.plans.arrivals import DocumentCollection
from layerworks.plans.datasets import Dataset, publish_all
from layerworks.plans.documents import document_datasets
from layerworks.plans.tables import append_stream, overwrite_table
from layerworks.queries import sql
from layerworks.queries.documents import CONFIG
from layerworks.queries.inputs import detach, fresh_name, table
from layerworks.session import scratch_path
from layerworks.sources.files import BATCH, INCREMENTAL, read_binary, to_bronze
from layerworks.sources.literals import literal_rows

# Documents per file: some, as a file each would leave a cluster with tiny files.
PER_FILE = 128

# Documents per file where some files are refused.
PER_SMALL_FILE = 32

# Added to the group of a file to name its copy.
COPIES = 1_000_000_000

# Spark's text writer names its files so; they hold Markdown.
TYPES = {".txt": "md"}


def _write_files(documents: DataFrame, path: str, per_file: int = PER_FILE) -> None:
    """One file per group of neighbouring ids, in a folder named after the group."""
    grouped = documents.select((F.col("doc_id") / per_file).cast("long").alias("part"), "doc_id", "text")
    (
        grouped.repartition("part")
        .sortWithinPartitions("part", "doc_id", "text")
        .select("part", "text")
        .write.mode("append")
        .partitionBy("part")
        .text(path)
    )


def _part(path: Column) -> Column:
    """The group of ids in a file, from the name of its folder."""
    return F.regexp_extract(path, "/part=(\\d+)/", 1).cast("long")


def _extracted(bronze: DataFrame) -> DataFrame:
    return add_extracted_text(bronze, types=TYPES).select(
        _part(F.col("file_path")).alias("part"),
        F.octet_length("binary_content").cast("long").alias("n_bytes"),
        "source_type",
        "extracted_text",
        "_corrupt",
    )


def ingest_files_batch(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "files")
    _write_files(table(spark, folder, "documents"), path)
    name = fresh_name("bronze_docs")
    bronze = to_bronze(read_binary(spark, path, BATCH, "*.txt"))
    overwrite_table(bronze, name, path=scratch_path(spark, name))
    return _extracted(detach(spark, name))


def ingest_files_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Two arrivals of files, each followed by a run that must pick up only the new ones."""
    path = scratch_path(spark, "files")
    documents = table(spark, folder, "documents")
    late = (F.col("doc_id") / PER_FILE).cast("long") % 2 == 1
    name = fresh_name("bronze_docs")
    target, checkpoint = scratch_path(spark, name), scratch_path(spark, "checkpoint")
    for arrival in (documents.where(~late), documents.where(late)):
        _write_files(arrival, path)
        bronze = to_bronze(read_binary(spark, path, INCREMENTAL, "*.txt"))
        append_stream(bronze, name, checkpoint, target)
    return _extracted(detach(spark, name))


def published_documents(spark: SparkSession, folder: str) -> DataFrame:
    """From files to chunks, as declared datasets over a stream of files."""
    path = scratch_path(spark, "files")
    _write_files(table(spark, folder, "documents"), path)
    config = {**CONFIG, "source": {"path": path, "mode": INCREMENTAL, "path_glob_filter": "*.txt"}}
    datasets = document_datasets(
        config, scratch_path(spark, "checkpoint"), types=TYPES, prefix=fresh_name("docs") + "_"
    )
    publish_all(spark, datasets, scratch_path(spark, "published_documents"))
    *_, silver, gold = [detach(spark, dataset.name) for dataset in datasets]
    parts = silver.select("document_id", _part(F.col("metadata")["file_path"]).alias("part"))
    return gold.join(parts, "document_id").select(
        "part", "chunk_index", "chunk_text", "allowed_roles", "department"
    )


def _refuse_some(content: bytes) -> str:
    """Stand-in for a parser that cannot read every file."""
    if len(content) % 3 == 0:
        raise ValueError("refused")
    return content.decode("utf-8")


def _refusing_datasets(spark: SparkSession, folder: str) -> list[Dataset]:
    """The layers of smaller files, some of which cannot be read."""
    path = scratch_path(spark, "files")
    _write_files(table(spark, folder, "documents"), path, PER_SMALL_FILE)
    config = {**CONFIG, "source": {"path": path, "mode": BATCH, "path_glob_filter": "*.txt"}}
    return document_datasets(
        config, parsers={"page": _refuse_some}, types={".txt": "page"}, prefix=fresh_name("docs") + "_"
    )


def published_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """The files without a text, as published with the other layers."""
    datasets = _refusing_datasets(spark, folder)[:3]
    publish_all(spark, datasets, scratch_path(spark, "published_quarantine"))
    *_, quarantine = [detach(spark, dataset.name) for dataset in datasets]
    return quarantine.select(_part(F.col("file_path")).alias("part"), "source_type", "_corrupt")


def published_document_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What publishing counts: rows before any is dropped, and those without a text."""
    datasets = _refusing_datasets(spark, folder)[:4]
    counts = publish_all(spark, datasets, scratch_path(spark, "published_document_counts"))
    rows = []
    for dataset, layer in zip(datasets, ("bronze", "extracted", "quarantined", "silver")):
        found = counts[dataset.name]
        rows.append((layer, found["rows"], found.get("has_extracted_text")))
        detach(spark, dataset.name)
    return literal_rows(spark, rows, ["layer", "n_rows", "n_without_text"])


def _collection(spark: SparkSession, path: str) -> DocumentCollection:
    config = {**CONFIG, "source": {"path": path, "path_glob_filter": "*.txt"}}
    return DocumentCollection(scratch_path(spark, "collection"), config, types=TYPES)


def _copies(documents: DataFrame, spark: SparkSession) -> DataFrame:
    """The same texts as other files."""
    return documents.withColumn("doc_id", F.col("doc_id") + COPIES * PER_FILE)


def silver_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Three arrivals of files, copies of earlier ones among them; Silver follows each."""
    path = scratch_path(spark, "files")
    documents = table(spark, folder, "documents")
    third = (F.col("doc_id") / PER_FILE).cast("long") % 3
    collection = _collection(spark, path)
    for number in range(3):
        _write_files(documents.where(third == number), path)
        if number:
            _write_files(_copies(documents.where(third == number - 1), spark), path)
        collection.refresh(spark)
    silver = collection.silver(spark)
    return silver.select((_part(F.col("metadata")["file_path"]) % COPIES).alias("part"), "source_type", "extracted_text")


def gold_follows_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Files are written; then one gets another text, one goes and one with a copy goes."""
    path = scratch_path(spark, "files")
    documents = table(spark, folder, "documents").withColumn("doc_id", F.col("doc_id") % (4 * PER_FILE))
    copied = F.col("doc_id") < PER_FILE
    _write_files(documents, path)
    _write_files(_copies(documents.where(copied), spark), path)
    collection = _collection(spark, path)
    collection.refresh(spark)
    second = (F.col("doc_id") / PER_FILE).cast("long") == 1
    _replace_file(path, 1, documents.where(second).withColumn("text", F.concat(F.lit("again "), "text")))
    for part in (0, 2):
        _replace_file(path, part, documents.where("false").withColumn("part", F.lit(part)))
    collection.refresh(spark)
    gold = collection.gold(spark)
    parts = collection.silver(spark).select("document_id", (_part(F.col("metadata")["file_path"]) % COPIES).alias("part"))
    return gold.join(parts, "document_id").select("part", "chunk_index", "chunk_text")


def _replace_file(path: str, part: int, documents: DataFrame) -> None:
    """Give the folder of a file other rows; without rows it is left without a file."""
    rows = documents.orderBy("doc_id", "text").coalesce(1)
    if rows.isEmpty():
        rows.select("text", "part").write.mode("overwrite").partitionBy("part").text(f"{path}/part={part}")
    else:
        rows.select("text").write.mode("overwrite").text(f"{path}/part={part}")


QUERIES = {
    "silver_arrivals": silver_arrivals,
    "gold_follows_changes": gold_follows_changes,
    "published_quarantine": published_quarantine,
    "published_document_counts": published_document_counts,
    "ingest_files_batch": ingest_files_batch,
    "ingest_files_stream": ingest_files_stream,
    "published_documents": published_documents,
}

def _files_of(per_file: int) -> str:
    return f"""
    WITH files AS (
        SELECT doc_id // {per_file} AS part,
               string_agg(text, chr(10) ORDER BY doc_id) || chr(10) AS text
        FROM documents GROUP BY doc_id // {per_file}
    )
"""


_PARTS, _SMALL_PARTS = _files_of(PER_FILE), _files_of(PER_SMALL_FILE)

_FILES = f"""{_PARTS}
    SELECT part, strlen(text) AS n_bytes, 'md' AS source_type,
           {sql.redact(sql.clean("text"))} AS extracted_text, CAST(NULL AS VARCHAR) AS _corrupt
    FROM files
"""

ORACLES = {
    "ingest_files_batch": _FILES,
    "published_document_counts": f"""{_SMALL_PARTS}, counted AS (
            SELECT count(*) AS n, count(*) FILTER (strlen(text) % 3 = 0) AS refused FROM files
        )
        SELECT 'bronze' AS layer, n AS n_rows, CAST(NULL AS BIGINT) AS n_without_text FROM counted
        UNION ALL SELECT 'extracted', n, NULL FROM counted
        UNION ALL SELECT 'quarantined', refused, NULL FROM counted
        UNION ALL SELECT 'silver', n, refused FROM counted
    """,
    "published_quarantine": f"""{_SMALL_PARTS}
        SELECT part, 'page' AS source_type, 'parse_error:ValueError: refused' AS _corrupt
        FROM files WHERE strlen(text) % 3 = 0
    """,
    "ingest_files_stream": _FILES,
    "silver_arrivals": f"""{_PARTS}
        SELECT part, 'md' AS source_type, {sql.redact(sql.clean("text"))} AS extracted_text FROM files
    """,
    "gold_follows_changes": f"""
        WITH rows AS (SELECT doc_id % {4 * PER_FILE} // {PER_FILE} AS part, doc_id % {4 * PER_FILE} AS doc_id, text FROM documents),
        files AS (
            SELECT part, string_agg(CASE WHEN part = 1 THEN 'again ' ELSE '' END || text,
                                    chr(10) ORDER BY doc_id, text) || chr(10) AS text
            FROM rows WHERE part <> 2 GROUP BY part
        ), prepared AS (
            SELECT part AS id, {sql.redact(sql.clean("text"))} AS text FROM files
        ), {sql.heading_chunks("prepared")}
        SELECT id AS part, chunk_index, chunk_text FROM heading_chunks
    """,
    "published_documents": f"""{_PARTS}, prepared AS (
            SELECT part AS id, {sql.redact(sql.clean("text"))} AS text FROM files
        ), {sql.heading_chunks("prepared")}
        SELECT id AS part, chunk_index, chunk_text, 'analyst,manager' AS allowed_roles,
               'engineering' AS department
        FROM heading_chunks
    """,
}
