"""Document layers that follow a folder: files that come, change and go cost only themselves.

``refresh`` compares the folder's listing with the one before, by path, time and length.  Only new
and changed files are read, extracted and hashed; the listing keeps the digest of every live text, so
copies of earlier documents are found without touching them again.  Where the document that stands
for a text changes, because a copy with a smaller id came, or the one that stood for it changed or
went, its row leaves Silver and its chunks leave Gold, and the next copy's come in.

Silver and Gold are logs: a folder of added rows and one of removed ids for each change.  A change
becomes visible when its number is committed, after all else is written; one that failed is done
again over its own folders.  No row is ever written anew for another document's sake.  One writer at
a time.

Texts of long files are kept in pieces (``pieces``, ``gold_pieces``), and joined only where the text or
the chunk is read; in the other logs they are null.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerworks.config import CORRUPT_COLUMN, section
from layerworks.functions.ids import SOURCE_TYPES, document_id
from layerworks.operators import long_texts
from layerworks.operators.chunk import to_gold_chunks
from layerworks.operators.extract import TEXT_TYPE, Parser, add_extracted_text, silver_rows
from layerworks.operators.long_texts import PIECES, clean_pieces, heading_chunk_pieces, is_long, joined, piece_digests
from layerworks.sources.files import compare_listings, list_files, read_listed, read_listed_lines, to_bronze

LISTING = "file_path string, modified timestamp, length long, document_id string, digest binary, extracted_in long"
DIFFERENCES = "file_path string, modified timestamp, length long, status string, digest binary"
EXTRACTED = (
    "document_id string, file_path string, source_type string, extracted_text string, digest binary, "
    f"ingest_timestamp timestamp, {CORRUPT_COLUMN} string"
)
SILVER = (
    "document_id string, extracted_text string, source_type string, metadata map<string, string>, "
    "extracted_in long"
)
COMMITS = "change long, added long, changed long, removed long"


class DocumentCollection:
    """The layers of one folder of documents, kept in another folder that all executors reach."""

    def __init__(
        self,
        folder: str,
        config: Mapping[str, Any],
        parsers: Mapping[str, Parser] | None = None,
        types: Mapping[str, str] = SOURCE_TYPES,
    ) -> None:
        source = section(config, "source")
        self.folder, self.config = folder.rstrip("/"), config
        self.source, self.pattern = section(source, "path"), source.get("path_glob_filter")
        self.parsers, self.types = parsers, types

    def refresh(self, spark: SparkSession) -> dict[str, int]:
        """Take over what came, changed and went since the last refresh; returns how many files."""
        last = self._last(spark)
        change = last + 1
        before = self._listing(spark, last)
        compared = compare_listings(before, list_files(spark, self.source, self.pattern))
        differences = self._write(compared.where("status != 'same'").select(*_names(DIFFERENCES)), "differences", change, DIFFERENCES)
        counts = {row["status"]: row["count"] for row in differences.groupBy("status").count().collect()}
        counts = {status: counts.get(status, 0) for status in ("added", "changed", "removed")}
        if not any(counts.values()):
            return counts
        extracted = self._write(self._extract(spark, differences, change), "extracted", change, EXTRACTED)
        after = self._write(_next_listing(before, differences, extracted, change), "listing", change, LISTING)
        moved = self._write(_moved(before, after, differences, extracted), "moved", change, MOVED)
        gone = moved.where("old_id is not null").select(F.col("old_id").alias("document_id"))
        self._write(gone, "removed", change, "document_id string")
        come = moved.where("new_id is not null").select(F.col("new_id").alias("document_id"), "digest", F.col("extracted_in").alias("change"))
        # The change of a text's extraction is a folder: only those with a text that comes in are read.
        texts = self._log(spark, "extracted", EXTRACTED, change).join(come, ["document_id", "digest", "change"])
        silver = silver_rows(texts, "change")
        silver = self._write(silver.withColumnRenamed("change", "extracted_in"), "silver", change, SILVER)
        gold = to_gold_chunks(silver, self.config)
        self._write(gold, "gold", change, gold.schema)
        self._write_gold_pieces(spark, silver.where("extracted_text is null"), change)
        row = (change, counts["added"], counts["changed"], counts["removed"])
        spark.createDataFrame([row], COMMITS).coalesce(1).write.mode("append").json(f"{self.folder}/commits")
        return counts

    def silver(self, spark: SparkSession) -> DataFrame:
        """One row per distinct text of the folder, that of the smallest document id."""
        rows = self._live(spark, "silver", SILVER)
        if not self._has(spark, "pieces"):
            return rows.drop("extracted_in")
        last, keys = self._last(spark), ["document_id", "extracted_in"]
        n_bytes = self._listing(spark, last).where(_may_be_long()).agg(F.sum("length")).first()[0]
        pieces = self._log(spark, "pieces", PIECES, last).withColumnRenamed("change", "extracted_in")
        pieces = pieces.join(rows.where("extracted_text is null").select(*keys), keys, "left_semi")
        texts = joined(pieces, keys, "text", n_bytes or 0)
        # Where the text is not read, the planner leaves this join out.
        text = F.coalesce("extracted_text", "text").alias("extracted_text")
        return rows.join(texts, keys, "left").select("document_id", text, "source_type", "metadata")

    def gold(self, spark: SparkSession) -> DataFrame:
        """The chunks of Silver."""
        empty = silver_rows(spark.createDataFrame([], EXTRACTED))
        schema = to_gold_chunks(empty, self.config).schema
        rows = self._live(spark, "gold", schema)
        if not self._has(spark, "gold_pieces"):
            return rows
        pieces = self._live(spark, "gold_pieces", _gold_pieces_schema(spark, self.config))
        n_bytes = pieces.agg(F.sum("n_bytes")).first()[0]
        keys = [name for name in schema.names if name != "chunk_text"]
        return rows.unionByName(joined(pieces, keys, "chunk_text", n_bytes)) if n_bytes else rows

    def quarantine(self, spark: SparkSession) -> DataFrame:
        """The files of the folder that have no text, and why."""
        last = self._last(spark)
        live = self._listing(spark, last).where("digest is null").select("document_id", F.col("extracted_in").alias("change"))
        texts = self._log(spark, "extracted", EXTRACTED, last).where("extracted_text is null")
        return texts.join(live, ["document_id", "change"]).select("file_path", "source_type", CORRUPT_COLUMN)

    def commits(self, spark: SparkSession) -> DataFrame:
        """The changes taken over, and how many files each had."""
        return spark.read.schema(COMMITS).json(f"{self.folder}/commits")

    def _extract(self, spark: SparkSession, differences: DataFrame, change: int) -> DataFrame:
        fresh = differences.where("status != 'removed'")
        long = is_long(self.parsers or (), self.types)
        files = read_listed(spark, self.source, fresh, self.pattern, ~long)
        documents = add_extracted_text(to_bronze(files), self.parsers, self.types)
        # A text is computed once: a digest of it must not repeat the work.
        texts = documents.select(
            document_id("file_path").alias("document_id"), "file_path", "source_type", "extracted_text",
            "ingest_timestamp", CORRUPT_COLUMN,
        )
        digest = F.unhex(F.sha2(F.col("extracted_text").cast("binary"), 256))
        extracted = texts.withColumn("digest", digest).select(*_names(EXTRACTED))
        if fresh.where(_may_be_long()).isEmpty() and not self._has(spark, "pieces"):
            return extracted
        named = read_listed(spark, self.source, fresh, self.pattern, long)
        lines = read_listed_lines(spark, self.source, fresh, self.pattern, long)
        pieces = clean_pieces(lines.withColumn("document_id", document_id("path")))
        pieces = self._write(pieces, "pieces", change, PIECES)
        known = to_bronze(named).drop("binary_content").withColumns(
            {
                "document_id": document_id("file_path"),
                "source_type": F.lit(TEXT_TYPE),
                "extracted_text": F.lit(None).cast("string"),
            }
        )
        return extracted.unionByName(known.join(piece_digests(pieces), "document_id").select(*_names(EXTRACTED)))

    def _write_gold_pieces(self, spark: SparkSession, silver: DataFrame, change: int) -> None:
        """The chunks of Silver's texts in pieces."""
        if silver.isEmpty() and not self._has(spark, "gold_pieces"):
            return
        schema = _gold_pieces_schema(spark, self.config)
        come = silver.select("document_id", F.col("extracted_in").alias("change"))
        if self._has(spark, "pieces"):
            pieces = self._log(spark, "pieces", PIECES, change).join(come, ["document_id", "change"])
        else:
            pieces = spark.createDataFrame([], PIECES)
        self._write(heading_chunk_pieces(pieces, self.config), "gold_pieces", change, schema)

    def _last(self, spark: SparkSession) -> int:
        try:
            return self.commits(spark).agg(F.max("change")).first()[0] or 0
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0

    def _has(self, spark: SparkSession, log: str) -> bool:
        """Whether a log that only long texts need was begun."""
        try:
            spark.read.schema("change long").parquet(f"{self.folder}/{log}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    def _listing(self, spark: SparkSession, change: int) -> DataFrame:
        return self._part(spark, "listing", change, LISTING) if change else spark.createDataFrame([], LISTING)

    def _write(self, df: DataFrame, log: str, change: int, schema: Any) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.folder}/{log}/change={change}")
        return self._part(df.sparkSession, log, change, schema)

    def _part(self, spark: SparkSession, log: str, change: int, schema: Any) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{self.folder}/{log}/change={change}")

    def _log(self, spark: SparkSession, log: str, schema: Any, last: int) -> DataFrame:
        """All committed changes of a log; the number of the change is a column."""
        whole = spark.createDataFrame([], schema).withColumn("change", F.lit(0).cast("long")).schema
        if not last:
            return spark.createDataFrame([], whole)
        return spark.read.schema(whole).parquet(f"{self.folder}/{log}").where(F.col("change") <= last)

    def _live(self, spark: SparkSession, log: str, schema: Any) -> DataFrame:
        last = self._last(spark)
        gone = self._log(spark, "removed", "document_id string", last).groupBy("document_id").agg(F.max("change").alias("gone_in"))
        added = self._log(spark, log, schema, last).alias("added")
        later = (F.col("added.document_id") == F.col("gone.document_id")) & (F.col("gone_in") > F.col("added.change"))
        return added.join(gone.alias("gone"), later, "left_anti").drop("change")


def _gold_pieces_schema(spark: SparkSession, config: Mapping[str, Any]) -> Any:
    return heading_chunk_pieces(spark.createDataFrame([], PIECES), config).schema


MOVED = "digest binary, old_id string, new_id string, extracted_in long"


def _may_be_long() -> Column:
    return F.col("length") > long_texts.LONG_BYTES


def _names(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(", ")]


def _next_listing(before: DataFrame, differences: DataFrame, extracted: DataFrame, change: int) -> DataFrame:
    """What stays as it was, and the new and changed files with the digests of their texts."""
    stays = before.join(differences, "file_path", "left_anti")
    found = differences.where("status != 'removed'").select("file_path", "modified", "length")
    fresh = found.join(extracted.select("file_path", "document_id", "digest"), "file_path")
    return stays.unionByName(fresh.withColumn("extracted_in", F.lit(change).cast("long"))).select(*_names(LISTING))


def _moved(before: DataFrame, after: DataFrame, differences: DataFrame, extracted: DataFrame) -> DataFrame:
    """Texts whose document changes: (digest, old_id, new_id, extracted_in of the new one)."""
    touched = differences.select("digest").unionByName(extracted.select("digest")).where("digest is not null").distinct()

    def standing(listing: DataFrame, name: str) -> DataFrame:
        first = F.min(F.struct("document_id", "extracted_in"))
        return listing.join(touched, "digest", "left_semi").groupBy("digest").agg(first.alias(name))

    both = standing(before, "old").join(standing(after, "new"), "digest", "full")
    differ = ~F.col("old.document_id").eqNullSafe(F.col("new.document_id"))
    return both.where(differ).select(
        "digest", F.col("old.document_id").alias("old_id"), F.col("new.document_id").alias("new_id"), F.col("new.extracted_in").alias("extracted_in")
    )
