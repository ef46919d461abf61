"""A corpus from documents to packed sequences: each stage works on what the one before kept.

Stages are written as Parquet in the shared scratch folder and read again, so a lost executor
costs work of one stage only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerworks.llm import jaccard, langid, lines, packing, passages
from layerworks.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A language must be this much likelier than all others together.
LEAST_SCORE = 0.5
#: Matches texts with a word.
SOME_WORD = r"[^\x20\x09-\x0D]"


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language learned from the table's labels; undetermined ones go."""
    model = langid.train(docs, public_tokenizers.path("piece_bpe_32k.model"))
    rows = langid.identify(docs.select(*COLUMNS), model, to=("_language", "_score"))
    return rows.where((F.col("_language") != langid.UNKNOWN) & (F.col("_score") >= LEAST_SCORE)).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an equal or near line precedes; a document of such lines only goes."""
    rows = lines.dedup_lines(docs.select(*COLUMNS))
    return _measured(rows.where((F.col("n_removed") == 0) | F.col("text").rlike(SOME_WORD)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest id, null being the largest, then
    the smallest hash of its text.  Ids may repeat or be null; texts without words all stay."""
    rows = docs.select(*COLUMNS)
    worded = F.coalesce(F.col("text").rlike(SOME_WORD), F.lit(False))
    classes = jaccard.near_duplicates(rows.where(worded), row_keys=True)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = classes.groupBy("class_key").agg(F.min(order).alias("first")).select(F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash"))
    hashed = rows.where(worded).withColumn("_text_hash", F.xxhash64("text"))
    kept = hashed.join(first, hashed["doc_id"].eqNullSafe(F.col("_id")) & (hashed["_text_hash"] == F.col("_hash")), "left_semi")
    # Rows with equal id and text are copies.
    once = kept.groupBy("doc_id", "_text_hash").agg(F.min(F.struct("lang", "source", "n_chars", "text")).alias("row")).select("doc_id", "row.*")
    return once.select(*COLUMNS).unionByName(rows.where(~worded))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of an earlier document, their other lines as they are; a document of
    such passages only goes.  Rows that repeat an id, or have none, each keep their own text."""
    rows = passages.remove_repeats(docs.select(*COLUMNS), carry=["lang", "source", "n_chars"], in_place=True)
    kept = rows.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("text", F.col("kept")).withColumn("n_chars", n_chars).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 4096 tokens."""
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("best_fit_packing", pack_sequences),
]

#: SQL cannot express language models, tokenizers or the packing; tests compare with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is what the last one packed."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
