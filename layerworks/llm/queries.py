"""The operators as queries over the test tables: thin, production parameters, whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerworks.llm import alignment, bpe, exact, jaccard, langid, lines, negatives, neighbours, packing, passages, quality, toxicity, warc
from layerworks.llm.common import remainder, stored
from layerworks.session import scratch_path


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_warc_captures(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as an archived capture, read back and assembled."""
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.captures_of_pages(_table(spark, folder, "pages")), path)
    # Payloads are measured where they are read, and the nested rows carry the measures.
    records = warc.with_digests(warc.read_warc(spark, path))
    records = stored(records.withColumn("payload", F.when(F.col("type") == "metadata", F.col("payload"))), "warc-records")
    return warc.with_full_payload_size(warc.assemble(records))


def op2_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every whole text and the text they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = bpe.decode(bpe.encode(_table(spark, folder, "documents"), path), path)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_pack_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.token_pieces(_table(spark, folder, "documents"), path))


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every whole text, learned from three quarters of the documents."""
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    held = remainder(F.col("doc_id"), 4) == 2
    model = langid.train(docs.where(~held), public_tokenizers.path("piece_bpe_32k.model"))
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op5_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the words of windows that an earlier document has."""
    rows = passages.remove_repeats(_table(spark, folder, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of documents linked by a shingle similarity of 0.8 or more."""
    return jaccard.near_duplicates(_table(spark, folder, "documents"))


def op7_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest of every twentieth vector among all others."""
    return neighbours.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every whole text, learned from two thirds of the labels."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    held = remainder(F.col("doc_id"), 3) == 1
    model = toxicity.train(docs, _table(spark, folder, "labels").where(~held))
    rows = toxicity.tag(docs, model)
    return rows.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), F.size("spans").alias("n_spans"))


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without lines that are equal or near to an earlier one, as digests."""
    rows = lines.dedup_lines(_table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Every document judged by the base rules and by cutoffs certified on the labels."""
    return quality.judged(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of other labels that are near, but not too near, every hundredth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(negatives.whole_vectors(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """How the tokens of two tokenizers correspond in every whole text, and how usual that is."""
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(_table(spark, folder, "documents"), *paths)


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the equal one that stays: even ids are history, the others arrive."""
    return exact.dedup_arrivals(_table(spark, folder, "documents"), F.col("doc_id") % 2 == 0)


QUERIES = {f.__name__: f for f in (op1_warc_captures, op2_bpe_round_trip, op3_language, op4_pack_sequences, op5_repeated_passages, op6_near_duplicates, op7_nearest_vectors, op8_toxicity, op9_line_dedup, op10_quality_rules, op11_hard_negatives, op12_token_alignment, op13_exact_dedup)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES: dict[str, str] = {
    "op1_warc_captures": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS largest
            FROM pages
        ), judged AS (SELECT *, strlen(payload) >= 1000 AND page_id <> largest AS revisits FROM payloads)
        SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest,
               CASE WHEN revisits THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN revisits THEN largest END AS refers_to
        FROM judged
    """,
    "op5_repeated_passages": r"""
        WITH split AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda word: word <> '') AS words
            FROM documents
        ), windows AS (
            SELECT doc_id, place, array_to_string(words[place : place + 12], ' ') AS text
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS place FROM split WHERE len(words) >= 13)
        ), firsts AS (SELECT text, min(doc_id) AS first FROM windows GROUP BY text),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(place, place + 13)) AS place
            FROM windows JOIN firsts USING (text) WHERE first < doc_id
        ), each_word AS (
            SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM split WHERE len(words) > 0
        ), left_over AS (
            SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.place) FILTER (g.place IS NULL) AS kept, count(g.place) AS n_removed
            FROM each_word AS e LEFT JOIN gone AS g ON e.doc_id = g.doc_id AND e.place = g.place GROUP BY e.doc_id
        )
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM split LEFT JOIN left_over USING (doc_id)
    """,
    "op11_hard_negatives": """
        WITH whole AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                   CAST(list_inner_product(a.vec, b.vec) AS BIGINT) AS score
            FROM whole AS a JOIN whole AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
    """,
    "op13_exact_dedup": f"""
        WITH hashed AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')) AS text_sha256,
                   doc_id % 2 = 0 AS historical
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, text_sha256, bool_or(historical) OVER same AS seen
        FROM hashed WINDOW same AS (PARTITION BY text_sha256)
    """,
}
