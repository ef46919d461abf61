"""WARC archives: written by Spark's text writer, read back, and assembled into captures.

A capture is a request, a response (or a revisit, which refers to an earlier response with an equal
payload) and a metadata record.  Requests and metadata name their capture's response in
WARC-Concurrent-To; ``assemble`` joins them through it to one nested row per capture.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerworks.llm.common import free_shuffles

EPOCH = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GAP = "\r\n\r\n"
RECORD = "record_id string, type string, uri string, concurrent_to array<string>, refers_to string, digest string, date string, http string, payload binary"
#: Bytes of payload in one Arrow batch.
BATCH_BYTES = 8 << 20


def _uuid(*parts: Column) -> Column:
    """Record id from what the record is: written again, it is the same."""
    # Each part is marked as present or not, and its length fixed by a separator that digests lack.
    md5 = F.md5(F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), p), F.lit("-")) for p in parts]).cast("binary"))
    pieces = [F.substring(md5, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def _record(kind: str, record_id: Column, fields: list[tuple[str, Column]], block: Column, content_type: str) -> Column:
    """A record without the two line ends after its block, which the writer puts there."""
    head = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: "), record_id, F.lit(f"\r\nWARC-Date: {EPOCH}")]
    for name, value in fields:
        head.append(F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value), F.lit("")))
    head.append(F.concat(F.lit(f"\r\nContent-Type: {content_type}\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(GAP)))
    return F.concat(*head, block)


def captures_of_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 1000) -> DataFrame:
    """(id, url, payload, digest, type, refers_to): which page is a response and which revisits it.

    Of equal payloads of at least ``least_bytes`` the page with the largest id is the response; a
    null id is the smallest.  A null payload is empty.  Payloads are equal if SHA-256 is.
    """
    rows = pages.select(
        F.col(id_col).alias("id"), F.regexp_replace(F.coalesce(F.col(url_col), F.lit("")), r"[\r\n\x00]", "").alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"),
    )
    data = F.col("payload").cast("binary")
    rows = rows.withColumn("key", F.when(F.octet_length("payload") >= least_bytes, F.sha2(data, 256)))
    chosen = rows.where(F.col("key").isNotNull()).groupBy("key").agg(F.max("id").alias("response"), F.count(F.lit(1)).alias("copies"))
    chosen = chosen.where("copies > 1").select(F.col("key").alias("same"), "response")
    revisit = F.col("same").isNotNull() & ~F.col("id").eqNullSafe(F.col("response"))
    return rows.join(chosen, F.col("key") == F.col("same"), "left").select(
        "id", "url", "payload", F.sha1(data).alias("digest"),
        F.when(revisit, "revisit").otherwise("response").alias("type"), F.when(revisit, F.col("response")).alias("refers_to"),
    )


def write_warc(captures: DataFrame, path: str, records_per_file: int = 15000, compression: str = "gzip") -> None:
    """Write a request, a response or revisit, and a metadata record per capture, as WARC 1.1 files.

    The writer separates records by two line ends, as WARC asks.  Files follow Spark's partitions
    and its commit protocol, so a lost executor leaves no half archive.  ``compression`` is the
    codec of whole files; "none" writes them plain.
    """
    name = F.col("id").cast("string")
    response = _uuid(F.lit("response"), name, F.col("digest"))
    target = F.when(F.col("type") == "revisit", _uuid(F.lit("response"), F.col("refers_to").cast("string"), F.col("digest")))
    revisit = F.col("type") == "revisit"
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit(GAP))
    answer = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    kept = [("WARC-Target-URI", F.col("url")), ("WARC-Payload-Digest", digest)]
    about = F.concat(F.lit("page-id: "), F.coalesce(name, F.lit("")), F.lit("\r\n"))
    records = F.array(
        _record("request", _uuid(F.lit("request"), name, F.col("url"), F.col("digest")), [("WARC-Target-URI", F.col("url")), ("WARC-Concurrent-To", response)],
                F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1" + GAP)), "application/http; msgtype=request"),
        F.when(revisit, _record("revisit", response, [*kept, ("WARC-Refers-To", target), ("WARC-Profile", F.lit(REVISIT_PROFILE))], answer, "application/http; msgtype=response"))
        .otherwise(_record("response", response, kept, answer, "application/http; msgtype=response")),
        _record("metadata", _uuid(F.lit("metadata"), name, F.col("url"), F.col("digest")), [("WARC-Target-URI", F.col("url")), ("WARC-Concurrent-To", response)],
                about, "application/warc-fields"),
    )
    lines = captures.select(F.explode(records).alias("value"))
    lines.write.option("lineSep", GAP).option("maxRecordsPerFile", records_per_file).option("compression", compression).text(path)
    free_shuffles(captures.sparkSession)


def parse_records(data: bytes) -> Iterator[dict]:
    """Records of an uncompressed or gzipped archive, one after the other; lengths are believed, text is not."""
    if data[:2] == b"\x1f\x8b":
        import gzip

        data = gzip.decompress(data)
    at, size = 0, len(data)
    while True:
        while data[at : at + 2] == b"\r\n":
            at += 2
        if at >= size:
            return
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or data[at : at + 5] != b"WARC/":
            raise ValueError(f"no WARC record at byte {at}")
        fields: dict[str, list[str]] = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            key, _, value = line.partition(b":")
            fields.setdefault(key.strip().lower().decode(), []).append(value.strip().decode("utf-8", "replace"))
        start = end + 4
        at = start + int(fields["content-length"][0])
        if at > size:
            raise ValueError("the archive ends inside a record")
        one = lambda key: fields.get(key, [None])[0]
        block, http = data[start:at], None
        if (one("content-type") or "").startswith("application/http"):
            head, _, block = block.partition(b"\r\n\r\n")
            http = head.decode("utf-8", "replace")
        yield {
            "record_id": one("warc-record-id"), "type": one("warc-type"), "uri": one("warc-target-uri"),
            "concurrent_to": fields.get("warc-concurrent-to", []), "refers_to": one("warc-refers-to"),
            "digest": one("warc-payload-digest"), "date": one("warc-date"), "http": http, "payload": block,
        }


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under a path.  A file must fit a task's memory: the writer's do."""
    schema = StructType.fromDDL(RECORD)
    arrow = pa.schema([
        ("record_id", pa.string()), ("type", pa.string()), ("uri", pa.string()), ("concurrent_to", pa.list_(pa.string())),
        ("refers_to", pa.string()), ("digest", pa.string()), ("date", pa.string()), ("http", pa.string()), ("payload", pa.binary()),
    ])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for row in parse_records(content.as_py()):
                    rows.append(row)
                    held += len(row["payload"]) + 500
                    if held > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(records, schema)


def with_digests(records: DataFrame) -> DataFrame:
    """Add payload_bytes and payload_digest (bare SHA-1), computed from the payload read."""
    return records.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha1("payload"))


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: (record_id, type, uri, date, response, request, metadata, requests, metadatas).

    ``response`` is the response or revisit with all its columns; ``request`` and ``metadata`` are
    the records that name it in WARC-Concurrent-To, or that it names.  Records with equal ids are
    one record.  Of several requests or metadata records of a capture the one with the smallest id
    is nested, and ``requests`` and ``metadatas`` count all; null and 0 where there is none.  Records
    of no capture give no row (``orphans`` has them).  Payloads of responses are moved once; the
    others are merged before the shuffle, so no group is held in a task.
    """
    columns = [c for c in records.columns if c not in ("record_id", "type")]
    main = F.col("type").isin("response", "revisit")
    body = F.struct("record_id", *columns)
    anchors = records.where(main).select(F.col("record_id").alias("capture"), F.col("type").alias("kind"), F.struct("type", *columns).alias("response"))
    others = records.where(~main)
    named = others.where("size(concurrent_to) > 0").select(F.explode("concurrent_to").alias("capture"), "type", body.alias("body"))
    naming = records.where(main & (F.size("concurrent_to") > 0)).select(F.col("record_id").alias("capture"), F.explode("concurrent_to").alias("member"))
    naming = naming.distinct().join(others.select("type", F.col("record_id").alias("member"), body.alias("body")), "member").select("capture", "type", "body")
    # A record written twice, or linked both ways, counts once.
    members = named.unionByName(naming).groupBy("capture", "type", "body.record_id").agg(F.first("body").alias("body")).drop("record_id")

    def first(kind: str) -> Column:
        chosen = F.when(F.col("type") == kind, F.col("body"))
        return F.min_by(chosen, F.when(F.col("type") == kind, F.col("body.record_id"))).alias(kind)

    grouped = members.groupBy("capture").agg(first("request"), first("metadata"), F.count(F.when(F.col("type") == "request", 1)).alias("requests"), F.count(F.when(F.col("type") == "metadata", 1)).alias("metadatas"))
    return anchors.dropDuplicates(["capture"]).join(grouped, "capture", "left").select(
        F.col("capture").alias("record_id"), F.col("kind").alias("type"), F.col("response.uri").alias("uri"), F.col("response.date").alias("date"),
        "response", "request", "metadata", F.coalesce("requests", F.lit(0)).alias("requests"), F.coalesce("metadatas", F.lit(0)).alias("metadatas"),
    )


def orphans(records: DataFrame) -> DataFrame:
    """Requests, metadata and other records that belong to no capture."""
    main = F.col("type").isin("response", "revisit")
    anchors = records.where(main).select(F.col("record_id").alias("_target")).distinct()
    others = records.where(~main)
    linked = others.select("record_id", F.explode("concurrent_to").alias("_target")).join(anchors, "_target", "left_semi").select("record_id")
    linked = linked.unionByName(records.where(main).select(F.explode("concurrent_to").alias("record_id"))).distinct()
    return others.join(linked, "record_id", "left_anti")


def with_full_payload_size(captures: DataFrame) -> DataFrame:
    """Add payload_bytes, payload_digest and the page ids of captures and of what revisits refer to.

    A revisit's payload is that of the response it refers to.  Only ids and sizes are joined; a
    response that a third of all captures refer to is one row on its side, and the join's other
    side is split by adaptive execution.
    """
    page = F.regexp_extract(F.col("metadata.payload").cast("string"), r"page-id: (-?\d+)", 1)
    narrow = captures.select(
        "record_id", "type", F.when(page != "", page.cast("long")).alias("page_id"), F.col("response.refers_to").alias("target"),
        F.col("response.payload_bytes").alias("own_bytes"), F.col("response.payload_digest").alias("own_digest"),
    )
    full = narrow.where("type = 'response'").select(
        F.col("record_id").alias("target"), F.col("page_id").alias("refers_to"), F.col("own_bytes").alias("bytes"), F.col("own_digest").alias("digest")
    )
    return narrow.join(full, "target", "left").select(
        "page_id", F.coalesce("bytes", "own_bytes").alias("payload_bytes"), F.coalesce("digest", "own_digest").alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to",
    )
