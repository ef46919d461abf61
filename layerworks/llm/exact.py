"""Exact deduplication against an index of all texts seen before, by minimal perfect hashing.

The index is cut into shards by the digest.  Each shard has one part for every generation of texts
that was added: a minimal perfect hash (levels of bit arrays, each holding the keys that collide
with none there) sends a digest of the generation to its own slot, and the slot holds the whole
digest, the row that stays and the number of rows.  Any other digest may be sent to some slot too,
so a lookup compares all bytes there; what no slot confirms is new, is grouped by itself and becomes
the next generation.

Lookups bring rows to the shards.  A text with a third of all rows makes one shard hot: shards with
over twice their share of the rows, and over a ``1 / HOT`` part of all, are copied and their rows
dealt among the copies.  Fewer than ``HOT`` shards can be so large, whatever the data, so their list
is broadcast; the copies together are at most as large as the index.  Tasks hold one shard at a time
and read rows in batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerworks.llm.common import stored
from layerworks.llm.shingles import GOLDEN, mixed

#: Distinct digests of a shard, about; twice as many make the index grow its number of shards.
KEYS = 50_000
#: The part of the rows that no copy of a shard need exceed, as a divisor.
HOT = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ROWS = "uid long, id long, digest binary"
INDEX = "shard int, generation int, sizes array<int>, bits binary, digests binary, ids array<long>, uids array<long>, counts array<long>"
FOUND = "id long, uid long, digest binary, keep_id long, keep_uid long, group_size long, generation int"


@dataclass
class Index:
    """``parts``: a row for each shard and generation; ``size``: distinct digests in all of them."""

    parts: DataFrame
    shards: int
    generations: int
    size: int


def normalised(text: Column) -> Column:
    """The text with A to Z in lower case, other letters as they are; null is empty."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def digest_rows(docs: DataFrame, *more: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(uid, id, digest, ...): SHA-256 of each whole normalised text, and a number for each row, so
    that rows with equal or null ids can be told apart.  Written, so that the numbers stay."""
    sha = F.unhex(F.sha2(normalised(F.col(f"`{text_col}`")).cast("binary"), 256))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{id_col}`").cast("long").alias("id"), sha.alias("digest"), *more)
    return stored(rows, "exact-digests")


def _distinct(rows: DataFrame) -> DataFrame:
    """(digest, id, uid, n): the row with the largest id (null is least; then the largest number)."""
    best = F.max(F.struct("id", "uid")).alias("best")
    return rows.groupBy("digest").agg(best, F.count(F.lit(1)).alias("n")).select("digest", "best.id", "best.uid", "n")


# Minimal perfect hashing of one shard.


def _matrix(column: pa.Array) -> np.ndarray:
    """The 32 bytes of each digest."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), 32)


def _place(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Bit of each key on a level.  Levels use the four words of a digest in turn."""
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    return (mixed(words[:, level % 4] * GOLDEN + salt) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Slots 0 to n - 1 for n distinct digests."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        counts = [int(bits.sum()) for bits in levels]
        self.first = np.cumsum([0, *counts])
        self.ranks = [np.cumsum(bits) - 1 for bits in levels]

    @classmethod
    def of(cls, digests: np.ndarray) -> "PerfectHash":
        words = np.ascontiguousarray(digests).view(np.uint64)
        levels = []
        while len(words):
            size = 2 * len(words) + 8
            at = _place(words, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            words = words[~alone[at]]
        return cls(levels)

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """A slot for every member; for others any slot or -1."""
        words = np.ascontiguousarray(digests).view(np.uint64)
        out, left = np.full(len(words), -1, np.int64), np.arange(len(words))
        for number, bits in enumerate(self.levels):
            at = _place(words[left], number, len(bits))
            hit = bits[at]
            out[left[hit]] = self.first[number] + self.ranks[number][at[hit]]
            left = left[~hit]
        return out


class Part:
    """A generation in a shard: the hash and its slots."""

    def __init__(self, shard: int, generation: int, hashing: PerfectHash, digests: np.ndarray, ids: list, uids: np.ndarray, counts: np.ndarray):
        self.shard, self.generation, self.hashing = shard, generation, hashing
        self.digests, self.ids, self.uids, self.counts = digests, ids, uids, counts

    @classmethod
    def made(cls, shard: int, generation: int, digests: np.ndarray, ids: list, uids: np.ndarray, counts: np.ndarray) -> "Part":
        hashing = PerfectHash.of(digests)
        order = np.argsort(hashing.slots(digests))
        return cls(shard, generation, hashing, digests[order], [ids[i] for i in order], uids[order], counts[order])

    @classmethod
    def read(cls, row: dict) -> "Part":
        sizes = row["sizes"]
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(sizes)).astype(bool)
        digests = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
        levels = np.split(bits, np.cumsum(sizes)[:-1]) if sizes else []
        return cls(row["shard"], row["generation"], PerfectHash(levels), digests, row["ids"], np.array(row["uids"], np.int64), np.array(row["counts"], np.int64))

    def row(self) -> dict:
        levels = self.hashing.levels
        bits = np.packbits(np.concatenate(levels)).tobytes() if levels else b""
        return {"shard": self.shard, "generation": self.generation, "sizes": [len(b) for b in levels], "bits": bits, "digests": self.digests.tobytes(), "ids": self.ids, "uids": self.uids.tolist(), "counts": self.counts.tolist()}

    def members(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which digests are in this generation, all bytes compared, and the slots of those."""
        slots = self.hashing.slots(digests)
        sure = slots >= 0
        sure[sure] = (self.digests[slots[sure]] == digests[sure]).all(axis=1)
        return sure, slots[sure]


_INDEX_TYPE = pa.schema([("shard", pa.int32()), ("generation", pa.int32()), ("sizes", pa.list_(pa.int32())), ("bits", pa.binary()), ("digests", pa.binary()), ("ids", pa.list_(pa.int64())), ("uids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])


def _advanced(parts: pa.Table, fresh: pa.Table) -> pa.Table:
    """The parts of a shard with the arriving distinct digests counted in; new ones as a part more."""
    held = [Part.read(row) for row in parts.to_pylist()]
    if fresh.num_rows:
        column = fresh.column("digest").combine_chunks()
        digests, ids = _matrix(column), fresh.column("id").to_pylist()
        uids, counts = fresh.column("uid").to_numpy(), fresh.column("n").to_numpy()
        unknown = np.arange(len(digests))
        for part in held:
            known, slots = part.members(digests[unknown])
            part.counts = part.counts.copy()
            part.counts[slots] += counts[unknown[known]]
            for slot, row in zip(slots.tolist(), unknown[known].tolist()):
                if _order(ids[row], uids[row]) > _order(part.ids[slot], part.uids[slot]):
                    part.ids[slot], part.uids[slot] = ids[row], uids[row]
            unknown = unknown[~known]
        if len(unknown):
            generation = int(fresh.column("generation")[0].as_py())
            held.append(Part.made(int(fresh.column("shard")[0].as_py()), generation, digests[unknown], [ids[i] for i in unknown], uids[unknown], counts[unknown]))
    return pa.Table.from_pylist([part.row() for part in held], _INDEX_TYPE)


def _order(number: int | None, uid: int) -> tuple:
    return (number is not None, number or 0, uid)


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")


def add(index: Index | None, rows: DataFrame, keys: int = KEYS) -> Index:
    """The index with the digests of (uid, id, digest) rows; members update their slots, the others
    are the next generation.  ``None`` starts an index; no rows leave it as it is."""
    spark = rows.sparkSession
    fresh = stored(_distinct(rows), "exact-distinct")
    size = fresh.count() + (index.size if index else 0)
    shards = max(-(-size // keys), int(spark.conf.get("spark.sql.shuffle.partitions")))
    if index is None:
        index = Index(spark.createDataFrame([], INDEX), shards, 0, 0)
    elif shards > 2 * index.shards:
        index = _resharded(index, shards)
    arriving = fresh.withColumns({"shard": _shard(index.shards), "generation": F.lit(index.generations)})
    grouped = index.parts.groupBy("shard").cogroup(arriving.groupBy("shard"))
    parts = stored(grouped.applyInArrow(_advanced, INDEX), "exact-index")
    total = parts.agg(F.sum(F.size("ids"))).first()[0] or 0
    return Index(parts, index.shards, index.generations + 1, total)


def entries(index: Index) -> DataFrame:
    """(digest, id, uid, n, generation): what the slots hold."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                digests = [row["digests"][at : at + 32] for at in range(0, len(row["digests"]), 32)]
                columns = [pa.array(digests, pa.binary()), *[pa.array(row[c], pa.int64()) for c in ("ids", "uids", "counts")], pa.array([row["generation"]] * len(digests), pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["digest", "id", "uid", "n", "generation"])

    return index.parts.mapInArrow(opened, "digest binary, id long, uid long, n long, generation int")


def _resharded(index: Index, shards: int) -> Index:
    rows = entries(index).withColumn("shard", _shard(shards))

    def made(table: pa.Table) -> pa.Table:
        digests = _matrix(table.column("digest").combine_chunks())
        generation = table.column("generation").to_numpy()
        ids, uids, counts = table.column("id").to_pylist(), table.column("uid").to_numpy(), table.column("n").to_numpy()
        shard, out = int(table.column("shard")[0].as_py()), []
        for number in np.unique(generation).tolist():
            at = np.flatnonzero(generation == number)
            out.append(Part.made(shard, number, digests[at], [ids[i] for i in at], uids[at], counts[at]).row())
        return pa.Table.from_pylist(out, _INDEX_TYPE)

    parts = stored(rows.groupBy("shard").applyInArrow(made, INDEX), "exact-resharded")
    return Index(parts, shards, index.generations, index.size)


def look_up(index: Index, rows: DataFrame) -> DataFrame:
    """(id, uid, digest, keep_id, keep_uid, group_size, generation) of (uid, id, digest) rows; the
    last four are null for digests that the index lacks."""
    placed = rows.select("uid", "id", "digest", _shard(index.shards).alias("shard"))
    per_shard = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    most = max(1, rows.count()) * max(1 / HOT, 2 / index.shards)
    # Fewer than HOT shards can have more than so many rows.
    hot = F.broadcast(per_shard.select("shard", F.ceil(F.col("n") / most).cast("int").alias("copies")).where("copies > 1"))
    copies = F.coalesce("copies", F.lit(1))
    asked = placed.join(hot, "shard", "left").select("shard", F.pmod(F.xxhash64("uid"), copies).cast("int").alias("copy"), "uid", "id", "digest")
    spread = index.parts.join(hot, "shard", "left").withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1))).drop("copies")
    both = asked.withColumn("asks", F.lit(True)).unionByName(spread.withColumn("asks", F.lit(False)), allowMissingColumns=True)
    dealt = both.repartition("shard", "copy").sortWithinPartitions("shard", "copy", "asks")

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, parts = None, []
        for batch in batches:
            place = list(zip(batch.column("shard").to_pylist(), batch.column("copy").to_pylist()))
            asks = batch.column("asks").to_pylist()
            at = 0
            while at < batch.num_rows:
                if place[at] != here:
                    here, parts = place[at], []
                if not asks[at]:
                    parts.append(Part.read({c: batch.column(c)[at].as_py() for c in _INDEX_TYPE.names}))
                    at += 1
                    continue
                end = at
                while end < batch.num_rows and place[end] == here and asks[end]:
                    end += 1
                yield _answers(batch.slice(at, end - at), parts)
                at = end

    return dealt.mapInArrow(answered, FOUND)


def _answers(asked: pa.RecordBatch, parts: list[Part]) -> pa.RecordBatch:
    digests = _matrix(asked.column("digest"))
    count = len(digests)
    keep, uid, size, generation = [None] * count, [None] * count, [None] * count, [None] * count
    unknown = np.arange(count)
    for part in parts:
        known, slots = part.members(digests[unknown])
        for row, slot in zip(unknown[known].tolist(), slots.tolist()):
            keep[row], uid[row], size[row], generation[row] = part.ids[slot], int(part.uids[slot]), int(part.counts[slot]), part.generation
        unknown = unknown[~known]
    columns = [pa.array(keep, pa.int64()), pa.array(uid, pa.int64()), pa.array(size, pa.int64()), pa.array(generation, pa.int32())]
    names = ["keep_id", "keep_uid", "group_size", "generation"]
    return pa.RecordBatch.from_arrays([*[asked.column(c) for c in ("id", "uid", "digest")], *columns], ["id", "uid", "digest", *names])


def dedup_arrivals(docs: DataFrame, historical: Column, id_col: str = "doc_id", text_col: str = "text", keys: int = KEYS) -> DataFrame:
    """One row per document, dropped ones too: (id, keep_id, group_size, kept, text_sha256, seen).

    Rows for which ``historical`` holds make the first generation; all others arrive later, are
    confirmed against it or become the second.  Texts are equal when they are after A to Z are made
    lower case; a null text is an empty one.  Of equal texts the row with the largest id stays,
    whichever side it is on; a null id is least, and of rows with the same largest id one stays.
    ``seen``: the text was in the first generation.  A null ``historical`` counts as false.  Columns
    besides the two named are not read.  No rows give no rows.
    """
    rows = digest_rows(docs, F.coalesce(historical, F.lit(False)).alias("historical"), id_col=id_col, text_col=text_col)
    index = add(None, rows.where("historical"), keys)
    index = add(index, rows.where("not historical"), keys)
    found = look_up(index, rows)
    return found.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("uid") == F.col("keep_uid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        (F.col("generation") == 0).alias("seen"),
    )
