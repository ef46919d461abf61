"""Similarity join on word shingles: MinHash bands find candidates, whole sets decide.

Documents with the same set of shingles are one class, so exact copies cost one row.  The classes'
signatures are cut into bands; classes that share a band are candidates of each other.  A candidate
group is connected through the smallest member of each band, so a group costs a row per member and
band and not one per pair.  In each connected group all pairs of whole sets are compared, in blocks
of bounded size; blocks report links per class and a tree of links, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerworks.llm.common import stored, text_slices
from layerworks.llm.components import components
from layerworks.llm.shingles import GOLDEN, mixed, shingle_sets

WIDTH = 5
#: Classes in a block; a larger group is compared block by block.
BLOCK = 400


def bands_and_rows(threshold: float, recall: float, most_hashes: int = 160) -> tuple[int, int]:
    """The most rows a band can have (fewest false candidates) while a pair at the threshold shares
    a band with chance ``recall`` or more."""
    best = None
    for rows in range(1, 17):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)) if threshold < 1 else 1
        if best is None or bands * rows <= most_hashes:
            best = (max(1, bands), rows)
    return best


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def signatures(texts: list[str | None], bands: int, rows: int, width: int) -> tuple[np.ndarray, ...]:
    """Of each text: number of shingles, two hashes of their set, and the hash of each band."""
    hashes, sizes = shingle_sets(texts, width)
    used = np.flatnonzero(sizes)
    one, two = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
    keys = np.zeros((len(sizes), bands), np.uint64)
    if len(used):
        starts = (np.cumsum(sizes) - sizes)[used]
        one[used] = np.add.reduceat(mixed(hashes), starts)
        two[used] = np.add.reduceat(mixed(hashes ^ GOLDEN), starts)
        odd = np.random.default_rng(17).integers(0, 1 << 62, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for band in range(bands):
            key = np.full(len(used), band + 1, np.uint64)
            for row in range(rows):
                # The high half of a product with an odd number orders the shingles anew.
                least = np.minimum.reduceat((hashes * odd[band * rows + row]) >> np.uint64(20), starts)
                key = mixed(key * GOLDEN + least)
            keys[used, band] = key
    return sizes, one, two, keys


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, recall: float = 0.9999, width: int = WIDTH, row_keys: bool = False) -> DataFrame:
    """One row per document: (id, class_id, set_id, n_links).

    ``class_id`` is the smallest id of all documents connected by links, ``set_id`` that of the
    documents with the same set of shingles, and ``n_links`` the number of other rows whose Jaccard
    similarity is at least ``threshold`` (equal sets included).  Links between different sets are
    found with chance ``recall`` or more each; within a connected candidate group all are.

    A text without words (or null) has no shingles and no links: class and set are its own id.  A
    text of fewer than five words has one shingle.  Null ids are allowed and count as smallest only
    if the whole class has none else.  Repeated rows are equal sets.  No rows give no rows.

    Several classes can have one ``class_id`` where ids repeat or are null.  With ``row_keys`` each
    row has ``class_key``, which no two classes share (null without words), and ``text_hash``
    (xxhash64 of the text) besides.
    """
    bands, rows = bands_and_rows(threshold, recall)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    hashes = ["text_hash"] if row_keys else []
    hashed = base.select("id", "text", *[F.xxhash64("text").alias(h) for h in hashes])

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                sizes, one, two, keys = signatures(part.column("text").to_pylist(), bands, rows, width)
                flat = pa.array(_signed(keys.ravel()))
                ends = pa.array(np.arange(0, len(flat) + 1, bands, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in ("id", *hashes)], pa.array(sizes.astype(np.int32)), pa.array(_signed(one)), pa.array(_signed(two)), pa.ListArray.from_arrays(ends, flat)],
                    ["id", *hashes, "n", "s1", "s2", "bands"],
                )

    columns = ", ".join(f"{c} long" for c in ("id", *hashes))
    marks = stored(hashed.mapInArrow(signed, f"{columns}, n int, s1 long, s2 long, bands array<long>"), "jaccard-signatures")
    # A class is named by the hash of its set.
    classes = stored(
        marks.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")),
        "jaccard-classes",
    )
    keyed = classes.select(F.col("s1").alias("node"), F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("center"), F.max("node").alias("other")).where("center != other").select("key", "center")
    edges = stored(keyed.join(shared, "key").where("node != center").select(F.col("node").alias("u"), F.col("center").alias("v")).distinct(), "jaccard-edges")
    groups = stored(components(edges), "jaccard-groups")
    links = stored(_links(base, classes, groups, threshold, width), "jaccard-links")
    return _joined(marks, classes, links, hashes).withColumnRenamed("id", id_col)


def _links(base: DataFrame, classes: DataFrame, groups: DataFrame, threshold: float, width: int) -> DataFrame:
    """(node, links, label, split): links found in each block, and a tree of them."""
    sizes = groups.groupBy("label").agg(F.count(F.lit(1)).alias("members"))
    members = groups.join(sizes, "label").join(classes.select(F.col("s1").alias("node"), "least", "copies"), "node")
    parts = F.ceil(F.col("members") / BLOCK).cast("int")
    members = members.select("node", F.col("label").alias("group"), "least", "copies", parts.alias("parts"), F.pmod(F.xxhash64("node", F.lit(1)), parts).cast("int").alias("part"))
    texts = base.join(members, base["id"].eqNullSafe(members["least"])).select("node", "group", "copies", "parts", "part", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                hashes, counts = shingle_sets(part.column("text").to_pylist(), width)
                used = np.flatnonzero(counts)
                one = np.zeros(len(counts), np.uint64)
                if len(used):
                    one[used] = np.add.reduceat(mixed(hashes), (np.cumsum(counts) - counts)[used])
                mine = pa.array(_signed(one) == part.column("node").to_numpy(zero_copy_only=False))  # the id may be that of other rows
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(_signed(hashes)))
                columns = [part.column(c) for c in ("node", "group", "copies", "parts", "part")]
                yield pa.RecordBatch.from_arrays([*columns, lists], ["node", "group", "copies", "parts", "part", "set"]).filter(mine)

    found = texts.mapInArrow(sets, "node long, group long, copies long, parts int, part int, set array<long>")
    with_all = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda other: F.struct(F.least("part", other).alias("a"), F.greatest("part", other).alias("b")))
    blocks = found.withColumn("block", F.explode(with_all)).select("group", "block.a", "block.b", "node", "copies", "part", "set")
    dealt = blocks.repartition("group", "a", "b").sortWithinPartitions("group", "a", "b", "node")

    def compared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            key = rest[["group", "a", "b"]].to_numpy()
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            begin = 0
            for end in cuts:
                yield _compared(rest.iloc[begin:end], threshold)
                begin = end
            rest = rest.iloc[begin:]
        if rest is not None and len(rest):
            yield _compared(rest, threshold)

    return dealt.mapInPandas(compared, "node long, links long, label long, split boolean")


def _compared(block: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of the classes of a block: all pairs within a part, or all across its two parts."""
    block = block.drop_duplicates("node")
    sets = [np.asarray(s) for s in block["set"]]
    sizes = np.array([len(s) for s in sets])
    values, column, owners = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    common = owners[column] > 1
    row, column = row[common], np.unique(column[common], return_inverse=True)[1]
    meet = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        here = slice(*np.searchsorted(column, [start, start + width]))
        matrix = np.zeros((len(sets), width), np.float32)
        matrix[row[here], column[here] - start] = 1
        meet += matrix @ matrix.T  # whole numbers below 2 ** 24 in each slice
    union = sizes[:, None] + sizes[None, :] - meet
    linked = meet >= threshold * union - 1e-6
    part = block["part"].to_numpy()
    first, second = block["a"].iloc[0], block["b"].iloc[0]
    np.fill_diagonal(linked, False)
    if first != second:
        linked &= part[:, None] != part[None, :]
    nodes = block["node"].to_numpy()
    label = np.arange(len(nodes))  # nodes ascend, so the smallest place is the smallest node
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], len(nodes)).min(axis=1))
        least = least[least]
        if (least == label).all():
            break
        label = least
    links = (linked * block["copies"].to_numpy()[None, :]).sum(axis=1)
    return pd.DataFrame({"node": nodes, "links": links.astype(np.int64), "label": nodes[label], "split": bool(first != second)})


def _joined(marks: DataFrame, classes: DataFrame, links: DataFrame, hashes: list[str]) -> DataFrame:
    counts = links.groupBy("node").agg(F.sum("links").alias("links"), F.max("split").alias("split"), F.min("label").alias("label"))
    # A group in one block is connected already; trees of several blocks are put together.
    several = links.join(counts.where("split").select("node"), "node", "left_semi").select(F.col("node").alias("u"), F.col("label").alias("v"))
    trees = components(several)
    labels = counts.join(trees.withColumnRenamed("label", "tree"), "node", "left").select("node", "links", F.coalesce("tree", "label").alias("label"))
    sets = classes.join(labels, F.col("s1") == F.col("node"), "left").select(
        "s1", F.col("least").alias("set_id"), "copies", F.coalesce("label", "s1").alias("label"), F.coalesce("links", F.lit(0)).alias("links")
    )
    least = sets.groupBy("label").agg(F.min("set_id").alias("class_id"))
    named = stored(sets.join(least, "label").select("s1", "set_id", "class_id", (F.col("copies") - 1 + F.col("links")).alias("n_links"), F.col("label").alias("class_key")), "jaccard-named")
    keys = ["class_key", *hashes] if hashes else []
    alone = marks.where("n = 0").select("id", F.col("id").alias("class_id"), F.col("id").alias("set_id"), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("class_key"), *hashes).select("id", "class_id", "set_id", "n_links", *keys)
    return marks.where("n > 0").select("id", *hashes, "s1").join(named, "s1").select("id", "class_id", "set_id", "n_links", *keys).unionByName(alone)
