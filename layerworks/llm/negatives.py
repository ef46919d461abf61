"""Hard negatives by exact window search in a multiway tree of split points.

For each anchor its nearest rows of the same label are positives; for each of those, rows of other
labels whose inner product with the anchor lies in a window below the positive's are negatives.

The tree is a GNAT: a node has ``FANOUT`` split points, a row belongs to the nearest of them, and for
each split point the node keeps the range of its distances to the rows of each sibling subtree.  Split
points come from a bounded sample of ``SAMPLE`` rows; every row is then dealt to a leaf and counted
in the ranges.  The tree has at most ``LEVELS`` levels and its split points at most ``TREE_BYTES``,
so tasks can all have it; leaves grow with the data and are cut into blocks of about ``BLOCK`` rows.

A window of inner products is, for a subtree whose squared lengths are known to lie in a range, a
window of distances from the anchor: an annulus.  With its distance to the split points the anchor
rules out each sibling subtree whose ranges, widened by the triangle inequality, miss the annuli of
all its windows.  Blocks of the leaves left are compared exactly.  A first look at the anchor's own
block gives what a row must reach to be among the best, which makes the annuli narrower.

Vectors are whole numbers and all scores exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerworks.llm.common import stored

FANOUT, LEVELS, LEAF, BLOCK, SAMPLE, TREE_BYTES = 8, 4, 1000, 4096, 20_000, 64 << 20
#: Squared lengths stay below this, so that scores and their multiples fit a long.
LARGEST = float(2**55)
LOWEST, HIGHEST = -(2**62), 2**62

BLOCKS = "leaf int, part int, ids binary, labels binary, vecs binary"
ASKS = "anchor long, label long, vec binary, leaf int, part int, lows array<long>, highs array<long>"
FOUND = "anchor long, place int, id long, score long"


def whole_vectors(vectors: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(id, label, anchor, vec): floor of the scaled components, in double precision.

    Rows with a null id, label, vector or component, with a component that is not finite, or with a
    scaled length whose square is not below 2**55, take no part; neither do vectors of another length
    than most have (of equally many the greater), for which there is no inner product.
    """
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    square = F.aggregate(vec, F.lit(0.0), lambda s, x: s + (x * scale) * (x * scale))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"), vec.alias("raw"), finite.alias("finite"), square.alias("square"))
    rows = rows.where("id is not null and label is not null and finite").where(F.col("square") < LARGEST)
    rows = rows.select("id", "label", "anchor", F.transform("raw", lambda x: F.floor(x * scale)).alias("vec"))
    length = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.size("vec") == (length["size"] if length else 0))


# The tree.


@dataclass
class Tree:
    """Split points of inner nodes, children of node t being t * k + 1 to t * k + k; ranges by node,
    child and split point; squared lengths and numbers of rows by node and child."""

    points: np.ndarray
    valid: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    shortest: np.ndarray
    longest: np.ndarray
    rows: np.ndarray

    @property
    def fanout(self) -> int:
        return self.points.shape[1]

    @property
    def levels(self) -> int:
        inner, levels = len(self.points), 0
        while inner > 0:
            inner, levels = (inner - 1) // self.fanout, levels + 1
        return levels

    def parts(self) -> np.ndarray:
        """Blocks of each leaf."""
        first = (len(self.points) - 1) // self.fanout
        return np.ceil(self.rows[first:].ravel() / BLOCK).astype(np.int64)


def _distances(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """From each row to each of a list of points."""
    squares = (vectors**2).sum(axis=1)[:, None] + (points**2).sum(axis=1)[None, :] - 2 * (vectors @ points.T)
    return np.sqrt(np.maximum(squares, 0))


def _split_points(rows: np.ndarray, fanout: int, random: np.random.Generator) -> np.ndarray:
    """Points far from each other: greedily from three times as many different random rows."""
    some = np.unique(rows[random.permutation(len(rows))[: 3 * fanout]], axis=0)
    chosen = [0]
    gaps = _distances(some, some[:1])[:, 0]
    while len(chosen) < min(fanout, len(some)):
        chosen.append(int(gaps.argmax()))
        gaps = np.minimum(gaps, _distances(some, some[chosen[-1:]])[:, 0])
    return some[chosen]


def fitted(sample: np.ndarray, levels: int, fanout: int = FANOUT, seed: int = 3) -> Tree:
    """A tree with split points from a sample, and ranges of no rows yet."""
    inner = (fanout**levels - 1) // (fanout - 1)
    size = sample.shape[1]
    points, valid = np.zeros((inner, fanout, size)), np.zeros((inner, fanout), bool)
    random = np.random.default_rng(seed)
    here = {0: np.arange(len(sample))}
    for node in range(inner):
        mine = here.pop(node, np.empty(0, np.int64))
        if len(mine):
            found = _split_points(sample[mine], fanout, random)
            owner = _distances(sample[mine], found).argmin(axis=1)
            here |= {node * fanout + 1 + child: mine[owner == child] for child in range(fanout)}
        else:  # no row of the sample comes here; others may
            found = points[(node - 1) // fanout, (node - 1) % fanout][None, :]
        points[node, : len(found)], valid[node, : len(found)] = found, True
    shape = (inner, fanout)
    return Tree(points, valid, np.full((*shape, fanout), np.inf), np.full((*shape, fanout), -np.inf), np.full(shape, np.inf), np.full(shape, -np.inf), np.zeros(shape, np.int64))


def walk(tree: Tree, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By level: the node each vector is at, the child it goes to and its distances to the split points."""
    node = np.zeros(len(vectors), np.int64)
    for _ in range(tree.levels):
        gaps = np.empty((len(vectors), tree.fanout))
        for at in np.unique(node):
            rows = node == at
            gaps[rows] = np.where(tree.valid[at], _distances(vectors[rows], tree.points[at]), np.inf)
        child = gaps.argmin(axis=1)
        yield node, child, gaps
        node = node * tree.fanout + 1 + child


def leaves(tree: Tree, vectors: np.ndarray) -> np.ndarray:
    for node, child, _ in walk(tree, vectors):
        last = node * tree.fanout + 1 + child
    return last - len(tree.points)


def count_in(tree: Tree, vectors: np.ndarray) -> None:
    """Widen the ranges by some rows."""
    squares = (vectors**2).sum(axis=1)
    for node, child, gaps in walk(tree, vectors):
        np.minimum.at(tree.lo, (node, child), np.where(np.isinf(gaps), 0, gaps))
        np.maximum.at(tree.hi, (node, child), gaps)
        np.minimum.at(tree.shortest, (node, child), squares)
        np.maximum.at(tree.longest, (node, child), squares)
        np.add.at(tree.rows, (node, child), 1)


def open_leaves(tree: Tree, anchors: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, leaf): the leaves that may hold a row whose inner product with the anchor is in one of
    its windows.  Windows whose low is above their high are none."""
    squares = (anchors**2).sum(axis=1)
    shape = (len(anchors), len(tree.points), tree.fanout)
    gaps = _distances(anchors, tree.points.reshape(-1, anchors.shape[1])).reshape(shape)
    gaps = np.where(tree.valid, gaps, 0)
    some = lows <= highs
    slack = 1e-6 * (1 + np.sqrt(squares.max(initial=0)) + np.sqrt(max(0.0, float(tree.longest.max(initial=0)))))
    who, node = np.arange(len(anchors)), np.zeros(len(anchors), np.int64)
    for _ in range(tree.levels):
        near = gaps[who, node][:, None, :]
        least = np.maximum(near - tree.hi[node], tree.lo[node] - near).max(axis=2)
        most = (near + tree.hi[node]).min(axis=2)
        # Annuli of the windows, by child: distances that give an inner product inside.
        inner = squares[who][:, None, None] + tree.shortest[node][:, :, None] - 2.0 * highs[who][:, None, :]
        outer = squares[who][:, None, None] + tree.longest[node][:, :, None] - 2.0 * lows[who][:, None, :]
        meets = (least[:, :, None] - slack <= np.sqrt(np.maximum(outer, 0))) & (most[:, :, None] + slack >= np.sqrt(np.maximum(inner, 0))) & (outer >= 0)
        stay, child = np.nonzero((meets & some[who][:, None, :]).any(axis=2) & (tree.rows[node] > 0))
        who, node = who[stay], node[stay] * tree.fanout + 1 + child
    return who, node - len(tree.points)


# Spark steps.


@dataclass
class Index:
    """The tree, the blocks of its leaves and the anchors with their own blocks."""

    tree: Tree
    blocks: DataFrame
    anchors: DataFrame
    kind: str


def _vectors(column: pa.Array, kind: str) -> np.ndarray:
    rows = len(column)
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(rows, -1 if rows else 0).astype(np.float64)


def _slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, most):
        yield batch.slice(at, most)


def build(rows: DataFrame) -> Index | None:
    """Index (id, label, anchor, vec) rows; of rows with the same id one counts, that with the least
    label, then vector.  None if there are no rows."""
    pick = F.struct("label", "vec")
    once = rows.groupBy("id").agg(F.min(pick).alias("row"), F.max("anchor").alias("anchor"))
    once = once.select("id", "row.label", "anchor", "row.vec")
    largest = F.max(F.greatest(F.abs(F.array_max("vec")), F.abs(F.array_min("vec"))))
    found = rows.agg(F.count(F.lit(1)).alias("n"), largest.alias("x"), F.max(F.size("vec")).alias("size")).first()
    if not found["n"]:
        return None
    kind = next((k for k, bits in (("<i2", 15), ("<i4", 31)) if (found["x"] or 0) < 2**bits), "<i8")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = batch.column("vec").flatten().to_numpy().reshape(batch.num_rows, -1).astype(kind)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("id", "label", "anchor")], pa.array([v.tobytes() for v in flat], pa.binary())], ["id", "label", "anchor", "vec"])

    packed_rows = stored(once.mapInArrow(packed, "id long, label long, anchor boolean, vec binary"), "negatives-rows")
    levels = int(np.clip(round(np.log(max(1, found["n"] / LEAF)) / np.log(FANOUT)), 1, LEVELS))
    while levels > 1 and FANOUT**levels * max(1, found["size"]) * 8 > TREE_BYTES:
        levels -= 1
    sample = packed_rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vec").collect()
    tree = fitted(_vectors(pa.array([r["vec"] for r in sample], pa.binary()), kind), levels)
    _count_all(tree, packed_rows, kind)
    parts = tree.parts()

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = np.concatenate([leaves(tree, _vectors(s.column("vec"), kind)) for s in _slices(batch, 4096)])
                part = batch.column("mark").to_numpy() % parts[leaf]
                columns = [batch.column(c) for c in ("id", "label", "anchor", "vec")]
                yield pa.RecordBatch.from_arrays([pa.array(leaf.astype(np.int32)), pa.array(part.astype(np.int32)), *columns], ["leaf", "part", "id", "label", "anchor", "vec"])

    marked = packed_rows.withColumn("mark", F.pmod(F.xxhash64("id"), F.lit(1 << 40)))
    dealt = stored(marked.mapInArrow(placed, "leaf int, part int, id long, label long, anchor boolean, vec binary"), "negatives-dealt")

    def blocked(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids, labels = (table.column(c).to_numpy().astype("<i8").tobytes() for c in ("id", "label"))
        row = {"leaf": table.column("leaf")[0].as_py(), "part": table.column("part")[0].as_py(), "ids": ids, "labels": labels, "vecs": b"".join(table.column("vec").to_pylist())}
        return pa.Table.from_pylist([row], pa.schema([("leaf", pa.int32()), ("part", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("vecs", pa.binary())]))

    blocks = stored(dealt.groupBy("leaf", "part").applyInArrow(blocked, BLOCKS), "negatives-blocks")
    anchors = dealt.where("anchor").select(F.col("id").alias("anchor"), "label", "vec", "leaf", "part")
    return Index(tree, blocks, stored(anchors, "negatives-anchors"), kind)


def _count_all(tree: Tree, rows: DataFrame, kind: str) -> None:
    """Ranges over all rows: each task sends at most a row for each node and child."""
    k = tree.fanout

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tree(tree.points, tree.valid, tree.lo.copy(), tree.hi.copy(), tree.shortest.copy(), tree.longest.copy(), tree.rows.copy())
        for batch in batches:
            for part in _slices(batch, 4096):
                count_in(own, _vectors(part.column("vec"), kind))
        node, child = np.nonzero(own.rows)
        lists = [pa.array(list(x[node, child]), pa.list_(pa.float64())) for x in (own.lo, own.hi)]
        plain = [pa.array(x[node, child]) for x in (own.shortest, own.longest, own.rows)]
        yield pa.RecordBatch.from_arrays([pa.array(node.astype(np.int32)), pa.array(child.astype(np.int32)), *lists, *plain], ["node", "child", "lo", "hi", "shortest", "longest", "n"])

    ranges = rows.select("vec").mapInArrow(ranged, "node int, child int, lo array<double>, hi array<double>, shortest double, longest double, n long")
    lows, highs = ([f(F.col(c)[i]).alias(f"{c}{i}") for i in range(k)] for f, c in ((F.min, "lo"), (F.max, "hi")))
    merged = ranges.groupBy("node", "child").agg(*lows, *highs, F.min("shortest").alias("shortest"), F.max("longest").alias("longest"), F.sum("n").alias("n"))
    for row in merged.collect():  # at most the number of subtrees
        at = row["node"], row["child"]
        tree.lo[at], tree.hi[at] = ([row[f"{c}{i}"] for i in range(k)] for c in ("lo", "hi"))
        tree.shortest[at], tree.longest[at], tree.rows[at] = row["shortest"], row["longest"], row["n"]


def _windows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Lows and highs of the windows, rows of fewer filled with empty windows."""
    sizes = pc.list_value_length(batch.column("lows")).to_numpy()
    inside = np.arange(sizes.max(initial=0))[None, :] < sizes[:, None]
    out = []
    for name, fill in (("lows", 1), ("highs", 0)):
        full = np.full(inside.shape, fill, np.int64)
        full[inside] = batch.column(name).flatten().to_numpy()
        out.append(full)
    return out[0], out[1]


def _routed(index: Index, asks: DataFrame) -> DataFrame:
    """Asks for all blocks of the leaves that the ranges leave open."""
    tree, kind, parts = index.tree, index.kind, index.tree.parts()

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _slices(batch, 64):
                who, leaf = open_leaves(tree, _vectors(some.column("vec"), kind), *_windows(some))
                copies = parts[leaf]
                who, leaf = np.repeat(who, copies), np.repeat(leaf, copies)
                part = np.arange(len(who)) - np.repeat(np.cumsum(copies) - copies, copies)
                for at in range(0, len(who), 8192):
                    rows = some.take(pa.array(who[at : at + 8192]))
                    place = [pa.array(x[at : at + 8192].astype(np.int32)) for x in (leaf, part)]
                    yield pa.RecordBatch.from_arrays([*rows.columns[:3], *place, *rows.columns[5:]], rows.schema.names)

    return asks.mapInArrow(routed, ASKS)


def _scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products, in the fastest type that cannot round: no sum of some of the products
    exceeds the product of the lengths."""
    bound = np.sqrt((anchors**2).sum(axis=1).max(initial=0)) * np.sqrt((rows**2).sum(axis=1).max(initial=0)) * (1 + 1e-9)
    kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64
    return (anchors.astype(kind) @ rows.astype(kind).T).astype(np.int64)


class _Block:
    def __init__(self, batch: pa.RecordBatch, at: int, kind: str):
        self.place = batch.column("leaf")[at].as_py(), batch.column("part")[at].as_py()
        self.ids, self.labels = (np.frombuffer(batch.column(c)[at].as_py(), "<i8") for c in ("ids", "labels"))
        self.rows = np.frombuffer(batch.column("vecs")[at].as_py(), kind).reshape(len(self.ids), -1).astype(np.float64)


def _best(block: _Block, asks: pa.RecordBatch, kind: str, same: bool, most: int) -> tuple[np.ndarray, ...]:
    """(ask, window, row, score): the first rows of the block in each window of each ask."""
    lows, highs = _windows(asks)
    scores = _scores(_vectors(asks.column("vec"), kind), block.rows)
    fits = (asks.column("label").to_numpy()[:, None] == block.labels[None, :]) == same
    fits &= asks.column("anchor").to_numpy()[:, None] != block.ids[None, :]
    out = []
    for place in range(lows.shape[1]):
        who, row = np.nonzero(fits & (scores >= lows[:, place, None]) & (scores <= highs[:, place, None]))
        score = scores[who, row]
        order = np.lexsort((row, -score, who))  # rows are in order of their ids
        who, row, score = who[order], row[order], score[order]
        keep = np.arange(len(who)) - np.searchsorted(who, who) < most
        out.append((who[keep], np.full(int(keep.sum()), place), row[keep], score[keep]))
    return tuple(np.concatenate(x) if out else np.empty(0, np.int64) for x in (zip(*out) if out else ((),) * 4))


def _scanned(index: Index, asks: DataFrame, same: bool, most: int, bounds: bool) -> DataFrame:
    """Asks meet the blocks they name.  Gives the rows found or, for ``bounds``, the asks with lows
    raised to the score of the last of ``most`` rows, where there are so many."""
    kind = index.kind
    both = asks.withColumn("asks", F.lit(True)).unionByName(index.blocks.withColumn("asks", F.lit(False)), allowMissingColumns=True)
    dealt = both.repartition("leaf", "part").sortWithinPartitions("leaf", "part", "asks")

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            held = ~batch.column("asks").to_numpy(zero_copy_only=False)
            place = np.stack([batch.column(c).to_numpy() for c in ("leaf", "part")], axis=1)
            turns = np.flatnonzero(held[1:] | held[:-1] | (place[1:] != place[:-1]).any(axis=1)) + 1
            for begin, end in zip([0, *turns], [*turns, batch.num_rows] if batch.num_rows else []):
                if held[begin]:
                    block = _Block(batch, begin, kind)
                elif block is not None and block.place == tuple(place[begin]):  # else no row was dealt there
                    for some in _slices(batch.slice(begin, end - begin), 256):
                        yield _raised(block, some, kind, same, most) if bounds else _rows(block, some, kind, same, most)

    return dealt.mapInArrow(scanned, ASKS if bounds else FOUND)


def _rows(block: _Block, asks: pa.RecordBatch, kind: str, same: bool, most: int) -> pa.RecordBatch:
    who, place, row, score = _best(block, asks, kind, same, most)
    columns = [asks.column("anchor").to_numpy()[who], place.astype(np.int32), block.ids[row], score]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "place", "id", "score"])


def _raised(block: _Block, asks: pa.RecordBatch, kind: str, same: bool, most: int) -> pa.RecordBatch:
    lows, _ = _windows(asks)
    who, place, _, score = _best(block, asks, kind, same, most)
    count, least = np.zeros(lows.shape, np.int64), np.full(lows.shape, HIGHEST)
    np.add.at(count, (who, place), 1)
    np.minimum.at(least, (who, place), score)
    lows = np.where(count >= most, least, lows)
    inside = np.arange(lows.shape[1])[None, :] < pc.list_value_length(asks.column("lows")).to_numpy()[:, None]
    raised = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(inside.sum(axis=1))].astype(np.int32)), pa.array(lows[inside]))
    names = [c.split()[0] for c in ASKS.split(", ")]
    return pa.RecordBatch.from_arrays([raised if c == "lows" else asks.column(c) for c in names], names)


def search(index: Index, asks: DataFrame, same: bool, most: int) -> DataFrame:
    """(anchor, place, id, score, rank): for each window, by its place in ``lows`` and ``highs``, the
    first ``most`` rows of the anchor's label or of others, higher scores first, then smaller ids."""
    narrowed = stored(_scanned(index, asks, same, most, bounds=True), "negatives-narrowed")
    found = _scanned(index, _routed(index, narrowed), same, most, bounds=False)
    first = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= most)


def mine(rows: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``whole_vectors``.

    An anchor's positives are its first ``positives`` other rows of the same label; for each the first
    ``negatives`` rows of other labels with low * positive_score <= 100 * negative_score <= high *
    positive_score come back.  Higher scores are first, ties go to the smaller id.  Fewer rows give
    fewer; an anchor without positives, or a positive below zero, gives none.  No rows give no rows.
    """
    index = build(rows)
    if index is None:
        spark = rows.sparkSession
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    every = [F.array(F.lit(x).cast("long")).alias(c) for x, c in ((LOWEST, "lows"), (HIGHEST, "highs"))]
    near = stored(search(index, index.anchors.select("anchor", "label", "vec", "leaf", "part", *every), True, positives), "negatives-positives")
    lists = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("near"))
    # A positive below zero has no window.
    lows = F.expr(f"transform(near, p -> if(p.score >= 0, (p.score * {low} + 99) div 100, 1L))").alias("lows")
    highs = F.expr(f"transform(near, p -> if(p.score >= 0, (p.score * {high}) div 100, 0L))").alias("highs")
    asks = index.anchors.join(lists, "anchor").select("anchor", "label", "vec", "leaf", "part", lows, highs)
    far = search(index, asks, False, negatives).select("anchor", (F.col("place") + 1).alias("of"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), "rank")
    given = near.select("anchor", F.col("rank").alias("of"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.join(given, ["anchor", "of"]).select(F.col("anchor").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")
