"""Nearest neighbours by inner product: a graph from NN-descent, searched greedily.

Equal vectors are one node that keeps its smallest ids.  A first graph comes from random
projections; then, round by round, each node compares the nodes around it with each other (its
neighbours and those it is a neighbour of), since neighbours of neighbours tend to be neighbours.
Joins bring the vectors to the nodes, so no task holds more than a neighbourhood.  A node that many
others name has several neighbourhoods, each with its own neighbours and a part of those others;
the parts are dealt anew in each round, and each link is used in every round.  Two of those others
in different parts are not compared there, so that a hub costs a part per ``NAMED`` and not a square.

Vectors of unequal length get one more component that makes their lengths equal; nearness in the
graph is then the distance, and inner products with a query are unchanged.  The longest vectors are
far from all others there but near many queries, so every search looks at them too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerworks.llm.common import release, stored

#: Neighbours a node keeps, and about how many of those that name it are in one neighbourhood.
KEPT, NAMED = 50, 100
#: Share of new links below which the graph is done.
OPEN = 0.01
#: Nodes of a bucket of the first graph.
BUCKET = 400
#: Nodes whose neighbourhoods are compared at once, and the most parts a round has: a part's vectors
#: are on disk once for each neighbourhood they are in, and go before the next part begins.
SLICE_NODES, MOST_SLICES = 16_384, 16
#: Longest vectors that every search starts with.
LONGEST = 96
GRAPH = "node long, ids array<long>, sims array<float>, fresh array<boolean>"


@dataclass
class Index:
    """``classes`` (node, ids): equal vectors; ``nodes`` (node, code): a vector's components as
    floats, divided by ``step``; ``graph``: neighbours of each node, best first; ``longest``: nodes
    and vectors (rows, divided by ``step``) that every search starts with."""

    classes: DataFrame
    nodes: DataFrame
    graph: DataFrame
    step: float
    longest: tuple[np.ndarray, np.ndarray]


def _limited(rows: DataFrame, key: str, order: Column, most: int) -> DataFrame:
    """The first rows of each key; Spark drops the others before the shuffle, so hot keys stay small."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return rows.withColumn("_place", place).where(F.col("_place") <= most).drop("_place")


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, vec) of vectors that take part: without nulls, finite, not zero."""
    vec = F.col(vec_col).cast("array<double>")
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec, lambda x: x != 0)
    return vectors.where(F.col(id_col).isNotNull() & vec.isNotNull() & good).select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"))


def _codes(column: pa.Array) -> np.ndarray:
    """Vectors of a column of equally long byte strings."""
    rows = len(column)
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(rows, -1)


def _nearness(vectors: np.ndarray) -> np.ndarray:
    """Minus the distance of all pairs.  Taken from their middle, so that tight groups keep their digits."""
    apart = vectors.astype(np.float64)
    apart -= apart.mean(axis=0)
    squares = (apart**2).sum(axis=1)
    sims = apart @ apart.T
    sims *= 2
    sims -= squares[:, None]
    sims -= squares[None, :]
    return -np.sqrt(np.maximum(-sims, 0)).astype(np.float32)


def build(rows: DataFrame, copies: int = 21, tables: int = 4, seed: int = 1) -> Index:
    """Index (id, vec) rows of one dimension.  ``copies``: ids kept of equal vectors, the smallest.

    Graph and search use single precision, divided by a power of two (``step``); answers are scored exactly.
    """
    keyed = rows.select("id", F.xxhash64("vec").alias("h1"), F.xxhash64("vec", F.lit(1)).alias("h2")).withColumn("h", F.struct("h1", "h2"))
    first = _limited(keyed, "h", F.col("id"), copies).groupBy("h").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    classes = stored(first.select(F.get("ids", F.lit(0)).alias("node"), "ids"), "ann-classes")
    squares = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    found = rows.agg(F.max(squares).alias("m"), F.max(F.size("vec")).alias("d"), F.max(F.array_max(F.transform("vec", lambda x: F.abs(x)))).alias("x"), F.min(squares).alias("l")).first()
    most, size = (found["m"] or 0.0), (found["d"] or 1)
    missing = float(np.sqrt(max(0.0, most - (found["l"] or 0.0))))
    step = float(2.0 ** np.ceil(np.log2(max(found["x"] or 1.0, missing))))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                exact = batch.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                spare = np.sqrt(np.maximum(most - (exact**2).sum(axis=1, keepdims=True), 0))
                parts = (np.hstack([exact, spare]) / step).astype(np.float32)
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([r.tobytes() for r in parts], pa.binary())], ["node", "code"])

    own = rows.join(classes.select("node"), F.col("id") == F.col("node")).dropDuplicates(["node"]).select("node", "vec")
    nodes = stored(own.mapInArrow(coded, "node long, code binary"), "ann-nodes")
    tops = own.orderBy(squares.desc(), "node").limit(LONGEST).collect()
    longest = np.array([r["node"] for r in tops], np.int64), np.array([r["vec"] for r in tops], float).reshape(len(tops), size) / step
    graph = stored(_first_graph(nodes, size, tables, seed), "ann-graph0")
    total = nodes.count()
    number, changed = 0, total * KEPT
    while changed > OPEN * KEPT * total:  # lists only get better, so this ends
        number += 1
        before, graph = graph, _round(graph, nodes, number, min(MOST_SLICES, -(-total // SLICE_NODES)))
        release(before)
        changed = graph.select(F.sum(F.size(F.filter("fresh", lambda f: f))).alias("n")).first()["n"] or 0
    return Index(classes, nodes, graph, step, longest)


def _first_graph(nodes: DataFrame, size: int, tables: int, seed: int) -> DataFrame:
    """Neighbours within buckets of like signs, large buckets split at random."""
    bits = 24
    planes = np.random.default_rng(seed).normal(size=(size, tables * bits)).astype(np.float32)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits)
        for batch in batches:
            if batch.num_rows:
                sides = (_codes(batch.column("code"))[:, :-1] @ planes > 0).reshape(-1, tables, bits)
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(list((sides * weights).sum(axis=2)), pa.list_(pa.int64()))], ["node", "codes"])

    codes = stored(nodes.mapInArrow(signed, "node long, codes array<long>"), "ann-codes")
    used = max(0, int(np.ceil(np.log2(max(1, codes.count() / BUCKET)))))
    each = codes.select("node", F.posexplode("codes").alias("table", "sign"))
    each = each.withColumn("sign", F.col("sign").bitwiseAND((1 << min(bits, used)) - 1))
    counts = each.groupBy("table", "sign").agg(F.count(F.lit(1)).alias("n"))
    split = F.pmod(F.xxhash64("node", "table"), F.ceil(F.col("n") / (2 * BUCKET)))
    placed = each.join(counts, ["table", "sign"]).select("node", "table", "sign", split.alias("part"))

    def near(frame: pd.DataFrame) -> pd.DataFrame:
        names = frame["node"].to_numpy()
        sims = _nearness(_codes(pa.array(frame["code"])))
        np.fill_diagonal(sims, -np.inf)
        take = min(KEPT // 2, len(names) - 1)
        best = np.argsort(-sims, axis=1, kind="stable")[:, :take]
        return pd.DataFrame({"node": names, "ids": list(names[best]), "sims": list(np.take_along_axis(sims, best, axis=1))})

    found = placed.join(nodes, "node").groupBy("table", "sign", "part").applyInPandas(near, "node long, ids array<long>, sims array<float>")
    gathered = found.groupBy("node").agg(F.flatten(F.collect_list("ids")).alias("new_ids"), F.flatten(F.collect_list("sims")).alias("new_sims"))
    none = F.array()
    return _merged(gathered.select("node", none.cast("array<long>").alias("ids"), none.cast("array<float>").alias("sims"), "new_ids", "new_sims"))


def _merged(rows: DataFrame) -> DataFrame:
    """Best neighbours of old ones and suggestions; ``fresh`` tells which are new."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = batch.num_rows
            owner, ids, sims, new = [], [], [], []
            for flag, (a, b) in enumerate((("ids", "sims"), ("new_ids", "new_sims"))):
                lists = batch.column(a)
                sizes = np.array([0 if n is None else n for n in pa.compute.list_value_length(lists).to_pylist()], np.int64)
                owner.append(np.repeat(np.arange(count), sizes))
                ids.append(lists.flatten().to_numpy(zero_copy_only=False))
                sims.append(batch.column(b).flatten().to_numpy(zero_copy_only=False))
                new.append(np.full(len(ids[-1]), bool(flag)))
            owner, ids, sims, new = map(np.concatenate, (owner, ids, sims, new))
            order = np.lexsort((new, ids, owner))  # the old one of two equals first
            owner, ids, sims, new = owner[order], ids[order], sims[order], new[order]
            first = np.ones(len(ids), bool)
            first[1:] = (ids[1:] != ids[:-1]) | (owner[1:] != owner[:-1])
            owner, ids, sims, new = owner[first], ids[first], sims[first], new[first]
            order = np.lexsort((ids, -sims, owner))
            owner, ids, sims, new = owner[order], ids[order], sims[order], new[order]
            place = np.arange(len(owner)) - np.searchsorted(owner, owner)
            keep = place < KEPT
            ends = pa.array(np.searchsorted(owner[keep], np.arange(count + 1)).astype(np.int32))
            columns = [pa.ListArray.from_arrays(ends, pa.array(x[keep], t)) for x, t in ((ids, pa.int64()), (sims, pa.float32()), (new, pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column("node"), *columns], ["node", "ids", "sims", "fresh"])

    return rows.mapInArrow(merged, GRAPH)


def _around(graph: DataFrame, number: int) -> DataFrame:
    """(node, part, other, fresh): neighbours of each node, and a part of the nodes it is a neighbour of."""
    zipped = F.explode(F.arrays_zip("ids", "fresh")).alias("x")
    ahead = graph.select("node", zipped).select("node", F.col("x.ids").alias("other"), F.col("x.fresh").alias("fresh"))
    back = ahead.select(F.col("other").alias("node"), F.col("node").alias("other"), "fresh")
    parts = back.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / NAMED).cast("int").alias("parts"))
    dealt = F.pmod(F.xxhash64("node", "other", F.lit(number)), F.col("parts")).cast("int")
    back = back.join(parts, "node").select("node", dealt.alias("part"), "other", "fresh")
    each = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
    ahead = graph.join(parts, "node", "left").select("node", each, "ids", "fresh").select("node", "part", zipped)
    ahead = ahead.select("node", "part", F.col("x.ids").alias("other"), F.col("x.fresh").alias("fresh"))
    return ahead.unionByName(back).groupBy("node", "part", "other").agg(F.max("fresh").alias("fresh"))


def _round(graph: DataFrame, nodes: DataFrame, number: int, slices: int = 1) -> DataFrame:
    """Compare the nodes around each node with each other, where one of the two is new there.  Stored.

    Neighbourhoods are taken in ``slices``, by a hash, one after the other.
    """
    worst = F.when(F.size("sims") >= KEPT, F.array_min("sims")).otherwise(F.lit(float("-inf"))).cast("float")
    points = nodes.join(graph.select("node", worst.alias("worst")), "node").select(F.col("node").alias("other"), "code", "worst")
    around = stored(_around(graph, number), "ann-around")
    chosen = F.pmod(F.xxhash64("node", "part"), F.lit(slices))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield _compared(batch.column("around")[at : at + 256])

    found = []
    for at in range(slices):
        named = around.where(chosen == at).join(points, "other").groupBy("node", "part").agg(F.collect_list(F.struct("other", "fresh", "code", "worst")).alias("around"))
        found.append(stored(named.drop("part").mapInArrow(compared, "node long, new_ids array<long>, new_sims array<float>"), "ann-compared"))
        del named
    release(around)
    suggested = reduce(DataFrame.unionByName, found).groupBy("node").agg(F.flatten(F.collect_list("new_ids")).alias("new_ids"), F.flatten(F.collect_list("new_sims")).alias("new_sims"))
    merged = _merged(graph.select("node", "ids", "sims").join(suggested, "node", "left").select("node", "ids", "sims", "new_ids", "new_sims"))
    kept = stored(merged, f"ann-graph{number}")
    release(*found)
    return kept


def _compared(around: pa.ListArray) -> pa.RecordBatch:
    """For every node of a neighbourhood the best others there that beat its worst neighbour."""
    ends = np.concatenate([[0], np.cumsum([len(x) for x in around])])
    flat = around.flatten()
    others = flat.field("other").to_numpy()
    fresh = flat.field("fresh").to_numpy(zero_copy_only=False)
    worst = flat.field("worst").to_numpy()
    vectors = _codes(flat.field("code"))
    names, counts, ids, scores = [], [], [], []
    for a, b in zip(ends, ends[1:]):
        own, new, part = others[a:b], fresh[a:b], vectors[a:b]
        sims = _nearness(part)
        sims[~(new[:, None] | new[None, :]) | (sims <= worst[a:b, None])] = -np.inf
        np.fill_diagonal(sims, -np.inf)
        take = min(KEPT, len(own))
        best = np.argpartition(-sims, take - 1, axis=1)[:, :take]
        value = np.take_along_axis(sims, best, axis=1)
        good = np.isfinite(value)
        count = good.sum(axis=1)
        some = count > 0
        names.append(own[some])
        counts.append(count[some])
        ids.append(own[best][good])
        scores.append(value[good])
    names, counts, ids, scores = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (names, counts, ids, scores))
    names, counts, ids, scores = _few_of_hubs(names, counts, ids, scores)
    ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int64))), pa.ListArray.from_arrays(ends, pa.array(scores.astype(np.float32)))]
    return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int64)), *lists], ["node", "new_ids", "new_sims"])


def _few_of_hubs(names: np.ndarray, counts: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, ...]:
    """The lists of a node that has many are made one of its ``KEPT`` best: no more can be kept."""
    own, place = np.unique(names, return_inverse=True)
    many = np.bincount(place, weights=counts, minlength=len(own)) > 4 * KEPT
    if not many.any():
        return names, counts, ids, scores
    here = np.repeat(many[place], counts)
    owner, some, value = np.repeat(place, counts)[here], ids[here], scores[here]
    order = np.lexsort((some, owner))
    owner, some, value = owner[order], some[order], value[order]
    first = np.ones(len(some), bool)
    first[1:] = (some[1:] != some[:-1]) | (owner[1:] != owner[:-1])
    owner, some, value = owner[first], some[first], value[first]
    order = np.lexsort((some, -value, owner))
    owner, some, value = owner[order], some[order], value[order]
    keep = np.arange(len(owner)) - np.searchsorted(owner, owner) < KEPT
    hubs, sizes = np.unique(owner[keep], return_counts=True)
    rest = ~many[place]
    return (
        np.concatenate([names[rest], own[hubs]]), np.concatenate([counts[rest], sizes]),
        np.concatenate([ids[~here], some[keep]]), np.concatenate([scores[~here], value[keep]]),
    )


def search(index: Index, queries: DataFrame, k: int = 20, beam: int = 96, width: int = 24) -> DataFrame:
    """(query, vec, found): the ``beam`` best nodes found for each (query, vec, start), best first.

    In every round each query looks at the neighbours of its ``width`` best nodes not looked at
    yet; a query is done when its ``k`` best have all been looked at.  ``start`` holds nodes; the
    longest vectors are looked at besides.
    """
    schema = "query long, vec array<double>, pool array<struct<id: long, sim: double, seen: boolean>>, next array<long>"
    none = F.array().cast("array<struct<id: long, sim: double, seen: boolean>>")
    links = index.graph.select("node", "ids")
    fresh = queries.select("query", F.col("vec").cast("array<double>").alias("vec"), none.alias("pool"), F.col("start").alias("next"))
    state = stored(_looked(fresh, fresh.select("query", F.explode("next").alias("other")), index, k, beam, width, schema, index.longest), "ann-search")
    done = []
    while True:
        done.append(stored(state.where(F.size("next") == 0).select("query", "vec", F.col("pool.id").alias("found")), "ann-found"))
        before, state = state, state.where(F.size("next") > 0)
        if state.isEmpty():
            release(before)
            return reduce(DataFrame.unionByName, done)
        frontier = state.select("query", F.explode("next").alias("node")).join(links, "node").select("query", F.explode("ids").alias("other")).distinct()
        state = stored(_looked(state, frontier, index, k, beam, width, schema), f"ann-search{len(done)}")
        release(before)


def _looked(
    state: DataFrame, candidates: DataFrame, index: Index, k: int, beam: int, width: int, schema: str, besides: tuple[np.ndarray, np.ndarray] | None = None
) -> DataFrame:
    codes = index.nodes.select(F.col("node").alias("other"), "code")
    near = candidates.join(codes, "other").groupBy("query").agg(F.collect_list(F.struct("other", "code")).alias("new"))

    def looked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("query", pa.int64()), ("vec", pa.list_(pa.float64())), ("pool", pa.list_(pa.struct([("id", pa.int64()), ("sim", pa.float64()), ("seen", pa.bool_())]))), ("next", pa.list_(pa.int64()))])
        for batch in batches:
            rows = []
            for query, vec, pool, new in zip(*(batch.column(c) for c in ("query", "vec", "pool", "new"))):
                best = {p["id"]: (p["sim"], p["seen"]) for p in pool.as_py()}
                ask = vec.values.to_numpy()
                looks = [(besides[0], besides[1] @ ask)] if besides is not None else []
                if new.is_valid and len(new.values):
                    codes = _codes(new.values.field("code"))[:, : len(ask)].astype(np.float64)
                    looks.append((new.values.field("other").to_numpy(), codes @ ask))
                for ids, sims in looks:
                    take = np.argpartition(-sims, beam)[:beam] if len(sims) > beam else np.arange(len(sims))
                    for name, sim in zip(ids[take].tolist(), sims[take].tolist()):
                        best.setdefault(name, (sim, False))
                chosen = sorted(((s, i, seen) for i, (s, seen) in best.items()), key=lambda x: (-x[0], x[1]))[:beam]
                ahead = [] if all(seen for _, _, seen in chosen[: k + 1]) else [i for _, i, seen in chosen if not seen][:width]
                ahead_set = set(ahead)
                rows.append({"query": query.as_py(), "vec": ask, "pool": [{"id": i, "sim": s, "seen": seen or i in ahead_set} for s, i, seen in chosen], "next": ahead})
            yield pa.RecordBatch.from_pylist(rows, kind)

    return state.join(near, "query", "left").select("query", "vec", "pool", "new").mapInArrow(looked, schema)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every query row among all others.

    Scores are inner products of the vectors as given, in double precision; ties go to the smaller
    id, a query is not its own neighbour, and fewer candidates give fewer rows.  Vectors that are
    null, zero or hold null or non-finite components take no part.  Equal vectors are searched once;
    of those only the ``k`` + 1 smallest ids can be an answer.  Rows that repeat an id with an equal
    vector are one.  No rows give no rows.
    """
    rows = stored(usable(vectors, id_col, vec_col), "ann-rows")
    index = build(rows, copies=k + 1)
    asked = usable(vectors.where(is_query), id_col, vec_col)
    hashed = asked.select("id", F.xxhash64("vec").alias("h1"), F.xxhash64("vec", F.lit(1)).alias("h2")).distinct()
    heads = rows.join(index.classes.select("node"), F.col("id") == F.col("node")).select("node", "vec").dropDuplicates(["node"])
    named = heads.select("node", "vec", F.xxhash64("vec").alias("h1"), F.xxhash64("vec", F.lit(1)).alias("h2"))
    queries = stored(hashed.join(named, ["h1", "h2"]).select("id", "node"), "ann-queries")
    starts = queries.select("node").distinct().join(heads, "node").select(F.col("node").alias("query"), "vec", F.array("node").alias("start"))
    found = search(index, starts, k)
    flat = found.select("query", F.col("vec").alias("ask"), F.explode("found").alias("node"))
    scored = flat.join(heads, "node").select("query", "node", F.aggregate(F.zip_with("ask", "vec", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x).alias("score"))
    each = scored.join(index.classes, "node").select("query", "score", F.explode("ids").alias("vec_id"))
    best = _limited(each.withColumn("order", F.struct((-F.col("score")).alias("s"), "vec_id")), "query", F.col("order"), k + 1)
    lists = best.groupBy("query").agg(F.array_sort(F.collect_list("order")).alias("best"))
    out = queries.join(lists, F.col("node") == F.col("query")).select(F.col("id").alias("query_id"), F.filter("best", lambda b: b["vec_id"] != F.col("id")).alias("best"))
    return out.select("query_id", F.posexplode(F.slice("best", 1, k)).alias("place", "b")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score")
    )
