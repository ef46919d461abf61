"""Best-fit packing by a grouping genetic algorithm on islands.

Pieces of documents are dealt into blocks of bounded size.  Each block is a packing problem that
several islands work on in separate tasks: an individual is an assignment of pieces to bins, and
crossover copies whole well-filled bins of one parent into the other, drops the bins that held
their pieces, and puts the displaced pieces back by best fit, longest first.  After each round the
best individual of an island moves to the next one.  The loose bins of all blocks are packed
again together.  A block whose best packing meets the lower bound is finished at once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerworks.llm.bpe import TwoGenerations, _byte_alphabet
from layerworks.llm.common import forget_others, stored, text_slices

END_OF_DOCUMENT = 1
CACHE_WORDS = 400_000
WORD_END = "</w>"
#: The vocabulary's units between blanks.
UNITS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words of Latin letters, whose normal form and classes are beyond doubt; the empty one has no ids.
PLAIN = re.compile("[\x21-\x7e\xa1-\u024f]*").fullmatch
UNIT_END = "\0"
ITEM = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordEncoder:
    """Ids of a vocabulary whose words end at white space: text between blanks encodes alone."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memory = TwoGenerations(CACHE_WORDS)
        # The same merges as ranks, for plain words: the mark of a unit's end is a byte that plain
        # words never have, and its merges come first, as their numbers are the smallest.  A line
        # end, which no word has, parts the words and gets a number of its own.
        import regex
        import tiktoken

        letters = _byte_alphabet()
        vocabulary = self.tokenizer.get_vocab()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = {}
        for token, number in vocabulary.items():
            if token not in self.special:
                body = token.removesuffix(WORD_END)
                ranks[bytes(letters[c] for c in body) + UNIT_END.encode() * (body != token)] = number
        self.between = max(vocabulary.values()) + 1
        ranks[f"\n{UNIT_END}".encode()] = self.between
        self.ranked = tiktoken.Encoding("ranks", pat_str=f"[^{UNIT_END}]+{UNIT_END}", mergeable_ranks=ranks, special_tokens={})
        self.units = regex.compile(rf"{UNITS}|\n")

    def _plain(self, words: list[str]) -> list[bytes]:
        """Ids of words of Latin letters, all at once: a call for each would cost more than its ids."""
        units = self.units.findall("\n".join([*words, ""]).lower())
        ids = np.array(self.ranked.encode_ordinary(UNIT_END.join([*units, ""])), "<u4")
        ends = np.flatnonzero(ids == self.between)
        packed, starts = ids.tobytes(), np.r_[0, ends + 1] * 4
        return [packed[start:end] for start, end in zip(starts.tolist(), (ends * 4).tolist())]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as packed little-endian uint32."""
        parts = [text.replace("\n", " ").split(" ") for text in texts]
        marks = [mark for mark in self.special if any(mark in text for text in texts)]
        plain, wanted = [], []
        for word in self.memory.missing({word for p in parts for word in p}):
            (plain if PLAIN(word) and not (marks and any(mark in word for mark in marks)) else wanted).append(word)
        for at in range(0, len(plain), 32768):
            some = plain[at : at + 32768]
            self.memory.new.update(zip(some, self._plain(some)))
        for at in range(0, len(wanted), 4096):
            some = wanted[at : at + 4096]
            codes = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            for word, code in zip(some, codes):
                self.memory.new[word] = np.array(code.ids, "<u4").tobytes()
        known = self.memory.new.__getitem__
        return [b"".join(map(known, p)) for p in parts]


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    """One per worker process."""
    forget_others(word_encoder)
    return WordEncoder(path)


def token_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document.

    A document is its ids and the end mark; only one longer than ``capacity`` is cut.  A null text
    counts as empty and gives one piece with the mark alone; repeated rows give a piece each.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = word_encoder(path)
        mark = np.array([END_OF_DOCUMENT], "<u4").tobytes()
        for batch in batches:
            for part in text_slices(batch, "text"):
                out = []
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), tool.encode_all(part.column("text").to_pylist())):
                    ids += mark
                    for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[at : at + 4 * capacity]
                        out.append((doc_id, number, at // 4, len(cut) // 4, zlib.crc32(cut), cut))
                columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(o[5], "<u4").astype("<i4") for o in out], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(pieces, ITEM + ", ids array<int>" * with_ids)


# ---- one block ----------------------------------------------------------------------------------


class Room:
    """Bins by the space left in them; finds the fullest bin that still takes a piece."""

    def __init__(self, capacity: int):
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.filled = 0  # bit s: a bin with s tokens of space exists

    def add(self, name: int, space: int) -> None:
        self.by_space[space].append(name)
        self.filled |= 1 << space

    def take(self, size: int) -> tuple[int, int] | None:
        above = self.filled >> size
        if not above:
            return None
        space = size + (above & -above).bit_length() - 1
        name = self.by_space[space].pop()
        if not self.by_space[space]:
            self.filled ^= 1 << space
        return name, space


def best_fit(sizes: np.ndarray, pieces: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Put ``pieces`` (in their order) into the bins of the others, each where it fits most tightly."""
    room, next_bin = Room(capacity), 0
    placed = bins >= 0
    if placed.any():
        load = np.bincount(bins[placed], weights=sizes[placed]).astype(np.int64)
        for name in np.flatnonzero(load):
            room.add(int(name), capacity - int(load[name]))
        next_bin = len(load)
    out = bins.copy()
    for piece in pieces.tolist():
        size = int(sizes[piece])
        found = room.take(size)
        if found is None:
            found, next_bin = (next_bin, capacity), next_bin + 1
        room.add(found[0], found[1] - size)
        out[piece] = found[0]
    return out


def _fitness(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller bins (sum of squared fillings)."""
    load = np.bincount(bins, weights=sizes)
    load = load[load > 0]
    return -len(load), float(((load / capacity) ** 2).sum())


def _crossover(sizes: np.ndarray, giver: np.ndarray, taker: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    load = np.bincount(giver, weights=sizes)
    used = np.flatnonzero(load)
    chance = (load[used] / capacity) ** 8
    injected = used[rng.random(len(used)) < 0.5 * chance]
    kept = np.isin(giver, injected)
    lost_bins = np.unique(taker[kept])
    displaced = np.isin(taker, lost_bins) & ~kept
    child = taker.copy()
    child[displaced] = -1
    child[kept] = giver[kept] + len(sizes)
    _, packed = np.unique(child[child >= 0], return_inverse=True)
    child[child >= 0] = packed
    loose = np.flatnonzero(displaced)
    return best_fit(sizes, loose[np.argsort(-sizes[loose], kind="stable")], child, capacity)


def _mutated(sizes: np.ndarray, bins: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Empty the loosest bins and a few others, and fit their pieces again."""
    load = np.bincount(bins, weights=sizes)
    used = np.flatnonzero(load)
    loosest = used[np.argsort(load[used])[:3]]
    some = rng.choice(used, min(len(used), 6), replace=False)
    child = bins.copy()
    loose = np.flatnonzero(np.isin(bins, np.concatenate([loosest, some])))
    child[loose] = -1
    return best_fit(sizes, loose[np.argsort(-sizes[loose], kind="stable")], child, capacity)


def evolve(sizes: np.ndarray, people: list[np.ndarray], capacity: int, seed: int, generations: int = 12, population: int = 4) -> list[np.ndarray]:
    """Some generations on one island, best individual first; deterministic for a seed."""
    rng = np.random.default_rng(seed)
    order = np.argsort(-sizes, kind="stable")
    none = np.full(len(sizes), -1, np.int64)
    bound = -int(-(-sizes.sum() // capacity))
    people = people or [best_fit(sizes, order, none, capacity)]
    scored = sorted(((_fitness(sizes, p, capacity), i, p) for i, p in enumerate(people)), key=lambda x: (-x[0][0], -x[0][1], x[1]))
    if scored[0][0][0] >= bound:
        return [scored[0][2]]
    while len(scored) < population:  # nearly longest first, so that islands differ
        shaken = np.argsort(-sizes * rng.uniform(0.9, 1.0, len(sizes)), kind="stable")
        made = best_fit(sizes, shaken, none, capacity)
        scored.append((_fitness(sizes, made, capacity), len(scored), made))
    for step in range(generations):
        scored.sort(key=lambda x: (-x[0][0], -x[0][1], x[1]))
        scored = scored[:population]
        if scored[0][0][0] >= bound:
            break
        one, two = rng.choice(len(scored), 2, replace=False)
        child = _crossover(sizes, scored[min(one, two)][2], scored[max(one, two)][2], capacity, rng)
        if rng.random() < 0.5:
            child = _mutated(sizes, child, capacity, rng)
        scored.append((_fitness(sizes, child, capacity), population + step, child))
    scored.sort(key=lambda x: (-x[0][0], -x[0][1], x[1]))
    return [s[2] for s in scored[:population]]


# ---- islands on Spark ---------------------------------------------------------------------------

_BLOCK = "block long, doc_ids array<long>, pieces array<int>, starts array<long>, lengths array<long>, crcs array<long>"
_STATE = "block long, island int, lengths array<long>, people array<array<int>>"


def _blocks(items: DataFrame, size: int) -> DataFrame:
    """Rows of bounded size: ``size`` pieces each, in the order of a partition."""

    names = {"doc_ids": "doc_id", "pieces": "piece", "starts": "start", "lengths": "length", "crcs": "ids_crc32"}

    # In Arrow, as a column of frames with one missing id would be no whole numbers any more.
    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, count = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= size:
                whole, at = pa.Table.from_batches(held), 0
                while count - at >= size:
                    yield _row(number, whole.slice(at, size))
                    at, number = at + size, number + 1
                held, count = whole.slice(at).to_batches(), count - at
        if count:
            yield _row(number, pa.Table.from_batches(held))

    def _row(number: int, part: pa.Table) -> pa.RecordBatch:
        ends = pa.array([0, part.num_rows], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.concat_arrays(part.column(c).chunks)) for c in names.values()]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *lists], ["block", *names])

    return items.mapInArrow(dealt, _BLOCK)


def _packed(items: DataFrame, capacity: int, block: int, islands: int, rounds: int, label: str) -> DataFrame:
    """Each block's best packing: (doc_id, piece, start, length, ids_crc32, block, bin, fill)."""
    blocks = stored(_blocks(items, block), f"{label}-blocks")
    state = blocks.select("block", "lengths", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"))
    state = state.select("block", "island", "lengths", F.lit(None).cast("array<array<int>>").alias("people"))

    def evolved(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                sizes = np.asarray(row.lengths, np.int64)
                people = [] if row.people is None else [np.asarray(p, np.int64) for p in row.people]
                seed = (int(row.block) * 1009 + int(row.island) * 31 + len(people)) & 0x7FFFFFFF
                people = evolve(sizes, people, capacity, seed)
                yield pd.DataFrame({"block": [row.block], "island": [row.island], "lengths": [sizes], "people": [[p.astype(np.int32) for p in people]]})

    for number in range(rounds):
        state = stored(state.repartition("block", "island").mapInPandas(evolved, _STATE), f"{label}-round{number}")
        if number + 1 < rounds and islands > 1:  # the elite of an island moves to the next
            elite = state.select("block", ((F.col("island") + 1) % islands).alias("island"), F.slice("people", 1, 1).alias("guest"))
            state = state.join(elite, ["block", "island"]).select("block", "island", "lengths", F.concat("people", "guest").alias("people"))

    def best(frame: pd.DataFrame) -> pd.DataFrame:
        rows = [(np.asarray(r.lengths, np.int64), np.asarray(r.people[0], np.int64)) for r in frame.sort_values("island").itertuples(index=False)]
        sizes, bins = max(rows, key=lambda r: _fitness(*r, capacity))
        load = np.bincount(bins, weights=sizes).astype(np.int64)
        return pd.DataFrame({"block": frame["block"].iloc[:1], "bins": [bins], "fills": [load[bins]]})

    chosen = state.groupBy("block").applyInPandas(best, "block long, bins array<long>, fills array<long>")
    zipped = F.arrays_zip("doc_ids", "pieces", "starts", "lengths", "crcs", "bins", "fills")
    return blocks.join(chosen, "block").select("block", F.explode(zipped).alias("x")).select(
        F.col("x.doc_ids").alias("doc_id"), F.col("x.pieces").alias("piece"), F.col("x.starts").alias("start"),
        F.col("x.lengths").alias("length"), F.col("x.crcs").alias("ids_crc32"), "block", F.col("x.bins").alias("bin"), F.col("x.fills").alias("fill"),
    )


def pack(items: DataFrame, capacity: int = 4096, block: int = 4096, islands: int = 3, rounds: int = 2, loose: float = 0.97) -> DataFrame:
    """Pack pieces (doc_id, piece, start, length, ids_crc32) into sequences of at most ``capacity``.

    Adds sequence_id and offset, gapless from 0 within a sequence.  Full pieces are sequences
    by themselves.  Bins of the first pass filled below ``loose`` are opened, and their pieces are
    packed again across blocks.  No rows give no rows; rows with equal or null ids are packed each.
    A length above the capacity fails.
    """
    checked = items.withColumn("length", F.when(F.col("length") > capacity, F.raise_error(F.lit("a piece exceeds the capacity"))).otherwise(F.col("length")))
    checked = stored(checked, "pack-items")
    names = [f.split()[0] for f in ITEM.split(", ")]
    full = checked.where(F.col("length") == capacity).select(*names)
    first = stored(_packed(checked.where(F.col("length") < capacity).select(*names), capacity, block, islands, rounds, "pack"), "pack-first")
    tight = first.where(F.col("fill") >= loose * capacity)
    again = _packed(first.where(F.col("fill") < loose * capacity).select(*names).coalesce(_few(first, block, loose * capacity)), capacity, block, islands, rounds, "pack-loose")
    return _placed(tight, 0).unionByName(_placed(again, 1)).unionByName(
        full.select(*names, (F.monotonically_increasing_id() * 4 + 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    )


def _few(first: DataFrame, block: int, limit: float) -> int:
    """Partitions for the loose pieces, so that their blocks are full."""
    return max(1, min(first.rdd.getNumPartitions(), first.where(F.col("fill") < limit).count() // (4 * block)))


def _placed(bins: DataFrame, kind: int) -> DataFrame:
    """Offsets within each bin; a bin has at most ``capacity`` pieces, so its window is small."""
    from pyspark.sql import Window

    window = Window.partitionBy("block", "bin").orderBy("doc_id", "piece", "start").rowsBetween(Window.unboundedPreceding, -1)
    numbered = bins.withColumn("offset", F.coalesce(F.sum("length").over(window), F.lit(0)).cast("long"))
    # 21 bits of partition, 24 of block, 16 of bin, 2 of kind
    name = F.shiftleft(F.shiftright("block", 32), 40) + F.col("block").bitwiseAND(0xFFFFFFFF) * (1 << 16) + F.col("bin")
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", (name * 4 + kind).alias("sequence_id"), "offset")
