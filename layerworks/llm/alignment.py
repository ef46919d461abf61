"""How the tokens of two tokenizers correspond, in every text and in the whole corpus.

Every whole text is encoded by a byte-level tokenizer (A) and a piece tokenizer (B) that puts a blank
before it.  Places where a token of both ends and the next token of both begins with a blank are
anchors: the bytes before them are the same for both, which is checked for the whole text.  Anchors
cut a text into windows of ids, mostly a word each.  The same windows come again and again: those of
some texts are put together by a hash, with all ids compared, and each pair of id sequences is aligned
once and remembered; those of a slice of texts that are new are aligned together, by one search of
the ends of their tokens of one side among those of the other.

What a text contributes to the corpus are its links, pairs of tokens that end together.  Texts are
taken in blocks of bounded size; a block keeps its different links once, and each text the places of
its links in that list.  Counts of the corpus are joined to the lists, so a row is shuffled for each
different link of a block and not for each link of a text, and no task needs all links.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerworks.llm.bpe import encoder
from layerworks.llm.common import stored, text_slices
from layerworks.llm.shingles import GOLDEN, mixed

#: Bytes of text in a block, about; one text at least.
BLOCK_BYTES = 8 << 20
#: Bytes of text that are encoded and aligned at once, about.
SLICE_BYTES = 1 << 20
#: Windows that are remembered from one slice of texts to the next.
REMEMBERED = 60_000
#: Texts of characters below this are encoded through the vocabulary's ranks, others by the library.
PLAIN = "ɐ"

BLOCKS = "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_links array<long>, digests array<string>, links array<long>, totals array<long>, sizes array<int>, places binary, times binary"
COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class Pair:
    """Two tokenizers: ids, the bytes of each token, and the memory of aligned windows."""

    def __init__(self, byte_path: str, piece_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        held = encoder(byte_path)
        self.ranked, self.bytes_a = held.ranked, held.token_bytes
        self.library = Tokenizer.from_file(byte_path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = True
        self.pieces = SentencePieceProcessor(model_file=piece_path)
        self.bytes_b = []
        for number in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(number)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(number) else piece.replace("▁", " ").encode())
        self.lengths = [np.array([len(t) for t in table], np.int64) for table in (self.bytes_a, self.bytes_b)]
        self.all_bytes = [np.frombuffer(b"".join(table), np.uint8) for table in (self.bytes_a, self.bytes_b)]
        self.marked = [np.array([t[:1] == b" " for t in table]) for table in (self.bytes_a, self.bytes_b)]
        # Every id in decimal digits, with room for a mark after them.
        names = [str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.n_digits = np.array([len(name) for name in names], np.int64)
        width = int(self.n_digits.max()) + 1
        self.digits = np.frombuffer("".join([name.ljust(width) for name in names]).encode(), np.uint8).reshape(-1, width)
        self.windows: dict[bytes, tuple[str, bytes]] = {}

    def ids(self, texts: list[str]) -> tuple["Tokens", "Tokens"]:
        """Ids of A and B of all texts; none where a text is empty or their bytes are not the text's."""
        spaced = [" " + text for text in texts]
        first: list = [self.ranked.encode_to_numpy(text, disallowed_special=()) if text.isascii() or max(text) < PLAIN else None for text in spaced]
        rest = [i for i, ids in enumerate(first) if ids is None]
        for at in range(0, len(rest), 1024):
            some = rest[at : at + 1024]
            for i, code in zip(some, self.library.encode_batch([spaced[i] for i in some], add_special_tokens=False)):
                first[i] = np.array(code.ids, np.int64)
        second = [np.array(ids, np.int64) for ids in self.pieces.encode(texts, num_threads=1)]
        for i in [i for i, text in enumerate(texts) if not text]:
            first[i] = second[i] = np.empty(0, np.int64)
        data = [text.encode() if of else b"" for of, text in zip(texts, spaced)]
        a, b = Tokens(first), Tokens(second)
        if not all(self._same(side, table, lengths, data) for side, table, lengths in zip((a, b), self.all_bytes, self.lengths)):
            for i, whole in enumerate(data):
                if any(b"".join(map(table.__getitem__, ids[i].tolist())) != whole for table, ids in ((self.bytes_a, first), (self.bytes_b, second))):
                    first[i] = second[i] = np.empty(0, np.int64)
            a, b = Tokens(first), Tokens(second)
        return a, b

    @staticmethod
    def _same(side: "Tokens", table: np.ndarray, lengths: np.ndarray, data: list[bytes]) -> bool:
        """Whether the tokens of each text have its bytes: all are equal end to end, and each as long."""
        sizes = lengths[side.flat]
        ends = np.cumsum(sizes)
        if np.r_[0, ends][np.cumsum(side.sizes)].tolist() != np.cumsum([len(d) for d in data]).tolist():
            return False
        places = np.cumsum(lengths) - lengths
        source = np.repeat(places[side.flat] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
        return bool((table[source] == np.frombuffer(b"".join(data), np.uint8)).all())

    def cuts(self, a: "Tokens", b: "Tokens") -> tuple[np.ndarray, np.ndarray]:
        """Tokens of A and of B before each anchor.  Every text begins with a blank, so its end is one."""
        ends_a, ends_b = np.cumsum(self.lengths[0][a.flat]), np.cumsum(self.lengths[1][b.flat])
        near = np.searchsorted(ends_b, ends_a)  # both have the same bytes, so every place is inside
        shared = np.flatnonzero(ends_b[near] == ends_a)
        other = near[shared]
        inner = slice(0, max(0, len(shared) - 1))  # the last shared end is that of the last text
        anchor = self.marked[0][a.flat[shared[inner] + 1]] & self.marked[1][b.flat[other[inner] + 1]]
        keep = np.r_[anchor, np.ones(len(shared) - len(anchor), bool)]
        return shared[keep] + 1, other[keep] + 1

    def aligned(self, a: "Tokens", b: "Tokens") -> tuple[list[str], list[np.ndarray]]:
        """Of each text its groups, as text, and its links (A's id << 32 | B's id)."""
        ends = self.cuts(a, b)
        sides = [Windows(side.flat, cut) for side, cut in zip((a, b), ends)]
        kinds, kind = _different(*sides)
        found = self.remembered(*(side.only(kinds) for side in sides))
        sizes = np.array([len(links) >> 3 for _, links in found], np.int64)
        every = np.frombuffer(b"".join([links for _, links in found]), np.int64)
        # Windows of a text follow each other.
        bounds = np.searchsorted(ends[0], np.r_[0, np.cumsum(a.sizes)], "right")
        bounds = np.where(np.r_[0, np.cumsum(a.sizes)] == 0, 0, bounds)
        names = list(map([groups for groups, _ in found].__getitem__, kind.tolist()))
        counts = sizes[kind]
        starts = (np.cumsum(sizes) - sizes)[kind]
        links = every[np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))]
        edges = np.r_[0, np.cumsum(counts)][bounds]
        return [";".join(names[i:j]) for i, j in zip(bounds, bounds[1:])], [links[i:j] for i, j in zip(edges, edges[1:])]

    def remembered(self, a: "Windows", b: "Windows") -> list[tuple[str, bytes]]:
        """Of each window its groups, as text, and its links; those not remembered are aligned together."""
        ids, ends = _joined(a, b, 1 << 30)  # tells B's ids from A's
        data = ids.astype("<u4").tobytes()
        keys = [data[i:j] for i, j in pairwise([0, *(4 * ends).tolist()])]
        found = list(map(self.windows.get, keys))
        new = [i for i, known in enumerate(found) if known is None]
        if new:
            for i, value in zip(new, self.grouped(a.only(new), b.only(new))):
                self.windows[keys[i]] = found[i] = value
        return found

    def grouped(self, a: "Windows", b: "Windows") -> Iterator[tuple[str, bytes]]:
        """The groups between shared ends of each window, and the last tokens of each."""
        ends_a, ends_b = np.cumsum(self.lengths[0][a.flat]), np.cumsum(self.lengths[1][b.flat])
        near = np.searchsorted(ends_b, ends_a)  # windows have the same bytes on both sides, so every place is inside
        last_a = np.flatnonzero(ends_b[near] == ends_a)
        last_b = near[last_a]
        links = a.flat[last_a] << 32 | b.flat[last_b]
        groups = Windows(a.flat, last_a + 1), Windows(b.flat, last_b + 1)
        ids, ends = _joined(*groups)
        marks = np.full(len(ids), ord(","), np.uint8)
        marks[ends - groups[1].sizes - 1], marks[ends - 1] = ord("|"), ord(";")
        sizes = self.n_digits[ids]
        written = self.digits[ids]
        written[np.arange(len(ids)), sizes] = marks
        text = written[np.arange(written.shape[1]) <= sizes[:, None]].tobytes().decode("ascii")
        chars = np.cumsum(sizes + 1)[a.ends + b.ends - 1].tolist()
        # A window ends in a shared end.
        links, places = links.tobytes(), (8 * np.searchsorted(last_a, a.ends)).tolist()
        for (i, j), (k, m) in zip(pairwise([0, *chars]), pairwise([0, *places])):
            yield text[i : j - 1], links[k:m]


class Tokens:
    """Ids of many texts end to end, and how many each has."""

    def __init__(self, lists: list[np.ndarray]):
        self.sizes = np.array([len(ids) for ids in lists], np.int64)
        self.flat = np.concatenate([*lists, np.empty(0, np.int64)]).astype(np.int64)


class Windows:
    """Ids cut into windows that end before each of some places."""

    def __init__(self, flat: np.ndarray, ends: np.ndarray):
        self.flat, self.ends = flat, ends
        self.starts = np.r_[0, ends[:-1]][: len(ends)]
        self.sizes = self.ends - self.starts
        self.place = np.arange(len(flat)) - np.repeat(self.starts, self.sizes)

    def hashes(self, salt: int) -> np.ndarray:
        each = mixed((self.flat.astype(np.uint64) + np.uint64(salt)) * GOLDEN + self.place.astype(np.uint64))
        return np.add.reduceat(each, self.starts) if len(self.starts) else np.empty(0, np.uint64)

    def same_as(self, others: np.ndarray) -> bool:
        """Whether each window has the ids of the window at the place given."""
        if (self.sizes != self.sizes[others]).any():
            return False
        return bool((self.flat == self.flat[np.repeat(self.starts[others], self.sizes) + self.place]).all())

    def only(self, which: np.ndarray | list[int]) -> "Windows":
        """Some of the windows, end to end."""
        sizes = self.sizes[which]
        ends = np.cumsum(sizes)
        return Windows(self.flat[np.repeat(self.starts[which] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))], ends)


def _joined(a: Windows, b: Windows, more: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """A's ids and then B's (and ``more``) of each window, and the places after each window."""
    ids = np.empty(len(a.flat) + len(b.flat), np.int64)
    ids[np.arange(len(a.flat)) + np.repeat(b.starts, a.sizes)] = a.flat
    ids[np.arange(len(b.flat)) + np.repeat(a.ends, b.sizes)] = b.flat + more
    return ids, a.ends + b.ends


def _different(a: Windows, b: Windows) -> tuple[np.ndarray, np.ndarray]:
    """One place of each different pair of windows, and for each window which of those it equals."""
    salt = 0
    while True:
        kind, kinds = pd.factorize(mixed(a.hashes(salt)) + b.hashes(salt + 1))
        first = np.empty(len(kinds), np.int64)
        first[kind[::-1]] = np.arange(len(kind))[::-1]
        if a.same_as(first[kind]) and b.same_as(first[kind]):
            return first, kind
        salt += 2  # two windows had one hash


@lru_cache(maxsize=2)
def pair(byte_path: str, piece_path: str) -> Pair:
    """One per worker process."""
    return Pair(byte_path, piece_path)


def aligned_blocks(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each block of texts: its documents, its different links, and which each text has.  Stored."""

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers, number = pair(byte_path, piece_path), 0
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for part in text_slices(batch, "text", block_bytes):
                more = part.column("text").nbytes
                if held and size + more > block_bytes:
                    yield _block(tokenizers, held, number)
                    held, size, number = [], 0, number + 1
                held.append(part)
                size += more
        if held:
            yield _block(tokenizers, held, number)

    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return stored(base.mapInArrow(blocked, BLOCKS), "alignment-blocks")


def _block(tokenizers: Pair, held: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
    gc.disable()  # it would walk the many small tuples again and again; none is part of a cycle
    try:
        return _block_row(tokenizers, held, number)
    finally:
        gc.enable()


def _block_row(tokenizers: Pair, held: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
    ids, n_a, n_b, digests, sizes, every = [], [], [], [], [], []
    for batch in held:
        ids += batch.column("id").to_pylist()
        # A slice of texts at a time, so that few ids are held as objects.
        for part in text_slices(batch, "text", SLICE_BYTES):
            if len(tokenizers.windows) > REMEMBERED:
                tokenizers.windows.clear()
            a, b = tokenizers.ids(part.column("text").to_pylist())
            groups, links = tokenizers.aligned(a, b)
            n_a += a.sizes.tolist()
            n_b += b.sizes.tolist()
            sizes += [len(x) for x in links]
            digests += [hashlib.sha256(g.encode()).hexdigest() if n else "" for g, n in zip(groups, a.sizes)]
            every += links
    flat = np.concatenate(every)
    place, links = pd.factorize(flat)
    totals = np.bincount(place, minlength=len(links))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    mixed, times = np.unique(owner * max(1, len(links)) + place, return_counts=True)
    owner, place = np.divmod(mixed, max(1, len(links)))
    per_text = np.bincount(owner, minlength=len(sizes))
    steps = np.diff(place, prepend=0).astype("<i4")  # small within a text, where places ascend
    block = TaskContext.get().partitionId() << 32 | number
    row = {
        "block": block, "doc_ids": ids, "n_a": n_a, "n_b": n_b, "n_links": sizes, "digests": digests, "links": links, "totals": totals,
        "sizes": per_text.astype(np.int32), "places": _packed(steps), "times": _packed(times.astype("<i4")),
    }
    kinds = {"block": pa.int64(), "digests": pa.list_(pa.string()), "sizes": pa.list_(pa.int32()), "places": pa.binary(), "times": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([v], kinds.get(c, pa.list_(pa.int64()))) for c, v in row.items()], list(row))


def _packed(values: np.ndarray) -> bytes:
    """Small numbers as bytes, compressed: their number, then the values."""
    data = values.tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True), "<i4")


def _each_link(blocks: DataFrame) -> DataFrame:
    both = F.posexplode(F.arrays_zip("links", "totals")).alias("place", "x")
    return blocks.select("block", both).select("block", "place", F.col("x.links").alias("link"), F.col("x.totals").alias("n"))


def link_counts(blocks: DataFrame) -> DataFrame:
    """(link, a_id, b_id, n, best): how often each pair of ids is linked in all texts, and whether that
    is the highest count of its B id.  Stored."""
    counts = stored(_each_link(blocks).groupBy("link").agg(F.sum("n").alias("n")), "alignment-counts")
    named = counts.select("link", F.shiftright("link", 32).cast("int").alias("a_id"), F.col("link").bitwiseAND(0xFFFFFFFF).cast("int").alias("b_id"), "n")
    highest = named.groupBy("b_id").agg(F.max("n").alias("highest"))
    return named.join(highest, "b_id").select("link", "a_id", "b_id", "n", (F.col("n") == F.col("highest")).alias("best"))


def documents(blocks: DataFrame, counts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A row for each text: its tokens, groups and links, with the corpus counts of the links."""
    valued = _each_link(blocks).join(counts.select("link", F.col("n").alias("count"), "best"), "link")
    per_block = valued.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("place", "count", "best"))).alias("found"))
    # A block has at most a link for each byte of its text.
    joined = blocks.drop("links", "totals").join(per_block, "block", "left").withColumns({"counts": F.col("found.count"), "bests": F.col("found.best")}).drop("found", "block")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield _rows(batch.slice(at, 1))

    schema = f"id long, {', '.join(f'{c} long' for c in COUNTS)}, groups_sha256 string"
    return joined.mapInArrow(summed, schema).withColumnRenamed("id", id_col)


def _rows(block: pa.RecordBatch) -> pa.RecordBatch:
    lists = {c: block.column(c).flatten() for c in ("doc_ids", "n_a", "n_b", "n_links", "digests", "sizes", "counts", "bests")}
    sizes = lists["sizes"].to_numpy()
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.cumsum(_unpacked(block.column("places")[0].as_py()), dtype=np.int64)
    times = _unpacked(block.column("times")[0].as_py()).astype(np.int64)
    best, total = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    if len(place):
        counts, bests = lists["counts"].to_numpy(), lists["bests"].to_numpy(zero_copy_only=False)
        np.add.at(best, owner, times * bests[place])
        np.add.at(total, owner, times * counts[place])
    # Tokens have a byte at least, so at each shared end exactly one pair of tokens ends.
    columns = [lists["doc_ids"], lists["n_a"], lists["n_b"], lists["n_links"], lists["n_links"], pa.array(best), pa.array(total), lists["digests"]]
    return pa.RecordBatch.from_arrays(columns, ["id", *COUNTS, "groups_sha256"])


def align(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256).

    Texts are encoded without special tokens, whose strings are plain text.  ``n_groups`` counts the
    spans between shared ends and ``n_links`` the pairs of tokens that end together; ``n_best`` counts
    the links whose corpus count is the highest of their B id, ``count_sum`` adds the corpus counts.
    ``groups_sha256`` is the digest of the ids of all groups in order.  Texts that are null, empty or
    changed by a tokenizer have no tokens: zeros and an empty digest.  Repeated rows and null ids each
    give a row and count.  Columns besides the two named are not read.  No rows give no rows.
    """
    blocks = aligned_blocks(docs, byte_path, piece_path, id_col, text_col, block_bytes)
    return documents(blocks, stored(link_counts(blocks), "alignment-links"), id_col)
