"""Byte-level BPE: whole texts to ids and back, long texts in parallel halves joined exactly.

A text longer than ``leaf_chars`` is cut into leaves that are encoded in different tasks.  Two
neighbours are joined by encoding a window around the cut again.  The window grows until its
encoding meets both sides: at a pre-token boundary that both found, or, inside one unbroken run
of characters, at a token that both have at the same place.  BPE makes that exact: a sequence
of tokens is the encoding of its text if each two neighbours are the encoding of theirs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from layerworks.llm.common import text_slices

#: Bytes before the end of a window in which a boundary may still depend on what follows it.
MARGIN = 12
CACHE_ENTRIES = 150_000
CACHED_CHARS = 64


class TwoGenerations:
    """A bounded dictionary: the older half goes when the newer one is full."""

    def __init__(self, limit: int = CACHE_ENTRIES):
        self.limit, self.new, self.old = limit, {}, {}

    def missing(self, keys: set) -> list:
        """Keys not held; those held by the older half move to the newer one."""
        if len(self.new) + len(keys) > self.limit:
            self.old, self.new = self.new, {}
        wanted = []
        for key in keys.difference(self.new):
            if key in self.old:
                self.new[key] = self.old[key]
            else:
                wanted.append(key)
        return wanted


class Encoder:
    """The tokenizers library, with a memory of the pieces of text between blanks."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab()
        byte_of = _byte_alphabet()
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.token_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.token_bytes[number] = token.encode() if token in special else bytes(byte_of[c] for c in token)
        self.lengths = np.array([len(b) for b in self.token_bytes], np.int64)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.all_bytes = np.frombuffer(b"".join(self.token_bytes), np.uint8)
        self.special = sorted(special, key=len, reverse=True)
        self.special_ids = {vocabulary[s] for s in special}
        self.memory = TwoGenerations()
        # The same merges as ranks, for plain texts: several times as fast.
        import tiktoken
        from public_tokenizers import PATTERN

        number = {t: vocabulary[t] for t in special}
        ranks = {b: n for n, b in enumerate(self.token_bytes) if n not in self.special_ids}
        self.ranked = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=number)

    def ids_of(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian int32.

        Texts of Latin letters go through the ranks; others, whose classes of characters may differ
        between versions of Unicode, and texts with a special token through the library.
        """
        out: list[bytes | None] = []
        for text in texts:
            plain = not text or (max(text) < "\u0250" and not any(mark in text for mark in self.special))
            out.append(np.array(self.ranked.encode_ordinary(text), "<i4").tobytes() if plain else None)
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, found in zip(rest, self.encode_all([texts[i] for i in rest])):
            out[i] = found[0]
        return out

    def encode_all(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """For each text: ids as little-endian int32, and a byte per id that is 1 at a pre-token's start."""
        parts = [_between_blanks(text) for text in texts]
        short = {c for p in parts for c in p if len(c) <= CACHED_CHARS}
        wanted = self.memory.missing(short)
        for chunk, found in zip(wanted, self._direct(wanted)):
            self.memory.new[chunk] = found
        known = self.memory.new
        out = []
        for p in parts:
            long = [c for c in p if len(c) > CACHED_CHARS]
            extra = dict(zip(long, self._direct(long))) if long else {}
            found = [known[c] if len(c) <= CACHED_CHARS else extra[c] for c in p]
            out.append((b"".join([f[0] for f in found]), b"".join([f[1] for f in found])))
        return out

    def _direct(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        for at in range(0, len(texts), 4096):
            for code in self.tokenizer.encode_batch(texts[at : at + 4096], add_special_tokens=False):
                ids = np.array(code.ids, "<i4")
                units = np.array([-1 if w is None else w for w in code.word_ids], np.int64)
                starts = np.ones(len(ids), np.uint8)
                if len(ids) > 1:
                    odd = np.isin(ids, list(self.special_ids))
                    starts[1:] = (units[1:] != units[:-1]) | odd[1:] | odd[:-1]
                yield ids.tobytes(), starts.tobytes()

    def piece(self, text: str, found: tuple[bytes, bytes] | None = None) -> "Piece":
        ids, starts = found or self.encode_all([text])[0]
        return Piece(self, text.encode(), np.frombuffer(ids, "<i4"), np.frombuffer(starts, np.uint8))

    def decode_all(self, lists: pa.ListArray) -> list[str]:
        """As the library's ``decode(ids, skip_special_tokens=False)``, for many lists at once."""
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        sizes = np.array([0 if n is None else n for n in pc.list_value_length(lists).to_pylist()], np.int64)
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        source = np.repeat(self.places[ids] - (ends - lengths), lengths) + np.arange(int(lengths.sum()))
        data = self.all_bytes[source].tobytes()
        last = np.cumsum(sizes)
        stops = np.r_[0, ends][last].tolist()
        out = []
        for row, (begin, stop) in enumerate(zip([0, *stops], stops)):
            try:
                out.append(data[begin:stop].decode())
            except UnicodeDecodeError:
                out.append(self.tokenizer.decode(ids[last[row] - sizes[row] : last[row]].tolist(), skip_special_tokens=False))
        return out


def _byte_alphabet() -> dict[str, int]:
    """Characters of the vocabulary to bytes: printable Latin-1 as it is, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _between_blanks(text: str) -> list[str]:
    """Parts that are encoded independently: each but the first starts with a blank after a visible
    character, where a pre-token always ends."""
    if not text:
        return []
    parts = text.split(" ")
    if len(parts) == 1:
        return parts
    if all(p and not p[-1].isspace() for p in parts[:-1]):
        return [parts[0], *[" " + p for p in parts[1:]]]
    out = [parts[0]]
    for p in parts[1:]:
        if out[-1] and not out[-1][-1].isspace():
            out.append(" " + p)
        else:
            out[-1] += " " + p
    return out


class Piece:
    """A text with its tokens, and where they end in it."""

    def __init__(self, encoder: Encoder, data: bytes, ids: np.ndarray, starts: np.ndarray):
        self.encoder, self.data, self.ids, self.starts = encoder, data, ids, starts
        self.ends = np.cumsum(encoder.lengths[ids])

    def begin(self, token: int) -> int:
        return int(self.ends[token - 1]) if token else 0


def join(a: Piece, b: Piece) -> Piece:
    """The encoding of two neighbouring texts as one."""
    encoder = a.encoder
    data = a.data + b.data
    if not len(a.ids) or not len(b.ids):
        full = a if len(a.ids) else b
        return Piece(encoder, data, full.ids, full.starts)
    cut, reach = len(a.data), 8
    while True:
        left, exact = _left_edge(a, reach)
        begin = a.begin(left)
        last = min(len(b.ids), reach)
        end = int(b.ends[last - 1])
        while end < len(b.data) and b.data[end] & 0xC0 == 0x80:
            end += 1
        window = encoder.piece(data[begin : cut + end].decode())
        whole_right = end == len(b.data)
        head = (left, 0) if exact else _common(a, window, left, -begin)
        if head:
            if whole_right:
                tail = (len(window.ids), len(b.ids))
            else:
                tail = _right_edge(window, b, cut - begin, end)
            if tail and tail[0] > head[1]:
                ids = np.concatenate([a.ids[: head[0]], window.ids[head[1] : tail[0]], b.ids[tail[1] :]])
                starts = np.concatenate([a.starts[: head[0]], window.starts[head[1] : tail[0]], b.starts[tail[1] :]])
                if not exact:  # the window began inside a pre-token
                    starts[head[0]] = a.starts[head[0]]
                return Piece(encoder, data, ids, starts)
        reach *= 2


def _left_edge(a: Piece, reach: int) -> tuple[int, bool]:
    """Token of the left text where the window begins, and whether a pre-token surely starts there."""
    last = max(0, len(a.ids) - reach)
    for token in range(last, max(-1, last - 4 * reach - 64), -1):
        if token == 0 or a.starts[token] and a.begin(token) <= len(a.data) - MARGIN:
            return token, True
    while last and (a.data[a.begin(last)] & 0xC0 == 0x80 or a.data[a.begin(last) : a.begin(last) + 1] == b"'"):
        last -= 1
    return last, last == 0


def _spans(piece: Piece, tokens: range, shift: int) -> dict[tuple[int, int], int]:
    return {(piece.begin(t) + shift, int(piece.ends[t]) + shift): t for t in tokens}


def _common(a: Piece, window: Piece, left: int, shift: int) -> tuple[int, int] | None:
    """A token that the left text and the window's first pre-token have at the same place."""
    inside = range(0, _first_start(window.starts, 1))
    spans = _spans(window, inside, 0)
    for token in range(left, len(a.ids)):
        at = spans.get((a.begin(token) + shift, int(a.ends[token]) + shift))
        if at is not None and window.ids[at] == a.ids[token] and not a.starts[left + 1 : token + 1].any():
            return token, at
    return None


def _first_start(starts: np.ndarray, origin: int) -> int:
    later = np.flatnonzero(starts[origin:])
    return origin + int(later[0]) if len(later) else len(starts)


def _right_edge(window: Piece, b: Piece, cut: int, end: int) -> tuple[int, int] | None:
    """Where the window hands over to the right text: (tokens of the window, tokens of b to drop)."""
    limit = cut + end - MARGIN
    of_b = {b.begin(t): t for t in range(min(len(b.ids), int(np.searchsorted(b.ends, end)) + 1)) if b.starts[t]}
    for token in np.flatnonzero(window.starts)[::-1]:
        place = window.begin(int(token))
        if place < cut:
            break
        if place <= limit and place - cut in of_b:
            return int(token), of_b[place - cut]
    run = int(np.flatnonzero(window.starts)[-1])
    first = _first_start(b.starts, 1)
    if first < len(b.ids) and b.begin(first) <= end:  # b's first pre-token is no unbroken run here
        return None
    spans = _spans(b, range(min(first, len(b.ids))), cut)
    for token in range(len(window.ids) - 1, run - 1, -1):
        at = spans.get((window.begin(token), int(window.ends[token])))
        if at is not None and b.ids[at] == window.ids[token]:
            return token + 1, at + 1
    return None


def join_tree(pieces: list[Piece]) -> Piece:
    """Join neighbours, then neighbours of those, up to the whole text."""
    while len(pieces) > 1:
        pieces = [join(*pieces[i : i + 2]) if i + 1 < len(pieces) else pieces[i] for i in range(0, len(pieces), 2)]
    return pieces[0]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One per worker process."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def leaf_texts(text: str, leaf_chars: int, special: list[str]) -> list[str]:
    """Cut a text into leaves, never inside a special token."""
    cuts, at = [0], leaf_chars
    while at < len(text):
        for mark in special:
            near = text.find(mark, max(cuts[-1], at - len(mark) + 1), at + len(mark) - 1)
            if near != -1 and near < at:
                at = near + len(mark)
        if at < len(text):
            cuts.append(at)
        at += leaf_chars
    return [text[i:j] for i, j in zip(cuts, [*cuts[1:], len(text)])]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", leaf_chars: int = 1 << 16) -> DataFrame:
    """(id, ids): the ids of every whole text, as the tokenizers library gives them.

    Columns besides the two named are ignored, so names cannot clash.  A null or empty text has no
    ids; repeated rows and null ids each give a row.  Texts above ``leaf_chars`` are encoded by
    leaves in different tasks; a text's ids meet in one task, as the text did when it was read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType
    short = rows.where(F.length("text") <= leaf_chars)
    long = rows.where(F.length("text") > leaf_chars).withColumn("row", F.monotonically_increasing_id())

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in batches:
            for part in text_slices(batch, "text"):
                found = tool.ids_of(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("id"), _lists(found)], ["id", "ids"])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special = encoder(path).special
        for batch in batches:
            for row, name, text in zip(*(batch.column(c).to_pylist() for c in ("row", "id", "text"))):
                parts = leaf_texts(text, leaf_chars, special)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row] * len(parts), pa.int64()),
                        pa.array([name] * len(parts), batch.schema.field("id").type),
                        pa.array(range(len(parts)), pa.int32()),
                        pa.array(parts),
                    ],
                    ["row", "id", "leaf", "text"],
                )

    def leaf_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in batches:
            for part in text_slices(batch, "text"):
                found = tool.encode_all(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.binary())],
                    ["row", "id", "leaf", "text", "ids", "starts"],
                )

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        tool = encoder(path)
        group = group.sort_values("leaf")
        whole = join_tree([tool.piece(t, (i, s)) for t, i, s in zip(group["text"], group["ids"], group["starts"])])
        out = group[["id"]].iloc[:1].copy()
        out["ids"] = [whole.ids]
        return out

    schema = f"id {id_type.simpleString()}, ids array<int>"
    cut = long.mapInArrow(leaves, f"row bigint, id {id_type.simpleString()}, leaf int, text string")
    halves = cut.repartition("row", "leaf").mapInArrow(
        leaf_ids, f"row bigint, id {id_type.simpleString()}, leaf int, text string, ids binary, starts binary"
    )
    out = short.mapInArrow(encoded, schema).unionByName(halves.groupBy("row").applyInPandas(joined, schema))
    return out.withColumnRenamed("id", id_col)


def _lists(ids: list[bytes]) -> pa.ListArray:
    """Arrow lists from packed int32s."""
    ends = np.cumsum([0, *[len(i) // 4 for i in ids]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def decode(rows: DataFrame, path: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """Add the text of the ids; special tokens are written out.  No ids give the empty text."""
    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in batches:
            for part in _slices(batch, ids_col):
                texts = tool.decode_all(part.column(ids_col))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, to])

    return rows.mapInArrow(decoded, StructType([*rows.schema.fields, StructField(to, StringType())]))


def _slices(batch: pa.RecordBatch, column: str, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
