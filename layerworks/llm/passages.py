"""Repeated passages: confirmed by counting, located by Aho-Corasick automata over word blocks.

1. Every window of ``WINDOW`` words has an anchor, the smallest hash of its short word grams.  Equal
   windows have equal anchors, and a document has about one anchor in six words.  Anchors that
   two documents share are found by one aggregate.
2. Only windows with a shared anchor are hashed and counted, first by groups: consecutive windows
   with one anchor, about six.  Of each group the smallest document that has it is found, and only
   there, and only where an anchor has groups of several documents, windows are counted one by one.
   What two documents have is confirmed.  Runs of confirmed windows are cut out of the smallest
   document as passages.
3. Passages, cut to a bounded length, go to the documents that share a window with them.  Each task compiles the
   passages of its shard of documents into an automaton and streams the shard through it.  The
   patterns are every passage's consecutive blocks of seven words, so that any window of 13 words
   holds a whole block; a hit is widened word by word, and 13 equal words make an occurrence.

Hashes only choose what is compared; what is removed was equal word by word.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerworks.llm.common import release, row_slices, stored, text_slices
from layerworks.llm.shingles import GOLDEN, hashed_words, hashes_of, mixed, split_words

WINDOW = 13
GRAM = 4
BLOCK = (WINDOW + 1) // 2
NO_ID = -(1 << 63)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Windows that hold a gram, so those of a group at most.
SPAN = WINDOW - GRAM + 1
#: Windows that begin in a passage at most, besides the rest of a group.
CUT = 256
#: Words compared at once where an occurrence is widened.
STEP = 16


def _spans(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each place on, by spans of twice the length before."""
    out, length = words, 1
    while length < width:
        step = min(length, width - length)
        out = mixed(out[:-step] * GOLDEN + out[step:])
        length += step
    return out


def _anchors(words: np.ndarray) -> np.ndarray:
    """Smallest gram hash of the window from each place on."""
    short = _spans(words, GRAM)
    count = len(words) - WINDOW + 1
    least = short[:count].copy()
    for at in range(1, WINDOW - GRAM + 1):
        np.minimum(least, short[at : at + count], out=least)
    return least


def _windows(split: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, words of each text, anchor of each window, window's place among all words, its text)."""
    words, sizes = hashes_of(split)
    if len(words) < WINDOW:
        return words, sizes, np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    whole = np.flatnonzero(owner[: len(words) - WINDOW + 1] == owner[WINDOW - 1 :])
    return words, sizes, _anchors(words)[whole], whole, owner[whole]


def _groups(anchors: np.ndarray, place: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Where groups begin: consecutive windows of a text with one anchor, ``SPAN`` at most."""
    new = np.ones(len(anchors), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)
    begins = np.flatnonzero(new)
    within = np.arange(len(anchors)) - np.repeat(begins, np.diff(np.r_[begins, len(anchors)]))
    return np.flatnonzero(within % SPAN == 0)


def _list_column(values: np.ndarray, owner: np.ndarray, rows: int, kind: pa.DataType) -> pa.ListArray:
    ends = np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


def _shared_anchors(base: DataFrame) -> DataFrame:
    """(id, anchors): of each document those that another one has too."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                _, _, anchors, _, owner = _windows(split_words(part.column("text").to_pylist()))
                order = np.lexsort((anchors, owner))
                anchors, owner = anchors[order], owner[order]
                first = np.ones(len(anchors), bool)
                first[1:] = (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1])
                lists = _list_column(anchors[first].view(np.int64), owner[first], part.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("id"), lists], ["id", "anchors"])

    own = stored(base.mapInArrow(found, "id long, anchors array<long>"), "passages-anchors")
    rows = own.select("id", F.explode("anchors").alias("anchor"))
    shared = rows.groupBy("anchor").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("anchor")
    found = stored(rows.join(shared, "anchor").groupBy("id").agg(F.collect_set("anchor").alias("anchors")), "passages-shared")
    release(own)
    return found


def _candidates(base: DataFrame, shared: DataFrame) -> DataFrame:
    """(id, t, starts, sizes, anchors, h, stretches): groups of windows with a shared anchor, and the words there.

    Of a group there are the first window, how many, their anchor and a hash of the group's words.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = split_words(part.column("text").to_pylist())
                words, counts, anchors, place, owner = _windows(texts)
                lists = part.column("anchors")
                keep = np.zeros(len(anchors), bool)
                ends = np.searchsorted(owner, np.arange(len(texts) + 1))
                for row in range(len(texts)):
                    here = slice(ends[row], ends[row + 1])
                    keep[here] = np.isin(anchors[here], lists[row].values.to_numpy().view(np.uint64))
                anchors, place, owner = anchors[keep], place[keep], owner[keep]
                wide = _spans(words, WINDOW)[place]
                starts = (place - (np.cumsum(counts) - counts)[owner]).astype(np.int32)
                ends = np.searchsorted(owner, np.arange(len(texts) + 1))
                cut = [_stretches(text, starts[a:b]) for text, a, b in zip(texts, ends, ends[1:])]
                begins = _groups(anchors, place, owner)
                sizes = np.diff(np.r_[begins, len(place)])
                # The first and the last window hold all words of the group.
                whole = mixed(wide[begins] * GOLDEN + mixed(wide[begins + sizes - 1] + sizes.astype(np.uint64)))
                columns = [(starts[begins], pa.int32()), (sizes, pa.int32()), (anchors[begins].view(np.int64), pa.int64()), (whole.view(np.int64), pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), part.column("t"), *[_list_column(values, owner[begins], len(texts), kind) for values, kind in columns],
                        pa.array(cut, pa.list_(pa.struct([("at", pa.int32()), ("words", pa.string())]))),
                    ],
                    ["id", "t", "starts", "sizes", "anchors", "h", "stretches"],
                )

    schema = "id long, t long, starts array<int>, sizes array<int>, anchors array<long>, h array<long>, stretches array<struct<at: int, words: string>>"
    pairs = base.join(shared, "id").select("id", F.xxhash64("text").alias("t"), "text", "anchors")  # rows may repeat an id
    candidates = stored(pairs.mapInArrow(found, schema), "passages-candidates")
    release(shared)
    return candidates


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Runs of consecutive window starts as (first word, word after the last)."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.r_[0, cuts + 1]].tolist(), (starts[np.r_[cuts, len(starts) - 1]] + WINDOW).tolist()))


def _stretches(words: list[bytes], starts: np.ndarray) -> list[dict]:
    return [{"at": a, "words": b" ".join(words[a:b]).decode("utf-8", "surrogatepass")} for a, b in _runs(starts)]


def _first(rows: DataFrame, *key: str) -> DataFrame:
    """(key, source, t, starts, sizes, last): the first place that has a key, and the largest document."""
    first = F.min(F.struct("id", "t", "starts", "sizes")).alias("first")
    found = rows.groupBy(*key).agg(first, F.max("id").alias("last"))
    return found.select(*key, F.col("first.id").alias("source"), "first.t", "first.starts", "first.sizes", "last")


def _edges(candidates: DataFrame, groups: DataFrame) -> DataFrame:
    """(id, t, starts, sizes, anchors, h): the windows that must be counted by themselves.

    A document that is not the first with a group has all its windows from the first.  So only
    windows of first places can still be in a smaller document, in another group of their anchor.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _stretch_slices(batch):
                flat = part.column("stretches").flatten()
                words, counts = hashed_words(flat.field("words").to_pylist())
                doc, groups = _row_of(part.column("wanted")), part.column("wanted").flatten()
                starts, sizes, anchors = (groups.field(c).to_numpy() for c in ("starts", "sizes", "anchors"))
                which = np.repeat(np.arange(len(groups)), sizes)
                place = starts[which] + np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                # A group lies in one stretch, the last that begins before it.
                begins = (_row_of(part.column("stretches")) << 32) + flat.field("at").to_numpy()
                order = np.argsort(begins)
                key = (doc[which] << 32) + place
                inside = order[np.searchsorted(begins[order], key, "right") - 1]
                hashes = _spans(words, WINDOW)[(np.cumsum(counts) - counts)[inside] + key - begins[inside]]
                rows = pa.array(doc[which])
                columns = [
                    part.column("source").take(rows), part.column("t").take(rows), pa.array(place, pa.int32()), pa.array(np.ones(len(place)), pa.int32()),
                    pa.array(anchors[which]), pa.array(hashes.view(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "t", "starts", "sizes", "anchors", "h"])

    several = groups.groupBy("anchors").agg(F.min("source").alias("a"), F.max("source").alias("b")).where("a < b").select("anchors")
    several = groups.join(several, "anchors", "left_semi")
    wanted = several.groupBy("source", "t").agg(F.collect_list(F.struct("starts", "sizes", "anchors")).alias("wanted"))
    own = candidates.select(F.col("id").alias("source"), "t", "stretches").join(wanted, ["source", "t"])
    return stored(own.mapInArrow(counted, "id long, t long, starts int, sizes int, anchors long, h long"), "passages-edges")


def _row_of(lists: pa.ListArray) -> np.ndarray:
    """The row of each item."""
    return np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())


def _stretch_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch by the length of their stretches."""
    lists = batch.column("stretches")
    lengths = pc.binary_length(lists.flatten().field("words")).to_numpy()
    total = np.bincount(_row_of(lists), lengths, batch.num_rows)
    return row_slices(batch, total.tolist())


def _routed_passages(candidates: DataFrame) -> DataFrame:
    """(id, found): for each document the passages of smaller documents that it shares a window with.

    A passage is a run of confirmed windows of the smallest document that has them, cut so that
    ``CUT`` windows and a group at most begin in it; a document gets only those that hold one of its windows.
    """
    rows = candidates.select("id", "t", F.explode(F.arrays_zip("starts", "sizes", "anchors", "h")).alias("x"))
    rows = rows.select("id", "t", "x.starts", "x.sizes", "x.anchors", "x.h")
    groups = stored(_first(rows, "anchors", "h"), "passages-groups")
    edges = _edges(candidates, groups)
    confirmed = [found.where("source < last").drop("last") for found in (groups, _first(edges, "anchors", "h"))]
    firsts = stored(confirmed[0].unionByName(confirmed[1]), "passages-windows")
    release(groups)
    # Windows of a document are in a run if none is missing between them.
    in_order = Window.partitionBy("source", "t").orderBy("starts")
    reached = F.max(F.col("starts") + F.col("sizes")).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opened = firsts.withColumn("opens", F.when(F.coalesce(F.col("starts") > reached, F.lit(True)), F.col("starts")))
    begins = opened.withColumn("begin", F.max("opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    placed = begins.select("anchors", "h", "source", "t", (F.col("starts") - (F.col("starts") - F.col("begin")) % CUT).alias("at"))
    held = rows.select("id", "anchors", "h").unionByName(edges.select("id", "anchors", "h"))
    routes = stored(held.join(placed, ["anchors", "h"]).where("source < id").select("id", "source", "t", "at").distinct(), "passages-routes")
    release(edges)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for source, t, own, stretches in zip(*(batch.column(c).to_pylist() for c in ("source", "t", "own", "stretches"))):
                ordered = [(s["at"], s["words"].split(" ")) for s in stretches]
                firsts_of = [at for at, _ in ordered]
                for a, b in _runs(np.unique(np.concatenate([np.arange(o["starts"], o["starts"] + o["sizes"]) for o in own]))):
                    at, words = ordered[bisect_right(firsts_of, a) - 1]
                    # A group that begins in a passage ends in it.
                    out += [(source, t, p, " ".join(words[p - at : min(b, p + CUT + SPAN + WINDOW - 2) - at])) for p in range(a, b - WINDOW + 1, CUT)]
            columns = list(zip(*out)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["source", "t", "at", "passage"])

    sources = firsts.groupBy("source", "t").agg(F.collect_list(F.struct("starts", "sizes")).alias("own"))
    texts = candidates.select(F.col("id").alias("source"), "t", "stretches").join(sources, ["source", "t"])
    passages = texts.mapInArrow(cut, "source long, t long, at int, passage string")
    found = routes.join(passages, ["source", "t", "at"]).groupBy("id").agg(F.collect_list(F.struct("source", "passage")).alias("found"))
    routed = stored(found, "passages-routed")
    release(candidates, firsts, routes)
    return routed


class Shard:
    """An automaton of passages, and what it finds in a document."""

    def __init__(self, passages: dict[str, int]):
        """``passages``: text to the smallest document that has it."""
        import ahocorasick

        self.words = [text.split(" ") for text in passages]
        self.sources = list(passages.values())
        blocks: dict[str, list[tuple[int, int]]] = {}
        for number, words in enumerate(self.words):
            for at in range(0, len(words) - BLOCK + 1, BLOCK):
                blocks.setdefault(" " + " ".join(words[at : at + BLOCK]) + " ", []).append((number, at))
        self.automaton = ahocorasick.Automaton()
        for pattern, places in blocks.items():
            self.automaton.add_word(pattern, places)
        self.automaton.make_automaton()

    def covered(self, words: list[str], doc_id: int) -> np.ndarray:
        """Which words lie in a window that also starts in a document with a smaller id."""
        out = np.zeros(len(words), bool)
        if len(words) < WINDOW or not len(self.automaton):
            return out
        text = " " + " ".join(words) + " "
        begins = [0, *accumulate(len(w) + 1 for w in words)]  # of the blank before each word
        done = np.zeros(len(words) - WINDOW + 1, bool)  # windows known to be covered
        last: dict[tuple[int, int], int] = {}
        since, until = 0, -1  # blocks that end here need no look: the latest occurrence holds all their windows
        for end, places in self.automaton.iter(text):
            if since <= end <= until:
                continue
            after = bisect_left(begins, end)
            at = after - BLOCK
            near = done[max(0, at + BLOCK - WINDOW) : at + 1]
            if len(near) and near.all():
                continue
            for number, offset in places:
                if self.sources[number] >= doc_id or last.get((number, at - offset), -1) >= after:
                    continue
                other = self.words[number]
                left = 0
                least = min(at, offset)
                while left + STEP <= least and words[at - left - STEP : at - left] == other[offset - left - STEP : offset - left]:
                    left += STEP
                while left < least and words[at - left - 1] == other[offset - left - 1]:
                    left += 1
                right = BLOCK
                most = min(len(words) - at, len(other) - offset)
                while right + STEP <= most and words[at + right : at + right + STEP] == other[offset + right : offset + right + STEP]:
                    right += STEP
                while right < most and words[at + right] == other[offset + right]:
                    right += 1
                last[number, at - offset] = at + right
                if left + right >= WINDOW:
                    out[at - left : at + right] = True
                    done[at - left : at + right - WINDOW + 1] = True
                    since = begins[at - left + WINDOW] if left < at else 0
                    until = begins[at + right - BLOCK] if at + right < len(words) else len(text)
        return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (), in_place: bool = False) -> DataFrame:
    """(id, n_words, n_removed, kept, removed, ...): each document without the words of repeated windows.

    A word goes if it lies in a window of 13 words that also starts in a document with a smaller
    id; windows are judged on the input.  ``kept`` is the other words joined by one space,
    ``removed`` the runs of words that went, as (start, end).  Words are what ASCII white space
    separates, unchanged.  Columns named in ``carry`` come along; of others none is read.

    With ``in_place`` the text itself is ``kept``, null if it is null, without the runs that went and
    the white space after each: other lines and gaps stay as they are.

    A null or empty text has no words.  A null id counts as smaller than all others.  Rows that
    repeat an id are the same document, which cannot repeat itself; each row keeps its own text and
    columns.  No rows give no rows.
    """
    own = [F.col(f"`{c}`").alias(f"_carried_{i}") for i, c in enumerate(carry)]
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(id_col).cast("long").alias("own_id"), F.col(text_col).alias("text"), *own)
    narrow = base.select("id", "text")
    routed = _routed_passages(_candidates(narrow, _shared_anchors(narrow)))
    carried = [f"_carried_{i}" for i in range(len(carry))]

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                passages: dict[str, int] = {}
                found = part.column("found").to_pylist()
                for item in (i for f in found if f for i in f):
                    passages[item["passage"]] = min(passages.get(item["passage"], item["source"]), item["source"])
                shard = Shard(passages)
                rows = []
                for doc_id, text, mine in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), found):
                    words = text.encode("utf-8", "surrogatepass").split() if text else []
                    joined = b" ".join(words).decode("utf-8", "surrogatepass")
                    gone: list[dict] = []
                    n = len(words)
                    if mine:
                        words = joined.split(" ")
                        out = shard.covered(words, doc_id)
                        joined = " ".join([w for w, o in zip(words, out.tolist()) if not o])
                        edges = np.flatnonzero(np.diff(np.r_[False, out, False]))
                        gone = [{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]
                    if in_place:
                        joined = _without(text, gone)
                    rows.append((n, sum(g["end"] - g["start"] for g in gone), joined, gone))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))))]
                yield pa.RecordBatch.from_arrays([part.column("own_id"), *columns, *[part.column(c) for c in carried]], ["id", "n_words", "n_removed", "kept", "removed", *carried])

    schema = StructType.fromDDL("id long, n_words long, n_removed long, kept string, removed array<struct<start: int, end: int>>")
    joined = base.join(routed, "id", "left").select("id", "own_id", "text", "found", *carried)
    out = joined.mapInArrow(located, StructType([*schema.fields, *base.select(carried).schema.fields]))
    return out.withColumnsRenamed({"id": id_col} | dict(zip(carried, carry)))


def _without(text: str | None, gone: list[dict]) -> str | None:
    """The text without runs of its words and the white space after each."""
    if not gone:
        return text
    places = [m.start() for m in WORD.finditer(text)] + [len(text)]
    kept, at = [], 0
    for run in gone:
        kept.append(text[at : places[run["start"]]])
        at = places[run["end"]]
    return "".join([*kept, text[at:]])
