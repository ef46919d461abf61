"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary.  A word's
probability is the sum over all ways to cut it into pieces, by the forward algorithm; a text's is
the product over its words.  The probabilities are learned by expectation maximisation: expected
piece counts by forward and backward sums over the distinct words of a sample, one Spark job an
iteration.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerworks.llm.common import forget_others, stored, text_slices

WORD = re.compile(r"[^\W\d_]+")
WORD_START = "▁"
LONG = 48  # characters above which a word is scored by itself, with another scale
#: Factor per character that keeps sums inside the range of doubles: no piece is likelier than one, so
#: 49 characters stay below 1e294, and pieces of a chance of 1e-12 or more per character above it.
SCALE = 1e6
#: Characters of the vocabulary's longest piece at most.
LONGEST = 64
CACHE_WORDS = 300_000
UNKNOWN = "und"


@lru_cache(maxsize=2)
def pieces(path: str) -> tuple[dict[str, int], int]:
    """Pieces of the vocabulary to numbers, and how many there are.

    Bytes, control and unknown pieces are left out; the number after the last stands for any
    character that is no piece.  Beginnings of pieces that are none themselves have -1, so that a
    search can stop where nothing longer is known.
    """
    forget_others(pieces)
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    own = {p: n for n, p in enumerate(sorted({p.lower() for p in plain}))}
    begun = {p[:size]: -1 for p in own for size in range(1, len(p))}
    return begun | own, len(own)


def lattice(words: list[str], known: dict[str, int], count: int) -> tuple[np.ndarray, ...]:
    """All pieces of all words, of up to ``LONG`` characters: (word, start, end, piece), by ends, then words."""
    edges: list[int] = []
    add, get = edges.append, known.get
    for number, word in enumerate(words):
        text = WORD_START + word
        size = len(text)
        mark = number << 24
        for start in range(size):
            place = mark + (start << 18)
            for end in range(start + 1, size + 1):
                piece = get(text[start:end])
                if piece is None or piece < 0:
                    if end == start + 1:
                        add((end << 40) + place + count)
                    if piece is None:
                        break
                else:
                    add((end << 40) + place + piece)
    table = np.sort(np.array(edges, np.int64))
    return (table >> 24) & 0xFFFF, (table >> 18) & 63, table >> 40, table & 0x3FFFF


def _bounds(ends: np.ndarray, last: int) -> np.ndarray:
    return np.searchsorted(ends, np.arange(last + 2))


def forward(words: list[str], table: np.ndarray, known: dict[str, int], count: int) -> np.ndarray:
    """log of the summed probability of each word under each column of ``table``."""
    out = np.empty((len(words), table.shape[1]))
    short = [i for i, w in enumerate(words) if len(w) <= LONG]
    if short:
        chosen = [words[i] for i in short]
        word, start, end, piece = lattice(chosen, known, count)
        sums = _sums(len(chosen), max(map(len, chosen)) + 1, word, start, end, table[piece] * (SCALE ** (end - start))[:, None])
        sizes = np.array([len(w) + 1 for w in chosen])
        out[short] = np.log(sums[np.arange(len(chosen)), sizes]) - sizes[:, None] * np.log(SCALE)
    for i in set(range(len(words))).difference(short):
        out[i] = _long_word(words[i], table, known, count)
    return out


def _sums(count: int, last: int, word: np.ndarray, start: np.ndarray, end: np.ndarray, weight: np.ndarray) -> np.ndarray:
    sums = np.zeros((count, last + 1, weight.shape[1]))
    sums[:, 0] = 1
    bounds = _bounds(end, last)
    for place in range(1, last + 1):
        here = slice(bounds[place], bounds[place + 1])
        if here.start < here.stop:
            owner = word[here]  # ascending
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sums[owner[first], place] = np.add.reduceat(sums[owner, start[here]] * weight[here], first, axis=0)
    return sums


def _long_word(word: str, table: np.ndarray, known: dict[str, int], count: int) -> np.ndarray:
    """The same sums for one word of any length, as logarithms; the last few are kept."""
    text = WORD_START + word
    recent = [np.zeros(table.shape[1])]
    for end in range(1, len(text) + 1):
        ways = []
        for back in range(1, min(LONGEST, end) + 1):
            piece = known.get(text[end - back : end], -1)
            if piece < 0 and back == 1:
                piece = count
            if piece >= 0:
                ways.append(recent[-back] + np.log(table[piece]))
        recent = [*recent[-(LONGEST - 1) :], np.logaddexp.reduce(ways, axis=0)]
    return recent[-1]


def expected_counts(words: list[str], times: np.ndarray, weights: np.ndarray, known: dict[str, int], count: int) -> np.ndarray:
    """Expected number of each piece in the words under one language's probabilities."""
    word, start, end, piece = lattice(words, known, count)
    weight = weights[piece] * SCALE ** (end - start)  # the factors cancel in the shares
    last = max(map(len, words)) + 1
    ahead = _sums(len(words), last, word, start, end, weight[:, None])[:, :, 0]
    sizes = np.array([len(w) + 1 for w in words])
    behind = np.zeros((len(words), last + 1))
    behind[np.arange(len(words)), sizes] = 1
    bounds = _bounds(end, last)
    for place in range(last, 0, -1):  # all that ends later is summed before
        here = slice(bounds[place], bounds[place + 1])
        if here.start < here.stop:
            np.add.at(behind, (word[here], start[here]), behind[word[here], place] * weight[here])
    total = ahead[np.arange(len(words)), sizes]
    share = ahead[word, start] * weight * behind[word, end] / total[word] * times[word]
    return np.bincount(piece, weights=share, minlength=count + 1)


@dataclass
class Model:
    """Languages, their piece probabilities (a column each) and shares of the training rows."""

    path: str
    languages: list[str]
    table: np.ndarray
    shares: np.ndarray


def train(
    labelled: DataFrame, path: str, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
    sample_per_language: int = 600, iterations: int = 3, smoothing: float = 0.05, max_languages: int = 500,
) -> Model:
    """Learn from labelled rows; rows without a language or text teach nothing.

    The sample is bounded: about ``sample_per_language`` documents each, chosen by a hash of the id.
    Its words of more than ``LONG`` letters teach nothing.
    What reaches the driver is a number per piece and language.  Without labelled rows the model
    has no language and calls every text undetermined.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    shares = rows.groupBy(F.col(lang_col).alias("_lang")).agg(F.count(F.lit(1)).alias("_rows")).limit(max_languages + 1).collect()
    if len(shares) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    shares = {r["_lang"]: r["_rows"] for r in sorted(shares, key=lambda r: r["_lang"])}
    known, count = pieces(path)
    languages = list(shares)
    table = np.full((count + 1, len(languages)), 1 / (count + 1))
    if not languages:
        return Model(path, [], table, np.zeros(0))
    limit = F.create_map(*[x for k, v in shares.items() for x in (F.lit(k), F.lit(min(1.0, sample_per_language / v)))])
    place = F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) / (1 << 20)
    chosen = rows.where(place < limit[F.col(lang_col)])
    words = F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(r"(\p{L}+)"), F.lit(1)))
    counts = chosen.select(F.col(lang_col).alias("lang"), words.alias("word")).where(F.length("word") <= LONG).groupBy("lang", "word").count()
    counts = stored(counts, "langid-words")
    for _ in range(iterations):
        table = _maximised(counts, path, languages, table, smoothing)
    total = sum(shares.values())
    return Model(path, languages, table, np.array([shares[x] / total for x in languages]))


def _maximised(counts: DataFrame, path: str, languages: list[str], table: np.ndarray, smoothing: float) -> np.ndarray:
    def expected(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, count = pieces(path)
        sums = np.zeros(table.shape)
        for frame in frames:
            for lang, part in frame.groupby("lang"):
                column = languages.index(lang)
                for at in range(0, len(part), 5000):
                    some = part.iloc[at : at + 5000]
                    times = some["count"].to_numpy(float)
                    sums[:, column] += expected_counts(some["word"].tolist(), times, table[:, column], known, count)
        piece, column = np.nonzero(sums)
        yield pd.DataFrame({"piece": piece, "column": column, "times": sums[piece, column]})

    found = counts.mapInPandas(expected, "piece long, column long, times double")
    rows = found.groupBy("piece", "column").agg(F.sum("times").alias("times")).toPandas()
    fresh = np.full(table.shape, smoothing)
    fresh[rows["piece"], rows["column"]] += rows["times"]
    return fresh / fresh.sum(axis=0)


class Scorer:
    """Log probabilities of words, remembered within bounds."""

    def __init__(self, model: Model):
        self.model = model
        self.known, self.count = pieces(model.path)
        self.reset()

    def reset(self) -> None:
        self.place: dict[str, int] = {}
        self.rows = np.empty((1024, len(self.model.languages)))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        found = [WORD.findall(t.lower()) if t and any(map(str.isalpha, t)) else [] for t in texts]
        flat = [w for f in found for w in f]
        wanted = set(flat).difference(self.place)
        if len(self.place) + len(wanted) > CACHE_WORDS:
            self.reset()
            wanted = set(flat)
        self._learn(sorted(wanted))
        names, scores = [], []
        sizes = np.array([len(f) for f in found])
        sums = np.zeros((len(texts), len(self.model.languages)))
        if flat:
            numbers = np.fromiter(map(self.place.__getitem__, flat), np.int64, len(flat))
            used = np.flatnonzero(sizes)
            starts = np.concatenate([[0], np.cumsum(sizes[used])[:-1]])
            sums[used] = np.add.reduceat(self.rows[numbers], starts, axis=0)
        for size, row in zip(sizes, sums):
            if not size or not self.model.languages:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            row = row + np.log(self.model.shares)
            best = int(row.argmax())
            names.append(self.model.languages[best])
            scores.append(float(1 / np.exp(row - row[best]).sum()))
        return names, scores

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), 5000):
            some = words[at : at + 5000]
            start = len(self.place)
            if start + len(some) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.empty((max(len(self.rows), len(some)), self.rows.shape[1]))])
            self.rows[start : start + len(some)] = forward(some, self.model.table, self.known, self.count)
            self.place.update(zip(some, range(start, start + len(some))))


def identify(docs: DataFrame, model: Model, text_col: str = "text", to: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Add the likeliest language of each whole text and its posterior probability.

    A text that is null or has no letter is ``und`` with score 0.  Columns of the names in ``to``
    are replaced; others stay.  Equal texts get equal answers; no rows give no rows.
    """
    base = docs.drop(*to)
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    schema = StructType([*base.schema.fields, StructField(to[0], StringType()), StructField(to[1], DoubleType())])

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            # Words are held as objects, many times the size of their text.
            for part in text_slices(batch, text_col, 1 << 20):
                names, scores = scorer.predict(part.column(text_col).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*part.schema.names, *to]
                )
        # The process stays, also for stages without Python.
        scorer = batch = part = None
        pa.default_memory_pool().release_unused()

    return base.mapInArrow(predicted, schema)


def held_out(id_col: Column, parts: int, held: int) -> Column:
    """Whether crc32 of the id as text falls on the held-out remainder."""
    from layerworks.llm.common import remainder

    return remainder(id_col, parts) == held
