"""Toxic spans by a linear-chain conditional random field.

Tokens carry one of two tags, clean or toxic.  Documents are labelled, tokens are not: in the
training sample a token of a toxic document is tagged toxic if its word, or the word's beginning,
is found far more often in toxic documents than in clean ones.  The field has a weight for each
word, for its first four and five characters, and for each pair of neighbouring tags.  Marginals by
forward and backward sums give spans; their sum over a document, calibrated on the sample's labels,
gives its score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerworks.llm.common import stored, text_slices

TOKEN = re.compile(r"\S+")
EDGE = re.compile(r"^\W+|\W+$")
BUCKETS = 1 << 18
BLOCK = 32
STRETCH = 64
#: Weight of a feature before it is learned, and of one never seen: evidence against the toxic tag.
UNSEEN = -2.0
FLOOR = 0.1
CACHE_WORDS = 400_000


def features(word: str) -> list[int]:
    """Hashed features of a token: the bare word and its beginnings."""
    bare = EDGE.sub("", word.lower()) or word
    parts = ["w" + bare, "4" + bare[:4] if len(bare) > 4 else "s" + bare, "5" + bare[:5] if len(bare) > 5 else "s" + bare]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts]


@dataclass
class Model:
    """Weights of the toxic tag, of tag pairs and of the first tag, and the calibration of scores."""

    weights: np.ndarray
    pairs: np.ndarray
    first: np.ndarray
    slope: float
    offset: float


# ---- the chain ----------------------------------------------------------------------------------


def chain(emission: np.ndarray, sizes: np.ndarray, pairs: np.ndarray, first: np.ndarray, with_pairs: bool = False) -> tuple:
    """Marginals of the toxic tag for all tokens of documents laid end to end.

    Documents are cut into blocks of ``BLOCK`` tokens.  The two by two products of all blocks are
    made at once, a short pass over blocks joins them per document, and a second pass over all
    blocks at once gives the sums inside: no loop over tokens, however long a document is.
    Returns the marginals, and the expected tag pairs if asked for.  Documents must have a token.
    """
    blocks = -(-sizes // BLOCK)
    first_block = np.concatenate([[0], np.cumsum(blocks)])
    total = int(first_block[-1])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    # Place of each token: its block, and its place in it.
    inside = np.arange(len(emission)) - np.repeat(starts, sizes)
    row = np.repeat(first_block[:-1], sizes) + inside // BLOCK
    column = inside % BLOCK
    local = np.zeros((total, BLOCK, 2))
    local[row, column, 1] = emission
    real = np.zeros((total, BLOCK), bool)
    real[row, column] = True
    top = local.max(axis=2, keepdims=True)
    factor = np.exp(local - top)
    matrix = np.exp(pairs - pairs.max())
    entry = np.exp(first - first.max())
    head = first_block[:-1]

    def step(vector: np.ndarray, at: int) -> np.ndarray:
        """Move a row vector per block over place ``at``; the document's first token has no pair before it."""
        moved = vector @ matrix * factor[:, at]
        if at == 0:
            moved[head] = vector[head] * factor[head, 0]
        moved = np.where(real[:, at, None], moved, vector)
        return moved / moved.sum(axis=1, keepdims=True)

    product = np.broadcast_to(np.eye(2), (total, 2, 2)).copy()
    for at in range(BLOCK):
        moved = (product @ matrix) * factor[:, at, None, :]
        if at == 0:
            moved[head] = product[head] * factor[head, 0][:, None, :]
        moved = np.where(real[:, at, None, None], moved, product)
        product = moved / moved.sum(axis=(1, 2), keepdims=True)
    ahead = np.empty((total, 2))
    behind = np.empty((total, 2))
    now = np.tile(entry / entry.sum(), (len(sizes), 1))
    back = np.ones((len(sizes), 2)) / 2
    longest = int(blocks.max())
    by_size = np.argsort(-blocks, kind="stable")
    counts = np.searchsorted(-blocks[by_size], -np.arange(longest), side="left")
    for number in range(longest):  # documents that have a block of this number
        docs = by_size[: counts[number]]
        at = head[docs] + number
        ahead[at] = now[docs]
        moved = np.einsum("ni,nij->nj", now[docs], product[at])
        now[docs] = moved / moved.sum(axis=1, keepdims=True)
        at = head[docs] + blocks[docs] - 1 - number
        behind[at] = back[docs]
        moved = np.einsum("nij,nj->ni", product[at], back[docs])
        back[docs] = moved / moved.sum(axis=1, keepdims=True)
    alpha = np.empty((total, BLOCK, 2))
    for at in range(BLOCK):
        ahead = step(ahead, at)
        alpha[:, at] = ahead
    beta = np.empty((total, BLOCK, 2))
    carried = behind
    for at in range(BLOCK - 1, -1, -1):
        beta[:, at] = carried
        moved = (carried * factor[:, at]) @ matrix.T
        if at == 0:
            moved[head] = carried[head] * factor[head, 0]
        moved = np.where(real[:, at, None], moved, carried)
        carried = moved / moved.sum(axis=1, keepdims=True)
    both = alpha * beta
    toxic = (both[..., 1] / both.sum(axis=2))[row, column]
    if not with_pairs:
        return toxic, None
    a, b, f = alpha[row, column], beta[row, column], factor[row, column]
    later = np.flatnonzero(inside > 0)
    joint = a[later - 1][:, :, None] * matrix[None] * (f[later] * b[later])[:, None, :]
    joint /= joint.sum(axis=(1, 2), keepdims=True)
    return toxic, joint.sum(axis=0)


# ---- training -----------------------------------------------------------------------------------


def _typical(documents: list[np.ndarray], of_word: np.ndarray, toxic: np.ndarray, count: int) -> np.ndarray:
    """Which features tell toxic documents: far more of them have it than of the clean ones."""
    hits = np.zeros((2, count))
    for words, label in zip(documents, toxic):
        hits[label, np.unique(of_word[words])] += 1
    rows = np.array([max(1, int((toxic == label).sum())) for label in (0, 1)])
    share = (hits + 0.5) / (rows + 1)[:, None]
    spread = np.sqrt(share[0] / rows[0] + share[1] / rows[1])
    least = 1.4 * np.log10(max(10, rows[1]))  # large samples hold more words, so more chance finds
    typical = (hits[1] >= 3) & (share[1] > 10 * share[0]) & (share[1] - share[0] > least * spread)
    return typical


def _without_copies(documents: list[np.ndarray]) -> list[int]:
    """Places of documents that are no near copies of earlier ones: words that copies share are no evidence.

    Eight minima of hashed three-word shingles are compared; four equal ones make a copy.
    """
    rng = np.random.default_rng(0)
    odd = rng.integers(1 << 20, 1 << 62, (8, 1), dtype=np.uint64) | np.uint64(1)
    seen: dict[tuple[int, int], list[int]] = {}
    kept = []
    for place, words in enumerate(documents):
        w = words.astype(np.uint64) + np.uint64(1)
        w = np.concatenate([w, np.zeros(max(0, 3 - len(w)), np.uint64)])
        mixed = (w[:-2] * np.uint64(0x9E3779B97F4A7C15) + w[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + w[2:]
        minima = ((mixed[None] ^ (mixed[None] >> np.uint64(31))) * odd).min(axis=1).tolist()
        equal: dict[int, int] = {}
        for key in enumerate(minima):
            for other in seen.get(key, ()):
                equal[other] = equal.get(other, 0) + 1
        if max(equal.values(), default=0) < 4:
            kept.append(place)
            for key in enumerate(minima):
                seen.setdefault(key, []).append(place)
    return kept


def fit(texts: list[str], labels: list[int], steps: int = 40, rate: float = 0.3, penalty: float = 1e-4) -> Model:
    """Train the field on documents in memory (Adam on the likelihood of the tags), then the calibration.

    The weights are learned from stretches of the documents: all that have a toxic tag, and some of
    the others.  The calibration sees the whole documents.
    """
    numbers: dict[str, int] = {}
    documents, toxic = [], []
    for text, label in zip(texts, labels):
        words = text.split()
        if words:
            documents.append(np.array([numbers.setdefault(w, len(numbers)) for w in words]))
            toxic.append(int(label))
    weights, pairs, first = np.full(BUCKETS, UNSEEN), np.zeros((2, 2)), np.zeros(2)
    if not documents or not any(toxic):
        return Model(weights, pairs, first, 1.0, -3.0)
    own = _without_copies(documents)
    documents, toxic = [documents[i] for i in own], np.array(toxic)[own]
    used, of_word = np.unique(np.array([features(w) for w in numbers]), return_inverse=True)
    of_word = of_word.reshape(-1, 3)
    typical = _typical(documents, of_word, toxic, len(used))[of_word].any(axis=1)
    stretches = [(d, at) for d, words in enumerate(documents) for at in range(0, len(words), STRETCH)]
    stretches = [(d, at) for n, (d, at) in enumerate(stretches) if n % 20 == 0 or toxic[d] and typical[documents[d][at : at + STRETCH]].any()]
    parts = [documents[d][at : at + STRETCH] for d, at in stretches]
    sizes = np.array([len(p) for p in parts])
    words = np.concatenate(parts)
    tags = (typical[words] & np.repeat([bool(toxic[d]) for d, _ in stretches], sizes)).astype(float)
    ids = of_word[words]
    head = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    follows = np.ones(len(tags), bool)
    follows[head] = False
    places = np.flatnonzero(follows)
    seen_pairs = np.zeros((2, 2))
    np.add.at(seen_pairs, (tags[places - 1].astype(int), tags[places].astype(int)), 1)
    seen_first = np.array([(tags[head] == 0).sum(), tags[head].sum()], float)
    theta = np.zeros(len(used) + 6)
    moment, square = np.zeros_like(theta), np.zeros_like(theta)
    theta[: len(used)] = UNSEEN
    for number in range(1, steps + 1):
        weight, pairs, first = theta[: len(used)], theta[-6:-2].reshape(2, 2), theta[-2:]
        marginal, joint = chain(weight[ids].sum(axis=1), sizes, pairs, first, with_pairs=True)
        slope = np.zeros_like(theta)
        slope[: len(used)] = np.bincount(ids.ravel(), weights=np.repeat(tags - marginal, 3), minlength=len(used))
        slope[-6:-2] = (seen_pairs - joint).ravel()
        expected = marginal[head].sum()
        slope[-2:] = seen_first - [len(head) - expected, expected]
        slope /= len(sizes)
        slope[: len(used)] -= penalty * (theta[: len(used)] - UNSEEN)
        moment = 0.9 * moment + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        theta = theta + rate * (moment / (1 - 0.9**number)) / (np.sqrt(square / (1 - 0.99**number)) + 1e-6)
    weights[used] = theta[: len(used)]
    pairs, first = theta[-6:-2].reshape(2, 2).copy(), theta[-2:].copy()
    emission = theta[: len(used)][of_word].sum(axis=1)
    evidence = np.zeros(len(documents))
    for at in range(0, len(documents), 500):
        some = documents[at : at + 500]
        sizes = np.array([len(d) for d in some])
        marginal, _ = chain(emission[np.concatenate(some)], sizes, pairs, first)
        evidence[at : at + 500] = _evidence(marginal, np.concatenate([[0], np.cumsum(sizes)[:-1]]))
    slope, offset = _calibrated(evidence, toxic)
    return Model(weights, pairs, first, slope, offset)


def _evidence(marginal: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Of each document: toxic tokens expected, on a log scale.  Small chances of many tokens don't add up."""
    return np.log(np.add.reduceat(np.maximum(marginal - FLOOR, 0), head) + 0.01)


def _calibrated(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one value by Newton steps, slightly held back."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.eye(2) * 0.05
        theta = theta + np.linalg.solve(hessian, design.T @ (y - p) - 0.05 * theta)
    return float(theta[0]), float(theta[1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = 2500) -> Model:
    """Fit on a bounded sample: about ``sample`` documents of either label, by a hash of the id.

    A document with several labels is toxic if one of them is; null labels and texts are left out.
    The sample is fitted in one task, which returns the weights.
    """
    marks = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_doc")).agg(F.max(F.col(label_col).cast("int")).alias("_label"))
    rows = {r["_label"]: r["n"] for r in marks.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = F.pmod(F.xxhash64("_doc"), F.lit(1 << 20)) / (1 << 20)
    limit = F.when(F.col("_label") == 1, min(1.0, sample / max(1, rows.get(1, 0)))).otherwise(min(1.0, sample / max(1, rows.get(0, 0))))
    chosen = stored(marks.where(place < limit), "toxicity-sample")
    # The ids of the sample are few by its bound, which is checked: then the texts need not move.
    few = chosen.count() <= 4 * sample
    both = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).where(F.col("_text").isNotNull()).join(F.broadcast(chosen) if few else chosen, "_doc")

    def fitted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = pd.concat([f for f in frames] or [pd.DataFrame({"_doc": [], "_text": [], "_label": []})]).sort_values(["_doc", "_text"])
        model = fit(whole["_text"].tolist(), whole["_label"].astype(int).tolist())
        packed = np.concatenate([model.weights, model.pairs.ravel(), model.first, [model.slope, model.offset]])
        yield pd.DataFrame({"model": [packed.astype("<f8").tobytes()]})

    found = both.repartition(1).mapInPandas(fitted, "model binary").first()
    if found is None:  # no labelled text, so no task ran
        return fit([], [])
    data = np.frombuffer(bytes(found["model"]), "<f8")
    weights, rest = data[:BUCKETS], data[BUCKETS:]
    return Model(weights, rest[:4].reshape(2, 2), rest[4:6], float(rest[6]), float(rest[7]))


# ---- scoring ------------------------------------------------------------------------------------


class Scorer:
    """Scores of texts; a word's weight is remembered within bounds."""

    def __init__(self, model: Model):
        self.model = model
        self.memory: dict[str, float] = {}

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[dict]]]:
        model = self.model
        words = [t.split() if t else [] for t in texts]
        flat = [w for ws in words for w in ws]
        if len(self.memory) > CACHE_WORDS:
            self.memory = {}
        wanted = list(set(flat).difference(self.memory))
        if wanted:
            ids = np.array([features(w) for w in wanted])
            self.memory.update(zip(wanted, model.weights[ids].sum(axis=1).tolist()))
        emission = np.fromiter(map(self.memory.__getitem__, flat), float, len(flat))
        sizes = np.array([len(ws) for ws in words])
        evidence = np.full(len(texts), np.log(0.01))
        spans: list[list[dict]] = [[] for _ in texts]
        used = np.flatnonzero(sizes)
        if len(used):
            marginal, _ = chain(emission, sizes[used], model.pairs, model.first)
            head = np.concatenate([[0], np.cumsum(sizes[used])[:-1]])
            evidence[used] = _evidence(marginal, head)
            hot = np.maximum.reduceat(marginal, head) >= 0.5
            for place in np.flatnonzero(hot):
                number = int(used[place])
                spans[number] = _spans(texts[number], marginal[head[place] : head[place] + sizes[number]])
        value = model.slope * evidence + model.offset
        return 1 / (1 + np.exp(-np.clip(value, -30, 30))), spans


def _spans(text: str, marginal: np.ndarray) -> list[dict]:
    """Runs of toxic tokens as character offsets, with the highest marginal of each."""
    out: list[dict] = []
    last = -2
    for number, (found, chance) in enumerate(zip(TOKEN.finditer(text), marginal.tolist())):
        if chance >= 0.5:
            if number == last + 1:
                out[-1]["end"], out[-1]["chance"] = found.end(), max(out[-1]["chance"], chance)
            else:
                out.append({"start": found.start(), "end": found.end(), "chance": chance})
            last = number
    return out


def tag(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) and ``spans`` (start, end, chance; offsets in characters) to every row.

    A null or empty text has no spans and the score of no evidence.  Columns of these names are
    replaced, others stay; no rows give no rows; equal texts get equal scores.
    """
    from pyspark.sql.types import StructType

    base = docs.drop("score", "spans")
    added = StructType.fromDDL("score double, spans array<struct<start: int, end: int, chance: double>>")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("chance", pa.float64())]))
    sent = base.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights

    def tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            for part in text_slices(batch, text_col):
                scores, spans = scorer.score(part.column(text_col).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores), pa.array(spans, kind)], [*part.schema.names, "score", "spans"])

    return base.mapInArrow(tagged, StructType([*base.schema.fields, *added.fields]))
