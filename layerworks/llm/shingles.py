"""Hashed word shingles of many texts at once."""

from __future__ import annotations

import numpy as np
import pandas as pd

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)
MIX2 = np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a finalizer of two multiplications)."""
    x = (x ^ (x >> np.uint64(30))) * MIX
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def hashed_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words end to end, and how many each text has.

    Words are runs of anything but ASCII white space, which is what splitting bytes does.
    """
    return hashes_of(split_words(texts))


def split_words(texts: list[str | None]) -> list[list[bytes]]:
    return [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]


def hashes_of(parts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """``hashed_words`` of texts that are split already."""
    sizes = np.array([len(p) for p in parts], np.int64)
    flat = np.empty(int(sizes.sum()), object)
    flat[:] = [w for p in parts for w in p]
    return (pd.util.hash_array(flat, categorize=False) if len(flat) else np.empty(0, np.uint64)), sizes


def grams(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each place on, regardless of where texts end."""
    count = len(words) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for at in range(width):
        out = mixed(out * GOLDEN + words[at : at + count])
    return out


def shingle_sets(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, end to end, and their counts.

    A text with fewer words than ``width`` has one shingle, all its words; one without words none.
    """
    words, sizes = hashed_words(texts)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.cumsum(sizes) - sizes
    all_grams = grams(words, width)
    inside = np.arange(len(words)) - starts[owner] + width <= sizes[owner]
    places = np.flatnonzero(inside)
    hashes, who = all_grams[places], owner[places]
    brief = np.flatnonzero((sizes > 0) & (sizes < width))
    if len(brief):
        extra = [grams(words[starts[i] : starts[i] + sizes[i]], int(sizes[i]))[0] + np.uint64(sizes[i]) for i in brief]
        hashes, who = np.concatenate([hashes, np.array(extra, np.uint64)]), np.concatenate([who, brief])
    order = np.lexsort((hashes, who))
    hashes, who = hashes[order], who[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (who[1:] != who[:-1])
    return hashes[first], np.bincount(who[first], minlength=len(sizes))
