"""Hashed word shingles of Arrow text arrays, all texts of an array at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WORDS = 5

_RANDOM = np.random.default_rng(9)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_PLACE = _RANDOM.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(max(n, 1), _ODD, np.uint64), dtype=np.uint64)


def sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of all texts, one text after another, and where each text's begin (n + 1 bounds).

    Words lie between ASCII white space, A-Z counts as a-z. A text of one to four words has
    one shingle; NULL and wordless texts have none.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    none = np.zeros(len(texts) + 1, np.int64)
    if len(texts) == 0 or texts.buffers()[2] is None:
        return np.empty(0, np.uint64), none
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2], np.uint8, int(bounds[-1] - bounds[0]), int(bounds[0]))
    bounds = bounds - bounds[0]
    solid = ~_SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    cut = bounds[:-1][bounds[:-1] < len(data)]
    begins[cut] |= solid[cut]
    places = np.flatnonzero(solid)
    if len(places) == 0:
        return np.empty(0, np.uint64), none
    starts = np.flatnonzero(begins)
    firsts = np.flatnonzero(begins[places])
    depth = places - np.repeat(starts, np.diff(np.append(firsts, len(places))))
    hashed = mix(np.add.reduceat(_BYTE[data[places]] * _powers(int(depth.max()) + 1)[depth], firsts))
    text_of = np.searchsorted(bounds, starts, "right") - 1
    n_words = np.bincount(text_of, minlength=len(texts))
    last = np.cumsum(n_words)  # of a text's words, plus one
    index = np.arange(len(hashed))
    full = index + WORDS <= last[text_of]
    grams = np.zeros(len(hashed), np.uint64)
    for j in range(WORDS):
        inside = index + j < last[text_of]
        grams[inside] += hashed[index[inside] + j] * _PLACE[j]
    keep = full | ((n_words[text_of] < WORDS) & (index == last[text_of] - n_words[text_of]))
    grams, owner = mix(grams[keep]), text_of[keep]
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    counts = np.bincount(owner[new], minlength=len(texts))
    return grams[new], np.concatenate((none[:1], np.cumsum(counts)))
