"""Word shingle sets as sorted arrays of 64-bit hashes, in NumPy."""

from __future__ import annotations

import numpy as np

from adlake.llm.common import SPACES, U64, mix64

_SPACE = np.zeros(256, bool)
_SPACE[[ord(c) for c in SPACES]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MULT, _STEP = U64(0x9E3779B97F4A7C15), U64(0xD1B54A32D192ED03)


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words of each text): a word is a run of bytes other
    than the six separators; its hash sums a random value for each (byte,
    place in the word)."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    sizes = np.fromiter((len(x) + 1 for x in texts), np.int64, len(texts))
    if lower:
        data = _LOWER[data]
    word = ~_SPACE[data]
    edge = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    length = stop - start
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    at = np.flatnonzero(word)
    place = (at - np.repeat(start, length)).astype(np.uint64)
    value = mix64(data[at].astype(np.uint64) * _MULT + place * _STEP + U64(1))
    first = np.cumsum(length) - length
    hashes = mix64(np.add.reduceat(value, first) + length.astype(np.uint64))
    owner = np.searchsorted(np.cumsum(sizes), start, side="right")
    return hashes, np.bincount(owner, minlength=len(texts)).astype(np.int64)


def shingle_sets(texts: list[bytes], k: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes in order, text by text; their number by text).

    A text of fewer than ``k`` words has its whole sequence as one shingle, a
    text without words none.
    """
    words, count = word_hashes(texts, lower)
    if not len(words):
        return words, count
    owner = np.repeat(np.arange(len(texts)), count)
    n = len(words) - k + 1
    value, doc = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n > 0:
        value = words[:n].copy()
        for i in range(1, k):
            value = mix64(value * _MULT + words[i : i + n])
        inside = owner[:n] == owner[k - 1 :]
        value, doc = value[inside], owner[:n][inside]
    few = np.flatnonzero((count > 0) & (count < k))
    if len(few):
        ends = np.cumsum(count)
        last = ends[few]
        short = np.zeros(len(few), np.uint64)
        for i in range(k - 1):  # the words from the last back, with the number of words as salt
            there = count[few] > i
            short[there] = mix64(short[there] * _STEP + words[last[there] - 1 - i] + count[few][there].astype(np.uint64))
        value, doc = np.concatenate([value, short]), np.concatenate([doc, few])
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.append(True, (value[1:] != value[:-1]) | (doc[1:] != doc[:-1]))
    return value[new], np.bincount(doc[new], minlength=len(texts)).astype(np.int64)
