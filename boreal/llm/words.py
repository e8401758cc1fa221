"""Hashes of the words of a text: words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z only."""

from __future__ import annotations

import numpy as np

#: Multiplier of the 64-bit FNV hash; increment and multipliers of SplitMix64 (fixed values).
BASE = np.uint64(0x100000001B3)
GOLDEN, MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
PART = 1 << 22


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two, in order."""
    return mix((a ^ GOLDEN) * MIX2 + b)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word in the text's bytes."""
    inside = np.empty(len(data) + 2, np.int8)
    inside[0] = inside[-1] = 0
    np.logical_not(SPACE[data], out=inside[1:-1].view(bool))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def _hashes(data: np.ndarray) -> np.ndarray:
    begin, end = word_spans(data)
    if not len(begin):
        return np.empty(0, np.uint64)
    length = end - begin
    offset = np.cumsum(length) - length
    at = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(offset, length)
    power = np.cumprod(np.full(int(length.max()), BASE, np.uint64))
    letters = data[~SPACE[data]].astype(np.uint64) + np.uint64(1)
    letters *= power[at]
    return mix(np.add.reduceat(letters, offset) + length.astype(np.uint64) * GOLDEN)


def word_hashes(text: str | bytes) -> np.ndarray:
    """64-bit hashes of the words in order; a long text is read in parts that end at white space."""
    data = np.frombuffer((text.encode() if isinstance(text, str) else text).lower(), np.uint8)
    if len(data) <= PART:
        return _hashes(data)
    out, begin = [], 0
    while begin < len(data):
        end = min(begin + PART, len(data))
        while end < len(data) and not SPACE[data[end - 1]]:
            gap = np.flatnonzero(SPACE[data[end:end + PART]])
            end = end + int(gap[0]) + 1 if len(gap) else min(end + PART, len(data))
        out.append(_hashes(data[begin:end]))
        begin = end
    return np.concatenate(out)


def block_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of all texts in order, and the number of words of each text."""
    if len(texts) == 1:
        words = word_hashes(texts[0])
        return words, np.array([len(words)])
    parts = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join(parts).lower(), np.uint8)
    first = np.cumsum([0] + [len(p) + 1 for p in parts])
    return _hashes(data), np.diff(np.searchsorted(word_spans(data)[0], first))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of ``size`` words in a row; of all words, if there are fewer."""
    if not len(words):
        return words
    size = min(size, len(words))
    grams = words[:len(words) - size + 1].copy()
    for k in range(1, size):
        grams = pair(grams, words[k:len(words) - size + 1 + k])
    return np.unique(grams)
