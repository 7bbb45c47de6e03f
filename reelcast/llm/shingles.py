"""Word shingles of whole texts as 64-bit hashes, vectorised over blocks of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from reelcast.llm.common import SMALL_BLOCK, RollingHash, mix64, utf8_blocks

WIDTH = 5
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_HASH: list[RollingHash] = []


def _hasher() -> RollingHash:
    if not _HASH:
        _HASH.append(RollingHash(seed=20240517))
    return _HASH[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, index of each text's first word): words are runs of bytes other than ASCII white space,
    A-Z lowered; a word never crosses a text's border."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    low = _LOWER[data]
    gap = _SPACE[low]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    after_gap = np.concatenate([[True], gap[:-1]])
    before_gap = np.concatenate([gap[1:], [True]])
    starts = np.flatnonzero(~gap & (after_gap | border[:-1]))
    ends = np.flatnonzero(~gap & (before_gap | border[1:])) + 1
    h = _hasher()
    return h.spans(h.prefix(low), starts, ends), np.searchsorted(starts, offsets)


def _combine(words: np.ndarray, width: int, n: int) -> np.ndarray:
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = mix64(out + words[i:i + n] * np.uint64(0x9E3779B97F4A7C15 + 2 * i))
    return out


def text_shingles(column: pa.Array, width: int = WIDTH) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text; a text of fewer words has its whole sequence as one
    shingle, one without words none."""
    for lo, hi, data, offsets in utf8_blocks(column, SMALL_BLOCK):
        words, first = word_hashes(data, offsets)
        full = _combine(words, width, max(len(words) - width + 1, 0))
        for row in range(lo, hi):
            a, b = first[row - lo], first[row - lo + 1]
            if b - a >= width:
                yield row, np.unique(full[a:b - width + 1])
            elif b > a:
                yield row, _combine(words[a:b], int(b - a), 1)
            else:
                yield row, np.zeros(0, np.uint64)
