"""Sets of word shingles as 64-bit hashes, made in numpy over batches of texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from shelfcast.llm.substrings import _MIX, _hashed, _mixed

#: A to Z in lower case; other bytes stay.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _lowered(texts: pa.Array) -> pa.Array:
    """A batch of texts with A to Z in lower case, without what lies around it in its buffer."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or offsets[-1] == offsets[0]:
        return texts
    data = _LOWER[np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]]
    return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(offsets - offsets[0]), pa.py_buffer(data)])


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle) of the distinct shingles of each text; a text of fewer words has one of all its words."""
    words, bounds = _hashed(_lowered(texts))
    lengths = np.diff(bounds)
    many = np.where(lengths >= width, lengths - width + 1, np.minimum(lengths, 1))
    of = np.repeat(np.arange(len(lengths)), many)
    at = np.arange(len(of)) + np.repeat(bounds[:-1] - (np.cumsum(many) - many), many)
    size = np.minimum(lengths, width)[of]
    with np.errstate(over="ignore"):
        hashes = _mixed(size.astype(np.uint64))
        for j in range(width):
            on = np.flatnonzero(size > j)
            hashes[on] = _mixed(hashes[on] * _MIX[0] + words[at[on] + j])
    order = np.lexsort((hashes, of))
    of, hashes = of[order], hashes[order]
    new = np.r_[True, (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])][: len(of)]
    return of[new], hashes[new]


def set_keys(of: np.ndarray, hashes: np.ndarray, count: int) -> np.ndarray:
    """A number for each of `count` sets of shingles."""
    with np.errstate(over="ignore"):
        sums = np.zeros(count, np.uint64)
        np.add.at(sums, of, _mixed(hashes * _MIX[0]))
        return _mixed(sums * _MIX[0] + np.bincount(of, minlength=count).astype(np.uint64)).view(np.int64)
