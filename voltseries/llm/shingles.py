"""Hashed word shingles of Arrow text columns, vectorised over many documents.

A word is a run of anything but ASCII white space, with A-Z lower-cased. Word and
shingle hashes have 64 bits; two different shingles of one pair of documents share
a hash with a chance of about 1e-13 for documents of a thousand words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_PIECE = 1 << 18  # bytes of text hashed in one step, at least one document
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CODE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**64 - 1, 256, dtype=np.uint64)
_CODE[65:91] = _CODE[97:123]
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, _PIECE), _powers(_INVERSE, _PIECE)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of some documents, and the first word of each document.

    ``data`` holds the UTF-8 bytes; document i is ``data[starts[i]:starts[i + 1]]``.
    """
    n = len(data)
    word = ~_SPACE[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    edge = starts[(starts > 0) & (starts < n)]
    first[edge] = word[edge]
    last[edge - 1] = word[edge - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last)
    up, down = (_UP, _DOWN) if n <= len(_UP) else (_powers(_BASE, n), _powers(_INVERSE, n))
    total = np.cumsum(_CODE[data] * up[:n], dtype=np.uint64)
    before = np.where(begin > 0, total[begin - 1], np.uint64(0))
    hashes = (total[end] - before) * down[begin] + (end - begin).astype(np.uint64)
    return _mix(hashes), np.searchsorted(begin, starts)


def _fold(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` consecutive words."""
    n = len(hashes) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = (out ^ hashes[k : k + n]) * _ODD
        out ^= out >> np.uint64(31)
    return _mix(out)


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, in order, as signed integers.

    A text with fewer words than a shingle has its whole sequence as the only
    one; a null text or one without words has none.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i, none = 0, np.empty(0, np.int64)
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + _PIECE, "right")) - 1)
        data, starts = raw[ends[i] : ends[j]], ends[i : j + 1] - ends[i]
        if not len(data):
            yield from [none] * (j - i)
        else:
            hashes, at = word_hashes(data, starts)
            rolled = _fold(hashes, words).view(np.int64) if len(hashes) >= words else none
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                if b - a >= words:
                    yield np.unique(rolled[a : b - words + 1])
                elif b > a:
                    yield _fold(hashes[a:b], b - a).view(np.int64)
                else:
                    yield none
        i = j


def list_array(parts: list[np.ndarray]) -> pa.Array:
    """An Arrow list<int64> column from one array per row."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))
