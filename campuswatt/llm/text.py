"""Vectorised reading of UTF-8 text inside tasks: words, their hashes, and runs of words.

Everything works on one *chunk*: the bytes of some whole texts, one after the other, with
their offsets. Chunks hold about half a megabyte, so a task's memory follows the longest single
text, not the size of its partition.
"""

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

_SEED = np.random.default_rng(0x5EED)
_BYTE = _SEED.integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LOWER = _BYTE.copy()
_LOWER[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_POWERS = {}

#: Bytes that end a word of ``[^\x20\x09-\x0D]+``.
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def chunks(column, limit=CHUNK_BYTES):
    """Cut an Arrow string or binary column into (first row, offsets, bytes) of whole values; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    blank = b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else ""
    column = column.fill_null(blank)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, offsets[first:last + 1] - offsets[first], data[offsets[first]:offsets[last]]
        first = last


def mix(x):
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base, n):
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK_BYTES + 1), base, dtype=np.uint64)
        have[0] = 1
        _POWERS[int(base)] = have = np.multiply.accumulate(have)
    return have[:n]


def spans(data, offsets, blank=BLANK):
    """Start and end byte of every word, and the number of words of each text."""
    inside = ~blank[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def hashes(data, starts, ends, lower=False):
    """64-bit hash of each span; with ``lower`` A-Z count as a-z."""
    summed = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_LOWER if lower else _BYTE)[data] * _powers(_BASE, len(data)), out=summed[1:])
    value = (summed[ends] - summed[starts]) * _powers(_INVERSE, len(data) + 1)[starts]
    return mix(value ^ ((ends - starts).astype(np.uint64) * _STEP))


def windows(words, n):
    """Hash of every run of ``n`` values (``len(words) - n + 1`` of them; none if there are fewer)."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    out = words[:count].copy()
    for k in range(1, n):
        out = mix(out * _STEP + words[k:count + k])
    return out


def fold(words):
    """One hash for a whole sequence."""
    value = int(len(words))
    for w in words.tolist():
        value = ((value ^ w) * int(_BASE) + 1) % (1 << 64)
    return mix(np.array([value], dtype=np.uint64))[0]
