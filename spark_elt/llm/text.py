"""Vectorised helpers over the text buffers of Arrow batches.

Every operator that runs Python gets its texts as Arrow string arrays and works on
their UTF-8 bytes with numpy: words are found with a 256-entry byte table (all
separators are ASCII, so bytes and code points give the same words), and their
64-bit hashes come from prefix sums of a polynomial, so no Python string is made per
word. Temporary arrays are bounded by working through a batch in slices of about
``SLICE`` bytes; a longer text is a slice of its own, and its words are hashed in
segments of ``SEGMENT`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
SEGMENT = 1 << 17

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the byte values in any of the inclusive ranges."""
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


#: Words split at ASCII white space: [^\x20\x09-\x0D]+
SPACED = ~byte_table((0x09, 0x0D), (0x20, 0x20))
#: Words of ASCII digits and letters and all non-ASCII characters.
ALNUM = byte_table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the offsets of its values (nulls: empty)."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64) if len(at) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of values of about ``limit`` bytes each; a longer value stands alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi
        lo = hi


def find_words(raw: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and the index of the first word of each value (one more entry
    than values). Words end where a value ends."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = in_word[raw]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cuts = offsets[(offsets > 0) & (offsets < len(raw))]
    begins[cuts] |= inside[cuts + 1]
    ends[cuts - 1] |= inside[cuts]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on the input."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _BASE, np.uint64)
    down = np.full(n, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans (sorted by start and by end)."""
    if not _POWERS:
        _POWERS.append(_powers(SEGMENT + 1))
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + SEGMENT, "right")))
        piece = raw[base : int(ends[j - 1])]
        up, down = _POWERS[0] if len(piece) <= SEGMENT else _powers(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * up[: len(piece)], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        i = j
    return mix(out)


def hash_shingles(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``k``-word shingles of each value and the index of the first one
    of each value. A value of fewer words, but some, has its whole sequence as one."""
    counts = np.diff(first)
    n = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    at = np.concatenate([[0], np.cumsum(n)])
    begin = np.repeat(first[:-1], n) + np.arange(at[-1]) - np.repeat(at[:-1], n)
    size = np.repeat(np.minimum(counts, k), n)
    out = size.astype(np.uint64)
    for step in range(k):
        here = np.flatnonzero(size > step) if len(size) and size.min() < k else slice(None)
        part = out[here] * np.uint64(0xFF51AFD7ED558CCD) + words[begin[here] + step]
        out[here] = mix(part)
    return out, at


def shingle_sets(column: pa.Array, k: int, in_word: np.ndarray = SPACED) -> Iterator[np.ndarray]:
    """For each value its sorted distinct shingle hashes (A-Z lowered)."""
    yield from shingle_sets_of(*buffers(column), k, in_word)


def shingle_sets_of(raw: np.ndarray, offsets: np.ndarray, k: int, in_word: np.ndarray = SPACED) -> Iterator[np.ndarray]:
    """``shingle_sets`` over bytes and offsets."""
    for lo, hi in slices(offsets):
        at = offsets[lo : hi + 1] - offsets[lo]
        part = LOWER[raw[offsets[lo] : offsets[hi]]]
        starts, ends, first = find_words(part, at, in_word)
        hashes, cut = hash_shingles(hash_spans(part, starts, ends), first, k)
        for i in range(hi - lo):
            yield np.unique(hashes[cut[i] : cut[i + 1]])


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """Arrow lists from numpy arrays."""
    ends = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))

