"""Vectorised text helpers for tasks that get Arrow batches.

Words are runs of bytes other than ASCII white space, as in ``[^\\x20\\x09-\\x0D]+``.
A null text counts as an empty one.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SLICE_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library than glibc
    _trim = None


def give_back() -> None:
    """Return memory that Arrow and the C library hold but do not use; tasks after this one share the process, and those of
    other stages the executor, of whose memory every idle worker holds a part."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into row ranges of about ``limit`` bytes of text; one long text is never cut."""
    n = batch.num_rows
    if not n:
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < n:
        done = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, done + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to
    give_back()


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the offset of each, with the end."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in ``data``, and each text's first word, with the end."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    ink = ~SPACE[data]
    border = np.zeros(len(data) + 1, dtype=bool)
    border[offsets] = True
    start = ink.copy()
    start[1:] &= ~ink[:-1] | border[1:-1]
    end = ink
    end[:-1] &= ~ink[1:] | border[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n + 1:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            x = np.full(max(n + 1, SLICE_BYTES * 2), base, dtype=np.uint64)
            x[0] = 1
            _powers[name] = np.multiply.accumulate(x)
    return _powers["up"], _powers["down"]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of bytes; equal bytes have equal hashes wherever they stand."""
    up, down = _power(len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of 64-bit values, in their order."""
    up, down = _power(len(values))
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(hashes: np.ndarray, firsts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``k`` words of each text, and each text's first, with the end.

    A text of fewer words has one run, its whole sequence; an empty one has none.
    """
    n = len(hashes)
    lengths = np.diff(firsts)
    if not n:
        return hashes, np.zeros(len(firsts), np.int64)
    rolled = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        part = np.zeros(n, dtype=np.uint64)
        part[: n - j] = hashes[j:]
        reach = np.arange(n) + j < np.repeat(firsts[1:], lengths)
        rolled = np.where(reach, mix(rolled * np.uint64(3) + part + np.uint64(j + 1)), rolled)
    counts = np.where(lengths == 0, 0, np.maximum(1, lengths - k + 1))
    keep = np.arange(n) - np.repeat(firsts[:-1], lengths) < np.repeat(counts, lengths)
    return rolled[keep], np.concatenate([[0], np.cumsum(counts)])


def utf8_positions(data: np.ndarray) -> np.ndarray:
    """For each byte offset, the number of code points before it."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
