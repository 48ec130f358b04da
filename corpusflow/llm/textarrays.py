"""Texts of an Arrow batch as flat numpy arrays: words and word-sequence hashes.

A batch's texts lie one after another in a single byte buffer, so splitting and hashing run
over the whole batch at once. A null text counts as an empty one. Nothing here knows Spark.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The bytes that separate words.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_SEED = np.random.default_rng(20240607)
_BYTE_KEYS = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD_KEYS = _SEED.integers(1, 2**63, (2, 64), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)

# Long arrays are worked on so many values at a time where steps follow each other: a block stays
# in the processor's cache, and no step takes new memory as large as the array.
BLOCK = 2**15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    """Powers of the hash base and of its inverse, grown to the longest batch seen."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, n), _powers(_INVERSE, n)
        return cls.up[:n], cls.down[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, so that any of their bits can serve as a bucket."""
    x = np.array(x, np.uint64)
    if x.ndim != 1 or not x.flags.c_contiguous:
        return _mix(x, np.empty_like(x))
    spare = np.empty(min(BLOCK, len(x)), np.uint64)
    for at in range(0, len(x), BLOCK):
        part = x[at : at + BLOCK]
        _mix(part, spare[: len(part)])
    return x


def _mix(x: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """``mixed`` in place."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, None)):
        np.right_shift(x, np.uint64(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        if factor is not None:
            np.multiply(x, np.uint64(factor), out=x)
    return x


def kept_things() -> dict:
    """What this process keeps from task to task.

    Functions reach a worker anew with every task, so the interpreter itself holds it. Tasks of
    other operators clear it, as the worker's memory is then theirs.
    """
    return sys.__dict__.setdefault("_corpusflow_kept", {})


def handed_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; after the last, what Arrow keeps of their memory goes back to the system.

    A worker lives on after its task, beside those of the next stage.
    """
    yield from batches
    pa.default_memory_pool().release_unused()


def trimmed() -> None:
    """Gives memory that this process has freed back to the system, where the C library can.

    A worker keeps what the tasks of earlier operators freed, as nothing else asks for it.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass


def utf8(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and where each text begins (one offset more than texts)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(starts):
        starts = np.zeros(1, np.int64)
    if data is None:
        return np.zeros(0, np.uint8), starts - starts[0]
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte stays."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def words(
    data: np.ndarray, offsets: np.ndarray, letters: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the index of its first word.

    Words are runs of bytes that ``letters``, a table of 256 marks, allows: by default all but
    ``SPACES``. They never cross two texts.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    if letters is None:
        letters = np.ones(256, bool)
        letters[list(SPACES)] = False
    inside = letters[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    up, down = _Powers.to(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_KEYS[data] * up[:-1], dtype=np.uint64, out=total[1:])
    length = (ends - starts).astype(np.uint64)
    return mixed((total[ends] - total[starts]) * down[starts] + length)


def span_hashes(data: np.ndarray) -> Callable[..., np.ndarray]:
    """A function that hashes any spans of the bytes in constant time each; two lanes.

    It takes places where spans begin and end, or two slices of them with spans of one length.
    """
    up, down = _Powers.to(len(data) + 1)
    totals = []

    def lane_of(lane: int) -> np.ndarray:
        while len(totals) <= lane:
            keys = mixed(_BYTE_KEYS) if totals else _BYTE_KEYS
            total = np.empty(len(data) + 1, np.uint64)
            total[0] = 0
            for at in range(0, len(data), BLOCK):
                part = keys[data[at : at + BLOCK]]
                part *= up[at : at + len(part)]
                part[:1] += total[at]
                np.cumsum(part, out=total[at + 1 : at + 1 + len(part)])
            totals.append(total)
        return totals[lane]

    def spans(begin: np.ndarray | slice, end: np.ndarray | slice, lane: int) -> np.ndarray:
        total = lane_of(lane)
        length = np.uint64(end.start - begin.start) if isinstance(begin, slice) else (end - begin).astype(np.uint64)
        found = total[end] - total[begin]
        found *= down[begin]
        found += length
        return mixed(found)

    return spans


def run_hashes(hashes: np.ndarray, size: int, lane: int = 0) -> np.ndarray:
    """A hash of every ``size`` neighbouring values; two lanes make a 128-bit one."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(size):
        total += hashes[j : j + n] * _WORD_KEYS[lane, j]
    return mixed(total + np.uint64(size))


def runs_inside(first: np.ndarray, size: int, n: int) -> np.ndarray:
    """Marks the runs of ``size`` words that lie within one text.

    ``first`` is the index of each text's first word; ``n`` the number of all runs.
    """
    inside = np.ones(max(n, 0), bool)
    for j in range(1, size):  # a run that begins j words before a text's end leaves it
        at = first[1:] - j
        at = at[(at >= first[:-1]) & (at < n) & (at >= 0)]
        inside[at] = False
    return inside


def shingles(
    data: np.ndarray, offsets: np.ndarray, size: int = 5, lane: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """Text index and hash of every shingle; a shorter text's words make one shingle.

    The shingles come in order and may repeat. Texts without words have none.
    """
    starts, ends, first = words(data, offsets)
    hashes = word_hashes(data, starts, ends)
    counts = np.diff(first)
    runs = run_hashes(hashes, size, lane)
    inside = runs_inside(first, size, len(runs))
    text = np.repeat(np.arange(len(counts)), counts)
    owner, value = text[: len(runs)][inside], runs[inside]
    for n in range(1, size):
        at = np.flatnonzero(counts == n)
        if len(at):
            total = np.zeros(len(at), np.uint64)
            for j in range(n):
                total += hashes[first[at] + j] * _WORD_KEYS[lane, j]
            owner = np.concatenate([owner, at])
            value = np.concatenate([value, mixed(total + np.uint64(n))])
    if len(owner) > 1 and (np.diff(owner) < 0).any():
        order = np.argsort(owner, kind="stable")
        owner, value = owner[order], value[order]
    return owner, value
