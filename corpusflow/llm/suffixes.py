"""Suffixes of a shard of short texts: Burrows-Wheeler transform and bounded common prefixes.

``repeats`` marks the starts of strings of ``depth`` bytes that occur twice or more in a shard.
The suffixes are sorted as deep as ``depth`` asks. Then intervals of the transform are extended
backwards, breadth first: all strings of length ``n`` before those of ``n + 1``. Where an
extended interval ends, the two neighbouring suffixes part after ``n`` bytes, unless they are
known to part earlier; so common prefixes come out by increasing length, and the search stops at
``depth``. What is still open then are neighbours that share ``depth`` bytes or more.
Nothing here knows Spark.
"""

from __future__ import annotations

import numpy as np

# Never part of UTF-8; ends each text.
END = 255
_SEED = 8


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``depth`` bytes at least, and where ``_SEED`` bytes differ.

    Sorts by eight bytes, then by ranks of twice the length, only where ranks are still equal.
    """
    n = len(text)
    padded = np.concatenate([text, np.full(_SEED, END, np.uint8)])
    # Every eight neighbouring bytes as a number.
    key = np.ndarray(n, ">u8", padded, strides=(1,)).astype(np.uint64)
    order = np.argsort(key)
    key = key[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    seeds = new.copy()
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[order], rank[n] = head, -1
    reach = _SEED
    while reach < depth:
        last = np.ones(n, bool)
        last[:-1] = new[1:]
        tied = np.flatnonzero(~(new & last))
        if not len(tied):
            break
        at = order[tied]
        follow = rank[np.minimum(at + reach, n)] + 1
        pair, inner = _sorted_pairs(rank[at].astype(np.uint64), follow.astype(np.uint64), n)
        at = at[inner]
        order[tied] = at
        fresh = np.ones(len(tied), bool)
        fresh[1:] = pair[1:] != pair[:-1]
        new[tied] = fresh
        rank[at] = tied[np.maximum.accumulate(np.where(fresh, np.arange(len(tied)), 0))]
        reach *= 2
    return order, seeds


def _sorted_pairs(first: np.ndarray, second: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` pairs of numbers up to it as sorted numbers, and where each comes from."""
    bits = np.uint64(most.bit_length())
    pair = first << bits | second
    if 3 * int(bits) > 64:
        inner = np.argsort(pair)
        return pair[inner], inner
    # Numbers that hold their places sort much faster than places do.
    pair = pair << bits | np.arange(len(pair), dtype=np.uint64)
    pair.sort()
    return pair >> bits, (pair & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def parted(text: np.ndarray, order: np.ndarray, seeds: np.ndarray, depth: int) -> np.ndarray:
    """Marks the suffixes that share fewer than ``depth`` bytes with the one before."""
    n = len(text)
    before = text[order - 1]  # the transform; a text's first byte follows another's end
    stable = np.argsort(before, kind="stable")
    back = np.empty(n, np.int32)  # where a suffix lies once its preceding byte is put before it
    back[stable] = np.arange(n, dtype=np.int32)
    same = before[stable][1:] == before[stable][:-1]
    after, prior = np.full(n, n, np.int32), np.full(n, -1, np.int32)
    after[stable[:-1][same]] = stable[1:][same]
    prior[stable[1:][same]] = stable[:-1][same]
    known = np.append(seeds, True)
    low = np.flatnonzero(seeds)
    high = np.append(low[1:], n) - 1
    for _ in range(_SEED, depth):
        size = high - low + 1
        ends = np.cumsum(size)
        place = np.arange(ends[-1]) + np.repeat(low - (ends - size), size)
        # Of each byte before an interval's suffixes: its first and its last occurrence there.
        first = back[place[prior[place] < np.repeat(low, size)]]
        last = back[place[after[place] > np.repeat(high, size)]]
        first.sort()
        last.sort()
        fresh = ~known[last + 1]
        low, high = first[fresh], last[fresh]
        if not len(low):
            break
        known[high + 1] = True
    return known[:n]


def repeats(texts: list[bytes], weights: np.ndarray, depth: int) -> list[np.ndarray]:
    """For each text, which of its starts begin a string of ``depth`` bytes that occurs twice.

    A text of weight two or more occurs that often itself. Texts have at least ``depth`` bytes.
    """
    sizes = np.array([len(t) + 1 for t in texts])
    text = np.frombuffer(b"".join(t + b"\xff" for t in texts), np.uint8)
    order, seeds = suffix_order(text, depth)
    group = np.cumsum(parted(text, order, seeds, depth)) - 1
    begin = np.concatenate([[0], np.cumsum(sizes)])
    starts = np.zeros(len(text), np.int64)  # how often a start occurs; 0 where none fits
    for b, e, w in zip(begin, begin[1:], weights):
        starts[b : e - depth] = w
    times = np.bincount(group, weights=starts[order])
    often = np.zeros(len(text), bool)
    often[order] = times[group] >= 2
    return [often[b : e - depth] for b, e in zip(begin, begin[1:])]
