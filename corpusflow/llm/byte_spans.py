"""Exact deduplication of long byte strings through a Burrows-Wheeler transform.

Every byte that a string of ``length`` bytes covers is removed if that string also starts
anywhere else, in the same document or another; strings never cross documents, and all are
judged on the input.

A corpus has no suffix array of its own that could be sorted in one place, so strings are first
dealt to shards by what they hold: the anchor of a string is its smallest hash of ``anchor``
neighbouring bytes, so equal strings have equal anchors. Starts in a row with one anchor make a
context: its bytes hold all their strings.

1. A sketch over all chunks tells which anchors may occur twice; contexts of others are done.
2. Chunks send their remaining contexts as digests. Equal contexts are counted together, and one
   chunk of those that have a context is named to send its bytes.
3. Each shard builds the transform of its distinct contexts and extends intervals backwards to
   find all strings of ``length`` bytes that occur twice (see ``suffixes``). Contexts that occur
   more than once weigh so much. Shards work through anchors in batches of ``BATCH_BYTES``.
4. An anchor with over ``MOST_CONTEXTS`` distinct contexts (a phrase in very many
   surroundings) would not fit one shard: its strings are grouped by their own 128-bit digests,
   spread over all shards, which is as exact and bounded by nothing.
5. Each chunk removes what its answers mark.

Defined results: a null or empty text has no bytes and nothing is removed; shorter texts than
``length`` stay whole. Repeated rows are separate texts, so their long strings repeat. The rest
is given as bytes, as a cut may split a character. Null ids come back null. An empty table gives
an empty result. Only the id and text column are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.rounds import (
    LAST_ID,
    Sketch,
    ask,
    by_slice,
    chunked,
    pack_bits,
    reply,
    text_bytes,
    unpack_bits,
)
from corpusflow.llm.suffixes import repeats
from corpusflow.llm.textarrays import BLOCK, mixed, span_hashes, utf8

ANCHOR = 100
MOST_CONTEXTS = 4096
# Hashes of every byte position and suffix arrays take far more memory than the bytes.
BATCH_BYTES = 1_000_000
CHUNK_BYTES = 2_000_000
SLICE_BYTES = 4_000_000

# What a chunk learns of a context.
_DONE, _SEND, _WAIT, _SPREAD = 0, 1, 2, 3
# How a message begins that holds contexts of a shard, or digests of strings.
_SHARD, _STRINGS = b"c", b"s"
_CONTEXT = np.dtype(
    [("anchor", "<u8"), ("high", "<u8"), ("low", "<u8"), ("count", "<u4"), ("size", "<u4")]
)


class _Contexts:
    """The contexts of a chunk's texts, and the distinct ones in order."""

    def __init__(self, chunk: pa.Table, length: int, anchor: int):
        self.length = length
        self.data, self.offsets = utf8(chunk.column("text"))
        n, width = len(self.data), length - anchor + 1
        fits = np.zeros(n + 1, np.int32)
        long = np.diff(self.offsets) >= length
        np.add.at(fits, self.offsets[:-1][long], 1)
        np.add.at(fits, self.offsets[1:][long] - length + 1, -1)
        starts = np.flatnonzero(np.cumsum(fits[:-1]))
        if not len(starts):
            self.begin = self.end = np.zeros(0, np.int64)
            self.distinct, self.place = np.zeros(0, _CONTEXT), np.zeros(0, np.int64)
            return
        self._span = span_hashes(self.data)
        hashes = self._span(slice(0, n - anchor + 1), slice(anchor, n + 1), 0)
        best = _window_argmin(hashes, width)[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (best[1:] != best[:-1]) | (np.diff(starts) != 1)
        at = np.flatnonzero(new)
        self.begin = starts[at]
        self.end = starts[np.append(at[1:], len(starts)) - 1] + length
        found = np.zeros(len(at), _CONTEXT)
        # The least of many hashes is small; mixed once more, anchors spread evenly over slices.
        found["anchor"] = mixed(hashes[best[at]])
        found["high"], found["low"] = (self._span(self.begin, self.end, lane) for lane in (0, 1))
        found["size"] = self.end - self.begin
        order = np.lexsort((found["low"], found["high"], found["anchor"]))
        found = found[order]
        new = np.ones(len(found), bool)
        new[1:] = ~(
            (found["anchor"][1:] == found["anchor"][:-1])
            & (found["high"][1:] == found["high"][:-1])
            & (found["low"][1:] == found["low"][:-1])
        )
        heads = np.flatnonzero(new)
        self.distinct = found[heads]
        self.distinct["count"] = np.diff(np.append(heads, len(found)))
        self.place = np.empty(len(found), np.int64)
        self.place[order] = np.cumsum(new) - 1
        self.sample = order[heads]  # one of the contexts that are the same

    def bytes_of(self, distinct: int) -> bytes:
        i = self.sample[distinct]
        return self.data[self.begin[i] : self.end[i]].tobytes()

    def strings_of(self, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """128-bit digests of each string of these contexts, and which context it is of."""
        i = self.sample[distinct]
        many = self.end[i] - self.begin[i] - self.length + 1
        of = np.repeat(np.arange(len(i)), many)
        step = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
        start = self.begin[i][of] + step
        return *(self._span(start, start + self.length, lane) for lane in (0, 1)), of


def _window_argmin(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of every ``width`` neighbouring hashes, the first if several.

    Places take the low half of the compared keys, so the hash's high half decides: the same
    way in every chunk, or equal strings could have different anchors.
    """
    mask = np.uint64(2**32 - 1)
    out = np.empty(max(0, len(hashes) - width + 1), np.int64)
    for at in range(0, len(out), BLOCK):
        part = hashes[at : at + BLOCK + width - 1]
        least = (part & ~mask) | np.arange(at, at + len(part), dtype=np.uint64)
        reach = 1  # least[i] is the smallest of as many from i on
        while reach < width:
            step = min(reach, width - reach)
            least = np.minimum(least[:-step], least[step:])
            reach += step
        out[at : at + BLOCK] = least & mask
    return out


def _sort_out(payloads: list[bytes]) -> list[bytes]:
    """For each message, a byte a context: done, send its bytes, wait, or spread its strings."""
    parts = [np.frombuffer(p, _CONTEXT) for p in payloads]
    found = np.concatenate(parts)
    order = np.lexsort((found["low"], found["high"], found["anchor"]))  # stable: chunks in order
    x = found[order]
    anchor_new, new = np.ones(len(x), bool), np.ones(len(x), bool)
    anchor_new[1:] = x["anchor"][1:] != x["anchor"][:-1]
    new[1:] = anchor_new[1:] | (x["high"][1:] != x["high"][:-1]) | (x["low"][1:] != x["low"][:-1])
    group = np.cumsum(anchor_new) - 1
    total = np.bincount(group, weights=x["count"])
    kinds = np.bincount(group, weights=new)
    code = np.where(new, _SEND, _WAIT)
    code[kinds[group] > MOST_CONTEXTS] = _SPREAD
    code[total[group] < 2] = _DONE
    out = np.empty(len(x), np.uint8)
    out[order] = code
    ends = np.cumsum([len(p) for p in parts])
    return [out[e - len(p) : e].tobytes() for p, e in zip(parts, ends)]


def _settle(payloads: list[bytes], length: int) -> list[bytes]:
    """For each message, a bit for each start of each of its contexts: whether it repeats."""
    heads, bodies = [], []
    for p in payloads:
        n = int.from_bytes(p[:4], "little")
        heads.append(np.frombuffer(p[4 : 4 + n * _CONTEXT.itemsize], _CONTEXT))
        bodies.append(p[4 + n * _CONTEXT.itemsize :])
    found = np.concatenate(heads)
    order = np.lexsort((found["low"], found["high"], found["anchor"]))
    x = found[order]
    new = np.ones(len(x), bool)
    new[1:] = (
        (x["anchor"][1:] != x["anchor"][:-1])
        | (x["high"][1:] != x["high"][:-1])
        | (x["low"][1:] != x["low"][:-1])
    )
    group = np.empty(len(x), np.int64)
    group[order] = np.cumsum(new) - 1
    weight = np.bincount(group, weights=found["count"])
    texts: list[bytes] = [b""] * len(weight)
    begin = 0
    for head, body in zip(heads, bodies):
        at = 0
        for i, size in enumerate(head["size"].tolist()):
            if size:  # only the sender's entry has its size
                texts[group[begin + i]] = body[at : at + size]
                at += size
        begin += len(head)
    anchors = x["anchor"][new]
    marks: list[np.ndarray] = [np.zeros(0, bool)] * len(texts)
    first, held = 0, 0
    for i in range(len(texts) + 1):
        done = i == len(texts)
        if done or (held > BATCH_BYTES and anchors[i] != anchors[i - 1]):
            if i > first:
                marks[first:i] = repeats(texts[first:i], weight[first:i], length)
            first, held = i, 0
        if not done:
            held += len(texts[i])
    out, begin = [], 0
    for head in heads:
        mine = [marks[g] for g in group[begin : begin + len(head)]]
        out.append(pack_bits(np.concatenate(mine)) if mine else b"")
        begin += len(head)
    return out


def _settle_spread(payloads: list[bytes]) -> list[bytes]:
    """For each message, a bit a string: whether it occurs twice in all."""
    parts = [np.frombuffer(p, np.uint64).reshape(3, -1) for p in payloads]
    high, low, count = np.concatenate(parts, axis=1)
    order = np.lexsort((low, high))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(high[order]) != 0) | (np.diff(low[order]) != 0)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    often = np.bincount(group, weights=count)[group] >= 2
    ends = np.cumsum([p.shape[1] for p in parts])
    return [pack_bits(often[e - p.shape[1] : e]) for p, e in zip(parts, ends)]


def remove_repeats(
    docs: DataFrame,
    length: int = 200,
    anchor: int = ANCHOR,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept`` (binary) of every document."""
    total = text_bytes(docs, text_col)
    chunks = chunked(docs, total, id_col, text_col, CHUNK_BYTES)
    sketch = Sketch(2 * total // (length - anchor + 2))
    bits = max(0, (total // SLICE_BYTES).bit_length())
    spread = 2**bits  # spread strings go to slices after those of the anchors

    def read(chunk: pa.Table) -> _Contexts:
        return _Contexts(chunk, length, anchor)

    def count(chunk: pa.Table, _: list[bytes]) -> Iterator[tuple[int, bytes]]:
        found = read(chunk)
        yield from sketch.question(np.repeat(found.distinct["anchor"], np.minimum(found.distinct["count"], 2)))

    def suspects(found: _Contexts, answers: list[bytes]) -> np.ndarray:
        return np.flatnonzero(sketch.repeated(found.distinct["anchor"], answers))

    def digests(chunk: pa.Table, answers: list[bytes]) -> Iterator[tuple[int, bytes]]:
        found = read(chunk)
        kept = found.distinct[suspects(found, answers)]
        for number, a, b in by_slice(kept["anchor"], bits, 64):
            yield number, kept[a:b].tobytes()

    def told(found: _Contexts, rounds: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """The suspected contexts and what is to be done with each."""
        at = suspects(found, rounds[0])
        return at, np.frombuffer(b"".join(rounds[1]), np.uint8)

    def send(chunk: pa.Table, rounds: list[list[bytes]]) -> Iterator[tuple[int, bytes]]:
        found = read(chunk)
        at, code = told(found, rounds)
        sharded = at[(code == _SEND) | (code == _WAIT)]
        sends = code[(code == _SEND) | (code == _WAIT)] == _SEND
        kept = found.distinct[sharded]
        kept["size"][~sends] = 0
        for number, a, b in by_slice(kept["anchor"], bits, 64):
            body = [found.bytes_of(i) for i in sharded[a:b][sends[a:b]]]
            yield number, _SHARD + (b - a).to_bytes(4, "little") + kept[a:b].tobytes() + b"".join(body)
        high, low, times, _, _ = spread_strings(found, at[code == _SPREAD])
        for number, a, b in by_slice(high, bits, 64):
            yield spread + number, _STRINGS + np.stack([high[a:b], low[a:b], times[a:b]]).tobytes()

    def spread_strings(found: _Contexts, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct strings of these contexts with their counts; each string's place and context."""
        if not len(at):
            none = np.zeros(0, np.uint64)
            return none, none, none, np.zeros(0, np.int64), np.zeros(0, np.int64)
        high, low, of = found.strings_of(at)
        order = np.lexsort((low, high))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(high[order]) != 0) | (np.diff(low[order]) != 0)
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        times = np.bincount(place, weights=found.distinct["count"][at][of]).astype(np.uint64)
        return high[order][new], low[order][new], times, place, of

    def act(chunk: pa.Table, rounds: list[list[bytes]]) -> pa.Table:
        found = read(chunk)
        at, code = told(found, rounds)
        many = found.distinct["size"].astype(np.int64) - length + 1
        sharded, alone = at[(code == _SEND) | (code == _WAIT)], at[code == _SPREAD]
        later = iter(rounds[2])
        bits_of = [np.zeros(0, bool)]
        for _, a, b in by_slice(found.distinct["anchor"][sharded], bits, 64):
            bits_of.append(unpack_bits(next(later), int(many[sharded[a:b]].sum())))
        high, _, _, place, _ = spread_strings(found, alone)
        often = [unpack_bits(next(later), b - a) for _, a, b in by_slice(high, bits, 64)]
        if often:
            bits_of.append(np.concatenate(often)[place])
        marks = np.concatenate(bits_of)  # of all starts of these contexts, one after another
        told_of = np.concatenate([sharded, alone])
        place_of = np.full(len(found.distinct), -1)
        place_of[told_of] = np.cumsum(many[told_of]) - many[told_of]
        here = np.flatnonzero(place_of[found.place] >= 0)
        starts = many[found.place[here]]
        step = np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts)
        repeated = marks[np.repeat(place_of[found.place[here]], starts) + step]
        hit = (np.repeat(found.begin[here], starts) + step)[repeated]
        edge = np.bincount(hit, minlength=len(found.data) + 1)
        edge -= np.bincount(hit + length, minlength=len(found.data) + 1)
        return _cut(chunk, found, np.cumsum(edge[:-1]) > 0)

    one = reply(ask(chunks, count), sketch.answer)
    two = reply(ask(chunks, digests, one), _sort_out)

    def rounds_of(answers: pa.Table, n: int) -> list[list[bytes]]:
        """Payloads of each round in slice order; rounds are marked in the slice's high bits."""
        out: list[list[bytes]] = [[] for _ in range(n)]
        if answers.num_rows:
            answers = answers.sort_by("slice")
            for number, payload in zip(
                answers.column("slice").to_pylist(), answers.column("payload").to_pylist()
            ):
                out[number >> 28].append(payload)
        return out

    def of_round(answers: DataFrame, number: int) -> DataFrame:
        return answers.withColumn("slice", F.col("slice") + (number << 28))

    both = of_round(one, 0).unionByName(of_round(two, 1))
    schema = "slice int, chunk int, payload binary"

    def sending(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        number = chunk.column("chunk")[0].as_py() if chunk.num_rows else 0
        sent = list(send(chunk, rounds_of(answers, 2))) if chunk.num_rows else []
        return pa.table(
            {
                "slice": pa.array([s for s, _ in sent], pa.int32()),
                "chunk": pa.array([number] * len(sent), pa.int32()),
                "payload": pa.array([p for _, p in sent], pa.binary()),
            }
        )

    sent = (
        chunks.groupBy("chunk")
        .cogroup(both.groupBy("chunk"))
        .applyInArrow(lambda a, b: sending(a, b), schema)
    )

    def settled(payloads: list[bytes]) -> list[bytes]:
        bodies = [p[1:] for p in payloads]  # all of a slice are of one kind
        return _settle(bodies, length) if payloads[0][:1] == _SHARD else _settle_spread(bodies)

    three = reply(sent, settled)
    rows = (
        chunks.groupBy("chunk")
        .cogroup(both.unionByName(of_round(three, 2)).groupBy("chunk"))
        .applyInArrow(
            lambda a, b: act(a, rounds_of(b, 3)),
            "id long, n_bytes long, n_removed long, n_spans long, kept binary",
        )
    )
    known = F.when(F.col("id") != LAST_ID, F.col("id")).alias(id_col)
    return rows.select(known, "n_bytes", "n_removed", "n_spans", "kept")


def _cut(chunk: pa.Table, found: _Contexts, gone: np.ndarray) -> pa.Table:
    """Each text without the bytes marked; runs never reach over a text's end."""
    offsets = found.offsets
    count = np.concatenate([[0], np.cumsum(gone)])
    opens = gone.copy()
    opens[1:] &= ~gone[:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]
    opens[edges] = gone[edges]
    spans = np.concatenate([[0], np.cumsum(opens)])
    rest = found.data[~gone].tobytes()
    kept = offsets - count[offsets]
    return pa.table(
        {
            "id": chunk.column("id"),
            "n_bytes": pa.array(np.diff(offsets), pa.int64()),
            "n_removed": pa.array(np.diff(count[offsets]), pa.int64()),
            "n_spans": pa.array(np.diff(spans[offsets]), pa.int64()),
            "kept": pa.array([rest[a:b] for a, b in zip(kept, kept[1:])], pa.binary()),
        }
    )
