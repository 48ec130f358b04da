"""Substring deduplication by words: a count-min prefilter, then exact grouping.

A window is ``size`` neighbouring words of one document. Windows that also start in a document
of a smaller id are removed, that is every word they cover; all windows are judged on the input.

1. Each chunk sends its count-min sketch of window hashes; merged, the sketches never
   underestimate, so a window estimated to occur once cannot be repeated and goes no further.
2. Windows estimated repeated are grouped exactly, by 128-bit hashes of their words: a chunk
   sends each with its smallest id there, and learns whether another chunk has a smaller one.
3. Each chunk marks the covered words and rebuilds its texts.

Defined results: words are runs of bytes other than blanks, unchanged; a null or empty text has
none. Rows that share an id are one document (neither is smaller). Null ids count as the largest
and are given back as null. A text shorter than a window loses nothing. An empty table gives an
empty result. Only the id and text column are read, so other columns cannot clash.
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
    finish,
    pack_bits,
    reply,
    slice_bits,
    text_bytes,
    unpack_bits,
)
from corpusflow.llm.textarrays import run_hashes, runs_inside, utf8, word_hashes, words

# On average a word and the blank after it take at least this many bytes.
_BYTES_A_WORD = 4


class _Windows:
    """All windows of a chunk: hashes, first words and ids."""

    def __init__(self, chunk: pa.Table, size: int):
        self.size = size
        self.ids = chunk.column("id").to_numpy()
        self.data, self.offsets = utf8(chunk.column("text"))
        self.starts, self.ends, self.first = words(self.data, self.offsets)
        hashes = word_hashes(self.data, self.starts, self.ends)
        high, low = run_hashes(hashes, size, 0), run_hashes(hashes, size, 1)
        self.at = np.flatnonzero(runs_inside(self.first, size, len(high)))
        self.high, self.low = high[self.at], low[self.at]
        self.owner = np.repeat(np.arange(len(self.ids)), np.diff(self.first))[self.at]

    def only(self, keep: np.ndarray) -> None:
        self.at, self.high, self.low = self.at[keep], self.high[keep], self.low[keep]
        self.owner = self.owner[keep]

    def grouped(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct windows in order: both hash halves and smallest id; each window's place."""
        order = np.lexsort((self.low, self.high))
        high, low = self.high[order], self.low[order]
        new = np.ones(len(order), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        begins = np.flatnonzero(new)
        least = np.minimum.reduceat(self.ids[self.owner[order]], begins) if len(begins) else self.ids[:0]
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        return high[begins], low[begins], least, place


def _smallest(payloads: list[bytes]) -> list[bytes]:
    """For each message, a bit a window: whether another message has a smaller id for it."""
    parts = [np.frombuffer(p, np.uint64).reshape(3, -1) for p in payloads]
    high, low, ids = np.concatenate(parts, axis=1)
    ids = ids.view(np.int64)
    order = np.lexsort((low, high))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(high[order]) != 0) | (np.diff(low[order]) != 0)
    begins = np.flatnonzero(new)
    least = np.empty(len(order), np.int64)
    least[order] = np.minimum.reduceat(ids[order], begins)[np.cumsum(new) - 1]
    smaller = least < ids
    ends = np.cumsum([p.shape[1] for p in parts])
    return [pack_bits(smaller[e - p.shape[1] : e]) for p, e in zip(parts, ends)]


def joined(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kept: np.ndarray, first: np.ndarray
) -> pa.Array:
    """The kept words of each text, joined by one blank."""
    a, b = starts[kept], ends[kept]
    places = np.concatenate([[0], np.cumsum(b - a + 1)])  # each word with a blank after it
    out = np.append(data, np.uint8(32))[
        np.repeat(a - places[:-1], b - a + 1) + np.arange(places[-1])
    ]
    out[places[1:] - 1] = 32
    counts = np.concatenate([[0], np.cumsum(kept)])[first]  # kept words before each text
    begin = places[counts[:-1]]
    end = np.where(counts[1:] > counts[:-1], places[counts[1:]] - 1, begin)
    whole = out.tobytes()
    return pa.array([whole[x:y] for x, y in zip(begin, end)], pa.binary()).cast(pa.string())


def deduplicate(
    docs: DataFrame, size: int = 13, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, n_words, n_removed, kept_text`` of every document."""
    total = text_bytes(docs, text_col)
    chunks = chunked(docs, total, id_col, text_col)
    keys = total // _BYTES_A_WORD
    sketch, bits = Sketch(keys), slice_bits(keys)

    def count(chunk: pa.Table, _: list[bytes]) -> Iterator[tuple[int, bytes]]:
        yield from sketch.question(_Windows(chunk, size).high)

    def suspects(chunk: pa.Table, answers: list[bytes]) -> Iterator[tuple[int, bytes]]:
        found = _Windows(chunk, size)
        found.only(sketch.repeated(found.high, answers))
        high, low, least, _ = found.grouped()
        # Whether a window was kept here is needed again with the exact answers.
        for number, a, b in by_slice(high, bits, 64):
            yield number, np.stack([high[a:b], low[a:b], least[a:b].view(np.uint64)]).tobytes()

    counted = reply(ask(chunks, count), sketch.answer)
    exact = reply(ask(chunks, suspects, counted), _smallest)
    # Both kinds of answers go to the last step, told apart by the sign of the slice.
    both = counted.withColumn("slice", -F.col("slice") - 1).unionByName(exact)

    def remove(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        found = _Windows(chunk, size)
        ours = answers.sort_by("slice")
        number = ours.column("slice").to_numpy() if ours.num_rows else np.zeros(0, np.int32)
        payload = ours.column("payload").to_pylist() if ours.num_rows else []
        first_round = [payload[i] for i in np.flatnonzero(number < 0)[::-1]]
        found.only(sketch.repeated(found.high, first_round))
        high, _, least, place = found.grouped()
        later = payload[len(first_round) :]
        smaller = np.zeros(len(high), bool)
        for data, (_, a, b) in zip(later, by_slice(high, bits, 64)):
            smaller[a:b] = unpack_bits(data, b - a)
        gone = smaller[place] | (found.ids[found.owner] > least[place])
        edge = np.zeros(len(found.starts) + 1, np.int32)
        np.add.at(edge, found.at[gone], 1)
        np.add.at(edge, found.at[gone] + size, -1)
        covered = np.cumsum(edge[:-1]) > 0
        before = np.concatenate([[0], np.cumsum(covered)])[found.first]
        return pa.table(
            {
                "id": chunk.column("id"),
                "n_words": pa.array(np.diff(found.first), pa.int64()),
                "n_removed": pa.array(np.diff(before), pa.int64()),
                "kept_text": joined(found.data, found.starts, found.ends, ~covered, found.first),
            }
        )

    rows = (
        chunks.groupBy("chunk")
        .cogroup(both.groupBy("chunk"))
        .applyInArrow(
            lambda a, b: remove(a, b),
            "id long, n_words long, n_removed long, kept_text string",
        )
    )
    known = F.when(F.col("id") != LAST_ID, F.col("id")).alias(id_col)
    return rows.select(known, "n_words", "n_removed", "kept_text")
