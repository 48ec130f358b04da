"""Questions from chunks of documents to slices of a key space, and the answers back.

Some operators need to know, of each of the billions of keys in a corpus (hashes of windows,
shingles, anchors), something about the same key elsewhere. One row a key would cost far more
than the texts themselves, so keys travel in bulk: documents lie in chunks of a few megabytes by
digest of their id and text, so that no repeated or missing id fills one; a chunk sends each slice of the key space one message with its distinct
keys, packed; a slice, met by all chunks' messages, answers each with a few bits a key. So a key
that a third of all rows share counts once a chunk, chunks and slices stay at a fixed size and
only their number grows, and Spark moves, spreads and repeats the work.

Every use reads the same chunks, so the texts are shuffled once and that exchange is reused.
Nothing depends on the order of rows in a chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.textarrays import kept_things

CHUNK_BYTES = 4_000_000
SLICE_KEYS = 1_000_000
# Stands for a null id: larger than any other.
LAST_ID = 2**63 - 1

Question = Callable[[pa.Table, list[bytes]], Iterator[tuple[int, bytes]]]
Answer = Callable[[list[bytes]], list[bytes]]


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """Bytes of all texts, read once: what chunks and slices are sized by."""
    return docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def chunked(
    docs: DataFrame,
    total: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``chunk, id, text``: documents by chunk; null texts are empty, null ids ``LAST_ID``.

    Equal texts without an id are dealt by the partition they were read in as well.
    """
    chunks = max(1, -(-total // chunk_bytes))
    key = F.col(id_col).cast("long")
    salt = F.when(key.isNull(), F.spark_partition_id())
    return docs.select(
        F.pmod(F.xxhash64(key, F.col(text_col), salt), F.lit(chunks)).cast("int").alias("chunk"),
        F.coalesce(key, F.lit(LAST_ID)).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def slice_bits(keys: int) -> int:
    """How many leading bits name a slice, so that one holds about ``SLICE_KEYS`` keys."""
    return max(0, (max(1, keys // SLICE_KEYS) - 1).bit_length())


def _payloads(answers: pa.Table) -> list[bytes]:
    return answers.sort_by("slice").column("payload").to_pylist() if answers.num_rows else []


def ask(chunks: DataFrame, question: Question, answers: DataFrame | None = None) -> DataFrame:
    """Messages ``slice, chunk, payload`` from every chunk, which may see earlier answers.

    ``question`` gets a chunk's table and its answers in slice order.
    """

    def send(chunk: pa.Table, earlier: pa.Table | None = None) -> pa.Table:
        kept_things().clear()
        if not chunk.num_rows:
            return _MESSAGE.empty_table()
        number = chunk.column("chunk")[0].as_py()
        known = [] if earlier is None else _payloads(earlier)
        sent = [(s, number, p) for s, p in question(chunk, known)]
        return pa.Table.from_arrays(
            [pa.array([x[i] for x in sent], f.type) for i, f in enumerate(_MESSAGE)],
            schema=_MESSAGE,
        )

    schema = "slice int, chunk int, payload binary"
    if answers is None:
        return chunks.groupBy("chunk").applyInArrow(lambda t: send(t), schema)
    return (
        chunks.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(lambda a, b: send(a, b), schema)
    )


def reply(messages: DataFrame, answer: Answer) -> DataFrame:
    """Answers ``slice, chunk, payload``: one for each message, worked out slice by slice."""

    def respond(slice_: pa.Table) -> pa.Table:
        slice_ = slice_.sort_by("chunk")  # a repeated task must decide alike
        found = answer(slice_.column("payload").to_pylist())
        return pa.Table.from_arrays(
            [slice_.column("slice"), slice_.column("chunk"), pa.array(found, pa.binary())],
            schema=_MESSAGE,
        )

    return messages.groupBy("slice").applyInArrow(respond, "slice int, chunk int, payload binary")


def finish(
    chunks: DataFrame,
    answers: DataFrame,
    act: Callable[[pa.Table, list[bytes]], pa.Table],
    schema: str | T.StructType,
) -> DataFrame:
    """Each chunk's result from its table and its answers in slice order."""
    return (
        chunks.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(lambda a, b: act(a, _payloads(b)), schema)
    )


_MESSAGE = pa.schema([("slice", pa.int32()), ("chunk", pa.int32()), ("payload", pa.binary())])


# --- packing -----------------------------------------------------------------------------


def pack_rising(values: np.ndarray) -> bytes:
    """Sorted 32-bit values as compressed byte planes of their gaps."""
    gaps = np.diff(values.astype(np.uint32), prepend=np.uint32(0)).astype("<u4")
    return zstandard.compress(gaps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack_rising(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def pack_bits(bits: np.ndarray) -> bytes:
    return np.packbits(bits).tobytes()


def unpack_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def by_slice(keys: np.ndarray, bits: int, width: int) -> Iterator[tuple[int, int, int]]:
    """Slice number, begin and end in sorted keys of ``width`` bits, for slices that have any."""
    if not len(keys):
        return
    top = (keys >> np.uint64(width - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    at = np.flatnonzero(np.diff(top, prepend=-1))
    for begin, end in zip(at, np.append(at[1:], len(keys))):
        yield int(top[begin]), int(begin), int(end)


# --- count-min sketch over all chunks ----------------------------------------------------


class Sketch:
    """A count-min sketch of ``rows`` hash rows, spread over the slices.

    Each chunk's sketch is the set of cells its keys touch, with a mark on those touched twice
    or more; a slice adds up the chunks' sketches. A key's count is never less than its own, so
    "at most one" is certain, while "two or more" is settled by an exact pass. The number of
    cells follows the input (about four a key in each row), so the share of false alarms is
    the same at every size.
    """

    def __init__(self, keys: int, rows: int = 2):
        self.rows = rows
        self.bits = max(8, (4 * max(1, keys) - 1).bit_length())
        self.width = self.bits + (rows - 1).bit_length()
        self.slices = max(slice_bits(rows * keys), self.width - 32)

    def cells(self, hashes: np.ndarray) -> np.ndarray:
        """Cell of each hash in each row (rows x hashes)."""
        out = np.empty((self.rows, len(hashes)), np.uint64)
        for r in range(self.rows):
            turn = np.uint64(0x9E3779B97F4A7C15 * (2 * r + 1) % 2**64)
            mix = (hashes ^ (hashes >> np.uint64(29))) * turn
            out[r] = (mix >> np.uint64(64 - self.bits)) | np.uint64(r << self.bits)
        return out

    def question(self, hashes: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """Messages for the slices that a chunk's hashes touch."""
        cells, counts = np.unique(self.cells(hashes), return_counts=True)
        low = np.uint64(2 ** (self.width - self.slices) - 1)
        for number, a, b in by_slice(cells, self.slices, self.width):
            twice = pack_bits(counts[a:b] > 1)
            size = len(twice).to_bytes(4, "little")
            yield number, size + twice + pack_rising(cells[a:b] & low)

    def answer(self, payloads: list[bytes]) -> list[bytes]:
        """For each message, a bit a cell: whether it is touched twice or more in all."""
        total = np.zeros(2 ** (self.width - self.slices), np.uint8)
        read = []
        for data in payloads:
            size = int.from_bytes(data[:4], "little")
            cells = unpack_rising(data[4 + size :])
            total[cells] = np.minimum(total[cells] + 1 + unpack_bits(data[4 : 4 + size], len(cells)), 2)
            read.append(cells)
        return [pack_bits(total[cells] > 1) for cells in read]

    def repeated(self, hashes: np.ndarray, answers: list[bytes]) -> np.ndarray:
        """Which of a chunk's hashes may occur twice or more anywhere."""
        cells, place = np.unique(self.cells(hashes), return_inverse=True)
        marks = [
            unpack_bits(answers[i], b - a)
            for i, (_, a, b) in enumerate(by_slice(cells, self.slices, self.width))
        ]
        marks = np.concatenate(marks) if marks else np.zeros(0, bool)
        return marks[place.reshape(self.rows, -1)].all(axis=0)
