"""Values of a keyed table for all the keys that rows ask for, however large the table.

Rows travel packed, in chunks of a few megabytes as they were read, whatever their ids. A chunk
sends each slice of the key space one message with its distinct keys; a slice, met by the
table's row of the same slice, answers with their values. So a key that every row has counts
once a chunk, no task holds more than a slice of the table, and nothing reaches the driver.
The table holds a slice in one row, its sorted keys and their values packed, as it is read often.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusflow.llm.rounds import ask, by_slice, finish

CHUNK_BYTES = 8_000_000
# On average a key that a chunk asks for comes with at least this many bytes of text.
BYTES_A_KEY = 10
_PACKED_ROWS = 400_000  # rows of a task that are packed at once

Keys = Callable[[pa.Table], np.ndarray]
Act = Callable[[pa.Table, np.ndarray], pa.Table]


def packed(docs: DataFrame, text_col: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``chunk, rows``: runs of whole rows; the number is a digest, and chunks may share one."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy()
            number = np.cumsum(size, dtype=np.int64) // chunk_bytes
            begins = np.flatnonzero(np.diff(number, prepend=-1))
            for a, b in zip(begins, np.append(begins[1:], batch.num_rows)):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema) as out:
                    out.write_batch(batch.slice(a, b - a))
                rows = zstandard.compress(sink.getvalue(), 1)
                name = hashlib.blake2b(rows, digest_size=4).digest()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(name, np.int32)), pa.array([rows], pa.binary())],
                    names=["chunk", "rows"],
                )

    return docs.mapInArrow(pack, "chunk int, rows binary")


def _rows(chunk: pa.Table) -> pa.Table:
    """The rows of all chunks of a number, always in the same order."""
    found = sorted(chunk.column("rows").to_pylist())
    return pa.concat_tables(pa.ipc.open_stream(zstandard.decompress(x)).read_all() for x in found)


def _planes(values: np.ndarray) -> bytes:
    """64-bit values as compressed byte planes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(planes.tobytes(), 1)


def _values(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.int64).ravel()


def _summed(key: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their values (columns x keys), those of one key added up."""
    order = np.argsort(key)
    key, values = key[order], values[:, order]
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[at], np.add.reduceat(values, at, axis=1) if len(at) else values


def _packed_slice(key: np.ndarray, values: np.ndarray) -> tuple[bytes, bytes]:
    return _planes(np.diff(key, prepend=np.uint64(0))), _planes(values)


def _unpacked_slice(keys: bytes, values: bytes) -> tuple[np.ndarray, np.ndarray]:
    key = np.cumsum(_values(keys).view(np.uint64), dtype=np.uint64)
    return key, _values(values).reshape(-1, len(key)) if len(key) else np.zeros((0, 0), np.int64)


def sliced(rows: DataFrame, bits: int) -> DataFrame:
    """``slice, keys, values``: a ``key`` and columns of longs, packed by task and slice."""
    columns = [c for c in rows.columns if c != "key"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def made() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            values = np.stack([table.column(c).to_numpy() for c in columns])
            key, values = _summed(table.column("key").to_numpy().view(np.uint64), values)
            found = [(s, *_packed_slice(key[a:b], values[:, a:b])) for s, a, b in by_slice(key, bits, 64)]
            return pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], f.type) for i, f in enumerate(_SLICE)], schema=_SLICE
            )

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= _PACKED_ROWS:
                yield made()
                held, n = [], 0
        if n:
            yield made()

    return rows.mapInArrow(pack, "slice int, keys binary, values binary")


def merged(parts: DataFrame, tell: Callable[[np.ndarray], list[int]], told: list[str]) -> DataFrame:
    """One row a slice, and what ``tell`` says of its values (keys x columns): longs named ``told``."""

    def merge(part: pa.Table) -> pa.Table:
        found = [
            _unpacked_slice(k.as_py(), v.as_py()) for k, v in zip(part.column("keys"), part.column("values"))
        ]
        key, values = _summed(*(np.concatenate(x, axis=-1) for x in zip(*found)))
        row = [part.column("slice")[0].as_py(), *_packed_slice(key, values)]
        made = [pa.array([x], f.type) for x, f in zip(row, _SLICE)]
        made += [pa.array([x], pa.int64()) for x in tell(values.T)]
        return pa.Table.from_arrays(made, names=[*_SLICE.names, *told])

    longs = "".join(f", `{c}` long" for c in told)
    return parts.groupBy("slice").applyInArrow(merge, f"slice int, keys binary, values binary{longs}")


def with_values(
    docs: DataFrame,
    text_col: str,
    table: DataFrame,
    columns: int,
    bits: int,
    keys: Keys,
    act: Act,
    schema: str | T.StructType,
) -> DataFrame:
    """``act`` on each chunk's rows and the values (keys x columns) of its sorted distinct keys.

    ``table`` is a ``merged`` one of slices by ``bits``; a key that it lacks has zeros.
    """
    chunks = packed(docs, text_col)

    def question(chunk: pa.Table, _: list[bytes]) -> Iterator[tuple[int, bytes]]:
        wanted = keys(_rows(chunk))
        for number, a, b in by_slice(wanted, bits, 64):
            yield number, _planes(np.diff(wanted[a:b], prepend=np.uint64(0)))

    def respond(messages: pa.Table, known: pa.Table) -> pa.Table:
        key, values = np.zeros(1, np.uint64), np.zeros((1, columns), np.int64)
        if known.num_rows and messages.num_rows:
            held = _unpacked_slice(known.column("keys")[0].as_py(), known.column("values")[0].as_py())
            key, values = np.append(held[0], key), np.concatenate([held[1].T, values])
        found = []
        for data in messages.column("payload"):
            wanted = np.cumsum(_values(data.as_py()).view(np.uint64), dtype=np.uint64)
            at = np.searchsorted(key[:-1], wanted)
            at[key[at] != wanted] = -1
            at[at == len(key) - 1] = -1
            found.append(_planes(values[at].T))
        return pa.table(
            {
                "slice": messages.column("slice"),
                "chunk": messages.column("chunk"),
                "payload": pa.array(found, pa.binary()),
            }
        )

    def finished(chunk: pa.Table, answers: list[bytes]) -> pa.Table:
        parts = [_values(x).reshape(columns, -1) for x in answers]
        values = np.concatenate([np.zeros((columns, 0), np.int64), *parts], axis=1)
        return act(_rows(chunk), values.T)

    answers = (
        ask(chunks, question)
        .groupBy("slice")
        .cogroup(table.select(*_SLICE.names).groupBy("slice"))
        .applyInArrow(respond, "slice int, chunk int, payload binary")
    )
    return finish(chunks, answers, finished, schema)


_SLICE = pa.schema([("slice", pa.int32()), ("keys", pa.binary()), ("values", pa.binary())])
