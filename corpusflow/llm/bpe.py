"""Byte-level BPE by prefix dynamic programming.

Every prefix of a byte string has exactly one token that can end its encoding: the token must
itself be reachable by merges, and must form a valid pair with the unique last token of the
prefix before it, meaning that the two tokens' bytes encode to just these two. Storing that one
token per prefix gives the whole encoding by walking back, lets bytes be appended without
touching what is stored, and after an edit recomputes only until the stored tokens agree again.

Defined results: a null or empty text has no tokens; texts are encoded whole, each match of the
pattern by itself, without special tokens. Any pattern, vocabulary and column names may be given.
Rows pass through one to one with their other columns, so repeated rows and ties need no rule
and an empty table gives an empty result. A result column replaces one of the same name.

The vocabulary file (a fixed, bounded table) is read on the driver and travels with the plan.
Each task streams Arrow batches; a worker's memo of pieces is bounded, goes over to its later
tasks and only saves time. It keeps pieces that came in two batches or more, as packed ids.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusflow.llm.textarrays import handed_back, kept_things, trimmed

MEMO = 100_000
_SEEN = 1 << 20  # marks of pieces that came before, by their hashes
_NEVER = 1 << 62
_SHIFT = 32

_KINDS = {
    "ids": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
    "n_tokens": (T.LongType(), pa.int64()),
    "ids_text": (T.StringType(), pa.string()),
    "decoded": (T.BinaryType(), pa.binary()),
}


class Vocabulary:
    """Tokens and ranks of a ``.tiktoken`` file, with what is known of valid pairs.

    As in any trained vocabulary, a token must rank after the parts it is merged from.
    """

    def __init__(self, content: bytes):
        lines = (line.split() for line in content.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.longest = max(map(len, self.ranks), default=1)
        self._follows: dict[int, bool] = {}  # by the left token's number, shifted, and the right's
        self._reachable: dict[int, bool] = {}
        self._spines: dict[tuple[int, int], list[tuple[int, bytes]]] = {}

    def _parts(self, data: bytes, stop: int) -> list[bytes]:
        """Plain merging, lowest rank first, until ``stop`` parts are left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > stop:
            ranks = [self.ranks.get(a + b) for a, b in zip(parts, parts[1:])]
            known = [r for r in ranks if r is not None]
            if not known:
                break
            at = ranks.index(min(known))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def reachable(self, token: int) -> bool:
        found = self._reachable.get(token)
        if found is None:
            found = self._reachable[token] = len(self._parts(self.tokens[token], 1)) == 1
        return found

    def _spine(self, token: int, side: int) -> list[tuple[int, bytes]]:
        """What lies at one edge (0 left, 1 right) of a token while it is merged, byte first."""
        found = self._spines.get((token, side))
        if found is None:
            data = self.tokens[token]
            found = [(token, data)]
            if len(data) > 1:
                part = self._parts(data, 2)[-side]
                found = self._spine(self.ranks[part], side) + found
            self._spines[token, side] = found
        return found

    def valid_pair(self, left: int, right: int) -> bool:
        """Whether two reachable tokens stay apart when their bytes are merged together.

        Follows the merges at the border in rank order. Both sides grow as they would alone;
        the pair is invalid once a merge across the border would come before the next of them.
        """
        a, b = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        while True:
            across = self.ranks.get(a[i][1] + b[j][1])
            next_a = a[i + 1][0] if i + 1 < len(a) else _NEVER
            next_b = b[j + 1][0] if j + 1 < len(b) else _NEVER
            if across is not None and across < next_a and across <= next_b:
                return False
            if next_a == next_b == _NEVER:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1

    def follows(self, left: int, right: int) -> bool:
        """Whether ``right`` may come next; ``left`` is -1 where nothing lies before."""
        found = self.reachable(right) and (left < 0 or self.valid_pair(left, right))
        if len(self._follows) >= 2 * MEMO:
            self._follows.clear()
        self._follows[left << _SHIFT | right] = found
        return found


class PrefixEncoding:
    """The encoding of a growing, editable byte string: one last token per prefix."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, data: bytes) -> None:
        start, self.data = len(self.data), self.data + data
        self._extend(start + 1, len(self.data))

    def _extend(self, begin: int, end: int, agree: Sequence[int] = ()) -> int:
        """Fill the entries of prefixes ``begin`` to ``end``.

        With ``agree``, the entries expected from ``begin`` on, stop once as many in a row
        are as expected as the longest token has bytes, and return the next prefix.
        """
        v, data, last = self.vocabulary, self.data, self.last
        ranks, longest, follows, tokens, alike = v.ranks.get, v.longest, v._follows.get, v.tokens, 0
        before = begin - 1 - len(tokens[last[begin - 1]]) if begin > 1 else 0
        for i in range(begin, end + 1):
            # Most often the token before grows by a byte; order is free, as only one fits.
            j = before
            token = ranks(data[j:i])
            if token is not None:
                ok = follows(last[j] << _SHIFT | token)
                if ok is None:
                    ok = v.follows(last[j], token)
            if token is None or not ok:
                for j in range(i - longest if i > longest else 0, i):
                    token = ranks(data[j:i])
                    if token is not None:
                        ok = follows(last[j] << _SHIFT | token)
                        if ok is None:
                            ok = v.follows(last[j], token)
                        if ok:
                            break
                else:
                    raise ValueError("a byte of the text is not in the vocabulary")
            last.append(token)
            before = j
            if agree:
                alike = alike + 1 if token == agree[i - begin] else 0
                if alike >= longest:
                    return i + 1
        return end + 1

    def become(self, data: bytes) -> None:
        """Encode other bytes, keeping the entries of the prefix both have."""
        old = self.data
        same, most = 0, min(len(old), len(data))
        while same < most and old[same] == data[same]:
            same += 1
        self.data = data
        del self.last[same + 1 :]
        self._extend(same + 1, len(data))

    def replace(self, start: int, stop: int, data: bytes) -> None:
        """Put ``data`` for the bytes from ``start`` to ``stop``; far entries are reused."""
        tail = self.last[stop + 1 :]
        self.data = self.data[:start] + data + self.data[stop:]
        del self.last[start + 1 :]
        self._extend(start + 1, start + len(data))
        first = start + len(data) + 1
        reached = self._extend(first, len(self.data), tail)
        self.last += tail[reached - first :]

    def ids(self) -> list[int]:
        out, at, tokens = [], len(self.data), self.vocabulary.tokens
        while at:
            out.append(self.last[at])
            at -= len(tokens[self.last[at]])
        return out[::-1]


class Encoder:
    """Encodes batches of texts; a memo of pieces, bounded, saves most of the work.

    Most pieces never come again: only those whose mark is set, or that share one, are kept.
    """

    def __init__(self, content: bytes, pattern: str, outputs: Sequence[str]):
        self.vocabulary, self.split = Vocabulary(content), regex.compile(pattern).findall
        self.outputs = outputs
        self.memo: dict[str, bytes] = {}  # ids of a piece, four bytes each
        self.older: dict[str, bytes] = {}
        self.seen, self.marks = bytearray(_SEEN), 0
        self.names = {i: str(i) for i in self.vocabulary.tokens} if "ids_text" in outputs else {}

    def _coded(self, data: bytes, scratch: PrefixEncoding) -> bytes:
        whole = self.vocabulary.ranks.get(data)
        if whole is not None:
            return whole.to_bytes(4, "little")
        scratch.become(data)
        return np.array(scratch.ids(), "<i4").tobytes()

    def _learn(self, pieces: set[str]) -> list[str]:
        """Sorted, so that each piece shares a long prefix with the one before; those new here."""
        scratch, new = PrefixEncoding(self.vocabulary), []
        if self.marks > _SEEN // 2:
            self.seen, self.marks = bytearray(_SEEN), 0
        for piece in sorted(pieces):
            known = self.older.get(piece)
            if known is None:
                known = self._coded(piece.encode(), scratch)
                mark = hash(piece) % _SEEN
                if not self.seen[mark]:
                    self.seen[mark] = 1
                    self.marks += 1
                    new.append(piece)
            self.memo[piece] = known
        return new

    def packed(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text, four bytes each."""
        split = [self.split(text) if text else [] for text in texts]
        pieces = set().union(*split)
        if len(self.memo) > MEMO:
            self.memo, self.older = {}, self.memo
        new = self._learn(pieces - self.memo.keys())
        get = self.memo.__getitem__
        found = [b"".join(map(get, text_pieces)) for text_pieces in split]
        for piece in new:
            del self.memo[piece]
        return found

    def columns(self, texts: Sequence[str | None]) -> list[pa.Array]:
        """For each output, its values for all texts."""
        rows = [np.frombuffer(ids, "<i4") for ids in self.packed(texts)]
        return [pa.array([_OF_IDS[o](ids, self) for ids in rows], _KINDS[o][1]) for o in self.outputs]

    def encode(self, texts: Sequence[str | None]) -> list[list]:
        """The same as Python's values."""
        return [column.to_pylist() for column in self.columns(texts)]


# What is made of a text's ids.
_OF_IDS: dict[str, Callable] = {
    "ids": lambda ids, encoder: ids,
    "n_tokens": lambda ids, encoder: len(ids),
    "ids_text": lambda ids, encoder: ",".join(map(encoder.names.__getitem__, ids.tolist())),
    "decoded": lambda ids, encoder: b"".join(map(encoder.vocabulary.tokens.__getitem__, ids.tolist())),
}


def _added(df: DataFrame, drop: Sequence[str], add: dict[str, T.DataType]) -> T.StructType:
    kept = [f for f in df.schema.fields if f.name not in {*drop, *add}]
    return T.StructType(kept + [T.StructField(n, t) for n, t in add.items()])


def _held(job: tuple, make: Callable[[], Encoder]) -> Encoder:
    """The encoder of this process, with what its memo learned in earlier tasks; one at a time,

    as memos are large.
    """
    place = kept_things()
    if job not in place:
        place.clear()
        trimmed()
        place[job] = make()
    return place[job]


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    text_col: str = "text",
    outputs: Sequence[str] = ("ids", "n_tokens"),
    keep_text: bool = False,
) -> DataFrame:
    """Encode a text column; the result has the other columns and ``outputs``.

    ``ids``: token ids; ``n_tokens``; ``ids_text``: decimal ids joined by commas; ``decoded``:
    the bytes that the ids decode to.
    """
    with open(path, "rb") as file:
        content = file.read()
    schema = _added(docs, [] if keep_text else [text_col], {o: _KINDS[o][0] for o in outputs})
    names = [n for n in schema.names if n not in outputs]

    outputs = tuple(outputs)
    job = (hashlib.md5(content).hexdigest(), pattern, outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _held(job, lambda: Encoder(content, pattern, outputs))
        for batch in handed_back(batches):
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = encoder.columns(part.column(text_col).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + made, names=[*names, *outputs]
                )
            batch = part = made = None  # not beside the next batch, which is read first

    return docs.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Turn token ids back into bytes; a null list gives null, a null id is an error."""
    with open(path, "rb") as file:
        content = file.read()
    schema = _added(df, [], {out_col: T.BinaryType()})
    names = [n for n in schema.names if n != out_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Vocabulary(content).tokens
        for batch in batches:
            found = [
                None if ids is None else b"".join([tokens[i] for i in ids])
                for ids in batch.column(ids_col).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(found, pa.binary())],
                names=[*names, out_col],
            )

    return df.mapInArrow(run, schema)
