"""Document fingerprints: one-permutation MinHash, densified, packed to low-order bits.

Each shingle is hashed once; the hash's top bits choose a bin and each bin keeps its smallest
hash. Empty bins are filled by optimal densification: bin ``i`` asks the bins that a fixed
universal hash of (i, attempt) names, until one was filled by a shingle. Only the ``bits``
low-order bits of each bin are kept. Two unlike texts agree in a bin by chance in one of
``2**bits`` cases, which the likeness takes off again.

Defined results: texts are lower-cased (A-Z), words are runs of non-blank bytes, shingles have
five words, a shorter text is one shingle. A null or empty text has no shingle; its fingerprint
is ``""``, which is like itself (1) and unlike any other (0). Equal texts have equal
fingerprints, so repeated rows and ties need no rule. An empty table gives an empty result.
Other columns pass through; a result column replaces one of the same name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.textarrays import lowered, mixed, shingles, utf8

BINS = 256
BITS = 4
WORDS = 5
# Texts worked on at a time in a task; bounds its arrays.
BLOCK = 128


def sketches(texts: pa.Array, bins: int = BINS, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Densified bins of each text (texts x bins) and which texts have a shingle at all."""
    data, offsets = utf8(texts)
    owner, value = shingles(lowered(data), offsets, words)
    n, none = len(offsets) - 1, np.uint64(2**64 - 1)
    table = np.full(n * bins, none, np.uint64)
    shift = np.uint64(64 - (bins - 1).bit_length())
    at = owner * bins + (value >> shift).astype(np.int64) % bins
    np.minimum.at(table, at, value)
    table = table.reshape(n, bins)
    filled = table != none
    some = filled.any(axis=1)
    open_row, open_bin = np.nonzero(~filled & some[:, None])
    attempt = 0
    while len(open_row):
        attempt += 1
        asked = mixed((open_bin + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt))
        asked = (asked % np.uint64(bins)).astype(np.int64)
        got = filled[open_row, asked]
        table[open_row[got], open_bin[got]] = table[open_row[got], asked[got]]
        open_row, open_bin = open_row[~got], open_bin[~got]
    return table, some


def packed(table: np.ndarray, some: np.ndarray, bits: int = BITS) -> list[str]:
    """Hex of the low-order bits of each row's bins, ``""`` for a row without shingles.

    A hash is mixed with its bin first, so bins that were filled from one another still agree
    by chance independently; a text of a single shingle fills all bins with the same hash.
    """
    bins = mixed(np.arange(1, table.shape[1] + 1, dtype=np.uint64))
    low = (mixed(table ^ bins) & np.uint64(2**bits - 1)).astype(np.uint8)
    planes = ((low[:, :, None] >> np.arange(bits, dtype=np.uint8)) & 1).reshape(len(table), -1)
    rows = np.packbits(planes, axis=1)
    return [row.tobytes().hex() if has else "" for row, has in zip(rows, some)]


def likeness(a: Sequence[str], b: Sequence[str], bits: int = BITS) -> list[float]:
    """Estimated Jaccard likeness of paired fingerprints, chance agreement taken off."""
    out, chance = [], 0.5**bits
    for x, y in zip(a, b):
        if not x or not y:
            out.append(float(x == y))
            continue
        differ = np.frombuffer(bytes.fromhex(x), np.uint8) ^ np.frombuffer(bytes.fromhex(y), np.uint8)
        same = 1 - np.unpackbits(differ).reshape(-1, bits).any(axis=1).mean()
        out.append(float(max(0.0, (same - chance) / (1 - chance))))
    return out


def _with_columns(df: DataFrame, add: dict[str, T.DataType]) -> T.StructType:
    kept = [f for f in df.schema.fields if f.name not in add]
    return T.StructType(kept + [T.StructField(n, t) for n, t in add.items()])


def fingerprint(
    docs: DataFrame,
    text_col: str = "text",
    out_col: str = "fingerprint",
    bins: int = BINS,
    bits: int = BITS,
    words: int = WORDS,
) -> DataFrame:
    """Add the packed fingerprint (hex) of a text column; one pass, no shuffle."""
    schema = _with_columns(docs, {out_col: T.StringType()})
    names = [n for n in schema.names if n != out_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                made = packed(*sketches(part.column(text_col), bins, words), bits)
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [pa.array(made, pa.string())],
                    names=[*names, out_col],
                )

    return docs.mapInArrow(run, schema)


def with_likeness(
    df: DataFrame, left: str, right: str, out_col: str, bits: int = BITS
) -> DataFrame:
    """Add the likeness of two fingerprint columns; null where either is null."""
    schema = _with_columns(df, {out_col: T.DoubleType()})
    names = [n for n in schema.names if n != out_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(left).to_pylist(), batch.column(right).to_pylist()
            known = [x is not None and y is not None for x, y in zip(a, b)]
            found = likeness([x or "" for x in a], [y or "" for y in b], bits)
            made = pa.array([f if k else None for f, k in zip(found, known)], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [made], names=[*names, out_col]
            )

    return df.mapInArrow(run, schema)


def _key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)))


def range_heads(docs: DataFrame, id_col: str = "doc_id") -> list[int]:
    """Ids that cut a table into ranges of about equal size: three per shuffle partition."""
    ranges = 3 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    key = _key(id_col)
    found = docs.agg(F.percentile_approx(key, share, 10_000), F.max(key)).first()
    return sorted({*(found[0] or []), *([] if found[1] is None else [found[1]])})


def with_next(
    docs: DataFrame,
    id_col: str = "doc_id",
    carried: Sequence[str] = ("text",),
    act: Callable[[pa.Table], pa.Table] | None = None,
    schema: T.StructType | None = None,
    heads: Sequence[int] | None = None,
) -> DataFrame:
    """Each row's ``id``, its ``carried`` columns, and ``next_*``: those of the next row.

    ``act`` may turn each small block of such rows (ids as ``key``) into other columns, which
    ``schema`` names; it runs in the task that pairs them, so texts need not travel further.

    The order is by descending id (null last), ties by the carried columns; after the last row
    comes the first. Ids are cut into ranges at approximate quantiles, which are ids that
    occur, so a range's first row is known beforehand: it also goes to the range before it as
    the closing row there. Each row moves once, and a range streams through its task.
    ``heads`` are the ranges' first ids, if known already.
    """
    least = -(2**63)
    rows = docs.select(_key(id_col).alias("key"), *carried)
    heads = range_heads(docs, id_col) if heads is None else heads
    ascending = F.array(*[F.lit(h) for h in heads]).cast("array<bigint>")
    count = F.lit(max(1, len(heads)))
    part = F.size(F.filter(ascending, lambda h: h < F.col("key")))
    place = F.when(
        F.array_contains(ascending, F.col("key")),
        F.array(
            F.struct("part", F.lit(False).alias("closing")),
            F.struct(F.pmod(F.col("part") + 1, count).alias("part"), F.lit(True).alias("closing")),
        ),
    ).otherwise(F.array(F.struct("part", F.lit(False).alias("closing"))))
    order = [F.col(c).desc() for c in ("key", *carried)]
    placed = (
        rows.withColumn("part", part)
        .withColumn("place", F.explode(place))
        .select("place.part", "place.closing", "key", *carried)
        .repartition("part")
        .sortWithinPartitions("part", "closing", *order)
    )
    columns = ["key", *carried]
    fields = [placed.schema[c] for c in columns]
    following = [T.StructField(f"next_{c}", placed.schema[c].dataType) for c in carried]
    paired = T.StructType([*fields, *following])

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                made: list[tuple] = []
                for row in zip(
                    *(batch.column(c).to_pylist() for c in ("part", "closing", *columns))
                ):
                    if held is not None and held[0] == row[0] and not held[1]:
                        made.append((*held[2:], *row[3:]))
                    held = row
                kinds = [batch.schema.field(c).type for c in (*columns, *carried)]
                values = list(zip(*made)) if made else [()] * len(kinds)
                table = pa.table(
                    [pa.array(v, k) for v, k in zip(values, kinds)], names=paired.names
                )
                yield from (act(table) if act else table).to_batches()

    if act is not None:
        return placed.mapInArrow(pair, schema)
    known = F.when(F.col("key") != least, F.col("key")).alias("id")
    return placed.mapInArrow(pair, paired).select(known, *paired.names[1:])


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likenesses.

    The edited text has its last half (rounded down) replaced by as many first characters of
    the next document's text, or all it has. Columns: ``id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next``.
    """
    texts = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def compare(rows: pa.Table) -> pa.Table:
        own, follow = rows.column("text").to_pylist(), rows.column("next_text").to_pylist()
        edit = [t[: len(t) - len(t) // 2] + f[: len(t) // 2] for t, f in zip(own, follow)]
        prints, after = rows.column("fingerprint").to_pylist(), packed(*sketches(pa.array(edit, pa.string())))
        near = likeness(prints, after), likeness(prints, rows.column("next_fingerprint").to_pylist())
        return pa.table(
            {
                "id": rows.column("key"),
                "n_chars": pa.array([len(t) for t in own], pa.int64()),
                "edited_sha256": pa.array(
                    [hashlib.sha256(e.encode()).hexdigest() for e in edit], pa.string()
                ),
                "fingerprint": rows.column("fingerprint"),
                "edited_fingerprint": pa.array(after, pa.string()),
                "near_edited": pa.array(near[0], pa.float64()),
                "near_next": pa.array(near[1], pa.float64()),
            }
        )

    schema = T.StructType()
    for name, kind in (
        ("id", T.LongType()),
        ("n_chars", T.LongType()),
        ("edited_sha256", T.StringType()),
        ("fingerprint", T.StringType()),
        ("edited_fingerprint", T.StringType()),
        ("near_edited", T.DoubleType()),
        ("near_next", T.DoubleType()),
    ):
        schema = schema.add(name, kind)
    carried = ["text", "fingerprint"]
    heads = range_heads(docs, id_col)
    found = with_next(fingerprint(texts), id_col, carried, compare, schema, heads)
    known = F.when(F.col("id") != -(2**63), F.col("id")).alias("id")
    return found.select(known, *schema.names[1:])
