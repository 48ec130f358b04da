"""Language identification by string kernels.

The kernel of two texts is the number of distinct byte n-grams (lengths 1 to 3, A-Z lower-cased)
that occur in both, divided by the geometric mean of their own numbers: a normalised blended
spectrum of presences. Landmark texts give a Nyström map of it; kernel ridge regression, one
language against the rest, is solved on that map. A batch of whole texts is scored by two matrix
products: presences with the landmarks' presences, then with the coefficients.

The classifier is fitted on a bounded sample, ``per_label`` training rows of each language (those
with the lowest digests of their ids, a second text of an id only where ids run out), ``landmarks`` of which are landmarks; every row is scored.
What reaches the driver are the sample's sets of n-grams.

Defined results: a null text, or one without any letter, is ``und`` with score 0; so is every
text if there is nothing to learn from. Ties between languages go to the first in code point
order. Rows with a null id are never learned from. Repeated rows score alike; an empty table
gives an empty result. Other columns pass through; a result column replaces one of its name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corpusflow.llm.names import clashing, restored
from corpusflow.llm.textarrays import handed_back, kept_things, lowered, utf8

ORDERS = 3
# Codes of the n-grams of each length lie one range after another.
_FIRST = [sum(256**k for k in range(1, p)) for p in range(1, ORDERS + 2)]
_SHARPNESS = 4.0
# A text is like its language if that language's landmarks know so much of its n-grams as this
# part of what they know of all but the lowest ``_LOW`` of the language's own sample.
_LENIENCE, _LOW = 0.75, 0.05


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learned from: every fourth by CRC of the id's text; null ids too."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % 4 == 2, F.lit(True))


def grams(text: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of a text's bytes, in order, with repeats."""
    x = text.astype(np.int32)
    found, code = [x], x
    for p in range(2, ORDERS + 1):
        code = code[:-1] * 256 + x[p - 1 :]
        found.append(code + _FIRST[p - 1])
    return np.concatenate(found)


class Presence:
    """Which n-grams a text has, by a table that is never cleared between texts."""

    def __init__(self) -> None:
        self.table = np.zeros(_FIRST[ORDERS], np.int32)
        self.base = 1

    def mark(self, codes: np.ndarray) -> int:
        """Mark a text's n-grams, forgetting the text before; the number of distinct ones."""
        if self.base > 2**31 - 2 - len(codes):
            self.table[:], self.base = 0, 1
        self.start = self.base
        places = np.arange(self.base, self.base + len(codes), dtype=np.int32)
        self.table[codes] = places
        self.base += len(codes)
        return int(np.count_nonzero(self.table[codes] == places))

    def has(self, codes: np.ndarray) -> np.ndarray:
        return self.table[codes] >= self.start


@dataclass
class KernelModel:
    languages: list[str]
    vocabulary: np.ndarray  # codes of the landmarks' n-grams
    landmarks: np.ndarray  # landmarks x vocabulary, 0 or 1
    sizes: np.ndarray  # distinct n-grams of each landmark
    weights: np.ndarray  # landmarks x languages
    bias: np.ndarray
    known: np.ndarray  # vocabulary x languages, whether the language's landmarks have it
    least: np.ndarray  # share of a text's n-grams that its language must know


def _presences(sets: list[np.ndarray], vocabulary: np.ndarray) -> np.ndarray:
    return np.stack([np.isin(vocabulary, s, assume_unique=True) for s in sets]).astype(np.float32)


def fit(
    sets: list[np.ndarray], labels: list[str], landmarks: int = 32, ridge: float = 1e-2
) -> KernelModel:
    """Nyström map and one-against-rest ridge regression from sets of n-gram codes."""
    languages = sorted(set(labels))
    chosen = [i for name in languages for i in [k for k, x in enumerate(labels) if x == name][:landmarks]]
    vocabulary = np.unique(np.concatenate([sets[i] for i in chosen]))
    x, sizes = _presences(sets, vocabulary), np.array([len(s) for s in sets], np.float64)
    marks = x[chosen]
    kernel = (x @ marks.T).astype(np.float64) / np.sqrt(np.outer(sizes, sizes[chosen]))
    values, vectors = np.linalg.eigh(kernel[chosen])
    kept = values > 1e-8 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])
    mapped = kernel @ root
    middle = mapped.mean(axis=0)
    y = np.array([[1.0 if x == name else -1.0 for name in languages] for x in labels])
    centred = mapped - middle
    gram = centred.T @ centred + ridge * len(labels) * np.eye(centred.shape[1]) / 10
    solved = np.linalg.solve(gram, centred.T @ (y - y.mean(axis=0)))
    bias = y.mean(axis=0) - middle @ solved
    # A sample's n-grams that its language's landmarks, but for the text itself, know.
    named = np.array(labels)
    known, least = np.zeros((len(vocabulary), len(languages)), np.uint8), np.zeros(len(languages))
    is_mark = np.isin(np.arange(len(labels)), chosen)
    for k, name in enumerate(languages):
        own = x[named == name]
        others = own[is_mark[named == name]].sum(axis=0)
        known[:, k] = others > 0
        itself = own * is_mark[named == name][:, None]
        share = (own * (others - itself > 0)).sum(axis=1) / sizes[named == name]
        least[k] = _LENIENCE * np.quantile(share, _LOW) if len(share) > 1 else 0.0
    return KernelModel(
        languages, vocabulary, marks.astype(np.uint8), sizes[chosen], root @ solved, bias, known, least
    )


def scores(
    model: KernelModel, texts: pa.Array, presence: Presence
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the best language of each text, its score between 0 and 1, and if it is like it."""
    data, offsets = utf8(texts)
    data, n = lowered(data), len(offsets) - 1
    has, sizes = np.zeros((n, len(model.vocabulary)), np.float32), np.ones(n)
    for i in range(n):
        if offsets[i + 1] > offsets[i]:
            sizes[i] = presence.mark(grams(data[offsets[i] : offsets[i + 1]]))
            has[i] = presence.has(model.vocabulary)
    kernel = (has @ model.landmarks.T.astype(np.float32)) / np.sqrt(np.outer(sizes, model.sizes))
    found = kernel @ model.weights + model.bias
    share = np.exp(_SHARPNESS * (found - found.max(axis=1, keepdims=True)))
    best = found.argmax(axis=1)
    shared = (has @ model.known.astype(np.float32))[np.arange(n), best] / sizes
    return best, share.max(axis=1) / share.sum(axis=1), shared >= model.least[best]


def sampled(known: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows of each label, as ``label, id, place, text``, from ``id, label, text``.

    Ids come by their digests, each with one text before any has a second; equal texts of an id
    count once. So a repeated id neither exceeds the bound nor outweighs the others.
    """
    of_id = Window.partitionBy("label", "id").orderBy("digest")
    order = Window.partitionBy("label").orderBy("nth", F.xxhash64("id"), "id")
    named = known.withColumn("digest", F.xxhash64("text"))
    picked = (
        named.select("id", "label", "digest")
        .distinct()
        .withColumn("nth", F.row_number().over(of_id))
        .where(F.col("nth") <= most)
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= most)
        .drop("nth")
    )
    # At most ``most`` rows a label are broadcast; a digest is never null.
    return (
        named.join(F.broadcast(picked), ["id", "label", "digest"])
        .groupBy("label", "place")
        .agg(F.min(F.struct("id", "text")).alias("row"))
        .select("label", "row.id", "place", "row.text")
    )


def train(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_label: int = 128,
    landmarks: int = 32,
) -> KernelModel | None:
    """Fit on ``per_label`` rows of each language for which ``learn`` holds; None if none do."""
    known = docs.where(learn & F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
    sample = sampled(
        known.select(F.col(id_col).alias("id"), F.col(lang_col).alias("label"), F.col(text_col).alias("text")),
        per_label,
    )

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            data = lowered(data)
            found = [
                np.unique(grams(data[a:b])).astype(np.int32).tobytes()
                for a, b in zip(offsets, offsets[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("place"), pa.array(found, pa.binary())],
                names=["label", "place", "grams"],
            )

    rows = sample.mapInArrow(sets, "label string, place int, grams binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.label, r.place, bytes(r.grams)))
    return fit([np.frombuffer(r.grams, np.int32) for r in rows], [r.label for r in rows], landmarks)


def identify(
    docs: DataFrame, model: KernelModel | None, text_col: str = "text", recognised: bool = False
) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row; whole texts, no shuffle.

    ``recognised`` adds a column of that name: whether the text is like the language's sample,
    by the share of its n-grams that the language's landmarks know, which depends on no other
    language.
    """
    add = {"lang_pred": T.StringType(), "score": T.DoubleType()}
    if recognised:
        add["recognised"] = T.BooleanType()
    if model is None:
        none = {"lang_pred": F.lit("und"), "score": F.lit(0.0), "recognised": F.lit(False)}
        return docs.withColumns({c: none[c] for c in add})
    if others := clashing(docs, "_letters", [text_col]):
        return restored(identify(docs.withColumnsRenamed(others), model, text_col, recognised), others)
    kept = [f for f in docs.schema.fields if f.name not in add]
    names = [f.name for f in kept]
    schema = T.StructType(
        [*kept, *(T.StructField(n, t) for n, t in add.items()), T.StructField("_letters", T.BooleanType())]
    )
    letters = docs.select(*names, F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("_letters"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_things().clear()
        presence = Presence()
        for batch in handed_back(batches):
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                best, score, like = scores(model, part.column(text_col), presence)
                made = [pa.array([model.languages[b] for b in best], pa.string()), pa.array(score)]
                made += [pa.array(like)] if recognised else []
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + made + [part.column("_letters")],
                    names=schema.names,
                )

    found = letters.mapInArrow(run, schema)
    return found.select(
        *names,
        F.when(F.col("_letters"), F.col("lang_pred")).otherwise("und").alias("lang_pred"),
        F.when(F.col("_letters"), F.col("score")).otherwise(0.0).alias("score"),
        *([(F.col("_letters") & F.col("recognised")).alias("recognised")] if recognised else []),
    )
